"""Secret scans over an incremental blob ledger.

Every version of a text is addressed by its SHA-256. The ledger keeps which blobs were scanned by which version
of which rule, and what was found; a scan reads only the pairs it has not seen, each blob once however many rows
hold it. Findings are joined back to all rows that hold the blob.

    <path>/findings/    blob, kind, version, start, end (code points, end exclusive)
    <path>/scanned/     blob, rules scanned ("kind@version")

Findings are written first: after a break in between, the blob is scanned again and readers drop the repeats.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candlewick.llm.text import matches


class Rule(NamedTuple):
    kind: str
    version: int
    pattern: str
    # The group whose length decides, and its least length; shorter matches are dropped after matching.
    group: int = 0
    least: int = 0


ASSIGN = (
    r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE = (
    Rule("assign", 1, ASSIGN, 1, 6),
    # A run that is too short has no shorter match inside that is long enough.
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
ADDED = (
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", 2, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + ADDED
_FINDING = "blob string, kind string, version int, start long, end long"
_SCANNED = "blob string, rules array<string>"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _name(rule: Rule) -> str:
    return f"{rule.kind}@{rule.version}"


def _table(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of a ledger table; none before its first write."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def _raw_matches(rule: Rule) -> Column:
    """struct(gap, size, good) of each match: the code points before it since the last one, and its own."""
    text, name = F.col("text"), _name(rule)
    found, value = matches(text, rule.pattern), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    pieces = F.zip_with(
        F.arrays_zip(found.alias("whole"), value.alias("value")), F.split(text, rule.pattern, -1),
        lambda match, gap: F.struct(
            F.length(gap).cast("long").alias("gap"), F.length(match["whole"]).cast("long").alias("size"),
            (F.length(match["value"]) >= rule.least).alias("good"),
        ),
    )
    asked = F.array_contains("needed", name) & text.rlike(rule.pattern)
    # The last gap has no match after it.
    return F.when(asked, F.filter(pieces, lambda piece: piece["size"].isNotNull()))


def scan(documents: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger at `path` has not seen; returns the findings of `rules` per blob.

    The result has `blob, spans` with sorted struct(start, order, kind, end) where `order` is the place of the
    rule in `rules`; blobs without findings have no row. NULL text counts as empty. Only `text` is read.
    """
    spark = documents.sparkSession
    names = [_name(rule) for rule in rules]
    texts = documents.select(blob_of(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    seen = _table(spark, f"{path}/scanned", _SCANNED).select("blob", F.explode("rules").alias("rule"))
    known = seen.where(F.col("rule").isin(names)).groupBy("blob").agg(F.collect_set("rule").alias("known"))
    wanted = F.array(*map(F.lit, names))
    needed = F.array_except(wanted, F.coalesce("known", F.array().cast("array<string>")))
    # Copies are dropped within each task first, so a task sends a text once, however many rows share it.
    blobs = texts.dropDuplicates(["blob"])
    pending = blobs.join(known, "blob", "left").withColumn("needed", needed).where(F.size("needed") > 0)
    by_rule = F.array(*[
        F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), _raw_matches(rule).alias("found"))
        for rule in rules
    ])
    each = pending.select("blob", F.explode(by_rule).alias("r")).where(F.size("r.found") > 0)
    placed = each.select("blob", "r.kind", "r.version", F.posexplode("r.found").alias("at", "m"))
    before = Window.partitionBy("blob", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ends = placed.withColumn("end", F.sum(F.col("m.gap") + F.col("m.size")).over(before)).where("m.good")
    findings = ends.select("blob", "kind", "version", (F.col("end") - F.col("m.size")).alias("start"), "end")
    findings.write.mode("append").parquet(f"{path}/findings")
    # Listed from the narrow digests alone, not from the texts again.
    marked = texts.select("blob").distinct().join(known, "blob", "left").withColumn("rules", needed)
    marked.where(F.size("rules") > 0).select("blob", "rules").write.mode("append").parquet(f"{path}/scanned")
    return found(spark, path, rules)


def found(spark: SparkSession, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    listed = F.array(*[F.lit(rule.kind) for rule in rules])
    current = _table(spark, f"{path}/findings", _FINDING).where(
        F.concat_ws("@", "kind", "version").isin([_name(rule) for rule in rules])
    )
    span = F.struct("start", F.array_position(listed, F.col("kind")).alias("order"), "kind", "end")
    return current.groupBy("blob").agg(F.sort_array(F.collect_set(span)).alias("spans"))


def _told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secrets(documents: DataFrame, path: str) -> DataFrame:
    """One row for each document row: counts and spans of its secrets, by way of the ledger at `path`.

    Columns `doc_id, n_assign, n_access, n_hex, base_sha256, spans`. NULL and empty texts have none; rows that
    share a text, or a whole row, each get its findings; a NULL id stays.
    """
    blobs = scan(documents.select("text"), path)
    base = F.filter("spans", lambda span: span["order"] <= len(BASE))
    count = lambda kind: F.size(F.filter("spans", lambda span: span["kind"] == kind)).cast("long")
    told = blobs.select(
        F.col("blob").alias("found_blob"), *[count(rule.kind).alias(f"n_{rule.kind}") for rule in BASE],
        _told(base).alias("base"), _told(F.col("spans")).alias("told"),
    )
    held = documents.select("doc_id", blob_of(F.col("text")).alias("blob"))
    joined = held.join(told, F.col("blob") == F.col("found_blob"), "left")
    return joined.select(
        "doc_id", *[F.coalesce(f"n_{rule.kind}", F.lit(0)).cast("long").alias(f"n_{rule.kind}") for rule in BASE],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("told", F.lit("")).alias("spans"),
    )
