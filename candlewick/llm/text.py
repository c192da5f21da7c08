"""Expressions that several text operators share."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Runs of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


# Keys of so many rows are broadcast, so that texts need not be shuffled to meet them.
BROADCAST_KEYS = 1_000_000


def sent(keys: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """Stored keys to join with: broadcast up to so many rows, whatever Spark's own limit, by shuffle beyond."""
    return F.broadcast(keys) if keys.count() <= most else keys


_CARRIED = "carried"


def carried(documents: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and all of the document in one struct, where no working column can clash with its own."""
    every = F.struct(*[F.col(f"`{name}`") for name in documents.columns])
    return documents.select(every.alias("own")).select(F.col("own").alias(_CARRIED), *[F.col("own")[name].alias(name) for name in needed])


def own_columns(documents: DataFrame, **changed: Column) -> list[Column]:
    """The document's own columns out of the struct, some of them replaced."""
    return [changed.get(name, F.col(_CARRIED)[name]).alias(name) for name in documents.columns]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; pure ASCII takes the faster way."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def between(text: Column, separators: str) -> Column:
    """The non-empty pieces between runs of the separators: the words, and several times faster than matching them."""
    return F.filter(F.split(text, separators, -1), lambda piece: piece != "")


def fenced(rows: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a column that is computed once for each row.

    Catalyst neither moves a filter below a generator nor copies what it makes into the lambdas that use it, where
    it would be computed again for each element.
    """
    return rows.select("*", F.explode(F.array(column)).alias(name))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def with_windows(rows: DataFrame, hashes: str, sizes: list[int], prefix: str) -> DataFrame:
    """Add for each size an array column `<prefix><size>`: one hash for each run of so many items, by place.

    Hashes of 2, 4, 8 items are made from pairs of the shorter ones, so a run costs a few steps, not its size.
    """
    powers, power = {1: hashes}, 1
    while 2 * power <= max(sizes):
        rows = fenced(rows, f"{prefix}power{2 * power}", _joined(powers[power], powers[power], power))
        power *= 2
        powers[power] = f"{prefix}power{power}"
    for size in sizes:
        parts, at = [], 0
        for power in sorted(powers, reverse=True):
            if size - at >= power:
                parts.append((powers[power], at))
                at += power
        run = F.col(parts[0][0])
        if len(parts) > 1:
            run = F.transform(parts[0][0], lambda first, i: F.xxhash64(
                first, *[F.get(F.col(name), i + ahead) for name, ahead in parts[1:]]
            ))
        whole = F.size(hashes) - size + 1
        rows = fenced(rows, f"{prefix}{size}", F.when(whole > 0, F.slice(run, 1, whole)).otherwise(
            F.array().cast("array<bigint>")
        ))
    return rows.drop(*[name for power, name in powers.items() if power > 1])


def _joined(left: str, right: str, ahead: int) -> Column:
    return F.transform(left, lambda first, i: F.xxhash64(first, F.get(F.col(right), i + ahead)))


def covered(ends: str) -> str:
    """SQL: how many places the sorted spans struct(pos, len) in column `ends` cover together."""
    return (
        f"aggregate({ends}, struct(0 as upto, 0 as n), (a, s) -> struct("
        "greatest(a.upto, s.pos + s.len - 1) as upto, "
        "a.n + greatest(0, s.pos + s.len - 1 - greatest(a.upto, s.pos - 1)) as n), a -> a.n)"
    )
