"""Benchmark decontamination: documents are scanned for the word windows of test items.

A document does not look up every window. A window of 13 words holds exactly one of the runs of 8 words that begin
at every 6th word of a text, so these runs are hashed and looked up; the hash set has the 6 runs of every window
that may be the one. Where the set is small it is broadcast whole; beyond `most_windows` it is broadcast in blocks of
that size, each against all documents, so a task never holds more. Where hashes agree the whole window is compared
word by word. Documents pass a shuffle as id, digest and word count; texts do not.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.llm.text import ascii_lower, between, carried, covered, fenced, own_columns, sent
from candlewick.session import stored

WINDOW = 13
# What lies between words; lower-casing A-Z does not move it.
APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MOST_WINDOWS = 40_000
# Contaminated documents that are broadcast, as id and digest.
BROADCAST_DIGESTS = 500_000
# A document is contaminated if at least this share of its words is hit.
SHARE = 20


def item_words(text: Column) -> Column:
    return between(ascii_lower(text), APART)


def benchmark_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """`window, items, len` of every different window; an item of fewer words is one window.

    Items without an id or without words have none. Items that repeat are counted once.
    """
    worded = items.select(F.col("item_id").cast("string").alias("item"), item_words(F.col("text")).alias("words"))
    worded = worded.where(F.col("item").isNotNull() & (F.size("words") > 0)).distinct()
    count = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(count - size + 1, F.lit(1)))
    windows = worded.select("item", F.explode(F.transform(starts, lambda at: F.slice("words", at, size))).alias("window"))
    return windows.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items")).withColumn("len", F.size("window"))


def run_and_step(size: int) -> tuple[int, int]:
    """Length of the runs looked up for windows of `size` words, and the distance between their starts."""
    run = min(size, size // 2 + 2)
    return run, size - run + 1


def _runs(words: str, size: int, start: int, step: int) -> Column:
    """struct(at, hash) of the runs for windows of `size` words, from place `start` on."""
    run, _ = run_and_step(size)
    last = F.size(words) - run + 1
    return F.when(last >= start, F.transform(
        F.sequence(F.lit(start), last, F.lit(step)),
        lambda at: F.struct(at.alias("at"), F.xxhash64(F.slice(words, at, run)).alias("hash")),
    ))


def hits(documents: DataFrame, items: DataFrame, size: int = WINDOW, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """`doc_id, digest, n_words, spans, items` of documents with a window of an item.

    `spans` are the verified places, struct(pos, len) in words from 1; `digest` is the SHA-256 of the text, so
    that rows which share an id but not a text stay apart.
    """
    windows = stored(benchmark_windows(items, size), "windows")
    kinds = windows.groupBy("len").count().collect()  # at most `size` rows
    if not kinds:
        kinds = [(size, 0)]
    lengths, total = sorted(kind[0] for kind in kinds), sum(kind[1] for kind in kinds)
    blocks = max(1, math.ceil(total / most_windows))
    # Every run of a window, and of a document those that begin at each step.
    of_window = F.coalesce(*[F.when(F.col("len") == n, _runs("window", n, 1, 1)) for n in lengths])
    single = windows.withColumn("r", F.explode(of_window)).select(
        F.col("r.hash").alias("hash"), F.col("r.at").alias("ahead"), "len", "window", "items"
    )
    words = documents.select("doc_id", F.sha2(F.col("text"), 256).alias("digest"), item_words(F.col("text")).alias("found"))
    own = fenced(words, "words", F.col("found"))
    of_text = F.array(*[
        F.struct(F.lit(n).alias("len"), _runs("words", n, 1, run_and_step(n)[1]).alias("runs")) for n in lengths
    ])
    own = own.select("doc_id", "digest", "words", F.explode(of_text).alias("r"))
    places = own.select("doc_id", "digest", "words", F.col("r.len").alias("len"), F.explode("r.runs").alias("p"))
    places = places.select("doc_id", "digest", "words", "len", "p.at", "p.hash")
    found = None
    for block in range(blocks):
        chosen = single if blocks == 1 else single.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block)
        joined = places.join(F.broadcast(chosen), ["hash", "len"]).withColumn("pos", F.col("at") - F.col("ahead") + 1)
        inside = joined.where((F.col("pos") >= 1) & (F.col("pos") + F.col("len") - 1 <= F.size("words")))
        # Behind the fence, so that the words are compared where the hashes agree and do not become a join key.
        verified = fenced(inside, "own", F.slice("words", F.col("pos"), F.col("len"))).where("own = window")
        part = verified.select("doc_id", "digest", F.size("words").alias("n_words"), F.struct("pos", "len").alias("span"), "items")
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "digest", "n_words").agg(
        F.sort_array(F.collect_set("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def _found(documents: DataFrame, items: DataFrame, size: int, most_windows: int, prefix: str) -> DataFrame:
    """The hits of the documents, all columns named with the prefix."""
    found = hits(documents.select("doc_id", "text"), items.select("item_id", "text"), size, most_windows)
    return found.select(*[F.col(name).alias(prefix + name) for name in found.columns])


def _same(documents: DataFrame, found: DataFrame, prefix: str) -> Column:
    return documents["doc_id"].eqNullSafe(found[prefix + "doc_id"]) & (documents["digest"] == found[prefix + "digest"])


def _count(text: Column) -> Column:
    """How many words; lower-casing does not change it."""
    return F.size(between(text, APART))


def contamination(
    documents: DataFrame, items: DataFrame, size: int = WINDOW, most_windows: int = MOST_WINDOWS
) -> DataFrame:
    """One row for each document row: `doc_id, n_words, n_hit, n_items, items, contaminated`.

    NULL or empty text has no words and is never contaminated; rows with a NULL id are judged like others;
    repeated rows get the same answer each. Columns other than `doc_id` and `text` are ignored.
    """
    documents = documents.select("doc_id", "text")
    found = _found(documents, items, size, most_windows, "hit_")
    # Texts are counted before the join, which carries a digest in their place.
    narrow = documents.select(
        "doc_id", F.sha2("text", 256).alias("digest"), F.coalesce(_count(F.col("text")), F.lit(0)).cast("long").alias("n_words")
    )
    counted = narrow.join(found, _same(narrow, found, "hit_"), "left").select(
        "doc_id", "n_words",
        F.coalesce(F.expr(covered("hit_spans")), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("hit_items", F.array().cast("array<string>")).alias("items"),
    )
    return counted.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        ((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(
    documents: DataFrame, items: DataFrame, spans: bool = False, size: int = WINDOW, most_windows: int = MOST_WINDOWS
) -> DataFrame:
    """The documents, all columns kept whatever they are called, without the contaminated ones.

    With `spans`, no document goes: the words that are hit are cut out of every text instead, and the text
    between words stays. Rows without text pass unchanged; rows that repeat id and text are judged alike.
    """
    prefix = "decontaminate_hit_"
    found = _found(documents, items, size, most_windows, prefix)
    spans_name = prefix + "spans"
    told = carried(documents, "doc_id", "text").withColumn("digest", F.sha2("text", 256)).drop("text")
    if not spans:
        # Stored, so that its size is known: up to many contaminated documents are broadcast, and texts not shuffled.
        gone = stored(found.where(SHARE * F.expr(covered(spans_name)) >= F.col(prefix + "n_words")).select(
            prefix + "doc_id", prefix + "digest"
        ), "contaminated")
        return told.join(sent(gone, BROADCAST_DIGESTS), _same(told, gone, prefix), "left_anti").select(*own_columns(documents))
    joined = told.join(found, _same(told, found, prefix), "left").drop(prefix + "doc_id", prefix + "digest")
    text = F.col("carried.text")
    # An empty piece at an end means that the text begins or ends with a gap.
    pieces = fenced(joined, prefix + "pieces", F.split(text, APART, -1))
    gaps = F.regexp_extract_all(text, F.lit(APART), F.lit(0))
    skipped = F.when(F.get(prefix + "pieces", F.lit(0)) == "", 0).otherwise(1)
    apart = fenced(fenced(pieces, prefix + "gaps", gaps), prefix + "skipped", skipped)
    rest = F.expr(
        f"array_join(transform({prefix}pieces, (w, i) -> concat("
        f"if(exists({spans_name}, s -> i + {prefix}skipped >= s.pos AND i + {prefix}skipped < s.pos + s.len), '', w), "
        f"coalesce(get({prefix}gaps, i), ''))), '')"
    )
    cut = apart.withColumn(prefix + "text", F.when(F.col(spans_name).isNull(), text).otherwise(rest))
    return cut.select(*own_columns(documents, text=F.col(prefix + "text")))
