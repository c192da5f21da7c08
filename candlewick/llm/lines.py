"""Line dedup: lines that many documents share go from all of them.

Counting shuffles one row for each task and different line hash. The hashes found often enough are indexed by
sharded minimal perfect hashes over compact fingerprint and count arrays, and documents probe these arrays; texts
and lines are never joined or shuffled. The index is broadcast if it is small; beyond `most_bytes`, blocks of its
shards are broadcast one after the other, each probed by all documents; their counts are stored with the documents
before the next block is sent, so executors hold one block at a time and each block costs one more copy of the documents.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_128_digest

from candlewick.llm.phash import PerfectHash
from candlewick.llm.text import carried, fenced, own_columns
from candlewick.session import stored

LEAST_DOCUMENTS = 10
SHARD_KEYS = 50_000
MOST_BYTES = 64 << 20
_WORK = "lines_work_"
_BLANKS = b" \t\n\x0b\f\r"
_NONE = bytes(16)
_SHARD = "shard long, sizes array<long>, bits binary, prints binary, counts binary"


def _line_hashes(texts: pa.Array, least_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each text's lines end, and the two 64-bit hashes of every line's key; 0 where the key is too short."""
    ends, prints = [0], []
    for text in texts.to_pylist():
        # Lower-casing and stripping bytes touches ASCII only.
        lines = (text or "").encode().lower().split(b"\n")
        ends.append(ends[-1] + len(lines))
        for line in lines:
            key = line.strip(_BLANKS)
            long_enough = len(key) >= least_chars and (least_chars <= 1 or len(key.decode()) >= least_chars)
            prints.append(xxh3_128_digest(key) if long_enough else _NONE)
    pairs = np.frombuffer(b"".join(prints), np.int64).reshape(-1, 2)
    return np.array(ends, np.int32), np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])


def _lists(ends: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def line_counts(documents: DataFrame, least_documents: int, least_chars: int = 1) -> DataFrame:
    """`first, second, documents` of the line keys that at least so many documents have."""

    @F.arrow_udf("array<struct<first:bigint,second:bigint>>")
    def keys(texts: pa.Array) -> pa.Array:
        ends, first, second = _line_hashes(texts, least_chars)
        return _lists(ends, pa.StructArray.from_arrays([pa.array(first), pa.array(second)], ["first", "second"]))

    lines = documents.select(F.explode(F.array_distinct(keys("text"))).alias("line")).select("line.*")
    counted = lines.where("first <> 0 OR second <> 0").groupBy("first", "second").agg(F.count(F.lit(1)).alias("documents"))
    return counted.where(F.col("documents") >= least_documents)


def _build(keys: pa.Table) -> pa.Table:
    first, second = (keys[name].to_numpy().astype(np.int64).view(np.uint64) for name in ("first", "second"))
    table = PerfectHash.build(first, second)
    slots = table.slots(first, second)
    prints, counts = np.zeros(len(first), np.uint64), np.zeros(len(first), np.uint32)
    prints[slots] = second
    counts[slots] = np.minimum(keys["documents"].to_numpy(), 2**32 - 1)
    return pa.table({
        "shard": pa.array([keys["shard"][0].as_py()], pa.int64()), "sizes": pa.array([table.sizes], pa.list_(pa.int64())),
        "bits": [table.pack()], "prints": [prints.tobytes()], "counts": [counts.tobytes()],
    })


def line_index(counts: DataFrame) -> tuple[DataFrame, int]:
    """The shards over counted line hashes, each of about SHARD_KEYS keys, and how many there can be."""
    kept = stored(counts, "line-counts")
    shards = max(1, math.ceil(kept.count() / SHARD_KEYS))
    dealt = kept.withColumn("shard", F.pmod("first", F.lit(shards)))
    return stored(dealt.groupBy("shard").applyInArrow(_build, _SHARD), "line-index"), shards


class Probe:
    """Broadcast shards, opened once in each worker."""

    def __init__(self, shards: int, rows: list):
        self.shards, self.rows, self.opened = shards, rows, None

    def open(self) -> dict:
        if self.opened is None:
            self.opened = {
                row["shard"]: (
                    PerfectHash.unpack(row["sizes"], bytes(row["bits"])),
                    np.frombuffer(row["prints"], np.uint64), np.frombuffer(row["counts"], np.uint32),
                )
                for row in self.rows
            }
        return self.opened

    def counts(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        found = np.zeros(len(first), np.int64)
        shard = np.mod(first, self.shards)
        a, b = first.view(np.uint64), second.view(np.uint64)
        for number, (table, prints, counts) in self.open().items():
            chosen = np.flatnonzero(shard == number) if self.shards > 1 else np.arange(len(first))
            slots = table.slots(a[chosen], b[chosen])
            chosen, slots = chosen[slots >= 0], slots[slots >= 0]
            same = prints[slots] == b[chosen]
            found[chosen[same]] = counts[slots[same]]
        return found


def _probe(block, least_chars: int):
    @F.arrow_udf("array<bigint>")
    def probed(texts: pa.Array) -> pa.Array:
        ends, first, second = _line_hashes(texts, least_chars)
        return _lists(ends, pa.array(block.value.counts(first, second)))

    return probed


def _blocks(index: DataFrame, most_bytes: int):
    """Lists of shards of at most so many bytes together (or one shard)."""
    size = F.length("bits") + F.length("prints") + F.length("counts")
    listed = sorted(index.select("shard", size.alias("size")).collect())
    block, held = [], 0
    for row in listed:
        if block and held + row["size"] > most_bytes:
            yield block
            block, held = [], 0
        block.append(row["shard"])
        held += row["size"]
    yield block


def with_line_counts(
    documents: DataFrame, least_documents: int = LEAST_DOCUMENTS, least_chars: int = 1, most_bytes: int = MOST_BYTES
) -> DataFrame:
    """The documents with `lines_work_counts`: for each line in how many documents it is, 0 if in too few."""
    spark = documents.sparkSession
    index, shards = line_index(line_counts(documents, least_documents, least_chars))
    blocks = list(_blocks(index, most_bytes))
    counts, rows = F.col(_WORK + "counts"), documents
    for number, block in enumerate(blocks):
        chosen = index.where(F.col("shard").isin(block)).collect() if block else []
        sent = spark.sparkContext.broadcast(Probe(shards, [row.asDict() for row in chosen]))
        part = _probe(sent, least_chars)(F.col("text"))
        if len(blocks) == 1:
            return fenced(documents, _WORK + "counts", part)
        # Stored before the next block is sent, so that workers hold one at a time.
        found = part if not number else F.zip_with(counts, part, lambda a, b: F.greatest(a, b))
        rows = stored(rows.withColumn(_WORK + "counts", found), "line-block")
        sent.destroy()
    return rows


def dedup_lines(documents: DataFrame, least_documents: int = LEAST_DOCUMENTS, **options) -> DataFrame:
    """The documents with `text` without its common lines, and `lines_work_n`, `lines_work_dropped`.

    A line's key is the line without ASCII blanks at its ends and with A-Z lower-cased; keys in at least
    `least_documents` rows lose all their lines. Every row counts as a document, also a repeated one. NULL or empty
    text is one empty line and stays empty; a text that loses all lines becomes empty. Blank lines stay.
    """
    counted = with_line_counts(documents, least_documents, **options)
    split = counted.withColumn(_WORK + "lines", F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1))
    common = F.filter(_WORK + "counts", lambda count: count >= least_documents)
    kept = F.expr(f"filter({_WORK}lines, (line, i) -> {_WORK}counts[i] < {int(least_documents)})")
    return split.withColumns({
        _WORK + "n": F.size(_WORK + "lines").cast("long"),
        _WORK + "dropped": F.size(common).cast("long"),
        "text": F.array_join(kept, "\n"),
    }).drop(_WORK + "lines", _WORK + "counts")


def line_digests(documents: DataFrame) -> DataFrame:
    """`doc_id, n_lines, n_dropped, kept_sha256` of every document row."""
    rows = dedup_lines(documents.select("doc_id", "text"))
    return rows.select(
        "doc_id", F.col(_WORK + "n").alias("n_lines"), F.col(_WORK + "dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def without_common_lines(documents: DataFrame, **options) -> DataFrame:
    """The documents, own columns only, with their common lines gone and `n_chars`, if there, counted anew.

    NULL and empty texts become empty, repeated rows stay and count once each; no name of a column is taken.
    """
    rows = dedup_lines(carried(documents, "text"), **options)
    return rows.select(*own_columns(documents, text=F.col("text"), n_chars=F.length("text").cast("long")))
