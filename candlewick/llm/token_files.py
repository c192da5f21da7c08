"""Corpora as token files: blocks coded against one shared frequency table, readable in parallel.

The documents are range-sorted by id and tokenized once; the counts of all tokens make the table; then every task
codes its run of documents into blocks of whole documents (a block ends with the first document that reaches
BLOCK_TOKENS). Blocks are rows of Parquet files, which Spark commits, so a lost executor leaves none half-written.
Each block names the number of tokens before it, so blocks can be decoded in any order and place.

    <path>/table     token, frequency
    <path>/blocks    part, first, block
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewick.llm.ans import NO_ID, Table, decode_block, encode_block
from candlewick.llm.tokens import encoder, runs
from candlewick.session import stored

BLOCK_TOKENS = 1 << 18
COUNTED_AT_ONCE = 256
# Bytes and texts encoded together: a new word passes the tokenizer once in a run, so long runs take less time.
RUN_BYTES, RUN_TEXTS = 8 << 20, 4_096
END = 2
_TOKENS = "part int, doc_id long, first long, n_tokens long, ids binary"
_READ = "doc_id long, start long, n_tokens long, ids binary"


def tokenized(documents: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """`part, doc_id, first, n_tokens, ids` in id order; `first` counts the tokens before it in its part.

    NULL text is empty and has the end id alone. Rows with a NULL id come first, repeated ids one after the other
    by text.
    """
    def encode(batches):
        part, first = TaskContext.get().partitionId(), 0
        own = encoder(tokenizer, False)
        for batch in batches:
            for at, count in runs(batch["text"], RUN_BYTES, RUN_TEXTS):
                rows = batch.slice(at, count)
                ids = [np.append(found, found.dtype.type(end)) for found in own.encode(rows["text"].to_pylist())]
                counts = np.array([len(found) for found in ids], np.int64)
                starts = first + np.cumsum(counts) - counts
                first += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part, np.int32)), rows["doc_id"], pa.array(starts), pa.array(counts),
                     pa.array([found.astype("<u4" if found.itemsize == 4 else "<u2").tobytes() for found in ids], pa.binary())],
                    names=["part", "doc_id", "first", "n_tokens", "ids"],
                )

    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col("doc_id").cast("long"), "text").repartitionByRange(parts, "doc_id")
    return stored(rows.sortWithinPartitions("doc_id", "text").mapInArrow(encode, _TOKENS), "tokens")


def _tokens(ids: bytes, count: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * count else "<u4")


def _counted(batches):
    total = np.zeros(0, np.int64)
    for batch in batches:
        # Rows are counted together: an array as long as the vocabulary for each would cost more than its tokens.
        for at in range(0, batch.num_rows, COUNTED_AT_ONCE):
            rows = batch.slice(at, COUNTED_AT_ONCE)
            pairs = zip(rows["ids"].to_pylist(), rows["n_tokens"].to_pylist(), strict=True)
            found = np.bincount(np.concatenate([_tokens(*pair) for pair in pairs]), minlength=len(total))
            found[: len(total)] += total
            total = found
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["token", "count"])


@lru_cache(maxsize=2)
def _opened(tokens: bytes, frequencies: bytes, scale: int) -> Table:
    return Table(np.frombuffer(tokens, np.int64), np.frombuffer(frequencies, np.int64), scale)


def write(documents: DataFrame, path: str, tokenizer: str, end: int = END) -> None:
    """Tokenize the documents and write them, in id order, to `path`."""
    rows = tokenized(documents, tokenizer, end)
    spark = rows.sparkSession
    counts = rows.select("n_tokens", "ids").mapInArrow(_counted, "token long, count long")
    # At most as many rows as the vocabulary has tokens, and one for each part.
    listed = counts.groupBy("token").agg(F.sum("count").alias("count")).collect()
    totals = dict(rows.groupBy("part").agg(F.sum("n_tokens")).collect())
    table = Table.from_counts(np.array([row[0] for row in listed], np.int64), np.array([row[1] for row in listed], np.int64))
    pairs = list(zip(table.tokens.tolist(), table.frequency.tolist(), strict=True))
    spark.createDataFrame(pairs, "token long, frequency long").coalesce(1).write.parquet(f"{path}/table")
    before, offsets = 0, {}
    for part in sorted(totals):
        offsets[part], before = before, before + totals[part]
    shared = (table.tokens.tobytes(), table.frequency.astype(np.int64).tobytes(), table.scale)
    sent = spark.sparkContext.broadcast(shared)

    def code(batches):
        own = _opened(*sent.value)
        ids, pieces, part, first, upto = [], [], None, 0, 0

        def block():
            lengths = np.array([len(piece) for piece in pieces], np.int64)
            coded = encode_block(own, np.array(ids, np.int64), lengths, np.concatenate(pieces), offsets[part] + first)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([offsets[part] + first]), pa.array([coded], pa.binary())],
                names=["part", "first", "block"],
            )

        for batch in batches:
            for row in zip(*(batch[name].to_pylist() for name in ("part", "doc_id", "first", "n_tokens", "ids")), strict=True):
                # A task may read parts of several files; a block never spans them.
                if pieces and (row[0] != part or row[2] != upto or upto - first >= BLOCK_TOKENS):
                    yield block()
                    ids, pieces = [], []
                if not pieces:
                    part, first = row[0], row[2]
                ids.append(NO_ID if row[1] is None else row[1])
                pieces.append(_tokens(row[4], row[3]))
                upto = row[2] + row[3]
        if pieces:
            yield block()

    blocks = rows.mapInArrow(code, "part int, first long, block binary")
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids` of every document: its tokens as 32-bit little-endian numbers."""
    listed = spark.read.parquet(f"{path}/table").orderBy("token").collect()
    tokens, frequencies = (np.array([row[i] for row in listed], np.int64) for i in (0, 1))
    sent = spark.sparkContext.broadcast((tokens.tobytes(), frequencies.tobytes(), int(frequencies.sum()).bit_length() - 1))

    def decode(batches):
        own = _opened(*sent.value)
        for batch in batches:
            for block in batch["block"]:
                ids, lengths, found, first = decode_block(own, block.as_py())
                lengths = lengths.astype(np.int64)
                ends = np.cumsum(lengths)
                data = found.astype("<u4").tobytes()
                texts = [data[4 * (end - size) : 4 * end] for end, size in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, mask=ids == NO_ID), pa.array(first + ends - lengths), pa.array(lengths), pa.array(texts, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return spark.read.parquet(f"{path}/blocks").select("block").mapInArrow(decode, _READ)


def crc32_of(ids: str) -> Column:
    """Spark's own expression: a Python function here would give each task that decodes a second worker."""
    return F.crc32(ids)
