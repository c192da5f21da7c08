"""Best-fit packing of token pieces into sequences of a fixed capacity.

Pieces are range-sorted by length and numbered within each length, which distributes them evenly however many
share one. Pieces of one length are interchangeable, and so are sequences with one gap, so the sorted lists of pieces
and gaps are held as runs (length, count) and (gap, count) on the driver: at most as many lengths and gaps as the
capacity, whatever the corpus, though a gap may have several runs of sequences. Each round sweeps the runs for the longest pieces left: their successors, the smallest gaps that hold them, take them
in order of rank; gaps that changed are sorted in again; pieces without a successor open new sequences. Then every
task places its pieces by their rank.
"""

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from candlewick.llm.tokens import encoder, runs
from candlewick.session import stored

CAPACITY = 2048
END = 0
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = True) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32, ids` of all documents; longer ones are cut at the capacity.

    NULL and empty texts have the end id alone. `ids` are 32-bit little-endian numbers, NULL without `keep_ids`.
    """

    def cut(batches):
        own = encoder(tokenizer, True)
        for batch in batches:
            for at, count in runs(batch["text"]):
                rows = batch.slice(at, count)
                found = []
                for doc_id, ids in zip(rows["doc_id"].to_pylist(), own.encode(rows["text"].to_pylist()), strict=True):
                    data = np.append(ids, ids.dtype.type(end)).astype("<u4")
                    for piece, start in enumerate(range(0, len(data), capacity)):
                        part = data[start : start + capacity].tobytes()
                        found.append((doc_id, piece, start, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
                columns = list(zip(*found, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
                )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, _PIECES)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Place `counts[length]` pieces: rows (length, first rank, first sequence, pieces a sequence, offset).

    Row by row, the pieces of a length from the first rank on fill the sequences from the first one on.
    """
    placed, opened = [], 0
    gaps: list[int] = []  # sorted
    runs: dict[int, list[tuple[int, int]]] = {}  # by gap: (first sequence, count)

    def free(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in runs:
                insort(gaps, gap)
                runs[gap] = []
            runs[gap].append((first, count))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        changed = []
        while left:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, count = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap], gaps[at]
            else:
                each = capacity // length
                gap, first, count = capacity, opened, -(-left // each)
                opened += count
            each = gap // length
            used = min(count, -(-left // each))
            placed.append((length, rank, first, each, capacity - gap))
            filled = min(left, used * each)
            rest = filled - (used - 1) * each  # in the last sequence used
            changed.append((gap - each * length, first, used - (rest < each)))
            if rest < each:
                changed.append((gap - rest * length, first + used - 1, 1))
            changed.append((gap, first + used, count - used))
            rank, left = rank + filled, left - filled
        for change in changed:
            free(*change)
    return placed


def _added(rows: DataFrame, **columns: str) -> str:
    """The schema of rows with more columns."""
    own = [f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema.fields]
    return ", ".join([*own, *[f"{name} {kind}" for name, kind in columns.items()]])


def packed(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with `sequence_id` and `offset`; they are stored once. All their columns are kept.

    Needs columns `doc_id, piece, length`; lengths from 1 to the capacity. Ties go by id and piece number;
    repeated rows are placed apart. Sequences are filled without gaps from 0.
    """
    spark = parts.sparkSession
    names = parts.columns
    number = "pack_rank"

    def ranked(batches):
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            lengths = batch["length"].to_numpy()
            ranks = np.empty(len(lengths), np.int64)
            # Sorted by length, so each is one slice.
            for length, first, count in zip(*np.unique(lengths, return_index=True, return_counts=True), strict=True):
                before = seen.get(int(length), 0)
                at = np.flatnonzero(lengths == length) if not (lengths[first : first + count] == length).all() else slice(first, first + count)
                ranks[at] = before + np.arange(count)
                seen[int(length)] = before + int(count)
            own = [*batch.columns, pa.array(np.full(len(lengths), part, np.int32)), pa.array(ranks)]
            yield pa.RecordBatch.from_arrays(own, names=[*names, "pack_part", number])

    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ready = stored(parts, "pieces")
    order = [F.desc("length"), F.asc("doc_id"), F.asc("piece")]
    rows = ready.repartitionByRange(count, *order).sortWithinPartitions(*order)
    schema = _added(ready, pack_part="int", **{number: "long"})
    numbered = stored(rows.mapInArrow(ranked, schema), "ranked")
    # Parts hold ranges of lengths: at most one row for each part and one for each length.
    held = sorted(numbered.groupBy("length", "pack_part").count().collect())
    totals, before = {}, {}
    for length, part, n in held:
        before[(part, length)] = totals.get(length, 0)
        totals[length] = totals.get(length, 0) + n
    placed = np.array(plan(totals, capacity), np.int64).reshape(-1, 5)
    placed = placed[np.lexsort((placed[:, 1], placed[:, 0]))]
    sent = spark.sparkContext.broadcast((placed, before))
    width = 40  # bits of a rank

    def place(batches):
        table, offsets = sent.value
        keys = (table[:, 0] << width) | table[:, 1]
        for batch in batches:
            lengths, part = batch["length"].to_numpy(), batch["pack_part"].to_numpy()
            base = np.zeros(len(lengths), np.int64)
            for pair in set(zip(part.tolist(), lengths.tolist(), strict=True)):
                base[(part == pair[0]) & (lengths == pair[1])] = offsets[pair]
            rank = base + batch[number].to_numpy()
            row = table[np.searchsorted(keys, (lengths << width) | rank, side="right") - 1]
            ahead = rank - row[:, 1]
            own = batch.columns[: len(names)]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(row[:, 2] + ahead // row[:, 3]), pa.array(row[:, 4] + ahead % row[:, 3] * lengths)],
                names=[*names, "sequence_id", "offset"],
            )

    schema = _added(ready, sequence_id="long", offset="long")
    return numbered.mapInArrow(place, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """`sequence_id, ids` of packed pieces that kept their `ids`: what a trainer reads."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.col("parts"), F.lit(b""), lambda a, part: F.concat(a, part["ids"]))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", joined.alias("ids"))
