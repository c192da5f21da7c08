"""Substring dedup: words inside long passages that also start earlier go, wherever the passage stands.

The suffixes of all texts, cut off at the window's length, are split by prefixes into groups of bounded size, and the nodes
of each group's tree at that depth are the repeats. Shipping every suffix with its words would cost a dozen times the
input, so three things keep it small:

* Windows are dealt by the least hash among the eight-word runs inside them, so neighbours mostly go to the same group and
  travel together; equal windows have equal least runs. Runs whose group would exceed `most_windows` are split by a longer
  prefix, the whole window. A counting pass over bounded tables of buckets finds these runs.
* A window is a 64-bit hash beside the group it is in. Tasks keep only the first of equal windows in a piece of the table,
  so a passage in a third of all documents costs a group one row for each piece.
* What a group finds goes back to the piece as places, and each piece turns them into spans of its documents.

Pieces hold at most PIECE_BYTES of text (or one document). Texts pass one shuffle, to meet their spans.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from candlewick.llm.words import Words, mixed, run_hashes

LEAST_WORDS = 20
PREFIX_WORDS = 8
MOST_WINDOWS = 1_000_000
BUCKET_BITS = 13
PIECE_BYTES = 6 << 20
_NULL_ID = -(1 << 63)
_DEALT = "shard long, piece long, docs binary, starts binary, places binary, counts binary, hashes binary"
_FOUND = "piece long, docs binary, keys binary, ends binary, nulls binary, places binary"
_KEPT = "struct<text:string,words:bigint,removed:bigint>"
_SPANS = "doc_id long, text_key long, spans array<struct<start:int,end:int>>"


def _planes(values: np.ndarray) -> bytes:
    """The bytes of sorted or small numbers by significance, which compress well."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unplaned(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    if not data:
        return np.zeros(0, kind)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _pieces(batches):
    """Slices of at most PIECE_BYTES of text, rows by id (NULL first)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        first, held = 0, 0
        for row, size in enumerate(sizes):
            if row > first and held + size > PIECE_BYTES:
                yield _ordered(batch.slice(first, row - first))
                first, held = row, 0
            held += size
        if first < len(sizes):
            yield _ordered(batch.slice(first))


def _ordered(rows: pa.RecordBatch) -> pa.RecordBatch:
    return rows.take(pc.sort_indices(rows, sort_keys=[("doc_id", "ascending"), ("text_key", "ascending")], null_placement="at_start"))


class _Windows:
    """The windows of a piece: where they are, their hash and the least hash of the runs inside them."""

    def __init__(self, texts: pa.Array, length: int, prefix: int):
        words = Words(texts)
        self.ends, self.begins = words.ends, words.starts
        sizes = self.ends - self.begins
        row_of = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
        room = np.arange(len(row_of), dtype=np.int64) <= self.ends[row_of] - length
        self.places = np.flatnonzero(room)
        self.rows = row_of[self.places]
        hashes = run_hashes(words.hashes(), sorted({prefix, length}))
        self.whole = hashes[length][self.places]
        self.least = _sliding_least(hashes[prefix], length - prefix + 1)[self.places]


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[: max(0, len(values) - reach)], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest and len(values) > rest else values


def _buckets(values: np.ndarray, bits: int) -> np.ndarray:
    # The least of several hashes has few high bits, so the bits are mixed first.
    return (mixed(values) >> np.uint64(64 - bits)).astype(np.int64)


def window_counts(rows: DataFrame, length: int, prefix: int, bits: int) -> DataFrame:
    """`bucket, windows`: how many windows each bucket of prefixes has."""

    def count(batches):
        total = np.zeros(1 << bits, np.int64)
        for piece in _pieces(batches):
            total += np.bincount(_buckets(_Windows(piece.column("text"), length, prefix).least, bits), minlength=1 << bits)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "windows"])

    counted = rows.mapInArrow(count, "bucket long, windows long")
    return counted.groupBy("bucket").agg(F.sum("windows").alias("windows"))


def _first_of_equal(whole: np.ndarray, rank: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each window whether an equal one has a smaller (rank, start)."""
    order = np.argsort(whole)
    equal = whole[order][1:] == whole[order][:-1]
    shared = order[np.concatenate([equal, [False]]) | np.concatenate([[False], equal])] if len(order) else order
    later = np.zeros(len(whole), bool)
    if len(shared):
        shared = shared[np.lexsort((start[shared], rank[shared], whole[shared]))]
        heads = np.concatenate([[True], whole[shared][1:] != whole[shared][:-1]])
        head = shared[np.flatnonzero(heads)[np.cumsum(heads) - 1]]
        later[shared] = (rank[shared] != rank[head]) | (start[shared] != start[head])
    return later


def _deal(length: int, prefix: int, bits: int, heavy: list[int], shards: int):
    """Each piece's windows by shard, and one row that says which documents the piece has."""

    def deal(batches):
        full = np.zeros(1 << bits, bool)
        full[heavy] = True
        for piece in _pieces(batches):
            own = piece.column("doc_id")
            nulls = np.asarray(own.is_null())
            ids = pc.fill_null(own, _NULL_ID).to_numpy()
            keys = piece.column("text_key").to_numpy()
            found = _Windows(piece.column("text"), length, prefix)
            number = np.int64(np.uint64(xxh3_64_intdigest(ids.tobytes() + keys.tobytes())).view(np.int64))
            start = found.places - found.begins[found.rows]
            later = _first_of_equal(found.whole, ids[found.rows], start)
            out = {name: [] for name in ("shard", "piece", "docs", "starts", "places", "counts", "hashes")}

            def put(shard, *blobs, out=out, number=number):
                for name, value in zip(out, (shard, number, *blobs), strict=True):
                    out[name].append(value)

            put(
                -1 - (int(number) & 0x7FFFFFFF), _planes(ids), _planes(keys), _planes(found.ends), nulls.tobytes(),
                _planes(found.places[later].astype(np.uint32)),
            )
            at = np.flatnonzero(~later)
            if len(at):
                dealt_by = np.where(full[_buckets(found.least[at], bits)], found.whole[at], found.least[at])
                shard = (mixed(dealt_by ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(shards)).astype(np.int64)
                place, row, whole = found.places[at], found.rows[at], found.whole[at]
                breaks = (np.diff(place) != 1) | (np.diff(row) != 0) | (np.diff(shard) != 0)
                first = np.concatenate([[0], np.flatnonzero(breaks) + 1])
                count = np.diff(np.concatenate([first, [len(at)]]))
                order = np.argsort(shard[first], kind="stable")
                first, count = first[order], count[order]
                ahead = np.concatenate([[0], np.cumsum(count)])
                hashes = whole[np.repeat(first - ahead[:-1], count) + np.arange(ahead[-1])]
                bounds = np.flatnonzero(np.diff(shard[first], prepend=-1, append=-1))
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    chosen = first[a:b]
                    put(
                        int(shard[chosen[0]]), _planes(ids[row[chosen]]), _planes(start[at[chosen]].astype(np.uint32)),
                        _planes(place[chosen].astype(np.uint32)), _planes(count[a:b].astype(np.uint32)),
                        hashes[ahead[a] : ahead[b]].tobytes(),
                    )
            kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(out.values(), kinds, strict=True)], list(out)
            )

    return deal


def _resolve(dealt: pa.Table) -> pa.Table:
    """A shard's windows that start earlier elsewhere, by piece; what a piece says of its documents goes through."""
    names = ("piece", "docs", "keys", "ends", "nulls", "places")
    out = {name: [] for name in names}
    rows = dealt.to_pylist()
    if dealt["shard"][0].as_py() < 0:
        for row in rows:
            for name, source in zip(names, ("piece", "docs", "starts", "places", "counts", "hashes"), strict=True):
                out[name].append(row[source])
    elif rows:
        ids, starts, places, whole, source = [], [], [], [], []
        for number, row in enumerate(rows):
            count = _unplaned(row["counts"], np.uint32).astype(np.int64)
            ahead = np.cumsum(count) - count
            step = np.arange(count.sum()) - np.repeat(ahead, count)
            ids.append(np.repeat(_unplaned(row["docs"], np.int64), count))
            starts.append(np.repeat(_unplaned(row["starts"], np.uint32).astype(np.int64), count) + step)
            places.append(np.repeat(_unplaned(row["places"], np.uint32).astype(np.int64), count) + step)
            whole.append(np.frombuffer(row["hashes"], np.uint64))
            source.append(np.full(len(step), number, np.int64))
        place, piece = np.concatenate(places), np.concatenate(source)
        later = _first_of_equal(np.concatenate(whole), np.concatenate(ids), np.concatenate(starts))
        for number in np.unique(piece[later]):
            chosen = np.sort(place[later & (piece == number)]).astype(np.uint32)
            out["piece"].append(rows[number]["piece"])
            out["places"].append(_planes(chosen))
            for name in ("docs", "keys", "ends", "nulls"):
                out[name].append(None)
    kinds = [pa.int64(), *[pa.binary()] * 5]
    return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds, strict=True)})


def _spans(length: int):
    """The covered words of each document of a piece, as spans of word numbers."""

    def spans(found: pa.Table) -> pa.Table:
        rows = found.to_pylist()
        piece = next((row for row in rows if row["docs"] is not None), None)
        ids, keys, starts, ends, sizes, nulls = [], [], [], [], [], []
        if piece is not None:
            until = _unplaned(piece["ends"], np.int64)
            words = int(until[-1]) if len(until) else 0
            steps = np.zeros(words + 1, np.int64)
            # Copies of a piece have the same number and say the same.
            for row in rows:
                at = np.unique(_unplaned(row["places"], np.uint32).astype(np.int64))
                np.add.at(steps, at, 1)
                np.add.at(steps, at + length, -1)
            covered = np.cumsum(steps)[:-1] > 0
            begins = np.concatenate([[0], until[:-1]])
            fresh = np.zeros(words + 1, bool)
            fresh[begins] = True
            before = np.concatenate([[False], covered[:-1]])
            after = np.concatenate([covered[1:], [False]])
            first = np.flatnonzero(covered & (~before | fresh[:-1]))
            last = np.flatnonzero(covered & (~after | fresh[1:]))
            of = np.searchsorted(until, first, side="right")
            docs, sizes = np.unique(of, return_counts=True)
            ids, keys = _unplaned(piece["docs"], np.int64)[docs], _unplaned(piece["keys"], np.int64)[docs]
            nulls = np.frombuffer(piece["nulls"], bool)[docs]
            starts, ends = first - begins[of], last + 1 - begins[of]
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        pairs = pa.StructArray.from_arrays(
            [pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["start", "end"]
        )
        return pa.table({
            "doc_id": pa.array(ids, pa.int64(), mask=np.array(nulls, bool)), "text_key": pa.array(keys, pa.int64()),
            "spans": pa.ListArray.from_arrays(offsets, pairs),
        })

    return spans


def repeated_spans(
    documents: DataFrame, length: int = LEAST_WORDS, prefix: int = PREFIX_WORDS,
    most_windows: int = MOST_WINDOWS, bits: int = BUCKET_BITS,
) -> DataFrame:
    """`doc_id, text_key, spans`: for each document with any, its words inside windows that also start earlier.

    A window is `length` words in a row of one document; earlier is a smaller `doc_id` (NULL is the smallest), or the same
    `doc_id` at an earlier word. Rows that share an id and a text say the same and come once for each piece of the table
    they are in. `text_key` is the xxhash64 of the text. Spans count words from 0, end exclusive. Rows should come from
    storage: a lost task's pieces are made again and must hold the same rows.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    prefix = min(prefix, length)
    counts = window_counts(rows, length, prefix, bits).collect()  # at most 2 ** bits rows
    heavy = [row["bucket"] for row in counts if row["windows"] > most_windows]
    shards = max(1, -(-4 * sum(row["windows"] for row in counts) // most_windows))
    dealt = rows.mapInArrow(_deal(length, prefix, bits, heavy, shards), _DEALT)
    found = dealt.groupBy("shard").applyInArrow(_resolve, _FOUND)
    return found.groupBy("piece").applyInArrow(_spans(length), _SPANS)


def _kept(texts: pa.Array, spans: pa.Array) -> pa.Array:
    words = Words(texts)
    steps = np.zeros(len(words.ids) + 1, np.int64)
    flat, sizes = spans.flatten(), pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
    offset = np.repeat(words.starts, sizes)
    np.add.at(steps, flat.field("start").to_numpy(zero_copy_only=False) + offset, 1)
    np.add.at(steps, flat.field("end").to_numpy(zero_copy_only=False) + offset, -1)
    kept = np.cumsum(steps)[:-1] == 0
    ahead = np.concatenate([[0], np.cumsum(kept)])
    n_words = words.ends - words.starts
    removed = n_words - (ahead[words.ends] - ahead[words.starts])
    return pa.StructArray.from_arrays(
        [words.joined(kept), pa.array(n_words), pa.array(removed)], ["text", "words", "removed"]
    )


def _judged(documents: DataFrame, **options) -> DataFrame:
    """`row` (the document's columns), `spans` (NULL without any) and `kept`."""
    spans = repeated_spans(documents, **options).dropDuplicates(["doc_id", "text_key"])
    left = documents.select(F.struct(*documents.columns).alias("row")).select(
        "row", F.col("row.doc_id").cast("long").alias("own_id"), F.xxhash64("row.text").alias("own_key")
    )
    both = left.join(
        spans, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key")), "left"
    )
    kept = F.arrow_udf(_kept, _KEPT)
    return both.select("row", "spans", kept(F.col("row.text"), F.col("spans")).alias("kept"))


def without_repeats(documents: DataFrame, **options) -> DataFrame:
    """The documents, own columns only, without the words that `repeated_spans` finds.

    A text that loses words is the rest joined by one space; any other stays as it is, and NULL stays NULL. Repeated rows
    of one id and text keep each other, as neither starts earlier. `n_chars`, if there, is counted anew.
    """
    text = F.when(F.col("spans").isNotNull(), F.col("kept.text")).otherwise(F.col("row.text"))
    columns = [text.alias(name) if name == "text" else F.col("row")[name].alias(name) for name in documents.columns]
    rows = _judged(documents, **options).select(*columns)
    return rows.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in documents.columns else rows


def repeat_digests(documents: DataFrame, **options) -> DataFrame:
    """`doc_id, n_words, n_removed, kept_sha256` of every row; kept words are joined by one space, NULL text has none."""
    return _judged(documents.select("doc_id", "text"), **options).select(
        F.col("row.doc_id").alias("doc_id"), F.col("kept.words").alias("n_words"), F.col("kept.removed").alias("n_removed"),
        F.sha2(F.col("kept.text"), 256).alias("kept_sha256"),
    )
