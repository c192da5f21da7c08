"""Near-duplicate documents by banded MinHash and odd sketches, confirmed on full shingle sets.

1. Texts with the same words form one class; only one document of each class goes on.
2. MinHash samples are cut into bands; classes that agree in a band share a bucket. Two sets at the least similarity
   miss each other in all bands with a probability of about 1e-7.
3. The samples are also folded into an odd sketch, a bitmap in which every sample flips one bit. The ones in the XOR
   of two sketches estimate how many samples differ; a pair far below the wanted similarity (about five standard
   deviations) is dropped there.
4. What is left is confirmed on the full shingle sets, and confirmed links are joined into components.

A bucket is not expanded into pairs. In a round every bucket compares its members with one leader, and what has
become one component needs no more comparing. After the first round the shingles that no other member has are
counted: a document can share only the rest, which bounds the sizes of its partners, or leaves it none. The next leaders
are the members with the fewest such shingles, as an original has beside its edited copies. At the end the members
outside their bucket's largest component are compared with all of a size within their bounds, so no link between
components is lost.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from candlewick.llm.text import sent
from candlewick.session import stored

SHINGLE = 5
SIMILARITY = 80  # per cent
BANDS, ROWS = 40, 5
SKETCH_BITS = 512
# Estimated similarity below which a candidate is dropped.
ESTIMATE = 0.62
# Leader rounds go on while the pairs left are more than so many for each member of a bucket.
PAIRS_EACH, MOST_ROUNDS = 4, 6
# They also end with a round that leaves more than this share of the pairs.
WORTH = 0.9
# Size classes for each factor of e.
SIZE_STEPS = 40
# Shingles are counted in so many cells (a power of two) by their hash.
CELLS = 64
_SAMPLES = BANDS * ROWS
_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(0, 2**64, _SAMPLES, dtype=np.uint64) | np.uint64(1)
_BAND_FACTORS = _RANDOM.integers(0, 2**64, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_BIT_FACTORS = _RANDOM.integers(0, 2**64, _SAMPLES, dtype=np.uint64) | np.uint64(1)
_SEEDS = _RANDOM.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_SIGNED = "doc_id long, text_key long, high long, low long, n_shingles long, sketch array<long>, bands array<long>"
_CACHED = 2_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII blanks, A-Z lower-cased."""
    return (text or "").encode().lower().split()


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the different runs of `size` words; of all words if there are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for place in range(size):
        total = _mix(total + hashes[place : len(words) - size + 1 + place] * _SEEDS[place % 64])
    return np.unique(total)


def samples(shingles: np.ndarray) -> np.ndarray:
    """The least of the shingles under each of the hash functions."""
    least = np.full(_SAMPLES, 2**64 - 1, np.uint64)
    room = np.empty((_SAMPLES, 512), np.uint64)
    for start in range(0, len(shingles), 512):
        block = shingles[start : start + 512]
        here = room[:, : len(block)]
        np.multiply(_FACTORS[:, None], block[None, :], out=here)
        np.minimum(least, here.min(axis=1), out=least)
    return least


def bands_of(least: np.ndarray) -> np.ndarray:
    own = (_mix(least).reshape(BANDS, ROWS) * _BAND_FACTORS).sum(axis=1, dtype=np.uint64)
    return _mix(own + np.arange(1, BANDS + 1, dtype=np.uint64)).view(np.int64)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """The bitmap as 64-bit numbers: each sample flips the bit it hashes to."""
    bit = (_mix(_mix(least) * _BIT_FACTORS) >> np.uint64(40)).astype(np.int64) % SKETCH_BITS
    odd = (np.bincount(bit, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def most_odd(estimate: float = ESTIMATE) -> int:
    """Ones in the XOR of two sketches that speak for this similarity; fewer speak for more."""
    return int(SKETCH_BITS / 2 * (1 - np.exp(-4 * _SAMPLES * (1 - estimate) / SKETCH_BITS)))


def _key(words: list[bytes]) -> tuple[int, int]:
    return tuple(np.frombuffer(xxh3_128_digest(b" ".join(words)), np.int64).tolist())


def signed(documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    """`doc_id, text_key, high, low, n_shingles, sketch, bands`; equal words give equal (high, low)."""

    def sign(batches):
        known = {}  # copies often come close together
        for batch in batches:
            rows = []
            for text in batch["text"].to_pylist():
                words = words_of(text)
                key = _key(words)
                if key not in known:
                    if len(known) >= _CACHED:
                        known.clear()
                    found = shingle_set(words, size)
                    least = samples(found)
                    known[key] = (len(found), odd_sketch(least), bands_of(least) if len(found) else np.zeros(0, np.int64))
                rows.append((*key, *known[key]))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_key"], *[pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]],
                names=["doc_id", "text_key", "high", "low", "n_shingles", "sketch", "bands"],
            )

    return documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(sign, _SIGNED)


def shingle_sets(documents: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """`id, shingles, cells` of the classes in `nodes` (`id, doc, high, low`), from the texts of their documents `doc`."""

    def collect(batches):
        for batch in batches:
            ids, sets, cells = [], [], []
            for row in zip(*(batch[name].to_pylist() for name in ("id", "high", "low", "text")), strict=True):
                words = words_of(row[3])
                if _key(words) == (row[1], row[2]):
                    ids.append(row[0])
                    sets.append(shingle_set(words, size).view(np.int64))
                    cells.append(np.bincount(sets[-1] & (CELLS - 1), minlength=CELLS).astype(np.int32))
            columns = [pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64())), pa.array(cells, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "shingles", "cells"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc"), "text").join(sent(nodes), "doc")
    found = texts.select("id", "high", "low", "text").mapInArrow(collect, "id long, shingles array<long>, cells array<int>")
    return found.dropDuplicates(["id"])


def components(links: DataFrame) -> DataFrame:
    """`node, root` of the nodes in links `a, b`: root is the least node of the component.

    Each pass points every node to its least neighbour, follows the pointers, and keeps only links between what is
    left, so chains shrink by a factor.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = stored(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct(), "links")
    roots = None
    while not both.isEmpty():
        step = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("r")), "pointers")
        for _ in range(2):
            onward = step.select(F.col("u").alias("r"), F.col("r").alias("s"))
            step = stored(step.join(onward, "r", "left").select("u", F.coalesce("s", "r").alias("r")), "pointers")
        if roots is None:
            roots = step.select(F.col("u").alias("node"), F.col("r").alias("root"))
        else:
            onward = step.select(F.col("u").alias("root"), "r")
            roots = roots.join(onward, "root", "left").select("node", F.coalesce("r", "root").alias("root"))
        roots = stored(roots, "roots")
        first = both.join(step, "u").select(F.col("r").alias("a"), "v")
        second = first.join(step.select(F.col("u").alias("v"), F.col("r").alias("b")), "v")
        both = stored(second.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "links")
    return roots if roots is not None else both.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _odd_ones(left: str, right: str) -> Column:
    parts = [F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(SKETCH_BITS // 64)]
    return sum(parts[1:], parts[0])


class Linker:
    """Confirms candidate pairs of classes, and keeps the shingle sets it has read."""

    def __init__(self, documents: DataFrame, nodes: DataFrame, size: int, similarity: int):
        """`nodes`: id, doc, high, low, n_shingles, sketch."""
        self.documents, self.nodes, self.size, self.similarity = documents, nodes, size, similarity
        self.sets = None

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs `a, b` that are at least so similar."""
        own = self.nodes
        pairs = pairs.join(own.select(F.col("id").alias("a"), F.col("n_shingles").alias("n"), F.col("sketch").alias("s")), "a")
        pairs = pairs.join(own.select(F.col("id").alias("b"), F.col("n_shingles").alias("m"), F.col("sketch").alias("t")), "b")
        near = pairs.where(
            (100 * F.least("n", "m") >= self.similarity * F.greatest("n", "m")) & (_odd_ones("s", "t") <= most_odd())
        )
        near = stored(near.select("a", "b", "n", "m"), "candidates")
        # Each side is reduced to its own ids first: there may be far more pairs than classes.
        ids = near.select(F.col("a").alias("id")).distinct().union(near.select(F.col("b").alias("id")).distinct())
        self._read(ids.distinct())
        left = self.sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
        right = self.sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
        shared = F.size(F.array_intersect("x", "y"))
        whole = F.col("n") + F.col("m") - shared
        met = near.join(right, "b").join(left, "a").where(100 * shared >= self.similarity * whole)
        return stored(met.select("a", "b"), "links")

    def _read(self, ids: DataFrame) -> None:
        """Read the sets of these classes, as far as they are not there yet."""
        if self.sets is not None:
            ids = ids.join(self.sets.select("id"), "id", "left_anti")
        wanted = stored(self.nodes.select("id", "doc", "high", "low").join(ids, "id"), "wanted")
        new = stored(shingle_sets(self.documents, wanted, self.size), "sets")
        self.sets = new if self.sets is None else self.sets.unionByName(new)

    def bounds(self, ids: DataFrame) -> DataFrame:
        """`id, n, met, low, high, cells` of those classes that can link with another of them.

        `met` of the n shingles are found in another of the classes; a partner has `low` to `high` shingles: two
        sets as similar as wanted share similarity / (100 + similarity) of their sizes' sum, so at most
        met * (100 + similarity) / similarity is left for both sizes. `cells` counts the met shingles by cell: two
        sets share no more than the lesser count of each cell.
        """
        self._read(ids)
        each = self.sets.join(ids, "id", "left_semi").select("id", F.explode("shingles").alias("shingle"))
        once = each.groupBy("shingle").agg(F.min("id").alias("id"), F.max("id").alias("other")).where("id = other")
        alone = once.groupBy("id", F.col("shingle").bitwiseAND(F.lit(CELLS - 1)).cast("int").alias("cell")).agg(
            F.count(F.lit(1)).cast("int").alias("alone")
        )
        # At most one entry for each cell.
        alone = alone.groupBy("id").agg(
            F.sum("alone").alias("alone"), F.map_from_entries(F.collect_list(F.struct("cell", "alone"))).alias("by_cell")
        )
        counted = self.nodes.select("id", F.col("n_shingles").alias("n")).join(ids, "id")
        counted = counted.join(self.sets.select("id", "cells"), "id").join(alone, "id", "left")
        cells = F.transform("cells", lambda count, cell: count - F.coalesce(F.col("by_cell")[cell], F.lit(0)))
        counted = counted.select("id", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("met"), cells.alias("cells"))
        least, n = self.similarity, F.col("n")
        most = F.least(100 * n / least, F.col("met") * (100 + least) / least - n)
        bounds = counted.select("*", F.ceil(n * least / 100).alias("low"), F.floor(most + 1e-6).alias("high"))
        return stored(bounds.where("low <= high"), "bounds")


def _most_shared(left: str, right: str) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda one, other: F.least(one, other)), F.lit(0), lambda total, least: total + least)


def _size_class(size: Column) -> Column:
    return F.floor(F.log(size.cast("double")) * SIZE_STEPS)


def _pairs(rows: DataFrame, one: str, other: str) -> DataFrame:
    return rows.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct()


def _classes(documents: DataFrame, size: int, similarity: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The signed rows; `doc_id, high, low` of the different texts of each id; `high, low, root, component_id` of each text.

    `root` joins texts that links connect. `component_id` is the least id among the texts that links or a common id
    connect.
    """
    rows = stored(signed(documents, size), "signed")
    own = stored(rows.where("doc_id IS NOT NULL AND n_shingles > 0").select("doc_id", "high", "low").distinct(), "keys")
    classes = own.groupBy("high", "low").agg(F.min("doc_id").alias("doc"))
    several = stored(own.groupBy("doc_id").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("doc_id"), "several")
    repeated = not several.isEmpty()
    if repeated:
        # A class is called by its least id; of several with the same one, all but the first by their hash, below zero.
        first = classes.join(several, F.col("doc") == F.col("doc_id"), "left_semi").groupBy("doc").agg(
            F.min(F.struct("high", "low")).alias("first")
        )
        named = -F.shiftrightunsigned(F.xxhash64("high", "low"), 1) - 1
        one = F.col("first").isNull() | (F.struct("high", "low") == F.col("first"))
        classes = classes.join(first, "doc", "left").select("high", "low", "doc", F.when(one, F.col("doc")).otherwise(named).alias("id"))
    else:
        classes = classes.withColumn("id", F.col("doc"))
    classes = stored(classes.select("high", "low", "doc", "id"), "classes")
    nodes = rows.withColumnRenamed("doc_id", "doc").join(classes, ["doc", "high", "low"]).dropDuplicates(["id"])
    nodes = stored(nodes.select("id", "doc", "high", "low", "n_shingles", "sketch", "bands"), "nodes")
    buckets = nodes.select("id", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("bucket")
    members = stored(buckets.join(shared, "bucket"), "members")
    roots = _linked(members, Linker(documents, nodes.drop("bands"), size, similarity))
    found = classes.join(roots, F.col("id") == F.col("node"), "left").select(
        "high", "low", "doc", F.coalesce("root", "id").alias("root")
    )
    if not repeated:
        return rows, own, found.select("high", "low", "root", F.col("root").alias("component_id"))
    found = stored(found, "found")
    # The texts of one id belong together.
    texts = own.join(several, "doc_id", "left_semi").join(found, ["high", "low"]).groupBy("doc_id", "root").agg(F.lit(1).alias("x"))
    least = texts.groupBy("doc_id").agg(F.min("root").alias("a"))
    joined = components(texts.join(least, "doc_id").select("a", F.col("root").alias("b")).where("a <> b"))
    found = found.join(joined.withColumnRenamed("root", "whole"), F.col("root") == F.col("node"), "left").select(
        "high", "low", "doc", "root", F.coalesce("whole", "root").alias("whole")
    )
    named = found.groupBy("whole").agg(F.min("doc").alias("component_id"))
    return rows, own, stored(found.join(named, "whole").select("high", "low", "root", "component_id"), "found")


def near_duplicates(documents: DataFrame, size: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """One row for each document row: `doc_id, n_shingles, component_id, kept`.

    `component_id` is the least id that links reach, `kept` says whether it is the row's own. NULL and empty texts
    have no shingles and link with nothing. Rows that repeat an id are one document: it links by any of its texts, and
    all its rows get its component. A row with a NULL id links with nothing: its component is NULL and it is kept.
    """
    rows, own, found = _classes(documents, size, similarity)
    of_id = own.join(found.select("high", "low", "component_id"), ["high", "low"])
    of_id = of_id.groupBy(F.col("doc_id").alias("own_id")).agg(F.min("component_id").alias("component_id"))
    joined = rows.select("doc_id", "n_shingles").join(of_id, F.col("doc_id") == F.col("own_id"), "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _linked(members: DataFrame, linker: Linker) -> DataFrame:
    """`node, root` of all links between members of one bucket."""
    roots, number, total, before, bounds = None, 0, members.count(), None, None
    placed = members.withColumn("root", F.col("id"))
    while True:
        # Buckets that are one component are done, for good: `placed` only keeps members of the others.
        groups = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
        # The most members, of equals the least root.
        largest = groups.groupBy("bucket").agg(
            F.sum("n").alias("all"), F.max(F.struct("n", (-F.col("root")).alias("minus"))).alias("top")
        ).where(F.col("all") > F.col("top.n"))
        largest = stored(largest.select("bucket", "all", (-F.col("top.minus")).alias("top"), F.col("top.n").alias("n")), "buckets")
        left = largest.agg(F.coalesce(F.sum(F.col("all") * (F.col("all") - F.col("n"))), F.lit(0))).first()[0]
        if not left:
            break
        placed = stored(placed.join(largest, "bucket").select("bucket", "id", "root", "top"), "placed")
        last = left <= PAIRS_EACH * total or number >= MOST_ROUNDS or (number > 1 and left > WORTH * before)
        before = left
        if bounds is None and (number or last):
            bounds = linker.bounds(placed.select("id").distinct())
            placed = stored(placed.join(bounds.select("id"), "id", "left_semi"), "placed")
        if last:
            # Every member outside the largest component with every member of another that its bounds, sketch and
            # cells allow, each pair in the first of its common buckets.
            buckets = placed.groupBy("id").agg(F.collect_list("bucket").alias("buckets"))
            sized = placed.join(bounds, "id").join(linker.nodes.select("id", "sketch"), "id").join(buckets, "id")
            classes = F.sequence(_size_class(F.col("low")), _size_class(F.col("high")))
            outside = sized.where("root <> top").select(
                "bucket", F.col("id").alias("other"), F.col("root").alias("apart"), F.col("low").alias("least"),
                F.col("high").alias("most"), F.col("n").alias("own"), F.col("sketch").alias("drawn"), F.col("cells").alias("counts"),
                F.col("buckets").alias("places"), F.explode(classes).alias("class"),
            )
            sized = sized.withColumn("class", _size_class(F.col("n")))
            met = outside.join(sized, ["bucket", "class"]).where(
                "root <> apart AND (root = top OR other < id) AND n BETWEEN least AND most AND own BETWEEN low AND high"
            ).where((_odd_ones("sketch", "drawn") <= most_odd()) & (
                F.col("bucket") == F.array_min(F.array_intersect("buckets", "places"))
            )).where((100 + linker.similarity) * _most_shared("cells", "counts") >= linker.similarity * (F.col("n") + F.col("own")))
            pairs = _pairs(met, "id", "other")
        else:
            order = F.xxhash64(F.lit(number), F.col("id"))
            if number == 1:
                placed = placed.join(bounds.select("id", "n", "met"), "id")
                order = F.struct((1 - F.col("met") / F.col("n")).alias("alone"), order)
            leaders = placed.groupBy("bucket").agg(F.min(F.struct(order.alias("order"), "id", "root")).alias("l"))
            met = placed.join(leaders, "bucket").where("root <> l.root").select("id", F.col("l.id").alias("leader"))
            pairs = _pairs(met, "id", "leader")
        links = linker.links(stored(pairs, "pairs"))
        if roots is not None:
            above = lambda side: roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
            between = links.join(above("a"), "a", "left").join(above("b"), "b", "left")
            between = between.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
        else:
            between = links
        new = components(between)
        moved = new.select(F.col("node").alias("root"), F.col("root").alias("onto"))
        placed = placed.select("bucket", "id", "root")
        if not last and not new.isEmpty():
            # Stored, as the next round reads it twice.
            onward = placed.join(moved, "root", "left").select("bucket", "id", F.coalesce("onto", "root").alias("root"))
            placed = stored(onward, "placed")
        if roots is None:
            roots = new
        else:
            old = roots.join(moved, "root", "left").select("node", F.coalesce("onto", "root").alias("root"))
            # Nodes that were alone until now.
            roots = old.unionByName(new.join(roots.select("node"), "node", "left_anti"))
        roots = stored(roots, "roots")
        number += 1
        if last:
            break
    if roots is None:
        roots = members.select(F.col("id").alias("node"), F.col("id").alias("root")).where("false")
    return roots


def keep_one(documents: DataFrame, size: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """The documents, own columns only, with one row of each group of texts that links connect.

    The row with the least id stays (NULL is the greatest; of several with that id, one). A row only goes for its own
    text: an id may have another text that stays. Rows that repeat id and text are one; NULL and empty texts all stay.
    """
    rows, _, found = _classes(documents, size, similarity)
    texts = rows.where("n_shingles > 0").groupBy("doc_id", "text_key", "high", "low").agg(F.count(F.lit(1)).alias("rows"))
    # Texts that only rows without an id have are no class; each is a group of its own.
    texts = stored(texts.join(found.select("high", "low", "root"), ["high", "low"], "left"), "texts")
    group = [F.coalesce("high_root", "high").alias("g"), F.coalesce("low_root", "low").alias("h")]
    texts = texts.select("*", F.col("root").alias("high_root"), F.when(F.col("root").isNotNull(), 0).alias("low_root"))
    texts = texts.select("doc_id", "text_key", "rows", *group, F.col("root").isNull().alias("alone"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    first = texts.groupBy("alone", "g", "h").agg(F.min(order).alias("first"))
    judged = texts.join(first, ["alone", "g", "h"]).withColumn("stays", order == F.col("first"))
    judged = stored(judged.select(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"), "rows", "stays"), "judged")
    told = documents.select(F.struct(*documents.columns).alias("row")).select(
        "row", F.col("row.doc_id").cast("long").alias("id"), F.xxhash64("row.text").alias("key")
    )
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("key") == F.col("own_key"))
    left = told.join(sent(judged.where("NOT stays").select("own_id", "own_key")), same, "left_anti")
    repeated = judged.where("stays AND rows > 1").select("own_id", "own_key")
    if not repeated.isEmpty():
        repeated = sent(repeated)
        single = left.join(repeated, same, "left_semi").dropDuplicates(["id", "key"])
        left = left.join(repeated, same, "left_anti").unionByName(single)
    return left.select("row.*")
