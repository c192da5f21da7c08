"""Periodic runs: stretches of words that repeat a shorter stretch four times or more, found on a grammar of the text.

Re-Pair rewrites the word numbers of each document: neighbouring symbols that occur together twice or more become a
nonterminal, the more frequent pair first wherever two overlap. Rounds go on while they pay; what is left of a document is
paired off evenly, so every document ends as one symbol. A run lies inside one lowest symbol and crosses the boundary between
that symbol's two halves, so runs are searched once at each nonterminal's boundary, in its first place:

* of a run of four periods, two lie on one side of the boundary, so a period is the distance to an equal square there;
* how far it reaches follows from a search on prefix sums of word hashes, and each run is then compared word by word.

The runs are translated to all places of their nonterminal. A run cut off at the end of a symbol lies inside the whole one,
found higher up, and is dropped there. Everything works on numpy arrays of a few megabytes of text at a time; a row is only ever
looked at alone, so no row is shuffled and no key can be hot.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from candlewick.llm.words import Words, mixed

LEAST_WORDS = 6
LEAST_TURNS = 4
TEXT_BYTES = 4 << 20
# A round that replaces fewer symbols than one in so many is the last.
_WORTH = 50
FOUND = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


def _ranges(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of so many elements its owner and its number, from 0."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class _Text:
    """Word numbers, with prefix sums that compare stretches of any length."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        factors = np.full(len(ids) + 1, 0x9E3779B97F4A7C15, np.uint64)
        factors[0] = 1
        self.powers = np.multiply.accumulate(factors)
        self.sums = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum(mixed(ids.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * self.powers[:-1], out=self.sums[1:])

    def equal(self, at: np.ndarray, ahead: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the stretches at `at` and `at + ahead` seem equal; equal ones always do."""
        first = self.sums[at + size] - self.sums[at]
        second = self.sums[at + ahead + size] - self.sums[at + ahead]
        return first * self.powers[ahead] == second

    def reach(self, at: np.ndarray, ahead: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words from `at` on (or before it) equal those `ahead`, at most so many."""
        low, high = np.zeros(len(at), np.int64), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.equal(at - middle if back else at, ahead, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _exact(ids: np.ndarray, start: int, end: int, period: int, left: int, right: int, least: int, turns: int):
    """The run as it is, word by word; (start, end) or None. Hashes can only make it look longer."""
    if np.array_equal(ids[start : end - period], ids[start + period : end]):
        return start, end
    # Colliding hashes: go by the words alone.
    equal = ids[left : right - period] == ids[left + period : right]
    steps = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
    found = [(left + a, left + b + period) for a, b in zip(steps[::2], steps[1::2], strict=True)]
    chosen = [run for run in found if run[0] < end and run[1] > start and run[1] - run[0] >= max(least, turns * period)]
    return max(chosen, key=lambda run: run[1] - run[0]) if chosen else None


def _crossing(text: _Text, left: np.ndarray, middle: np.ndarray, right: np.ndarray, least: int, turns: int):
    """(owner, start, end, period) of the runs inside [left, right) that cross `middle`."""
    ids, found = text.ids, []
    for back in (False, True):
        side = middle - left if back else right - middle
        owner, period = _ranges(side // 2)
        period = period + 1
        cut = middle[owner]
        at = cut - 2 * period if back else cut
        likely = np.flatnonzero(ids[at] == ids[at + period])
        owner, period, at = owner[likely], period[likely], at[likely]
        likely = np.flatnonzero(ids[at + period - 1] == ids[at + 2 * period - 1])
        owner, period, at = owner[likely], period[likely], at[likely]
        square = np.flatnonzero(text.equal(at, period, period))
        owner, period = owner[square], period[square]
        # From here on, the words of one period equal those of the next.
        found.append((owner, period, middle[owner] - period if back else middle[owner]))
    owner, period, pivot = (np.concatenate(parts) for parts in zip(*found, strict=True))
    if not len(owner):
        return np.zeros((0, 4), np.int64)
    first, cut, last = left[owner], middle[owner], right[owner]
    start = pivot - text.reach(pivot, period, pivot - first, back=True)
    end = pivot + text.reach(pivot, period, last - period - pivot, back=False) + period
    long_enough = (end - start >= np.maximum(least, turns * period)) & (start < cut) & (end > cut)
    runs = np.stack([owner, start, end, period], axis=1)[long_enough]
    # A multiple of the period spans the same words.
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):
        runs = runs[np.concatenate([[True], (np.diff(runs[:, :3], axis=0) != 0).any(axis=1)])]
    checked = []
    for number, start, end, period in runs.tolist():
        exact = _exact(ids, start, end, period, int(left[number]), int(right[number]), least, turns)
        if exact:
            checked.append((number, *exact, period))
    return np.array(checked, np.int64).reshape(-1, 4)


def _pairs(symbols: np.ndarray, rows: np.ndarray):
    """(group, count) of each neighbouring pair inside a document; group -1 and count 0 at a document's end."""
    inside = np.flatnonzero(rows[:-1] == rows[1:])
    a, b, row = symbols[inside].astype(np.uint64), symbols[inside + 1].astype(np.uint64), rows[inside].astype(np.uint64)
    key = mixed(mixed(a * np.uint64(0x9E3779B97F4A7C15) + b) + row)
    order = np.argsort(key)
    a, b, row = a[order], b[order], row[order]
    fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (row[1:] != row[:-1])]) if len(order) else order
    sorted_group = np.cumsum(fresh) - 1
    group, count = np.full(len(symbols), -1), np.zeros(len(symbols), np.int64)
    group[inside[order]] = sorted_group
    count[inside[order]] = np.bincount(sorted_group)[sorted_group] if len(order) else 0
    return group, count


def _chosen(group: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Places of pairs to replace: of two that overlap the more frequent, of equal ones every other from the left."""
    rank = np.where(count > 1, count * (len(group) + 1) + group + 1, 0)
    before, after = np.concatenate([[0], rank[:-1]]), np.concatenate([rank[1:], [0]])
    top = (rank > 0) & (rank >= before) & (rank >= after)
    # A stretch of one pair overlapping itself, as in a a a a.
    begins = top & ~(np.concatenate([[False], top[:-1]]) & (rank == before))
    places = np.arange(len(rank))
    offset = places - np.maximum.accumulate(np.where(begins, places, 0))
    return np.flatnonzero(top & (offset % 2 == 0))


def _grammar(ids: np.ndarray, ends: np.ndarray):
    """Yield (left, middle, right, place, rule): the halves of each rule's first place, and all places with their rule."""
    sizes = np.diff(np.concatenate([[0], ends]))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    symbols, starts = ids.copy(), np.arange(len(ids))
    lengths = np.ones(len(ids), np.int64)
    known = int(ids.max()) + 1 if len(ids) else 0
    paying = True
    while len(symbols) and (rows[:-1] == rows[1:]).any():
        if paying:
            group, count = _pairs(symbols, rows)
            places = _chosen(group, count)
            paying = len(places) * _WORTH >= len(symbols)
            if not len(places):
                paying = False
                continue
            _, first, rule = np.unique(group[places], return_index=True, return_inverse=True)
        else:
            # Even pairs of what is left of each document, each a rule of one place.
            begins = np.concatenate([[True], rows[1:] != rows[:-1]])
            at = np.arange(len(rows))
            offset = at - np.maximum.accumulate(np.where(begins, at, 0))
            places = np.flatnonzero((offset[:-1] % 2 == 0) & (rows[:-1] == rows[1:]))
            first = rule = np.arange(len(places))
        left, middle = starts[places], starts[places + 1]
        right = middle + lengths[places + 1]
        yield left[first], middle[first], right[first], left, rule
        symbols[places] = known + rule
        known += len(first)
        lengths[places] = right - left
        kept = np.ones(len(symbols), bool)
        kept[places + 1] = False
        symbols, starts, lengths, rows = symbols[kept], starts[kept], lengths[kept], rows[kept]


def find_runs(ids: np.ndarray, ends: np.ndarray, least: int = LEAST_WORDS, turns: int = LEAST_TURNS) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start and period; `ends` says where each text ends."""
    text, found = _Text(ids), []
    for left, middle, right, places, rule in _grammar(ids, ends):
        runs = _crossing(text, left, middle, right, least, turns)
        if not len(runs):
            continue
        order = np.argsort(rule, kind="stable")
        sizes = np.bincount(rule, minlength=len(left))
        ahead = np.cumsum(sizes) - sizes
        owner, number = _ranges(sizes[runs[:, 0]])
        run = runs[owner]
        shift = places[order[ahead[run[:, 0]] + number]] - left[run[:, 0]]
        found.append(np.stack([run[:, 1] + shift, run[:, 2] + shift, run[:, 3]], axis=1))
    if not found:
        return np.zeros((0, 4), np.int64)
    runs = np.concatenate(found)
    row = np.searchsorted(ends, runs[:, 0], side="right")
    order = np.lexsort((-runs[:, 1], runs[:, 0], runs[:, 2], row))
    runs, row = runs[order], row[order]
    # Inside one text and period, a run that ends no later than one that began no later lies inside it.
    fresh = np.concatenate([[True], (np.diff(row) != 0) | (np.diff(runs[:, 2]) != 0)])
    base = np.cumsum(fresh) * (len(ids) + 1)
    furthest = np.maximum.accumulate(runs[:, 1] + base)
    whole = np.concatenate([[True], furthest[1:] > furthest[:-1]])
    runs, row = runs[whole], row[whole]
    begins = np.concatenate([[0], ends[:-1]])[row]
    out = np.stack([row, runs[:, 0] - begins, runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _found(texts: pa.Array, least: int, turns: int) -> pa.Array:
    words = Words(texts)
    runs = find_runs(words.ids, words.ends, least, turns)
    begin = words.starts[runs[:, 0]] + runs[:, 1]
    steps = np.zeros(len(words.ids) + 1, np.int64)
    np.add.at(steps, begin + runs[:, 3], 1)
    np.add.at(steps, begin + runs[:, 2], -1)
    offsets = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1)).astype(np.int32)
    names = ["start", "length", "period"]
    listed = pa.ListArray.from_arrays(
        pa.array(offsets), pa.StructArray.from_arrays([pa.array(runs[:, i].copy()) for i in (1, 2, 3)], names)
    )
    return pa.StructArray.from_arrays(
        [pa.array(words.ends - words.starts), listed, words.joined(np.cumsum(steps)[:-1] == 0)],
        ["n_words", "runs", "collapsed"],
    )


def _sliced(texts: pa.Array):
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for row, size in enumerate(sizes):
        if row > first and held + size > TEXT_BYTES:
            yield texts.slice(first, row - first)
            first, held = row, 0
        held += size
    yield texts.slice(first)


def periodic_runs(text: Column, least: int = LEAST_WORDS, turns: int = LEAST_TURNS) -> Column:
    """struct(n_words, runs, collapsed) of a text.

    A run is a stretch of words with smallest period q, of at least `least` and `turns * q` words, that no neighbouring word
    extends; `turns` must be at least 4, or a boundary may leave less than two periods on either side. `runs` are sorted by
    start and period. `collapsed` are the words joined by one space without those that any run has after its first period.
    NULL and empty texts have no words and no runs; equal rows have equal results.
    """
    if turns < 4:
        raise ValueError("a run must have four turns at least")

    def found(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([_found(part, least, turns) for part in _sliced(texts)])

    return F.arrow_udf(found, FOUND)(text)


def run_digests(found: Column) -> list[Column]:
    """What the registered query says of `periodic_runs`."""
    runs = found["runs"]
    # The longest; of equal ones the first by start and period, which is how they are sorted.
    most = F.array_max(F.transform(runs, lambda run: F.struct(
        run["length"].alias("length"), (-run["start"]).alias("start"), (-run["period"]).alias("period")
    )))
    lines = F.transform(runs, lambda run: F.concat(
        run["start"].cast("string"), F.lit(","), run["length"].cast("string"), F.lit(","), run["period"].cast("string"), F.lit("\n")
    ))
    return [
        F.size(runs).cast("long").alias("n_runs"), (-most["start"]).alias("start"), most["length"].alias("length"),
        (-most["period"]).alias("period"),
        F.floor(most["length"] * 1000 / -most["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(found["collapsed"], 256).alias("collapsed_sha256"),
    ]
