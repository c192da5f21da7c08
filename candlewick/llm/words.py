"""Words of whole Arrow batches: split, numbered and hashed without a Python step for each word."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh3_64_intdigest


class Words:
    """The words (runs of anything but the six ASCII blanks) of a batch of texts; NULL has none.

    `ends[i]` is where the words of text i end, `ids` numbers every word by its place in `known`.
    """

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string())
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        flat, lists = split.flatten(), split.offsets.to_numpy()
        # Blanks at an end of a text leave an empty piece there.
        real = np.asarray(pc.not_equal(pc.binary_length(flat), 0))
        before = np.concatenate([[0], np.cumsum(real)])
        coded = flat.filter(pa.array(real)).dictionary_encode()
        self.ends = before[lists[1:] - lists[0]].astype(np.int64)
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.known = coded.dictionary
        self.flat = coded

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]]).astype(np.int64)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        own = [xxh3_64_intdigest(word) for word in self.known.cast(pa.large_binary()).to_pylist()]
        return np.array(own, np.uint64)[self.ids] if own else np.zeros(0, np.uint64)

    def joined(self, kept: np.ndarray | None = None) -> pa.Array:
        """Each text's words (of which `kept` are chosen) joined by one space."""
        flat, ends = self.flat, self.ends
        if kept is not None:
            flat, ends = flat.filter(pa.array(kept)), np.concatenate([[0], np.cumsum(kept)])[ends]
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        words = flat.cast(pa.string()) if len(flat) else pa.array([], pa.string())
        return pc.binary_join(pa.ListArray.from_arrays(offsets, words), " ")


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def run_hashes(hashes: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """For each size the 64-bit hash of so many values in a row, from every place; by doubling, each level mixed anew."""
    powers = {1: hashes}
    while 2 * max(powers) <= max(sizes):
        power = max(powers)
        powers[2 * power] = _followed(powers[power], powers[power], power)
    found = {}
    for size in sizes:
        value, length = None, 0
        for power in sorted(powers, reverse=True):
            if size - length >= power:
                value = powers[power] if value is None else _followed(value, powers[power], length)
                length += power
        found[size] = value
    return found


def _followed(first: np.ndarray, second: np.ndarray, ahead: int) -> np.ndarray:
    """Combine each value with the one so far ahead; the result has as many fewer values."""
    n = max(0, len(second) - ahead)
    return mixed(first[:n] * np.uint64(0x9E3779B97F4A7C15) + second[ahead : ahead + n])
