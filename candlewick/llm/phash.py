"""A minimal perfect hash over pairs of 64-bit hashes, in numpy.

Level by level every key sets a bit; keys that share a bit go on to the next level. A key's slot is the number
of set bits before its own, so n keys fill the slots 0 to n - 1. Keys that are not in the set end nowhere or in a
slot with another key's fingerprint.
"""

import numpy as np

SPREAD = 2.0  # bits a key and level
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def _place(first: np.ndarray, second: np.ndarray, level: int, size: int) -> np.ndarray:
    x = first + (second ^ np.uint64(level + 1)) * _ODD
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    def __init__(self, sizes: list[int], bits: np.ndarray):
        """`bits` holds the levels one after the other, `sizes` their lengths."""
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.before = np.cumsum(bits, dtype=np.int64) - bits

    @classmethod
    def build(cls, first: np.ndarray, second: np.ndarray) -> "PerfectHash":
        """From different pairs."""
        sizes, levels = [], []
        while len(first):
            size = max(64, int(SPREAD * len(first)))
            place = _place(first, second, len(sizes), size)
            alone = np.bincount(place, minlength=size)[place] == 1
            bits = np.zeros(size, np.uint8)
            bits[place[alone]] = 1
            sizes.append(size)
            levels.append(bits)
            first, second = first[~alone], second[~alone]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, np.uint8))

    @classmethod
    def unpack(cls, sizes: list[int], packed: bytes) -> "PerfectHash":
        bits = np.unpackbits(np.frombuffer(packed, np.uint8), count=int(sum(sizes)))
        return cls(list(sizes), bits)

    def pack(self) -> bytes:
        return np.packbits(self.bits).tobytes()

    def slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level has its bit."""
        slots = np.full(len(first), -1, np.int64)
        open_keys = np.arange(len(first))
        for level, size in enumerate(self.sizes):
            if not len(open_keys):
                break
            at = self.starts[level] + _place(first[open_keys], second[open_keys], level, size)
            here = self.bits[at] == 1
            slots[open_keys[here]] = self.before[at[here]]
            open_keys = open_keys[~here]
        return slots
