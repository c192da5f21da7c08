"""Range asymmetric numeral system over a fixed frequency table, in numpy.

A block is coded by interleaved lanes that share one stream of 32-bit words: token i belongs to lane i mod LANES.
Every SEGMENT steps the encoder writes a checkpoint, the states of all lanes and the place in the stream, and a
decoder can begin at any of them; here it decodes all segments of a block at the same time. The last four bytes of
a block are the CRC-32 of all bytes before.
"""

import struct
import zlib

import numpy as np

LANES = 1024
SEGMENT = 128
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_HEAD = struct.Struct("<4sHHBxxxIQQII")
_MAGIC = b"RANS"
NO_ID = -(1 << 63)  # stands for a NULL id


class Table:
    def __init__(self, tokens: np.ndarray, frequencies: np.ndarray, scale: int):
        """Frequencies of the tokens, in token order, that add up to 2 ** scale."""
        self.tokens, self.scale = tokens.astype(np.int64), scale
        self.frequency = frequencies.astype(np.uint64)
        self.below = (np.cumsum(frequencies) - frequencies).astype(np.uint64)
        self.place = np.full(int(tokens.max()) + 1 if len(tokens) else 1, -1, np.int64)
        self.place[self.tokens] = np.arange(len(tokens))
        self.slot = np.repeat(np.arange(len(tokens), dtype=np.uint32), frequencies.astype(np.int64))
        self.checksum = zlib.crc32(self.tokens.tobytes() + self.frequency.tobytes())

    @classmethod
    def from_counts(cls, tokens: np.ndarray, counts: np.ndarray, scale: int = 20) -> "Table":
        """Scale counts; every token keeps at least one slot."""
        order = np.argsort(tokens)
        tokens, counts = tokens[order], counts[order].astype(np.float64)
        if len(tokens) == 0:
            tokens, counts = np.array([0]), np.array([1.0])
        if len(tokens) > 1 << scale:
            raise ValueError(f"{len(tokens)} different tokens need a scale over {scale} bits")
        spare = (1 << scale) - len(tokens)
        share = counts / counts.sum() * spare
        frequencies = 1 + np.floor(share).astype(np.int64)
        frequencies[np.argsort(np.floor(share) - share, kind="stable")[: (1 << scale) - frequencies.sum()]] += 1
        return cls(tokens, frequencies, scale)


def encode_block(table: Table, ids: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, first: int) -> bytes:
    """A block of whole documents: their ids and token counts, and all tokens; `first` counts the tokens before."""
    n = len(tokens)
    steps = -(-n // LANES)
    symbols = np.zeros(steps * LANES, np.int64)
    symbols[:n] = table.place[tokens]
    symbols = symbols.reshape(steps, LANES)
    scale, room = np.uint64(table.scale), np.uint64(63 - table.scale)
    state = np.full(LANES, _LOW, np.uint64)
    chunks, checkpoints = [None] * steps, {}
    for step in range(steps - 1, -1, -1):
        frequency, below = table.frequency[symbols[step]], table.below[symbols[step]]
        full = state >= frequency << room
        chunks[step] = state[full].astype(np.uint32)
        state[full] >>= _WORD
        whole = state // frequency
        state = (whole << scale) + (state - whole * frequency) + below
        if step % SEGMENT == 0:
            checkpoints[step] = state.copy()
    starts = np.cumsum([0] + [len(chunk) for chunk in chunks])
    words = np.concatenate(chunks) if chunks else np.zeros(0, np.uint32)
    body = [_HEAD.pack(_MAGIC, 1, LANES, table.scale, table.checksum, n, first, len(ids), len(words))]
    body += [ids.astype("<i8").tobytes(), lengths.astype("<u4").tobytes()]
    for step in range(0, steps, SEGMENT):
        body += [struct.pack("<I", starts[step]), checkpoints[step].astype("<u8").tobytes()]
    body.append(words.astype("<u4").tobytes())
    whole = b"".join(body)
    return whole + struct.pack("<I", zlib.crc32(whole))


def decode_block(table: Table, block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The ids, token counts, tokens and `first` of a block; raises ValueError if it is damaged."""
    if len(block) < _HEAD.size + 4 or struct.unpack("<I", block[-4:])[0] != zlib.crc32(block[:-4]):
        raise ValueError("damaged block")
    magic, version, lanes, scale, checksum, n, first, documents, count = _HEAD.unpack_from(block)
    if (magic, version, scale, checksum) != (_MAGIC, 1, table.scale, table.checksum):
        raise ValueError("block of another format or table")
    at = _HEAD.size
    ids = np.frombuffer(block, "<i8", documents, at)
    lengths = np.frombuffer(block, "<u4", documents, at + 8 * documents)
    at += 12 * documents
    steps = -(-n // lanes)
    segments = -(-steps // SEGMENT)
    state, place = np.empty((segments, lanes), np.uint64), np.empty(segments, np.int64)
    for segment in range(segments):
        place[segment] = struct.unpack_from("<I", block, at)[0]
        state[segment] = np.frombuffer(block, "<u8", lanes, at + 4)
        at += 4 + 8 * lanes
    words = np.concatenate([np.frombuffer(block, "<u4", count, at), [0]]).astype(np.uint64)
    symbols = np.zeros((segments, SEGMENT, lanes), np.uint32)
    mask, bits = np.uint64((1 << scale) - 1), np.uint64(scale)
    last = steps - SEGMENT * (segments - 1)
    for step in range(min(SEGMENT, steps)):
        live = segments if step < last else segments - 1
        x = state[:live]
        slot = x & mask
        symbol = table.slot[slot]
        symbols[:live, step] = symbol
        x = table.frequency[symbol] * (x >> bits) + slot - table.below[symbol]
        short = x < _LOW
        taken = np.cumsum(short, axis=1)
        read = words[np.minimum(place[:live, None] + taken - 1, count)]
        state[:live] = np.where(short, (x << _WORD) | read, x)
        place[:live] += taken[:, -1]
    return ids, lengths, table.tokens[symbols.reshape(-1)[:n]], first
