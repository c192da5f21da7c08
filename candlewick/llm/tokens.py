"""Token ids by the tokenizers library, with the pieces between blanks encoded once per worker.

A tokenizer treats a piece of text alike wherever it stands, as long as the cut lies where its own splitting cuts
anyway. For byte-level tokenizers that is before a single blank between other characters and around a single
newline; texts with other white space, or two such in a row, are encoded whole. For tokenizers that drop white
space it is any blank or newline.

Pieces are numbered as Arrow columns and their ids gathered as arrays. A new piece of plain letters, with or without
marks behind, goes straight to the library's model, as its own splitting leaves such letters whole; all others pass
the whole tokenizer.
"""

import json
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Pieces a worker keeps (about 200 bytes each), and texts and bytes it encodes together.
KEPT_PIECES = 400_000
TEXTS_AT_ONCE, BYTES_AT_ONCE = 2_048, 4 << 20
_PAIRS = ("  ", "\n\n", " \n", "\n ")
_ASCII_BLANKS = tuple(map(chr, (0, 9, 11, 12, 13, 28, 29, 30, 31)))
_BLANKS = _ASCII_BLANKS + tuple(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# Letters that NFC leaves alone, each lower-cased to one other; behind them marks that no rule joins to letters.
_MARKS = ",.;:!?"
_PLAIN = f"^ ?[A-Za-zÀ-ÖØ-öø-ÿ]+[{_MARKS}]*$"
_ID = attrgetter("id")
# What a file must say of its splitting for the letters to be one word of its model.
_BYTE_LEVEL = (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
_WORD_LEVEL = (
    {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
)


def _byte_characters() -> dict[int, int]:
    """The characters by which byte-level models write the 256 bytes."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: byte for byte in shown} | {byte: 256 + at for at, byte in enumerate(hidden)}


def _byte_level_cut(text: str) -> str | None:
    """The text with a NUL at each cut; None if it is to be encoded whole."""
    if any(pair in text for pair in _PAIRS) or any(
        blank in text for blank in (_ASCII_BLANKS if text.isascii() else _BLANKS)
    ):
        return None
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0")


def _word_cut(text: str) -> str:
    return text.replace("\n", " ")


def runs(texts: pa.Array, most_bytes: int = BYTES_AT_ONCE, most_texts: int = TEXTS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """(start, count) of runs of texts to be encoded together."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        stop = min(stop, start + most_texts)
        yield start, stop - start
        start = stop


class Encoder:
    def __init__(self, path: str, drops_blanks: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.code = "H" if self.dtype is np.uint16 else "I"
        self.cut, self.mark = (_word_cut, " ") if drops_blanks else (_byte_level_cut, "\0")
        self.lowers = drops_blanks
        self.bytes = _byte_characters() | {ord(self.mark): self.mark}
        self.kept: dict[str, bytes] = {"": b""}
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        splitting = (said.get("normalizer"), said.get("pre_tokenizer"))
        self.knows_letters = splitting == (_WORD_LEVEL if drops_blanks else _BYTE_LEVEL) and all(
            token["content"].startswith("<|") for token in said.get("added_tokens", [])
        )

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        cut = [self.cut(text or "") for text in texts]
        split = pc.split_pattern(pa.array(["" if text is None else text for text in cut], pa.string()), self.mark)
        coded = split.flatten().dictionary_encode()
        ids, lengths = self._ids(coded.dictionary)
        pieces = coded.indices.to_numpy().astype(np.int64)
        counts = lengths[pieces]
        upto = np.concatenate([[0], np.cumsum(counts)])
        # Each piece's ids stand together in `ids`; they are copied to every place of the piece.
        ahead = (np.cumsum(lengths) - lengths)[pieces] - upto[:-1]
        data = ids[np.arange(upto[-1]) + np.repeat(ahead, counts)]
        ends = upto[split.offsets.to_numpy()].tolist()
        found = [data[start:end] for start, end in zip(ends[:-1], ends[1:], strict=True)]
        whole = [at for at, text in enumerate(cut) if text is None]
        for at, own in zip(whole, self._whole([texts[at] for at in whole]), strict=True):
            found[at] = np.frombuffer(own, self.dtype)
        return found

    def _ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all the pieces, one after the other, and how many each has."""
        names = self._listed(pieces)
        found = list(map(self.kept.get, names))
        missing = [at for at, ids in enumerate(found) if ids is None]
        if missing:
            new = self._new(pieces.take(pa.array(missing)), [names[at] for at in missing])
            for at, ids in zip(missing, new, strict=True):
                found[at] = ids
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype().itemsize
        return np.frombuffer(b"".join(found), self.dtype), lengths

    def _joined(self, pieces: pa.Array) -> str:
        """One string, not one for each piece; pieces do not hold the mark."""
        return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), self.mark)[0].as_py()

    def _listed(self, pieces: pa.Array) -> list[str]:
        return self._joined(pieces).split(self.mark) if len(pieces) else []

    def _new(self, pieces: pa.Array, names: list[str]) -> list[bytes]:
        found: list[bytes | None] = [None] * len(names)
        plain = pc.match_substring_regex(pieces, _PLAIN) if self.knows_letters else pa.array([False] * len(names))
        places = np.flatnonzero(plain.to_numpy(zero_copy_only=False)).tolist()
        if places:
            joined = self._joined(pc.utf8_rtrim(pieces.filter(plain), _MARKS))
            words = (joined.lower() if self.lowers else joined).encode().decode("latin-1").translate(self.bytes)
            for at, letters, word in zip(places, joined.split(self.mark), words.split(self.mark), strict=True):
                found[at] = self._plain(names[at], letters, word)
        others = [at for at, ids in enumerate(found) if ids is None]
        for at, ids in zip(others, self._whole([names[at] for at in others]), strict=True):
            found[at] = ids
            self._keep(names[at], ids)
        return found

    def _keep(self, piece: str, ids: bytes) -> None:
        if len(self.kept) < KEPT_PIECES and len(piece) <= 64:
            self.kept[piece] = ids

    def _plain(self, piece: str, letters: str, word: str) -> bytes:
        """The ids of letters, which the model writes as `word`, and of the marks behind them."""
        ids = self.kept.get(letters)
        if ids is None:
            ids = array(self.code, map(_ID, self.model.tokenize(word))).tobytes()
            self._keep(letters, ids)
        if len(letters) == len(piece):
            return ids
        marks = piece[len(letters) :]
        behind = self.kept.get(marks)
        if behind is None:
            behind = self._whole([marks])[0]
            self._keep(marks, behind)
        self._keep(piece, ids + behind)
        return ids + behind

    def _whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, item.ids).tobytes() for item in encoded]


@lru_cache(maxsize=2)
def encoder(path: str, drops_blanks: bool) -> Encoder:
    return Encoder(path, drops_blanks)
