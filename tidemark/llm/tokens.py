"""Token ids of whole batches with the ``tokenizers`` library.

A text's pre-tokens never reach over white space, and many recur, so a batch is cut into segments
first and each distinct segment is encoded once. A plain segment (a run of Latin letters, a digit,
a run of symbols) is one pre-token and goes straight to the library's BPE model; a word that holds
any other character goes whole through the library's normaliser and pre-tokeniser.
``tests/llm/test_tokens.py`` compares the ids with those of whole texts.
"""

from __future__ import annotations

import os
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa

from tidemark.llm.words import LOWER, SPACES, prints, split, text_bytes

_LETTER, _DIGIT, _SYMBOL, _OTHER = 1, 2, 3, 4
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[33:127] = _SYMBOL
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[SPACES] = 0
# Contractions and special tokens are for the library to find.
_KIND[[ord("'"), ord("<")]] = _OTHER

#: Bytes of text encoded at once; the more, the fewer segments recur in the next slice.
ENCODED = 4 << 20
#: Distinct segments whose ids a Python worker keeps between batches, and their bytes at most.
CACHE = 400_000
CACHE_BYTES = 40_000_000


class Encoder:
    """Ids of texts under one tokenizer file; held once per Python worker."""

    held: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        # The character that stands for each byte of a Latin-1 letter, as the library shows it.
        self.shown = {}
        for letter in map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]):
            for byte, sign in zip(letter.encode(), self.whole.pre_tokenizer.pre_tokenize_str(letter)[0][0], strict=True):
                self.shown[byte] = sign
        self.known: dict[bytes, bytes] = {}
        self.known_bytes = 0

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls.held:
            cls.held[path] = cls(path)
        return cls.held[path]

    def _ids(self, segment: bytes, plain: bool) -> bytes:
        if not plain:
            ids = self.whole.encode(segment.decode(), add_special_tokens=False).ids
        else:
            text = segment.decode() if segment.isascii() else segment.decode("latin-1").translate(self.shown)
            ids = [t.id for t in self.model.tokenize(text)]
        if len(self.known) >= CACHE or self.known_bytes >= CACHE_BYTES:
            self.known, self.known_bytes = {}, 0
        packed = self.known[segment] = array("I", ids).tobytes()  # the garbage collector passes bytes over
        self.known_bytes += len(segment) + len(packed)
        return packed

    def batch(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and each text's offset in them."""
        data, offsets = text_bytes(column)
        words = split(data, offsets)
        if not len(words.start):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        kind = _KIND[data]
        # Latin-1 letters: a byte C3 and a byte 80-BF, but for the signs of times and division.
        after = np.flatnonzero(data[:-1] == 0xC3) + 1
        after = after[(data[after] != 0x97) & (data[after] != 0xB7)]
        kind[after] = kind[after - 1] = _LETTER
        low = LOWER[data]
        upper = after[data[after] < 0x9F]
        low[upper] += 0x20
        # A word with any other byte is one segment, taken as it is.
        other = np.flatnonzero(np.maximum.reduceat(kind, words.start) == _OTHER) if len(words.start) else words.start
        # reduceat runs to the next word's start; what lies between are separators of kind 0.
        begins = np.zeros(len(data), bool)
        np.not_equal(kind[1:], kind[:-1], out=begins[1:])
        begins |= kind == _DIGIT
        begins[words.start] = True
        begins &= kind != 0
        if len(other):
            inside = np.zeros(len(data) + 1, np.int8)
            inside[words.start[other]] = 1
            inside[words.end[other]] -= 1
            inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
            begins &= ~inside
            begins[words.start[other]] = True
            low = np.where(inside, data, low)
        start = np.flatnonzero(begins)
        word = np.searchsorted(words.start, start, "right") - 1
        end = np.empty_like(start)
        end[:-1] = start[1:]
        end[-1] = len(data)
        np.minimum(end, words.end[word], out=end)
        codes, _ = pd.factorize(prints(low, start, end))
        sample = np.empty(codes.max() + 1, np.int64)
        sample[codes[::-1]] = np.arange(len(codes))[::-1]
        raw = low.tobytes()
        whole = np.zeros(len(words.start), bool)
        whole[other] = True
        plain = ~whole[word[sample]]
        pools = []
        for a, b, c in zip(start[sample].tolist(), end[sample].tolist(), plain.tolist(), strict=True):
            segment = raw[a:b]
            ids = self.known.get(segment)
            pools.append(self._ids(segment, c) if ids is None else ids)
        count = np.fromiter(map(len, pools), np.int64, len(pools)) // 4
        pool = np.frombuffer(b"".join(pools), np.uint32)
        ids = pool[ragged(np.cumsum(count)[codes] - count[codes], count[codes])]
        before = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(count[codes], out=before[1:])
        return ids, before[np.searchsorted(start, offsets)]


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0] .. start[0]+length[0]-1, start[1] .. and so on, in one array."""
    total = int(length.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(length)
    return np.repeat(start - ends + length, length) + np.arange(total)


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Every document's ids followed by the id ``end``."""
    n = len(offsets) - 1
    return np.insert(ids, offsets[1:], end).astype(np.uint32), offsets + np.arange(n + 1)


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
