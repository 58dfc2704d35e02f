"""Words of whole Arrow batches as numpy arrays, without a Python step per word.

All texts of a batch are one byte array. Separators are found by a table lookup, and a word's
64-bit fingerprint comes from running sums of a polynomial over its bytes, so the cost is a few
array passes however long or short texts and words are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
#: Odd multipliers of the polynomials and their inverses modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_BASE_2 = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
#: Everything but 0-9, a-z and bytes of non-ASCII characters, for lower-cased text.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[48:58] = NOT_ALNUM[97:123] = NOT_ALNUM[128:] = False
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept, and grown by half when too short."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        p = np.full(max(1024, n + n // 2), base, _U)
        p[0] = 1
        have = _powers[base] = np.cumprod(p, dtype=_U)
    return have[:n]


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Fingerprint of values[starts[i]:ends[i]] for every i, for 64-bit values."""
    if not len(starts):
        return np.empty(0, _U)
    inverse = pow(base, -1, 1 << 64)
    total = np.empty(len(values) + 1, _U)
    total[0] = 0
    np.cumsum(values * _power(base, len(values)), dtype=_U, out=total[1:])
    return mix((total[ends] - total[starts]) * _power(inverse, len(values) + 1)[starts] + (ends - starts).astype(_U))


#: Bytes or words whose running sums are held at a time, so that memory does not grow with a batch.
PIECE = 1 << 18


def prints(data: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Fingerprint of each of the ascending, disjoint runs of bytes, some at a time."""
    out = np.empty(len(start), _U)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + PIECE, "right")))
        low, high = start[at], end[to - 1]
        out[at:to] = spans(_BYTES[data[low:high]], start[at:to] - low, end[at:to] - low, base)
        at = to
    return out


@dataclass
class Words:
    """Words of a batch: bytes of all texts, each word's span in them, and each document's words."""

    data: np.ndarray  # uint8
    start: np.ndarray  # int64, per word
    end: np.ndarray
    first: np.ndarray  # int64, per document and one more: words before it

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, base: int = _BASE) -> np.ndarray:
        return prints(self.data, self.start, self.end, base)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and each text's offset in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def split(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACES) -> Words:
    """Words of texts as runs of bytes that are not ``apart``; no word spans two texts."""
    n = len(data)
    inside = ~apart[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    bounds = offsets[1:-1]
    bounds = bounds[bounds < n]
    begins[bounds] = inside[bounds]
    start = np.flatnonzero(begins)
    ends = inside
    ends[:-1] &= ~inside[1:] | begins[1:]
    end = np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def words_of(column: pa.Array, lower: bool = False, apart: np.ndarray = SPACES) -> Words:
    data, offsets = text_bytes(column)
    return split(LOWER[data] if lower else data, offsets, apart)


def windows(hashes: np.ndarray, size: int, base: int = _BASE) -> np.ndarray:
    """Fingerprint of each ``size`` consecutive values; one at each place where so many are left."""
    n = max(0, len(hashes) - size + 1)
    out = np.empty(n, _U)
    for low in range(0, n, PIECE):
        at = np.arange(min(PIECE, n - low))
        out[low : low + len(at)] = spans(hashes[low : low + len(at) + size - 1], at, at + size, base)
    return out


def starts_of(first: np.ndarray, size: int) -> np.ndarray:
    """Places at which a window of ``size`` words fits into its document."""
    ok = np.ones(int(first[-1]), bool)
    counts = np.diff(first)
    last = first[1:]
    for k in range(1, size):  # the last size - 1 words of a document
        ok[last[counts >= k] - k] = False
    return np.flatnonzero(ok)


def sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest key of each ``width`` consecutive ones."""
    n = len(keys)
    if n < width:
        return np.empty(0, np.int64)
    at = np.arange(n)
    have = 1
    while have < width:
        step = min(have, width - have)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(keys[right] < keys[left], right, left)
        have += step
    return at


#: Bytes of text handled at once; intermediates take a few dozen times as much.
SLICE = 1 << 20


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE):
    """Cuts a batch into runs of rows whose texts take ``limit`` bytes at most, or one row."""
    texts = batch.column(column)
    if not len(texts):
        return
    _, offsets = text_bytes(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
