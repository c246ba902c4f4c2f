"""Words of whole Arrow text batches as 64-bit hashes, without a Python object per word.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; A-Z are lower-cased. The UTF-8
bytes of the batch are hashed with one running polynomial sum, so the cost is a few passes of NumPy
over the bytes. Equal words have equal hashes in every process.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute

BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Every ASCII byte but letters and digits.
MARKS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """hash, start and end (bytes in `raw`) of every word; words of row i are first[i]:first[i+1]."""

    def __init__(self, texts: pa.Array, lower: bool = True, between: np.ndarray = SPACE):
        raw, offsets = buffers(texts)
        self.raw, self.offsets = raw, offsets
        inside = ~between[raw]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cuts = offsets[:-1][(offsets[:-1] < offsets[1:]) & (offsets[:-1] > 0)]
        begins[cuts] = inside[cuts]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        ends[cuts - 1] = inside[cuts - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self._cut()
        values = self._folded(lower).astype(np.uint64)
        values += np.uint64(1)
        values *= powers(BASE, len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(values, dtype=np.uint64, out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * powers(BASE_INVERSE, len(raw) + 1)[self.start])

    def _cut(self) -> None:
        """Words stay whole."""

    def _folded(self, lower: bool) -> np.ndarray:
        return LOWER[self.raw] if lower else self.raw

    def __len__(self) -> int:
        return len(self.hash)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of `size` word hashes (none if there are fewer words)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = (out * np.uint64(BASE)) ^ mix(hashes[k : k + n] + np.uint64(k + 1))
    return mix(out)


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles of one text; with fewer words, the whole sequence as one."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    if len(hashes) < size:
        return np.array([grams(hashes, len(hashes))[0] ^ np.uint64(len(hashes))], np.uint64)
    return np.unique(grams(hashes, size))


def plain_words(texts: pa.Array) -> Words:
    """Words for matching across editions: lower case, ASCII punctuation separates."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return Words(pa.compute.utf8_lower(texts), lower=False, between=MARKS)


class Members:
    """Which of many 64-bit values belong to a fixed set: a bit filter first, then a sorted search."""

    BITS = 22

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.bits = np.zeros(1 << self.BITS, bool)
        self.bits[self.values & np.uint64((1 << self.BITS) - 1)] = True

    def where(self, x: np.ndarray) -> np.ndarray:
        """Positions of members in x."""
        if not len(self.values):
            return np.zeros(0, np.int64)
        hit = np.flatnonzero(self.bits[x & np.uint64((1 << self.BITS) - 1)])
        at = np.minimum(np.searchsorted(self.values, x[hit]), len(self.values) - 1)
        return hit[self.values[at] == x[hit]]


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the longs that Spark holds."""
    return x.view(np.int64)


def pieces(batch: pa.RecordBatch, column: int | str, size: int = 1 << 19):
    """Slices of a batch with about `size` bytes of text each (a longer text alone), in order."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, to - at)
        at = to
