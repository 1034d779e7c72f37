"""Words, shingles and their hashes of many texts at once, on numpy arrays.

Texts come as Arrow batches inside Spark tasks.  A batch is worked on in slices
that fit a core's cache, so memory depends on the slice and the longest single text only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
LONG = 128
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit half of the time."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_powers = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64; kept for the next slices unless a text is very long."""
    known = _powers.get(int(base))
    if known is None or len(known) <= n:
        steps = np.full(max(n, SLICE_BYTES) + 1, base, np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if len(known) <= 16 * SLICE_BYTES:
            _powers[int(base)] = known
    return known[: n + 1]


class PrefixHash:
    """Hashes of any byte ranges of one array, from one running sum.

    A sum modulo 2^64 has unlike strings of equal hash from about a thousand bytes on (sequences of two letters
    whose differences cancel).  Ranges of more than ``LONG`` bytes are hashed by BLAKE2 instead.
    """

    def __init__(self, data: np.ndarray):
        self.data = data
        terms = _BYTE_CODE[data]
        terms *= _power(_BASE, len(data))[:-1] if len(data) else terms
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])
        self.shift = _power(_INVERSE, len(data))

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        length = (ends - starts).astype(np.uint64)
        found = mix((self.sums[ends] - self.sums[starts]) * self.shift[starts] + length)
        for i in np.flatnonzero(length > LONG):
            some = hashlib.blake2b(np.ascontiguousarray(self.data[starts[i] : ends[i]]), digest_size=8)
            found[i] = int.from_bytes(some.digest(), "little")
        return found

    def windows(self, width: int) -> np.ndarray:
        """One hash for each start of ``width`` bytes."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * self.shift[:n])


class Texts:
    """A slice of texts: their bytes end to end, and where each begins."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Cut a string column into slices of about ``limit`` bytes; null texts are empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), n)
        yield Texts(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at)
        at = to


class Words:
    """Runs of non-separators: start, end, text number, and the first word of each text."""

    def __init__(self, texts: Texts, separator: np.ndarray = SPACE):
        gap = separator[texts.data]
        edge = np.zeros(len(texts.data) + 1, bool)
        edge[texts.offsets] = True
        before = np.ones(len(gap), bool)
        before[1:] = gap[:-1]
        after = np.ones(len(gap), bool)
        after[:-1] = gap[1:]
        self.starts = np.flatnonzero(~gap & (before | edge[:-1]))
        self.ends = np.flatnonzero(~gap & (after | edge[1:])) + 1
        self.text = np.searchsorted(texts.offsets, self.starts, "right") - 1
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self.count = np.diff(self.first)


def shingles(word_hash: np.ndarray, words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """text number, first word and hash of every run of ``k`` words.

    A text of fewer words has one shingle, its whole sequence; one without words has none.
    """
    n = len(word_hash)
    left = words.first[words.text + 1] - np.arange(n)
    short = (words.count[words.text] < k) & (np.arange(n) == words.first[words.text])
    at = np.flatnonzero((left >= k) | short)
    padded = np.concatenate([word_hash, np.zeros(k, np.uint64)])
    size = np.minimum(left[at], k)
    total = size.astype(np.uint64)
    for j in range(k):
        term = mix(padded[at + j] + np.uint64((j + 1) * int(_BASE) % 2**64))
        total += np.where(size > j, term, np.uint64(0)) * np.uint64((2 * j + 1) * int(_C2) % 2**64)
    return words.text[at], at, mix(total)


def distinct_in_text(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort by text and hash and keep each pair once."""
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[keep], hashes[keep]
