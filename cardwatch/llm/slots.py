"""A minimal perfect hash over a fixed set of 32-byte digests, on numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from cardwatch.llm.textarrays import mix

_STEP = 0x9E3779B97F4A7C15


def digest_words(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of 32-byte values as rows of four words; null is all zero."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(bytes(32) if v is None else v for v in values), np.uint64).reshape(len(values), 4)


class SlotTable:
    """Gives n distinct digests the slots 0 to n-1.

    Keys are thrown into a row of twice as many places; those that fall alone keep their place, the rest go
    on to the next row.  A slot is the number of taken places before it.  Every slot remembers its digest, so
    a digest that is not in the table is never taken for one that is.
    """

    def __init__(self, keys: np.ndarray):
        self.rows, self.slots = [], np.zeros(len(keys), np.int64)
        left, taken = np.arange(len(keys)), 0
        while len(left):
            size = 2 * len(left) + 1
            at = self._place(keys[left], len(self.rows), size)
            alone = np.bincount(at, minlength=size) == 1
            rank = np.cumsum(alone) - 1 + taken
            self.rows.append((size, alone, rank))
            hit = alone[at]
            self.slots[left[hit]] = rank[at[hit]]
            taken += int(hit.sum())
            left = left[~hit]
            if len(self.rows) > 200:
                raise ValueError("the keys of a slot table must be distinct")
        self.keys = np.zeros_like(keys)
        self.keys[self.slots] = keys

    @staticmethod
    def _place(keys: np.ndarray, row: int, size: int) -> np.ndarray:
        salt = np.uint64((row + 1) * _STEP % 2**64)
        return (mix(keys[:, 0] ^ mix(keys[:, 1] + salt)) % np.uint64(size)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slots of digests; -1 for those that are not in the table."""
        found, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for row, (size, alone, rank) in enumerate(self.rows):
            at = self._place(keys[left], row, size)
            hit = alone[at]
            found[left[hit]] = rank[at[hit]]
            left = left[~hit]
        known = found >= 0
        known[known] = (self.keys[found[known]] == keys[known]).all(axis=1)
        return np.where(known, found, -1)
