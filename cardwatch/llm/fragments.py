"""Which keys have several owners: counts in hash fragments, combined inside tasks first.

A key is the top bits of a 64-bit hash: ``bits`` of them name its fragment, the next 32 are what the
fragment stores.  A task sends every key once per owner, or once with the number of owners if it has seen
several, so a key that stands everywhere sends one entry per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PACKED = "fragment int, keys binary, owners binary, sizes binary, shared binary, shared_counts binary"
FLUSH_KEYS = 2_000_000
_LOW = np.uint64(32)


def by_key(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of ``bits`` bits in order, and their places, equal keys by place.

    A place is sorted along as the lowest bits of its key where both fit 64 bits, which takes a fraction of an argsort's time.
    """
    low = len(key).bit_length()
    if bits + low > 64:
        place = np.argsort(key, kind="stable")
        return key[place], place
    packed = (key.astype(np.uint64) << np.uint64(low)) | np.arange(len(key), dtype=np.uint64)
    packed.sort()
    return packed >> np.uint64(low), (packed & np.uint64((1 << low) - 1)).astype(np.int64)


def owners_of(key: np.ndarray, owner: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, how many different owners each has, and the place of one of its entries.

    Only entries of keys that come more than once are compared by owner.
    """
    key, place = by_key(key, bits)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    several = np.flatnonzero(count > 1)
    run = np.repeat(np.arange(len(several)), count[several])
    inside = np.arange(len(run)) - np.repeat(np.cumsum(count[several]) - count[several], count[several])
    whose = owner[place[first[several][run] + inside]]
    same = np.append(False, (run[1:] == run[:-1]) & (whose[1:] == whose[:-1])) if len(run) else np.zeros(0, bool)
    run, whose = run[~same], whose[~same]  # an owner's entries mostly follow each other
    order = np.lexsort((whose, run))
    run, whose = run[order], whose[order]
    new = np.append(True, (run[1:] != run[:-1]) | (whose[1:] != whose[:-1])) if len(run) else np.zeros(0, bool)
    count[several] = np.bincount(run[new], minlength=len(several))
    return key[first], count, place[first]


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in ``known``, which is sorted: each is looked up, ``known`` is not sorted again as by ``np.isin``."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def pack(hashes: np.ndarray, owner: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """One row per fragment: keys by owner, and the keys of several owners with their counts."""
    raw = hashes >> np.uint64(32 - bits)
    key, count, place = owners_of(raw, owner, 32 + bits)
    shared, shared_count = key[count > 1], count[count > 1].astype(np.uint32)
    single = place[count == 1].astype(np.uint64)
    low = len(raw).bit_length()
    single |= raw[single] >> _LOW << np.uint64(low)
    single.sort()  # by fragment, then as they came: an owner's keys follow each other
    single &= np.uint64((1 << low) - 1)
    fragment, owner, single = raw[single] >> _LOW, owner[single], raw[single].astype(np.uint32)
    start = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (fragment[1:] != fragment[:-1]))) if len(owner) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(owner))).astype(np.uint32)
    owner, of = owner[start], fragment[start]
    names = np.union1d(of, shared >> _LOW)
    cuts = [np.append(np.searchsorted(x, names), len(x)) for x in (fragment, of, shared >> _LOW)]
    shared = shared.astype(np.uint32)
    rows = [(f, single[a:b].tobytes(), owner[c:d].tobytes(), size[c:d].tobytes(), shared[e:g].tobytes(), shared_count[e:g].tobytes())
            for f, a, b, c, d, e, g in zip(names.tolist(), *(x for cut in cuts for x in (cut[:-1].tolist(), cut[1:].tolist())))]
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows))],
            ["fragment", "keys", "owners", "sizes", "shared", "shared_counts"])


class Packer:
    """Holds pairs of hash and owner until there are enough to send."""

    def __init__(self, bits: int):
        self.bits, self.hashes, self.owners, self.count = bits, [], [], 0

    def add(self, hashes: np.ndarray, owner: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.hashes.append(hashes)
        self.owners.append(owner)
        self.count += len(hashes)
        if self.count >= FLUSH_KEYS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.count:
            yield from pack(np.concatenate(self.hashes), np.concatenate(self.owners), self.bits)
        self.hashes, self.owners, self.count = [], [], 0


def tally(rows: pa.Table) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Fragment, its distinct keys, their owners' numbers, and the owner of each key of one owner only."""

    def joined(name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(rows.column(name).to_pylist()), kind)

    owner = np.repeat(joined("owners", np.uint64), joined("sizes", np.uint32))
    keys, count, first = owners_of(joined("keys", np.uint32), owner, 32)
    keys = keys.astype(np.uint32)
    shared, place = np.unique(joined("shared", np.uint32), return_inverse=True)
    more = np.bincount(place, joined("shared_counts", np.uint32), len(shared)).astype(np.int64)
    at = np.searchsorted(shared, keys)
    known = at < len(shared)
    known[known] = shared[at[known]] == keys[known]
    total = count.astype(np.int64)
    alone = owner[first[(count == 1) & ~known]]
    total[known] += more[at[known]]
    only = np.setdiff1d(np.arange(len(shared)), at[known])
    return rows.column("fragment")[0].as_py(), np.append(keys, shared[only]), np.append(total, more[only]), alone
