"""Benchmark decontamination with SimHash fingerprints of item-sized windows.

A benchmark item of m word shingles is compared with every window of m consecutive shingles of a
document (or the whole document if it is shorter).  Windows that share no shingle with any item
cannot be similar and are skipped.  The others get a 128-bit SimHash; a multi-index of
``RADIUS`` + 1 bit blocks finds every item whose fingerprint lies within ``RADIUS`` bits, as two
fingerprints that near agree on a whole block.  Candidates are verified by the exact weighted
similarity of their shingles: sum of the smaller over sum of the larger counts, 0.8 or more.

``RADIUS`` = 36 lies four standard deviations above the distance that similarity 0.8 gives if no
shingle is repeated.  A repeated shingle can turn many bits at once, so windows and items with one
are compared without fingerprints: their common weight is counted for every window.

Words are runs of letters, digits and non-ASCII bytes, A-Z lower-cased.  A text of fewer words than a
shingle is one shingle and only matches equal texts.  Null and empty texts, documents or items,
match nothing.  Repeated rows give the same pairs once.  Items without id are told apart by their
text and give pairs with a null item_id.  Items are worked on in passes of at most
about ``PASS_BYTES`` of benchmark text, the only data every task gets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardwatch.llm.textarrays import LOWER, PrefixHash, Texts, Words, mix, shingles, slices

WORDS = 5
SIMILAR = 0.8
RADIUS = 36
PASS_BYTES = 4 << 20
_RUN = 8192

NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def text_shingles(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """Text number, first word and hash of every shingle, and the words."""
    words = Words(texts, NOT_WORD)
    return *shingles(PrefixHash(LOWER[texts.data]).ranges(words.starts, words.ends), words, k), words


def _signs(hashes: np.ndarray) -> np.ndarray:
    """The 128 bits of each shingle as rows of -1 and 1."""
    both = np.stack([hashes, mix(hashes ^ np.uint64(0x5851F42D4C957F2D))], 1)
    return np.unpackbits(both.view(np.uint8).reshape(len(hashes), 16), axis=1).astype(np.int32) * 2 - 1


def window_prints(hashes: np.ndarray, size: int) -> np.ndarray:
    """The fingerprint bits of every window of ``size`` shingles, one row each."""
    running = np.zeros((len(hashes) + 1, 128), np.int32)
    np.cumsum(_signs(hashes), axis=0, out=running[1:])
    return running[size:] > running[:-size]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two lists of shingles, counts as weights."""
    keys, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.bincount(place[: len(a)], minlength=len(keys)), np.bincount(place[len(a) :], minlength=len(keys))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


def _latest_repeat(hashes: np.ndarray) -> np.ndarray:
    """For each place, the last place up to which a shingle seen by then was seen before; -1 for none."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    before = np.full(len(hashes), -1)
    before[order[1:][same]] = order[:-1][same]
    return np.maximum.accumulate(before)


def window_similarities(hashes: np.ndarray, size: int, part: np.ndarray, least: float) -> np.ndarray:
    """The weighted similarity of ``part`` and every window of ``size``; 0 for all if none reaches ``least``."""
    def windows(here: np.ndarray) -> np.ndarray:
        running = np.zeros(len(here) + 1, np.int64)
        np.cumsum(here, out=running[1:])
        return running[size:] - running[:-size]

    keys, counts = np.unique(part, return_counts=True)
    place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    shared = keys[place] == hashes
    common, whole = windows(shared), size + len(part)
    if (common / (whole - common) < least).all():
        return np.zeros(len(common))
    seen = np.bincount(place[shared], minlength=len(keys))
    common = windows(shared & (seen[place] <= counts[place]))
    for g in np.flatnonzero(seen > counts):
        common += np.minimum(windows(shared & (place == g)), counts[g])
    return common / (whole - common)


def _blocks(bits: np.ndarray) -> np.ndarray:
    """One small number for each of the RADIUS + 1 blocks of a row of bits."""
    edges = np.linspace(0, bits.shape[1], RADIUS + 2).astype(int)
    weights = np.zeros((bits.shape[1], RADIUS + 1), np.int64)
    for j, (a, b) in enumerate(zip(edges, edges[1:])):
        weights[a:b, j] = 1 << np.arange(b - a)
    return bits.astype(np.int64) @ weights


@dataclass
class Items:
    """Benchmark items of one pass."""

    ids: np.ndarray
    parts: list[np.ndarray]
    prints: np.ndarray
    blocks: np.ndarray
    known: np.ndarray
    holders: np.ndarray
    first: np.ndarray
    repeated: np.ndarray | None = None
    named: np.ndarray | None = None

    @staticmethod
    def of(rows: pa.Table, k: int) -> "Items":
        ids, named, parts = [], [], []
        for batch in rows.to_batches():
            for texts in slices(batch.column("text")):
                text, _, hashes, _ = text_shingles(texts, k)
                bounds = np.searchsorted(text, np.arange(len(texts) + 1))
                numbers = batch.column("item").to_numpy(zero_copy_only=False)
                known = batch.column("named").to_numpy(zero_copy_only=False)
                for i in np.flatnonzero(np.diff(bounds)):
                    ids.append(numbers[texts.first + i])
                    named.append(known[texts.first + i])
                    parts.append(hashes[bounds[i] : bounds[i + 1]])
        prints = (np.concatenate([window_prints(p, len(p)) for p in parts]) if parts else np.zeros((0, 128), bool))
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.argsort(flat, kind="stable")
        known, first = np.unique(flat[order], return_index=True)
        return Items(np.array(ids, np.int64), parts, prints, _blocks(prints), known, owner[order],
                     np.append(first, len(flat)), np.array([len(np.unique(p)) < len(p) for p in parts], bool),
                     np.array(named, bool))

    def near(self, sizes_of: np.ndarray, bits: np.ndarray) -> list[tuple[int, int]]:
        """(window, item) pairs of the items ``sizes_of`` within the radius, by way of the blocks."""
        shared = np.zeros((len(bits), len(sizes_of)), bool)
        mine, theirs = _blocks(bits), self.blocks[sizes_of]
        for j in range(RADIUS + 1):
            shared |= mine[:, j, None] == theirs[None, :, j]
        window, item = np.nonzero(shared)
        distance = (bits[window] != self.prints[sizes_of[item]]).sum(1)
        close = distance <= RADIUS
        return list(zip(window[close].tolist(), sizes_of[item[close]].tolist()))


def _runs(hits: np.ndarray, size: int, n: int) -> Iterator[tuple[int, int]]:
    """Ranges of window starts that contain a hit, cut to ``_RUN`` starts."""
    low, high = np.maximum(hits - size + 1, 0), np.minimum(hits, n - size)
    good = high >= low
    low, high = low[good], high[good]
    if not len(low):
        return
    new = np.flatnonzero(np.append(True, low[1:] > high[:-1] + 1))
    for a, b in zip(low[new], np.append(high[new[1:] - 1], high[-1])):
        for s in range(int(a), int(b) + 1, _RUN):
            yield s, min(s + _RUN, int(b) + 1)


def matches(hashes: np.ndarray, items: Items, least: float) -> dict[int, tuple[float, int, int]]:
    """Item -> best similarity, first shingle and size of the window, of one document."""
    place = np.searchsorted(items.known, hashes)
    hit = place < len(items.known)
    hit[hit] = items.known[place[hit]] == hashes[hit]
    hits, n, best = np.flatnonzero(hit), len(hashes), {}
    if not len(hits):
        return best
    found = np.unique(place[hits])
    touched = np.unique(np.concatenate([items.holders[items.first[g] : items.first[g + 1]] for g in found]))
    sizes = np.array([min(len(items.parts[i]), n) for i in touched])
    repeat = _latest_repeat(hashes)

    def offer(i: int, value: float, at: int, size: int) -> None:
        if value >= least and (i not in best or (value, -at) > (best[i][0], -best[i][1])):
            best[i] = (value, at, size)

    for size in map(int, np.unique(sizes)):
        of_size = touched[sizes == size]
        for a, b in _runs(hits, size, n):
            run = hashes[a : b - 1 + size]
            again = repeat[a + size - 1 : b + size - 1] >= np.arange(a, b)
            plain = of_size[~items.repeated[of_size]]
            if len(plain) and not again.all():
                for w, i in items.near(plain, window_prints(run, size)):
                    if not again[w]:
                        offer(i, similarity(run[w : w + size], items.parts[i]), a + w, size)
            for i in (of_size if again.any() else of_size[items.repeated[of_size]]).tolist():
                values = window_similarities(run, size, items.parts[i], least)
                if not items.repeated[i]:
                    values[~again] = 0
                w = int(values.argmax())
                offer(i, float(values[w]), a + w, size)
    return best


def _search(items: Items, k: int, least: float):
    schema = pa.schema([("doc_id", pa.int64()), ("item", pa.int64()), ("named", pa.bool_()),
                        ("similarity", pa.float64()), ("first_byte", pa.int64()), ("end_byte", pa.int64())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for texts in slices(batch.column("text")):
                text, word, hashes, words = text_shingles(texts, k)
                place = np.searchsorted(items.known, hashes)
                hit = place < len(items.known)
                hit[hit] = items.known[place[hit]] == hashes[hit]
                bounds, rows = np.searchsorted(text, np.arange(len(texts) + 1)), []
                for t in np.unique(text[hit]):
                    a, b = bounds[t], bounds[t + 1]
                    last = words.first[t + 1] - 1
                    for i, (value, at, size) in matches(hashes[a:b], items, least).items():
                        end = min(word[a + at + size - 1] + k - 1, last)
                        base = texts.offsets[t]
                        rows.append((ids[texts.first + int(t)].as_py(), int(items.ids[i]), bool(items.named[i]), value,
                                     int(words.starts[word[a + at]] - base), int(words.ends[end] - base)))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return apply


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = WORDS, least: float = SIMILAR,
                 pass_bytes: int = PASS_BYTES) -> DataFrame:
    """doc_id, item_id, similarity and byte range (UTF-8) of the best window, for every similar pair."""
    number = F.col("item_id").cast("long")
    items = benchmark.filter("text is not null").select(
        F.coalesce(number, F.xxhash64("text")).alias("item"), number.isNotNull().alias("named"), "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes, found = max(1, -(-total // pass_bytes)), None
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for n in range(passes):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == n).orderBy("item", "text").toArrow()
        pairs = narrow.mapInArrow(
            _search(Items.of(rows, k), k, least),
            "doc_id long, item long, named boolean, similarity double, first_byte long, end_byte long")
        found = pairs if found is None else found.union(pairs)
    best = F.max(F.struct("similarity", (-F.col("first_byte")).alias("before"), "end_byte"))
    return found.groupBy("doc_id", "item", "named").agg(best.alias("b")).select(
        "doc_id", F.when(F.col("named"), F.col("item")).alias("item_id"), "b.similarity", (-F.col("b.before")).alias("first_byte"), "b.end_byte")
