"""Jaccard self-join of documents on word shingles by vertical partitioning.

The shingles of all documents have one global order: the frequent ones last, the others by
their hash.  The order is cut into fragments.  Four facts keep the join small and exact, for a
similarity of ``percent`` hundredths and a document of n distinct shingles:

* A partner shares ceil(percent n / 100) of them.  Fragments count, each by itself, the shingles
  that only one set has; summed per document they rule out most documents (``_singles``).
* Partners share one of the first n - ceil(percent n / 100) + 1 in the global order.  Those make
  the candidates; sizes and places in the order rule out more.
* The bits in which two sets' marks differ are at most the shingles that one of them alone has.  A mark is ``MARKS`` words, each the
  sum modulo 2 of a bit per shingle; pairs whose marks differ in too many bits are no partners, and their sets are not read.
* The overlap of a pair that is left is counted fragment by fragment and summed, in one expression on the pair's row: a row per
  pair and fragment would give the same sums from four times as many rows.

Equal sets are one node, whatever the number of copies.  Candidates of a shared shingle are not
all paired: in a few rounds each is compared with some of them (``LEADERS``, drawn anew per shingle and round), and
then only pairs that are not yet known to be of one component are compared one by one.  No link between
different components is missed, so components are exact; pairs inside a component are not enumerated.

Which shingles count as frequent only affects speed; the ``HOT_GRAMS`` most frequent go to all
executors.  Sets and shingles are compared by 64-bit hashes.

Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased.  A document of fewer words than a shingle has one,
its whole sequence; one without words or text has none and is alone.  Null ids take part, but a
component's id is the least id that is not null.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cardwatch.llm.components import components
from cardwatch.llm.fragments import PACKED, Packer, among, tally
from cardwatch.llm.store import written
from cardwatch.llm.textarrays import LOWER, PrefixHash, Texts, Words, distinct_in_text, mix, shingles, slices

HOT_GRAMS = 1_000_000
HOT_DOCUMENTS = 48
FRAGMENT_GRAMS = 1_500_000
FIRST_PART = 0.3
SEGMENTS = 4
MARKS = 8
LEADERS = (1, 24)
STAR_STEPS = 2
LEAST_BITS = 7
LOOK_BACK = 64
BROADCAST_NODES = 1_000_000

_SEED = np.uint64(0xD6E8FEB86659FD93)
_MARKS = [f"mark_{i}" for i in range(MARKS)]


def gram_sets(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds per text, sorted distinct shingle hashes, and a hash of each text's whole set."""
    words = Words(texts)
    text, _, grams = shingles(PrefixHash(LOWER[texts.data]).ranges(words.starts, words.ends), words, k)
    text, grams = distinct_in_text(text, grams)
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    running = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(mix(grams ^ _SEED), out=running[1:])
    size = np.diff(bounds)
    return bounds, grams, mix(running[bounds[1:]] - running[bounds[:-1]] + size.astype(np.uint64) * _SEED)


def shared_at_least(n, percent: int):
    """The least overlap of a set of n with any partner: percent n / 100, rounded up."""
    return -(-percent * n // 100)


def _sets(k: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                bounds, _, node = gram_sets(texts, k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(texts.first, len(texts)),
                     pa.array(np.diff(bounds).astype(np.int64)), pa.array(node.view(np.int64))],
                    ["doc_id", "n", "node"])

    return apply


def _with_node(k: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                node = gram_sets(texts, k)[2]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("text").slice(texts.first, len(texts)), pa.array(node.view(np.int64))], ["text", "node"])

    return apply


def _fragments(k: int, bits: int, part: float):
    """Shingles of the first ``part`` of the order with the set they are from, by fragment."""
    last = np.uint64(min(int(part * 2.0**64), 2**64 - 1))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(bits)
        for batch in batches:
            for texts in slices(batch.column("text")):
                bounds, grams, node = gram_sets(texts, k)
                inside = grams <= last
                yield from packer.add(grams[inside], np.repeat(node, np.diff(bounds))[inside])
        yield from packer.flush()

    return apply


def _singles(hot_from: int):
    """Per set the number of shingles that it alone has, and the frequent shingles, of one fragment."""

    def apply(rows: pa.Table) -> pa.Table:
        fragment, keys, total, alone = tally(rows)
        owners, singles = np.unique(alone, return_counts=True)
        hot = total >= hot_from
        full = keys[hot].astype(np.int64) | (fragment << 32)
        return pa.table({
            "id": np.append(owners.view(np.int64), full), "count": np.append(singles, total[hot]).astype(np.int64),
            "hot": np.append(np.zeros(len(owners), bool), np.ones(len(full), bool))})

    return apply


def _counted(texts: DataFrame, k: int, bits: int, part: float, hot_from: int) -> DataFrame:
    return written(
        texts.select("text").mapInArrow(_fragments(k, bits, part), PACKED)
        .groupBy("fragment").applyInArrow(_singles(hot_from), "id long, count long, hot boolean"),
        "fragment-counts")


def _possible(sets: DataFrame, counted: DataFrame, percent: int) -> DataFrame:
    """The sets with enough shingles that others have too."""
    alone = counted.filter("not hot").groupBy(F.col("id").alias("node")).agg(F.sum("count").alias("alone"))
    least = F.ceil(F.col("n") * percent / F.lit(100))
    return sets.join(alone, "node", "left").filter(F.col("n") - F.coalesce("alone", F.lit(0)) >= least).select("node", "doc_id", "n")


def _prefixes(k: int, percent: int, bits: int, hot: np.ndarray):
    down = np.uint64(32 - bits)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                bounds, grams, node = gram_sets(texts, k)
                size = np.diff(bounds)
                text = np.repeat(np.arange(len(texts)), size)
                order = np.lexsort((grams, among(grams >> down, hot), text))
                place = np.arange(len(grams)) - bounds[text]
                keep = place < (size - shared_at_least(size, percent) + 1)[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[order][keep].view(np.int64)), pa.array(node[text[keep]].view(np.int64)),
                     pa.array(size[text[keep]].astype(np.int32)), pa.array(place[keep].astype(np.int32))],
                    ["gram", "node", "n", "place"])

    return apply


def set_marks(text: np.ndarray, grams: np.ndarray, texts: int) -> np.ndarray:
    """``MARKS`` words per text, of shingles in order: a word is of one part of the hash order, a shingle turns one of its bits."""
    part = text * MARKS + (grams >> np.uint64(64 - MARKS.bit_length() + 1)).astype(np.int64)
    marks = np.zeros(texts * MARKS, np.uint64)
    if len(part):
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        marks[part[first]] = np.bitwise_xor.reduceat(np.uint64(1) << (grams & np.uint64(63)), first)
    return marks.reshape(texts, MARKS)


def _segments(k: int):
    """Every set with its marks, and with its shingles cut into ``SEGMENTS`` fragments of the hash order."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                bounds, grams, node = gram_sets(texts, k)
                text = np.repeat(np.arange(len(texts)), np.diff(bounds))
                marks = set_marks(text, grams, len(texts)).view(np.int64)
                piece = text * SEGMENTS + (grams >> np.uint64(64 - SEGMENTS.bit_length() + 1)).astype(np.int64)
                ends = np.searchsorted(piece, np.arange(len(texts) * SEGMENTS + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(grams.view(np.int64)))
                whole = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * SEGMENTS), lists)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node.view(np.int64)), *(pa.array(np.ascontiguousarray(m)) for m in marks.T), whole],
                    ["node", *_MARKS, "fragments"])

    return apply


def _fit(a: str, b: str, percent: int):
    """Sizes and places of a shared shingle leave room for enough overlap."""
    na, nb = F.col(f"n_{a}"), F.col(f"n_{b}")
    left = F.least(na - F.col(f"place_{a}"), nb - F.col(f"place_{b}"))
    return (left * 100 >= percent * (na + nb - left)) & (F.least(na, nb) * 100 >= percent * F.greatest(na, nb))


def _close(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, n_a, b, n_b) whose marks leave room for enough overlap."""
    for side in "ba":
        pairs = pairs.join(segments.select(F.col("node").alias(side), *(F.col(m).alias(f"{m}_{side}") for m in _MARKS)), side)
    differ = sum((F.bit_count(F.col(f"{m}_a").bitwiseXOR(F.col(f"{m}_b"))) for m in _MARKS), F.lit(0))
    return pairs.filter(differ * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)).select("a", "b", "n_a", "n_b")


def _verified(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Links among candidate pairs (a, n_a, b, n_b): overlaps fragment by fragment, summed per pair."""
    pairs = written(_close(pairs, segments, percent), "close-pairs")
    theirs = segments.select(F.col("node").alias("b"), F.col("fragments").alias("fragments_b"))
    mine = segments.select(F.col("node").alias("a"), F.col("fragments").alias("fragments_a"))
    partial = F.zip_with("fragments_a", "fragments_b", lambda x, y: F.size(F.array_intersect(x, y)).cast("long"))
    total = pairs.join(theirs, "b").join(mine, "a").select(
        "a", "b", "n_a", "n_b", F.aggregate(partial, F.lit(0).cast("long"), lambda s, x: s + x).alias("common"))
    return total.filter(F.col("common") * 100 >= percent * (F.col("n_a") + F.col("n_b") - F.col("common")))


def _side(frame: DataFrame, name: str) -> DataFrame:
    rest = [F.col(c).alias(f"{c}_{name}") for c in ("n", "place", "label", "earlier") if c in frame.columns]
    return frame.select("gram", F.col("node").alias(name), *rest)


def _pairs(left: DataFrame, right: DataFrame, percent: int, tested: DataFrame | None, which: Column) -> DataFrame:
    """Pairs of nodes with a common shingle and different labels that have not been tested."""
    joined = left.join(right, "gram").filter((F.col("label_a") != F.col("label_b")) & which & _fit("a", "b", percent))
    if "earlier_a" in joined.columns:  # a pair is met at its first common shingle
        joined = joined.filter(~F.arrays_overlap("earlier_a", "earlier_b"))
    swap = F.col("a") > F.col("b")
    pairs = joined.select(
        F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"),
        F.when(swap, F.col("n_b")).otherwise(F.col("n_a")).cast("long").alias("n_a"),
        F.when(swap, F.col("n_a")).otherwise(F.col("n_b")).cast("long").alias("n_b")).distinct()
    return pairs if tested is None else pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")


def _with_earlier(marked: DataFrame) -> DataFrame:
    """Add the shingles that come before this one, of the first ``LOOK_BACK`` of the node."""
    items = F.sort_array(F.collect_list(F.struct("place", "gram")))
    front = marked.groupBy("node").agg(F.slice(items, 1, LOOK_BACK).alias("front"))
    before = F.transform(F.filter("front", lambda x: x["place"] < F.col("place")), lambda x: x["gram"])
    return marked.join(front, "node").withColumn("earlier", before).drop("front")


def _link(members: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Components (node, label) of the candidates in ``members`` (gram, node, n, place)."""
    links, tested, labels = None, None, None
    for step, leads in enumerate((*LEADERS, 0)):
        if labels is None:
            marked = members.withColumn("label", F.col("node"))
        else:
            other = labels.select(F.col("node").alias("of"), "label")
            marked = members.join(other, members.node == F.col("of"), "left").select(
                "gram", "node", "n", "place", F.coalesce("label", "node").alias("label"))
            mixed = marked.groupBy("gram").agg((F.min("label") != F.max("label")).alias("mixed")).filter("mixed")
            marked = written(marked.join(mixed.select("gram"), "gram", "left_semi"), "mixed")
        if leads:
            drawn = [F.min(F.struct(F.xxhash64("node", "gram", F.lit(step), F.lit(i)).alias("draw"), "node", "n", "place", "label"))
                     for i in range(leads)]
            leaders = marked.groupBy("gram").agg(F.array_distinct(F.array(*drawn)).alias("leads"))
            leaders = leaders.select("gram", F.explode("leads").alias("lead")).select("gram", "lead.*")
            pairs = _pairs(_side(marked, "a"), _side(leaders, "b"), percent, tested, F.lit(True))
        else:
            marked = _with_earlier(marked)
            sizes = marked.groupBy("gram", "label").agg(F.count("*").alias("nodes"))
            largest = sizes.groupBy("gram").agg(F.max(F.struct("nodes", "label"))["label"].alias("largest"))
            smaller = _side(marked, "a").join(largest, "gram").filter("label_a <> largest")
            once = (F.col("label_b") == F.col("largest")) | (F.col("a") < F.col("b"))
            pairs = _pairs(smaller, _side(marked, "b"), percent, tested, once)
        pairs = written(pairs, f"pairs-{step}")
        found = written(_verified(pairs, segments, percent).select(F.col("a").alias("u"), F.col("b").alias("v")), "found")
        tested = pairs if tested is None else tested.select("a", "b").union(pairs.select("a", "b"))
        links = found if links is None else links.union(found)
        labels = components(links, steps=STAR_STEPS) if leads else components(links)
    return labels


def components_of(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = written(narrow.mapInArrow(_sets(k), "doc_id long, n long, node long"), "gram-sets")
    nodes = written(
        sets.filter("n > 0").groupBy("node", "n").agg(F.min("doc_id").alias("doc_id")), "gram-nodes")
    total = nodes.agg(F.sum("n")).first()[0] or 0
    bits = min(24, max(LEAST_BITS, int(total / FRAGMENT_GRAMS).bit_length()))
    some = _possible(nodes, _counted(narrow, k, bits, FIRST_PART, 1 << 62), percent)
    some = written(some, "some-nodes")
    keys = some.filter("doc_id is not null").select("doc_id").distinct()
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_NODES else keys
    texts = narrow.join(keys, "doc_id").select("text").mapInArrow(_with_node(k), "text string, node long")
    unnamed = some.filter("doc_id is null").select("node")
    if not unnamed.isEmpty():  # sets of rows without id only: found by their hash
        others = narrow.filter("doc_id is null").select("text").mapInArrow(_with_node(k), "text string, node long")
        texts = texts.union(others.dropDuplicates(["node"]).join(unnamed, "node", "left_semi").select("text", "node"))
    texts = written(texts.dropDuplicates(["node"]).select("text"), "possible-texts")
    counted = _counted(texts, k, bits, 1.0, HOT_DOCUMENTS)
    hot = counted.filter("hot").orderBy(F.desc("count"), "id").limit(HOT_GRAMS).select("id").toPandas()["id"].to_numpy()
    still = written(_possible(some, counted, percent).select("node"), "still-nodes")
    rows = texts.mapInArrow(
        _prefixes(k, percent, bits, np.sort(hot).astype(np.uint64)), "gram long, node long, n int, place int"
    ).join(still, "node", "left_semi")
    rows = written(rows, "prefixes")
    several = rows.groupBy("gram").agg(F.count("*").alias("sets")).filter("sets > 1").select("gram")
    members = written(rows.join(several, "gram", "left_semi"), "prefix-members")
    compared = members.select("node").distinct()
    segments = written(
        texts.mapInArrow(_segments(k), f"node long, {', '.join(f'{m} long' for m in _MARKS)}, fragments array<array<long>>")
        .join(compared, "node", "left_semi"), "segments")
    labels = _link(members, segments, percent)
    placed = sets.filter("n > 0").join(labels, "node", "left").select("doc_id", "n", F.coalesce("label", "node").alias("label"))
    least = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    alone = sets.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return placed.join(least, "label").select("doc_id", "n", "component_id").union(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
