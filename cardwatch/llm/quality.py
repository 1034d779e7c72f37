"""Document quality by histogram gradient-boosted trees over document statistics.

Statistics come from whole texts and from nothing else.  Trees are grown on a bounded sample of
labelled rows (``SAMPLE``), whose statistics, not texts, reach the driver.  Fitted trees are
flat arrays in heap order, walked for a whole batch of documents at once.

Empty and null texts have all statistics 0 and get a score like any other row; null ids are
scored too.  Repeated rows get the same score each.  Without labels of both kinds the score is
the base rate, or 0.5 without any.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cardwatch.llm.labels import fold, sample
from cardwatch.llm.textarrays import LOWER, PrefixHash, Texts, Words, distinct_in_text, shingles, slices

SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, LEAST = 60, 4, 64, 0.15, 20.0

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "line_words", "distinct_words", "repeated_next", "distinct_shingles",
    "distinct_lines", "upper", "digit", "high", "exclaim", "stop", "comma", "bar", "other_punctuation", "bare_symbols",
    "longest_word",
)
_CLASS = np.zeros((8, 256), bool)
_CLASS[0, 65:91] = True
_CLASS[1, 48:58] = True
_CLASS[2, 128:] = True
for _row, _marks in ((3, b"!?"), (4, b"."), (5, b",;:"), (6, b"|")):
    _CLASS[_row, list(_marks)] = True
_CLASS[7, [b for b in range(33, 127) if not chr(b).isalnum() and b not in b"!?.,;:|"]] = True
_LINE_END = np.zeros(256, bool)
_LINE_END[10] = True


def statistics(texts: Texts) -> np.ndarray:
    """One row of STATISTICS for each text."""
    n = len(texts)
    size = np.diff(texts.offsets).astype(float)
    words, lines = Words(texts), Words(texts, _LINE_END)
    count, line_count = words.count.astype(float), lines.count.astype(float)

    def per_text(text: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(text, weights, n)[:n]

    def share(top: np.ndarray, base: np.ndarray) -> np.ndarray:
        return np.divide(top, base, out=np.zeros(n), where=base > 0)

    hashes = PrefixHash(LOWER[texts.data])
    word = hashes.ranges(words.starts, words.ends)
    same = (word[1:] == word[:-1]) & (words.text[1:] == words.text[:-1])
    run_text, _, run = shingles(word, words, 3)
    length = (words.ends - words.starts).astype(float)
    longest = np.zeros(n)
    np.maximum.at(longest, words.text, length)
    symbols = np.zeros(len(texts.data) + 1)
    np.cumsum(_CLASS[3:8].any(0)[texts.data], out=symbols[1:])
    bare = (symbols[words.ends] - symbols[words.starts]) == length
    columns = [
        np.log1p(size), np.log1p(count), share(per_text(words.text, length), count), share(count, line_count),
        share(per_text(distinct_in_text(words.text, word)[0]), count),
        share(per_text(words.text[1:][same]), count),
        share(per_text(distinct_in_text(run_text, run)[0]), per_text(run_text)),
        share(per_text(distinct_in_text(lines.text, hashes.ranges(lines.starts, lines.ends))[0]), line_count),
    ]
    for kind in _CLASS:
        running = np.zeros(len(texts.data) + 1)
        np.cumsum(kind[texts.data], out=running[1:])
        columns.append(share(np.diff(running[texts.offsets]), size))
    columns += [share(per_text(words.text, bare.astype(float)), count), longest]
    return np.stack(columns, 1)


@dataclass
class Trees:
    """``feature`` and ``cut`` of the inner nodes and ``value`` of the leaves of every tree; ``rows`` they are fitted to."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    rows: int = 0

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Logistic boosting with second-order gains on ``BINS`` quantile bins of each statistic."""
    inner, leaves = 2**depth - 1, 2**depth
    feature = np.zeros((trees, inner), np.int64)
    cut, value = np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(rate / (1 - rate)))
    if not len(y) or y.min() == y.max():
        return Trees(base, feature[:0], cut[:0], value[:0], len(y))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)
    margin = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-9)
            place = node - first
            for j, edge in enumerate(edges):
                cell = place * BINS + binned[:, j]
                g = np.bincount(cell, slope, width * BINS).reshape(width, BINS).cumsum(1)
                h = np.bincount(cell, bend, width * BINS).reshape(width, BINS).cumsum(1)
                gl, hl, gr, hr = g, h, g[:, -1:] - g, h[:, -1:] - h
                gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                gain[(np.minimum(hl, hr) < LEAST / 10)] = 0
                gain[:, len(edge):] = 0
                at = gain.argmax(1)
                better = gain[np.arange(width), at] > best
                best[better] = gain[np.arange(width), at][better]
                feature[t, first : first + width][better] = j
                cut[t, first : first + width][better] = edge[np.minimum(at, len(edge) - 1)][better] if len(edge) else np.inf
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > cut[t, node])
        leaf = node - inner
        value[t] = -RATE * np.bincount(leaf, slope, leaves) / (np.bincount(leaf, bend, leaves) + 1)
        margin += value[t, leaf]
    return Trees(base, feature, cut, value, len(y))


def _statistics_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in slices(batch.column("text")):
            part = batch.slice(texts.first, len(texts))
            x = statistics(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1])
                 .cast(pa.list_(pa.float64()))], ["label", "x"])


def fit(docs: DataFrame, labels: DataFrame, use: Column, label: str = "quality", most: int = SAMPLE) -> Trees:
    """Trees for the labelled rows for which ``use`` holds; at most about ``most`` of them count."""
    rows = (
        sample(docs, labels, label, most, use).select("label", "text")
        .mapInArrow(_statistics_of, "label double, x array<double>").toPandas()
    )
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(STATISTICS))
    y = (rows["label"].to_numpy(float) >= 0.5).astype(float)
    order = np.lexsort((*x.T, y))
    return fit_trees(x[order], y[order])


def _scored(trees: Trees, names: list[str]):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                part = batch.slice(texts.first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(trees.score(statistics(texts)))], [*names, "score"])

    return apply


def score_rows(docs: DataFrame, trees: Trees) -> DataFrame:
    """The rows with a column ``score``, the quality of their text (a column of that name is replaced)."""
    rows = docs.drop("score")
    kinds = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_scored(trees, rows.columns), kinds)


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id and the quality score, 0 to 1, of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scored(trees, ["doc_id"]), "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, least: float = 0.7,
             most: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted; the fold ``held`` of ``folds`` is never learnt from."""
    out = fold(F.col("doc_id"), folds) == held
    return score(docs, fit(docs, labels, ~out, most=most)).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
