"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

A sentence is scored by a logistic model over its words and their beginnings; the score of a
document is the noisy-or of its sentences, 1 - prod(1 - p).  The model is trained through the
noisy-or from document labels alone, on a bounded sample of labelled rows (``SAMPLE``), and then
names the sentences that offend.

Sentences end at ``.``, ``!``, ``?`` or a line feed.  Words are lower-cased (A-Z) runs of
letters, digits and non-ASCII bytes.  Texts without words and null texts score 0.  Null ids are
scored too, repeated rows get the same score each.  Without labels every score is 0.5 or less
for lack of evidence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cardwatch.llm.labels import fold, sample
from cardwatch.llm.textarrays import LOWER, PrefixHash, Texts, Words, distinct_in_text, slices

SAMPLE = 6_000
EPOCHS, RATE, SHRINK = 300, 0.1, 1e-4
IN_DOCUMENTS, TRIFLE = 5, 0.02
STEM = 5
OFFENDING = 0.5

_NOT_WORD = np.ones(256, bool)
_NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[list(b".!?\n")] = True


@dataclass
class Instances:
    """Features of sentences: ``item`` fires in ``sentence``; sentences belong to texts."""

    sentence: np.ndarray
    item: np.ndarray
    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def instances(texts: Texts, known: np.ndarray | None = None) -> Instances:
    """Hashes of each word and of its first ``STEM`` bytes, once per sentence.

    With ``known`` (sorted hashes) only those count, and ``item`` is their place in it.
    """
    sentences, words = Words(texts, _SENTENCE_END), Words(texts, _NOT_WORD)
    of = np.searchsorted(sentences.starts, words.starts, "right") - 1
    hashes = PrefixHash(LOWER[texts.data])
    long = words.ends - words.starts > STEM
    starts = words.starts[long]
    item = np.concatenate([hashes.ranges(words.starts, words.ends), ~hashes.ranges(starts, starts + STEM)])
    where = np.concatenate([of, of[long]])
    if known is not None:
        place = np.searchsorted(known, item)
        hit = place < len(known)
        hit[hit] = known[place[hit]] == item[hit]
        where, item = where[hit], place[hit]
    where, item = distinct_in_text(where, item)
    return Instances(where, item, sentences.text, sentences.starts, sentences.ends)


@dataclass
class Model:
    """Weights of the words and beginnings in ``known``, sorted hashes."""

    known: np.ndarray
    weight: np.ndarray
    bias: float

    def sentences(self, texts: Texts) -> tuple[Instances, np.ndarray]:
        """The sentences and the probability of each."""
        found = instances(texts, self.known)
        n = len(found.text)
        return found, 1 / (1 + np.exp(-self.bias - np.bincount(found.sentence, self.weight[found.item], n)[:n]))


def noisy_or(p: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    quiet = np.log1p(-np.minimum(p, 1 - 1e-12))
    return -np.expm1(np.bincount(text, quiet, texts)[:texts])


def fit_model(parts: list[tuple[Instances, np.ndarray]], epochs: int = EPOCHS) -> Model:
    """Gradient steps (Adam) on the log loss of the noisy-or over all sampled documents.

    Weights are evidence of toxicity only: not negative, and drawn to 0 (L1).  Words and beginnings in fewer than ``IN_DOCUMENTS`` sampled documents are left out, as are
    weights that end below ``TRIFLE``.
    """
    sentence, item, text, label, shift, rows = [], [], [], [], 0, 0
    for found, y in parts:
        sentence.append(found.sentence + shift)
        item.append(found.item)
        text.append(found.text + rows)
        label.append(y)
        shift, rows = shift + len(found.text), rows + len(y)
    if not rows:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -4.0)
    sentence, item, text, y = map(np.concatenate, (sentence, item, text, label))
    known, documents = np.unique(distinct_in_text(text[sentence], item)[1], return_counts=True)
    known = known[documents >= IN_DOCUMENTS]
    column = np.searchsorted(known, item)
    inside = column < len(known)
    inside[inside] = known[column[inside]] == item[inside]
    sentence, column, n = sentence[inside], column[inside], len(known)
    w, b, m, v, mb, vb = np.zeros(n), -4.0, np.zeros(n), np.zeros(n), 0.0, 0.0
    for step in range(1, epochs + 1):
        p = 1 / (1 + np.exp(-b - np.bincount(sentence, w[column], shift)[:shift]))
        doc = np.clip(noisy_or(p, text, rows), 1e-6, 1 - 1e-6)
        pull = ((doc - y) / doc)[text] * p / rows
        g, gb = np.bincount(column, pull[sentence], n)[:n] + SHRINK, pull.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix, fix2 = 1 - 0.9**step, 1 - 0.999**step
        w = np.maximum(0, w - RATE * (m / fix) / (np.sqrt(v / fix2) + 1e-8))
        b -= RATE * (mb / fix) / (np.sqrt(vb / fix2) + 1e-8)
    keep = np.abs(w) >= TRIFLE
    return Model(known[keep], w[keep], float(b))


def fit(docs: DataFrame, labels: DataFrame, use: Column, label: str = "toxic", most: int = SAMPLE) -> Model:
    """The model of the labelled rows for which ``use`` holds; at most about ``most`` of them count."""
    rows = sample(docs, labels, label, most, use).select("doc_id", "label", "text").toArrow().combine_chunks()
    rows = rows.sort_by("doc_id")
    y = (rows.column("label").to_numpy() >= 0.5).astype(float)
    column, parts, done = rows.column("text").combine_chunks(), [], 0
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        for texts in slices(chunk):
            parts.append((instances(texts), y[done : done + len(texts)]))
            done += len(texts)
    return fit_model(parts)


def _scored(model: Model, least: float):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                found, p = model.sentences(texts)
                score = noisy_or(p, found.text, len(texts))
                bad = np.flatnonzero(p >= least)
                base = texts.offsets[found.text[bad]]
                spans = pa.StructArray.from_arrays(
                    [pa.array((found.starts[bad] - base).astype(np.int32)),
                     pa.array((found.ends[bad] - base).astype(np.int32)), pa.array(p[bad])], fields=list(kind.value_type))
                bounds = np.searchsorted(found.text[bad], np.arange(len(texts) + 1)).astype(np.int32)
                ids = batch.column("doc_id").slice(texts.first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(score), pa.ListArray.from_arrays(pa.array(bounds), spans, type=kind)],
                    ["doc_id", "score", "offending"])

    return apply


def score(docs: DataFrame, model: Model, least: float = OFFENDING) -> DataFrame:
    """doc_id, score, and the byte ranges (UTF-8, end exclusive) and scores of sentences at ``least`` or more."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scored(model, least),
        "doc_id long, score double, offending array<struct<start:int,end:int,score:double>>")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, most: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted and offending; the fold ``held`` of ``folds`` is never learnt from."""
    out = fold(F.col("doc_id"), folds) == held
    return score(docs, fit(docs, labels, ~out, most=most)).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")
