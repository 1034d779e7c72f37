"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; a null id counts as the empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(folds))


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int, use: Column) -> DataFrame:
    """(doc_id, text, label) of about ``most`` labelled rows for which ``use`` of the id holds.

    Rows are taken by the hash of their id.  Null labels are left out; of several labels of one
    document the mean counts.  The sampled ids (12 bytes each, at most about ``most``) go to all
    executors, so the texts do not move.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("double").alias("label")).filter(use)
        .filter("doc_id is not null and label is not null")
        .groupBy("doc_id").agg(F.avg("label").alias("label"))
    )
    share = min(1.0, most / max(1, known.count()))
    few = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    return docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")
