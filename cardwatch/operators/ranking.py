"""Counts by decreasing score without a single-task global sort.

Area under the ROC curve and threshold choice need running totals over all scores.
The input is read once: the rows of each distinct score are counted (hot values collapse before the shuffle) and
the counts are written.  Everything else comes from that table, however costly the scores are: it is cut into slices at
approximate quantiles of the distinct scores, summed inside each slice, and offset by the totals of the
higher slices.  There is one slice for every ``ROWS_PER_SLICE`` distinct scores, so the window tasks
do not grow with the table; the totals have one row per slice and group.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardwatch.session import scratch_path
from cardwatch.sinks.tables import write_table

_SLICE = "__slice"
LEAST_SLICES, ROWS_PER_SLICE = 256, 2_000_000


def _slice_bounds(df: DataFrame, score: str, slices: int) -> list[float]:
    """Cut points at approximate quantiles: a bounded list, whatever the input."""
    wanted = [i / slices for i in range(1, slices)]
    found = df.approxQuantile(score, wanted, 1 / (4 * slices))
    inner = sorted({c for c in found if math.isfinite(c)}) or [0.0]
    return [-math.inf, *inner, math.inf]


def ranked_counts(
    df: DataFrame,
    score: str,
    label: str,
    keys: tuple[str, ...] = (),
    slices: int | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Per group and distinct score: ``positives``/``negatives`` with exactly this
    score, ``true_positives``/``false_positives`` with at least it, and the group's
    ``all_positives``/``all_negatives``.  ``slices`` is counted from the distinct scores unless given.
    """
    rows = df.select(*keys, F.col(score).cast("double").alias(score), label)
    rows = rows.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    path = scratch_path(df.sparkSession, "scores")
    write_table(rows.groupBy(*keys, score).agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    ), path)
    grouped = df.sparkSession.read.parquet(path)
    if slices is None:
        slices = max(LEAST_SLICES, math.ceil(grouped.count() / rows_per_slice))
    bounds = _slice_bounds(grouped, score, slices)
    cut = Bucketizer(splits=bounds, inputCol=score, outputCol=_SLICE, handleInvalid="keep")
    grouped = cut.transform(grouped)

    # At most len(bounds) rows per group of keys.
    group = Window.partitionBy(*keys)
    higher = group.orderBy(F.desc(_SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    slice_totals = grouped.groupBy(*keys, _SLICE).agg(
        F.sum("positives").alias("p"), F.sum("negatives").alias("n")
    )
    offsets = slice_totals.select(
        *keys,
        _SLICE,
        F.coalesce(F.sum("p").over(higher), F.lit(0)).alias("p_above"),
        F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("n_above"),
        F.sum("p").over(group).alias("all_positives"),
        F.sum("n").over(group).alias("all_negatives"),
    )
    inside = Window.partitionBy(*keys, _SLICE).orderBy(F.desc(score))
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return grouped.join(offsets, [*keys, _SLICE]).select(
        *keys,
        score,
        "positives",
        "negatives",
        (F.sum("positives").over(running) + F.col("p_above")).alias("true_positives"),
        (F.sum("negatives").over(running) + F.col("n_above")).alias("false_positives"),
        "all_positives",
        "all_negatives",
    )


def area_under_roc(
    df: DataFrame, score: str, label: str, keys: tuple[str, ...] = (), slices: int | None = None
) -> DataFrame:
    """Exact area, ties counting one half; null when a class is absent."""
    counts = ranked_counts(df, score, label, keys, slices)
    below = F.col("all_negatives") - F.col("false_positives")
    wins = F.col("positives").cast("double") * (below + F.col("negatives") / 2)
    pairs = F.max("all_positives").cast("double") * F.max("all_negatives")
    return counts.groupBy(*keys).agg(F.when(pairs > 0, F.sum(wins) / pairs).alias("auc"))


def f_beta(precision: Column, recall: Column, beta: float) -> Column:
    weight = beta * beta
    bottom = precision * weight + recall
    return F.when(bottom > 0, precision * recall * (1 + weight) / bottom).otherwise(0.0)


def select_threshold(
    df: DataFrame,
    score: str,
    label: str,
    beta: float = 0.5,
    max_fpr: float = 0.05,
    slices: int | None = None,
) -> DataFrame:
    """The score limit with the best F-beta among those within ``max_fpr``.

    A row is called fraud when its score is at least the limit.  Equal F-beta goes
    to the higher limit.
    """
    counts = ranked_counts(df, score, label, (), slices)
    precision = F.col("true_positives") / (F.col("true_positives") + F.col("false_positives"))
    recall = F.col("true_positives") / F.nullif(F.col("all_positives"), F.lit(0))
    fpr = F.col("false_positives") / F.nullif(F.col("all_negatives"), F.lit(0))
    options = counts.select(
        F.col(score).alias("threshold"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.coalesce(fpr, F.lit(0.0)).alias("fpr"),
    ).withColumn("f_beta", f_beta(F.col("precision"), F.col("recall"), beta))
    best = F.max_by(
        F.struct("threshold", "precision", "recall", "fpr", "f_beta"),
        F.struct("f_beta", "threshold"),
    )
    return options.filter(F.col("fpr") <= max_fpr).agg(best.alias("best")).select("best.*")
