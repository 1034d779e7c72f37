"""Champion against challenger on one test set.

Accuracy and F1 depend on the eight joint cells (label, champion call, challenger
call) only.  A resample of n rows with replacement is therefore a multinomial draw of
the cells, and 1 000 resamples cost 1 000 small draws instead of 1 000 passes.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from cardwatch.functions.stats import cohens_d, welch
from cardwatch.operators.confusion import accuracy, confusion, f1_weighted
from cardwatch.operators.ranking import area_under_roc
from cardwatch.operators.rows import side_by_side

SIDES = ("champion", "challenger")
PROMOTE, KEEP = "PROMOTE", "KEEP_CHAMPION"
SMALL_MEAN, STEPS = 50, 150
_CELLS = [(label, a, b) for label in (0, 1) for a in (0, 1) for b in (0, 1)]
# Cells on which both sides agree, and pairs on which they differ: drawn as one and then split, so swapping sides swaps the draws.
_GROUPS = [(0,), (3,), (1, 2), (4,), (7,), (5, 6)]


def compare_metrics(
    df: DataFrame,
    label: str,
    predictions: dict[str, str],
    scores: dict[str, str],
) -> DataFrame:
    """One row: AUC, weighted F1 and accuracy of both sides and the test-set size."""
    cells = [
        cell.alias(f"{side}_{name}")
        for side in SIDES
        for name, cell in confusion(label, predictions[side]).items()
    ]
    metrics = []
    for side in SIDES:
        tp, fp, fn, tn = (F.col(f"{side}_{name}") for name in ("tp", "fp", "fn", "tn"))
        metrics += [
            f1_weighted(tp, fp, fn, tn).alias(f"{side}_f1"),
            accuracy(tp, fp, fn, tn).alias(f"{side}_accuracy"),
        ]
    counted = df.agg(F.count(F.lit(1)).alias("test_set_size"), *cells).select(
        "test_set_size", *metrics
    )
    sides = F.array(
        *[F.struct(F.lit(side).alias("side"), F.col(scores[side]).alias("score")) for side in SIDES]
    )
    by_side = df.select(label, F.inline(sides))
    areas = area_under_roc(by_side, "score", label, ("side",)).agg(
        *[F.max(F.when(F.col("side") == side, F.col("auc"))).alias(f"{side}_auc") for side in SIDES]
    )
    return side_by_side(counted, areas).select(
        *[f"{side}_{metric}" for side in SIDES for metric in ("auc", "f1", "accuracy")],
        "test_set_size",
    )


def _uniform(seed: int, *parts: Column | str) -> Column:
    """52 bits of the md5 of ``seed|iteration|cell|use``, inside (0, 1)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])
    return (F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _few(n: Column, p: Column, u: Column) -> Column:
    """The binomial draw at ``u`` by its distribution function, for small means: how many of its steps lie below ``u``."""
    start = F.struct(F.exp(n * F.log1p(-p)).alias("term"), F.lit(0.0).alias("below"), F.lit(0).cast("long").alias("k"))

    def step(state: Column, i: Column) -> Column:
        total = state["below"] + state["term"]
        return F.struct(
            (state["term"] * (n - i) / (i + 1) * p / (1 - p)).alias("term"), total.alias("below"),
            (state["k"] + F.when((total < u) & (i < n), 1).otherwise(0)).cast("long").alias("k"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(STEPS - 1)), start, step)["k"]


def _many(n: Column, p: Column, u: Column, v: Column) -> Column:
    """The binomial draw by the normal quantile corrected for skew, for large means."""
    z = F.sqrt(-2 * F.log(u)) * F.cos(2 * math.pi * v)
    exact = n * p + z * F.sqrt(n * p * (1 - p)) + (1 - 2 * p) * (z * z - 1) / 6
    return F.least(F.greatest(F.floor(exact + 0.5), F.lit(0)), n).cast("long")


def _binomial(n: Column, p: Column, u: Column, v: Column) -> Column:
    rare = F.least(p, 1 - p)
    drawn = F.when(n * rare < SMALL_MEAN, _few(n, rare, u)).otherwise(_many(n, rare, u, v))
    return F.when(p > 0.5, n - drawn).otherwise(drawn)


def _f1_of(cells: list[Column], side: int) -> Column:
    """Fraud F1 from the drawn cells, by the call at ``side`` of their names."""
    tp = reduce(add, [c for c, of in zip(cells, _CELLS) if of[0] and of[side]])
    wrong = reduce(add, [c for c, of in zip(cells, _CELLS) if of[0] != of[side]])
    return F.when(tp + wrong > 0, 2 * tp / (2 * tp + wrong)).otherwise(0.0)


def bootstrap_f1(cells: DataFrame, iterations: int = 1000, seed: int = 42) -> DataFrame:
    """Fraud F1 of both sides in each resample; both see the same resample.

    ``cells`` comes from :func:`cardwatch.operators.confusion.joint_cells`.  A resample is drawn group by group: given
    what the groups before took, a group's number is binomial.  Draws hang on md5 hashes of (seed, iteration, cell), so any
    engine can repeat them.  Means below ``SMALL_MEAN`` use the exact distribution, larger ones the normal quantile with
    its skew term, whose error is far below one row's effect on F1.
    """
    counts = cells.agg(*[
        F.coalesce(F.sum(F.when(
            (F.col("label") == label) & (F.col("champion") == a) & (F.col("challenger") == b), F.col("n"))), F.lit(0))
        .cast("long").alias(f"c{position}")
        for position, (label, a, b) in enumerate(_CELLS)
    ])
    names = [f"c{i}" for i in range(len(_CELLS))]
    total = reduce(add, [F.col(c) for c in names])
    drawn = counts.select(
        F.explode(F.sequence(F.lit(0), F.lit(iterations - 1))).alias("iteration"), *names, total.alias("left"), total.alias("mass")
    ).repartition("iteration")

    def with_draw(frame: DataFrame, i: int, n: str, part: Column, whole: Column) -> DataFrame:
        share = F.when(whole > 0, part / whole).otherwise(0.0)
        at = [_uniform(seed, F.col("iteration"), str(i), use) for use in ("u", "v")]
        frame = frame.withColumns({"p": share, "u": at[0], "v": at[1]})
        return frame.withColumn(f"g{i}", _binomial(F.col(n), F.col("p"), F.col("u"), F.col("v")))

    for i, cells_of in enumerate(_GROUPS[:-1]):
        part = reduce(add, [F.col(f"c{c}") for c in cells_of])
        drawn = with_draw(drawn, i, "left", part, F.col("mass"))
        drawn = drawn.withColumns({"left": F.col("left") - F.col(f"g{i}"), "mass": F.col("mass") - part})
    drawn = drawn.withColumnRenamed("left", f"g{len(_GROUPS) - 1}")
    numbers = {cells_of[0]: F.col(f"g{i}") for i, cells_of in enumerate(_GROUPS) if len(cells_of) == 1}
    for i, (group, (one, other)) in enumerate(((g, c) for g, c in enumerate(_GROUPS) if len(c) == 2), len(_GROUPS)):
        drawn = with_draw(drawn, i, f"g{group}", F.col(f"c{one}"), F.col(f"c{one}") + F.col(f"c{other}"))
        numbers |= {one: F.col(f"g{i}"), other: F.col(f"g{group}") - F.col(f"g{i}")}
    ordered = [numbers[i] for i in range(len(_CELLS))]
    return drawn.select("iteration", _f1_of(ordered, 1).alias("champion_f1"), _f1_of(ordered, 2).alias("challenger_f1"))


def significance(
    scores: DataFrame,
    champion: str = "champion_f1",
    challenger: str = "challenger_f1",
    alpha: float = 0.05,
) -> DataFrame:
    """Gain, Welch's t, p, Cohen's d and the flag, from paired score rows.

    Paired resamples are not independent samples, so Welch's p shrinks as iterations
    grow.  It is what the decision uses; the percentile interval of the paired
    differences stands beside it.
    """
    gain = F.col(challenger) - F.col(champion)
    stats = scores.agg(
        F.count(F.lit(1)).alias("iterations"),
        F.avg(champion).alias("champion_f1_mean"),
        F.avg(challenger).alias("challenger_f1_mean"),
        F.stddev_pop(champion).alias("champion_f1_std"),
        F.stddev_pop(challenger).alias("challenger_f1_std"),
        F.var_samp(champion).alias("var_a"),
        F.var_samp(challenger).alias("var_b"),
        F.percentile(gain, [0.025, 0.975]).alias("interval"),
    )
    n = F.col("iterations")
    a, b = F.col("champion_f1_mean"), F.col("challenger_f1_mean")
    test = welch(a, F.col("var_a"), n, b, F.col("var_b"), n)
    tested = stats.select(
        "iterations",
        "champion_f1_mean",
        "challenger_f1_mean",
        "champion_f1_std",
        "challenger_f1_std",
        (b - a).alias("f1_improvement"),
        test["t_statistic"].alias("welch_t"),
        test["degrees_of_freedom"].alias("welch_df"),
        test["p_value"].alias("p_value"),
        cohens_d(a, F.col("champion_f1_std"), b, F.col("challenger_f1_std")).alias("effect_size"),
        F.get("interval", F.lit(0)).alias("gain_low"),
        F.get("interval", F.lit(1)).alias("gain_high"),
    )
    better = (F.col("p_value") < alpha) & (F.col("f1_improvement") > 0)
    return tested.withColumn("is_significant", F.coalesce(better, F.lit(False)))


def decide(tested: DataFrame) -> DataFrame:
    return tested.withColumn("decision", F.when(F.col("is_significant"), PROMOTE).otherwise(KEEP))


def report(metrics: DataFrame, decided: DataFrame, names: dict[str, str]) -> DataFrame:
    """The sixteen report fields from one row of metrics and one row of the test."""
    tested = decided.select(
        "f1_improvement", "p_value", "effect_size", "is_significant", "decision"
    )
    return side_by_side(metrics, tested).select(
        *[f"{side}_{metric}" for side in SIDES for metric in ("auc", "f1", "accuracy")],
        "f1_improvement",
        "p_value",
        "effect_size",
        "is_significant",
        "decision",
        "test_set_size",
        F.lit(names.get("run_id")).cast("string").alias("run_id"),
        F.lit(names["champion"]).alias("champion_model"),
        F.lit(names["challenger"]).alias("challenger_model"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )
