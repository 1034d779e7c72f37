"""Classification metrics from confusion counts: one aggregate, no evaluator pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardwatch.operators.ranking import f_beta


def confusion(label: str, prediction: str) -> dict[str, Column]:
    """Aggregates for the four cells, fraud being 1."""
    actual, called = F.col(label) == 1, F.col(prediction) == 1
    return {
        "tp": F.count_if(actual & called),
        "fp": F.count_if(~actual & called),
        "fn": F.count_if(actual & ~called),
        "tn": F.count_if(~actual & ~called),
    }


def confusion_counts(
    df: DataFrame, label: str, prediction: str, keys: tuple[str, ...] = ()
) -> DataFrame:
    cells = confusion(label, prediction)
    return df.groupBy(*keys).agg(*[cell.alias(name) for name, cell in cells.items()])


def _share(part: Column, whole: Column) -> Column:
    """0 on an empty denominator."""
    return F.when(whole > 0, part / whole).otherwise(0.0)


def precision(tp: Column, fp: Column) -> Column:
    return _share(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return _share(tp, tp + fn)


def false_positive_rate(fp: Column, tn: Column) -> Column:
    return _share(fp, fp + tn)


def accuracy(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    return _share(tp + tn, tp + fp + fn + tn)


def f1_fraud(tp: Column, fp: Column, fn: Column) -> Column:
    """F1 of the fraud class alone."""
    return _share(2 * tp, 2 * tp + fp + fn)


def f1_weighted(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """F1 of both classes, weighted by how often each occurs."""
    fraud, legitimate = tp + fn, fp + tn
    both = f1_fraud(tp, fp, fn) * fraud + f1_fraud(tn, fn, fp) * legitimate
    return _share(both, fraud + legitimate)


def _cells() -> tuple[Column, Column, Column, Column]:
    return F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")


def metric_table(
    df: DataFrame,
    label: str,
    prediction: str,
    keys: tuple[str, ...] = (),
    beta: float = 0.5,
) -> DataFrame:
    """Counts and every threshold metric per group."""
    tp, fp, fn, tn = _cells()
    return confusion_counts(df, label, prediction, keys).select(
        *keys, "tp", "fp", "fn", "tn",
        precision(tp, fp).alias("precision"),
        recall(tp, fn).alias("recall"),
        false_positive_rate(fp, tn).alias("fpr"),
        accuracy(tp, fp, fn, tn).alias("accuracy"),
        f1_fraud(tp, fp, fn).alias("f1_fraud"),
        f1_weighted(tp, fp, fn, tn).alias("f1_weighted"),
        f_beta(precision(tp, fp), recall(tp, fn), beta).alias("f_beta"),
    )


def joint_cells(df: DataFrame, label: str, champion: str, challenger: str) -> DataFrame:
    """At most eight rows: how often each pair of calls meets each label."""
    return df.groupBy(
        F.col(label).cast("int").alias("label"),
        F.col(champion).cast("int").alias("champion"),
        F.col(challenger).cast("int").alias("challenger"),
    ).agg(F.count(F.lit(1)).alias("n"))
