"""Service quality and business limits over scored transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardwatch.operators.confusion import confusion, false_positive_rate, recall

# The limits the service must keep.
MAX_FPR = 0.05
MIN_RECALL = 0.85
MAX_MONTHLY_LOSS = 500_000.0
MAX_FRAUD_PER_100 = 2.0
USUAL_PER_SECOND, PEAK_PER_SECOND = 50, 400
MAX_DELAY_MS, MIN_SHARE_IN_TIME = 200, 0.95


def _missed(label: str, prediction: str, amount: str):
    missed = (F.col(label) == 1) & (F.col(prediction) != 1)
    return F.sum(F.when(missed, F.col(amount)).otherwise(0.0))


def monthly_missed_loss(
    df: DataFrame, time: str, label: str, prediction: str, amount: str
) -> DataFrame:
    """Money lost per month to fraud that was let through."""
    month = F.date_format(time, "yyyy-MM").alias("month")
    lost = df.groupBy(month).agg(_missed(label, prediction, amount).alias("missed_loss"))
    return lost.withColumn("within_limit", F.col("missed_loss") <= MAX_MONTHLY_LOSS)


def fraud_rate(df: DataFrame, label: str) -> DataFrame:
    share = F.count_if(F.col(label) == 1) / F.nullif(F.count(F.lit(1)), F.lit(0)) * 100
    rates = df.agg(F.count(F.lit(1)).alias("transactions"), share.alias("fraud_per_100"))
    return rates.withColumn("within_limit", F.col("fraud_per_100") <= MAX_FRAUD_PER_100)


def daily_cells(
    df: DataFrame, time: str, label: str, prediction: str, amount: str | None = None
) -> DataFrame:
    """Confusion counts per day, and the money missed when ``amount`` is given."""
    cells = [cell.alias(name) for name, cell in confusion(label, prediction).items()]
    if amount is not None:
        cells.append(_missed(label, prediction, amount).alias("missed_loss"))
    return df.groupBy(F.col(time).cast("date").alias("day")).agg(*cells)


def daily_quality(df: DataFrame, time: str, label: str, prediction: str) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return daily_cells(df, time, label, prediction).select(
        "day",
        (tp + fp + fn + tn).alias("transactions"),
        false_positive_rate(fp, tn).alias("fpr"),
        recall(tp, fn).alias("recall"),
    )


def quality_alerts(
    df: DataFrame, time: str, label: str, prediction: str, amount: str
) -> DataFrame:
    """Every broken limit: per day FPR, recall and fraud share, per month the loss.

    One scan: the months are summed over the daily rows, of which there are few
    whatever the size of the table.
    """
    return cell_alerts(daily_cells(df, time, label, prediction, amount))


def cell_alerts(cells: DataFrame) -> DataFrame:
    """The broken limits of ``daily_cells`` with an amount."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    month = Window.partitionBy(F.date_format("day", "yyyy-MM"))
    days = cells.select(
        "*",
        F.sum("missed_loss").over(month).alias("loss"),
        (F.col("day") == F.min("day").over(month)).alias("opens_month"),
    )

    def check(pattern: str, metric: str, value: Column, limit: float, broken: Column) -> Column:
        return F.struct(
            F.date_format("day", pattern).alias("period"),
            F.lit(metric).alias("metric"),
            value.cast("double").alias("value"),
            F.lit(limit).alias("limit"),
            broken.alias("broken"),
        )

    day, fpr, hit, loss = "yyyy-MM-dd", false_positive_rate(fp, tn), recall(tp, fn), F.col("loss")
    per_100 = (tp + fn) / (tp + fp + fn + tn) * 100
    checks = (
        check(day, "fpr", fpr, MAX_FPR, fpr > MAX_FPR),
        check(day, "recall", hit, MIN_RECALL, (tp + fn > 0) & (hit < MIN_RECALL)),
        check(day, "fraud_per_100", per_100, MAX_FRAUD_PER_100, per_100 > MAX_FRAUD_PER_100),
        check("yyyy-MM", "missed_loss", loss, MAX_MONTHLY_LOSS,
              F.col("opens_month") & (loss > MAX_MONTHLY_LOSS)),
    )
    return days.select(F.inline(F.array(*checks))).filter("broken").drop("broken")


def throughput_profile(df: DataFrame, time: str) -> DataFrame:
    """Transactions per second: mean over busy seconds, over the span, and the peak."""
    per_second = df.groupBy(F.date_trunc("second", time).alias("second")).agg(
        F.count(F.lit(1)).alias("n")
    )
    span = F.timestamp_diff("SECOND", F.min("second"), F.max("second")) + 1
    profile = per_second.agg(
        F.sum("n").alias("transactions"),
        F.count(F.lit(1)).alias("busy_seconds"),
        F.avg("n").alias("mean_per_busy_second"),
        (F.sum("n") / span).alias("mean_per_second"),
        F.max("n").alias("peak_per_second"),
    )
    return profile.select(
        "*",
        (F.col("mean_per_second") <= USUAL_PER_SECOND).alias("usual_within_target"),
        (F.col("peak_per_second") <= PEAK_PER_SECOND).alias("peak_within_target"),
    )


def latency_share(df: DataFrame, delay_ms: str) -> DataFrame:
    """Share of decisions in time and delay percentiles.

    Delays are whole milliseconds, so they are counted per value first and the exact
    percentiles see each distinct delay once.
    """
    per_delay = df.groupBy(F.col(delay_ms).cast("bigint").alias("ms")).agg(
        F.count(F.lit(1)).alias("n")
    )
    in_time = F.sum(F.when(F.col("ms") <= MAX_DELAY_MS, F.col("n")).otherwise(0))
    return per_delay.agg(
        F.sum("n").alias("decisions"),
        (in_time / F.sum("n")).alias("share_in_time"),
        F.percentile("ms", 0.5, F.col("n")).alias("median_ms"),
        F.percentile("ms", 0.95, F.col("n")).alias("p95_ms"),
        F.max("ms").alias("max_ms"),
    ).withColumn("within_target", F.col("share_in_time") >= MIN_SHARE_IN_TIME)
