"""Transactions, dirty text, driver statistics and model scores made from ``events``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

from cardwatch.functions.hashing import split_name
from cardwatch.operators.confusion import f1_fraud, confusion_counts
from cardwatch.operators.latest import latest_per_key
from cardwatch.operators.ranking import area_under_roc
from cardwatch.schema import TRANSACTION_COLUMNS
from cardwatch.sources.messages import as_messages

EVENTS_SCHEMA = StructType([
    StructField("event_id", LongType()),
    StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()),
    StructField("event_type", StringType()),
    StructField("value", DoubleType()),
    StructField("props", StringType()),
])
MESSAGE_SCHEMA = StructType([
    StructField("transaction_id", LongType()),
    StructField("timestamp", StringType()),
    StructField("tx_amount", DoubleType()),
    StructField("terminal_id", LongType()),
    StructField("tx_time_seconds", LongType()),
    StructField("tx_time_days", LongType()),
])
STATS_COLUMNS = (
    "driver_id", "event_timestamp", "created", "conv_rate", "acc_rate", "avg_daily_trips",
)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def events_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A pattern rather than a path, so one file and a folder of parts both work.

    A backlog of many files is taken in micro-batches of bounded size.
    """
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 1000)
    return reader.parquet(f"{sf}/{{events.parquet}}")


STAGES = 4


def in_stages(spark: SparkSession, sf: str, root: str, run: Callable[[DataFrame], None]) -> None:
    """``run`` a stream over the events after each of four arrivals of eight days, the later of two always first."""
    rows = events(spark, sf)
    for stage in range(STAGES):
        part = rows.filter(F.expr(f"(day(ts) - 1) div 8 = {stage ^ 1}"))
        part.write.mode("append").parquet(root)
        run(spark.readStream.schema(EVENTS_SCHEMA).parquet(root))


def _second_text() -> Column:
    """The event's time to the second, free of any session zone."""
    return F.substring(F.col("ts").cast("string"), 1, 19)


def transactions(rows: DataFrame) -> DataFrame:
    """``tx``: clean transactions from events, as a batch or as a stream."""
    day = F.day("ts") - 1
    seconds = day * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    terminal = F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
    scenario = (
        F.when(F.col("value") > 150, 1)
        .when((F.col("terminal_id") % 20 == 0) & (F.col("event_type") == "purchase"), 2)
        .when((F.col("event_type") == "error") & (F.col("user_id") % 10 == 0), 3)
        .otherwise(0)
    )
    return (
        rows.withColumn("terminal_id", terminal)
        .withColumn("tx_fraud_scenario", scenario)
        .select(
            F.col("event_id").alias("transaction_id"),
            _second_text().cast("timestamp_ntz").alias("tx_datetime"),
            F.col("user_id").alias("customer_id"),
            "terminal_id",
            F.col("value").alias("tx_amount"),
            seconds.cast("bigint").alias("tx_time_seconds"),
            day.cast("bigint").alias("tx_time_days"),
            F.when(F.col("tx_fraud_scenario") > 0, 1).otherwise(0).alias("tx_fraud"),
            "tx_fraud_scenario",
            "event_type",
        )
    )


def tx(spark: SparkSession, sf: str) -> DataFrame:
    return transactions(events(spark, sf)).select(*TRANSACTION_COLUMNS)


def raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``tx_raw``: the text file with one header, repeated ids and seven kinds of fault.

    The lines come out of ``explode``, so a filter on them does not build them twice.
    """
    fault = F.col("transaction_id") % 101

    def field(value: Column, *faults: tuple[int, str]) -> Column:
        text = value.cast("string")
        for remainder, bad in faults:
            text = F.when(fault == remainder, bad).otherwise(text)
        return text

    def line(amount: Column) -> Column:
        return F.concat_ws(
            ",",
            field(F.col("transaction_id"), (1, "abc")),
            field(F.col("tx_datetime"), (3, "2019-13-45 00:00:00")),
            field(F.col("customer_id"), (6, "")),
            field(F.col("terminal_id")),
            field(amount, (2, "-5.0")),
            field(F.col("tx_time_seconds"), (7, "-1")),
            field(F.col("tx_time_days")),
            field(F.col("tx_fraud"), (4, "2"), (5, "1")),
            field(F.col("tx_fraud_scenario"), (5, "0")),
        )

    amount = F.col("tx_amount")
    repeated = F.when(F.col("transaction_id") % 103 == 0, line(F.round(amount + 1, 2)))
    lines = F.explode(F.array_compact(F.array(line(amount), repeated)))
    header = spark.range(1).select(F.lit("#" + ",".join(TRANSACTION_COLUMNS)).alias("value"))
    return header.unionByName(tx(spark, sf).select(lines.alias("value")))


def stats_from(rows: DataFrame) -> DataFrame:
    """``driver_stats``: rates and counts per user and day, known at the day's end."""
    day = F.col("ts").cast("date")
    total = F.count(F.lit(1))
    per_day = rows.groupBy(F.col("user_id").alias("driver_id"), day.alias("day")).agg(
        (F.count_if(F.col("event_type") == "purchase") / total).alias("conv_rate"),
        (F.count_if(F.col("event_type") != "error") / total).alias("acc_rate"),
        total.alias("avg_daily_trips"),
    )
    corrected = F.col("driver_id") % 7 == 0
    copies = F.when(corrected, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    end = F.date_add("day", 1).cast("timestamp_ntz")
    return per_day.withColumn("copy", F.explode(copies)).select(
        "driver_id",
        end.alias("event_timestamp"),
        F.when(F.col("copy") == 0, end)
        .otherwise(end + F.expr("interval 1 hour"))
        .alias("created"),
        (F.col("conv_rate") + F.col("copy") * 0.1).alias("conv_rate"),
        "acc_rate",
        "avg_daily_trips",
    )


def driver_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats_from(events(spark, sf))


def latest_stats(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(driver_stats(spark, sf), "driver_id")


def entities(spark: SparkSession, sf: str) -> DataFrame:
    k = F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
    return (
        events(spark, sf)
        .filter(F.col("event_type") == "purchase")
        .select(
            "event_id",
            F.col("user_id").alias("driver_id"),
            F.col("ts").alias("event_timestamp"),
            F.col("value").alias("label"),
            k.alias("val_to_add"),
            (k * 10).alias("val_to_add_2"),
        )
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Request rows without a time; every 50th names a driver nobody knows."""
    unknown = F.col("event_id") % 50 == 0
    driver = F.when(unknown, -F.col("driver_id")).otherwise(F.col("driver_id"))
    return entities(spark, sf).select(
        "event_id", driver.alias("driver_id"), "val_to_add", "val_to_add_2"
    )


def with_scores(rows: DataFrame) -> DataFrame:
    """``scored``: two rules that stand for two models."""
    score_b = F.col("tx_amount") + F.when(F.col("terminal_id") % 20 == 0, 40.0).otherwise(0.0)
    return rows.select(
        "*",
        F.col("tx_amount").alias("score_a"),
        (F.col("tx_amount") > 150).cast("int").alias("pred_a"),
        score_b.alias("score_b"),
        (score_b > 150).cast("int").alias("pred_b"),
    )


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return with_scores(tx(spark, sf))


def f1_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Fraud F1 of both rules in every hour: two samples for the significance test."""
    hour = F.floor(F.col("tx_time_seconds") / 3600).alias("hour")
    sides = F.array(
        F.struct(F.lit("champion_f1").alias("side"), F.col("pred_a").alias("called")),
        F.struct(F.lit("challenger_f1").alias("side"), F.col("pred_b").alias("called")),
    )
    rows = scored(spark, sf).select(hour, "tx_fraud", F.inline(sides))
    cells = confusion_counts(rows, "tx_fraud", "called", ("hour", "side"))
    value = f1_fraud(F.col("tp"), F.col("fp"), F.col("fn"))
    return cells.groupBy("hour").pivot("side", ["champion_f1", "challenger_f1"]).agg(F.max(value))


def model_versions(spark: SparkSession, sf: str) -> DataFrame:
    """One model per event type and one version per day: the rule's AUC on that day."""
    rows = with_scores(transactions(events(spark, sf))).select(
        F.col("event_type").alias("model_name"),
        (F.col("tx_time_days") + 1).cast("int").alias("version"),
        "score_b",
        "tx_fraud",
    )
    areas = area_under_roc(rows, "score_b", "tx_fraud", ("model_name", "version"))
    return areas.filter(F.col("auc").isNotNull()).select(
        "model_name", "version", F.concat_ws("-", "model_name", "version").alias("run_id"), "auc"
    )


def training(rows: DataFrame) -> DataFrame:
    """Transactions as a training table with label ``fraud``."""
    return rows.withColumnRenamed("tx_fraud", "fraud").drop("tx_fraud_scenario", "event_type")


def train_part(rows: DataFrame) -> DataFrame:
    return rows.filter(split_name(F.col("transaction_id")) == "train")


def test_part(rows: DataFrame) -> DataFrame:
    return rows.filter(split_name(F.col("transaction_id")) == "test")


def messages(rows: DataFrame, with_faults: bool = True) -> DataFrame:
    """JSON texts of transactions; every 97th is cut off when faults are wanted."""
    body = rows.select(
        "transaction_id",
        F.col("tx_datetime").cast("string").alias("timestamp"),
        "tx_amount",
        "terminal_id",
        "tx_time_seconds",
        "tx_time_days",
        F.col("tx_fraud").alias("fraud"),
    )
    if not with_faults:
        return as_messages(body)
    bad = F.col("transaction_id") % 97 == 0
    text = F.to_json(F.struct(*[c for c in body.columns if c != "fraud"]))
    return body.select(
        F.when(bad, "{bad").otherwise(text).alias("value"),
        F.lit(None).cast("bigint").alias("offset"),
    )
