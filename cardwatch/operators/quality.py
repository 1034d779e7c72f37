"""Data-quality profile of a typed transaction table.

The input is the profile's view of a file (``sources.transactions.split_lines``):
numbers already cast, the date still text.  :func:`profile` answers every question
but the duplicates in one aggregate; the functions before it answer one each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardwatch.functions.parsing import parse_timestamp

ID = "transaction_id"


def rules() -> dict[str, Column]:
    """Violations.  A null operand is no violation; nulls are counted apart."""
    return {
        "id_negative": F.col(ID) < 0,
        "amount_not_positive": F.col("tx_amount") <= 0,
        "seconds_negative": F.col("tx_time_seconds") < 0,
        "days_negative": F.col("tx_time_days") < 0,
        "label_unknown": ~F.col("tx_fraud").isin(0, 1),
        "scenario_negative": F.col("tx_fraud_scenario") < 0,
    }


def _bad_date() -> Column:
    return parse_timestamp(F.col("tx_datetime")).isNull()


def _unexplained_fraud() -> Column:
    return (F.col("tx_fraud") == 1) & (F.col("tx_fraud_scenario") == 0)


def _long(counts: DataFrame, name: str, value: str) -> DataFrame:
    return counts.unpivot([], counts.columns, name, value)


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _long(counts, "column", "nulls")


def rule_violations(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(test).alias(name) for name, test in rules().items()])
    return _long(counts, "rule", "violations")


def invalid_dates(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(_bad_date()).alias("invalid_dates"))


def fraud_without_scenario(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(_unexplained_fraud()).alias("fraud_without_scenario"))


def duplicate_ids(df: DataFrame) -> DataFrame:
    """Ids that occur more than once; rows without an id are not counted."""
    copies = df.filter(F.col(ID).isNotNull()).groupBy(ID).count()
    return copies.agg(F.count_if(F.col("count") > 1).alias("duplicate_ids"))


def summary(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Totals and ranges.  ``approximate`` avoids the shuffle of all distinct ids."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("tx_fraud").alias("fraud"),
        distinct("customer_id").alias("customers"),
        distinct("terminal_id").alias("terminals"),
        F.min("tx_amount").alias("min_amount"),
        F.max("tx_amount").alias("max_amount"),
    )


def profile(df: DataFrame) -> DataFrame:
    """All counts of this module but the duplicates, one row, one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("transactions"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns],
        *[F.count_if(test).alias(f"rule_{name}") for name, test in rules().items()],
        F.count_if(_bad_date()).alias("invalid_dates"),
        F.count_if(_unexplained_fraud()).alias("fraud_without_scenario"),
        F.sum("tx_fraud").alias("fraud"),
        F.min("tx_amount").alias("min_amount"),
        F.max("tx_amount").alias("max_amount"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("terminal_id").alias("terminals"),
    )
