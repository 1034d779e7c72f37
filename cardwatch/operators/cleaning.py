"""From raw text fields to a typed, rule-checked table with unique ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardwatch.functions.parsing import typed
from cardwatch.schema import COMMENT_MARK, CORRUPT, TRANSACTION_COLUMNS

KEPT = "kept"
REJECTIONS = ("comment", "field_count", "type", "range", "scenario")


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def is_comment() -> Column:
    return F.coalesce(F.col("transaction_id").startswith(COMMENT_MARK), F.lit(False))


def has_wrong_field_count() -> Column:
    return F.col(CORRUPT).isNotNull() & ~is_comment()


def has_all_values(columns: tuple[str, ...] = TRANSACTION_COLUMNS) -> Column:
    """No null, and an amount that is a number: neither NaN nor infinite."""
    given = [F.col(c).isNotNull() for c in columns]
    if "tx_amount" in columns:
        given.append(F.coalesce(F.abs(F.col("tx_amount")) < F.lit(float("inf")), F.lit(False)))
    return _all(given)


def is_in_range() -> Column:
    not_negative = ("tx_time_seconds", "tx_time_days", "transaction_id", "customer_id",
                    "terminal_id", "tx_fraud_scenario")
    return _all(
        [F.col("tx_amount") > 0, F.col("tx_fraud").isin(0, 1)]
        + [F.col(c) >= 0 for c in not_negative]
    )


def fraud_names_scenario() -> Column:
    return (F.col("tx_fraud") == 0) | (F.col("tx_fraud_scenario") >= 1)


def typed_projection(raw: DataFrame) -> DataFrame:
    """The nine fields as their types.

    ``inline`` instead of a plain projection keeps later filters above the casts;
    pushed below, each condition would parse its field again.
    """
    return raw.select(F.inline(F.array(F.struct([typed(c, F.col(c)) for c in TRANSACTION_COLUMNS]))))


def drop_malformed(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Without comment lines; ``strict`` also drops rows with too few or many fields."""
    return raw.filter(~is_comment() & ~has_wrong_field_count() if strict else ~is_comment())


def malformed_counts(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(is_comment()).alias("comment_lines"),
        F.count_if(has_wrong_field_count()).alias("wrong_field_count"),
    )


def keep_not_null(df: DataFrame) -> DataFrame:
    return df.filter(has_all_values())


def keep_business_ranges(df: DataFrame) -> DataFrame:
    return df.filter(is_in_range())


def keep_explained_fraud(df: DataFrame) -> DataFrame:
    return df.filter(fraud_names_scenario())


def quarantine(df: DataFrame) -> DataFrame:
    """Rows with no id, no positive amount or an unknown label, and why."""
    faults = {
        "id_missing": F.col("transaction_id").isNull(),
        "amount_not_positive": F.col("tx_amount") <= 0,
        "label_unknown": ~F.col("tx_fraud").isin(0, 1),
    }
    reasons = F.array_compact(F.array(*[F.when(test, name) for name, test in faults.items()]))
    return df.withColumn("reasons", reasons).filter(F.size("reasons") > 0)


def earliest_first(columns: list[str], key: str, order: tuple[str, ...]) -> list[str]:
    return [*order, *[c for c in columns if c != key and c not in order]]


def deduplicate(
    df: DataFrame, key: str = "transaction_id", order: tuple[str, ...] = ("tx_datetime",)
) -> DataFrame:
    """One row per key: the first by ``order``, then by every other column.

    Spark applies a first-row limit before the shuffle as well, so an id that holds a
    large share of the rows sends one row per task.
    """
    ranked = Window.partitionBy(key).orderBy(*earliest_first(df.columns, key, order))
    return df.withColumn("__place", F.row_number().over(ranked)).filter("__place = 1").drop("__place")


def clean(raw: DataFrame, strict: bool = False) -> DataFrame:
    rows = typed_projection(drop_malformed(raw, strict))
    return deduplicate(keep_explained_fraud(keep_business_ranges(keep_not_null(rows))))


def classify(raw: DataFrame, strict: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns plus ``outcome``: why a line is rejected, or ``kept``."""
    rows = raw.select(
        *keep,
        *[typed(c, F.col(c)) for c in TRANSACTION_COLUMNS],
        is_comment().alias("is_comment"),
        (has_wrong_field_count() if strict else F.lit(False)).alias("is_short_or_long"),
    )
    outcome = (
        F.when(F.col("is_comment"), "comment")
        .when(F.col("is_short_or_long"), "field_count")
        .when(~has_all_values(), "type")
        .when(~is_in_range(), "range")
        .when(~fraud_names_scenario(), "scenario")
        .otherwise(KEPT)
    )
    return rows.select(*keep, *TRANSACTION_COLUMNS, outcome.alias("outcome"))


def funnel(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Rows read, dropped at each stage and kept, from one scan."""
    rows = classify(raw, strict)
    kept_id = F.when(F.col("outcome") == KEPT, F.col("transaction_id"))
    counts = rows.agg(
        F.count(F.lit(1)).alias("lines_read"),
        *[F.count_if(F.col("outcome") == r).alias(f"dropped_{r}") for r in REJECTIONS],
        F.count_if(F.col("outcome") == KEPT).alias("valid"),
        F.count_distinct(kept_id).alias("rows_kept"),
    )
    duplicates = (F.col("valid") - F.col("rows_kept")).alias("dropped_duplicate")
    return counts.select(
        "lines_read", *[f"dropped_{r}" for r in REJECTIONS], duplicates, "rows_kept"
    )
