"""Row numbers within groups, dealt over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from cardwatch.llm.store import written


def numbered(rows: DataFrame, group: str, order: Sequence[str], label: str) -> DataFrame:
    """The rows with ``pos``, from 0 within their group by ``order``, and ``n``, their group's rows.

    Rows are dealt out by ranges of (group, order), so a large group is numbered in many tasks; what is summed up in order
    is one count per range and group.
    """
    cut = written(rows.repartitionByRange(group, *order).withColumn("part", F.spark_partition_id()), label)
    counts = cut.groupBy(group, "part").agg(F.count("*").alias("rows"))
    whole = Window.partitionBy(group)
    starts = counts.select(
        group, "part", F.sum("rows").over(whole).alias("n"),
        (F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")).alias("start"),
    )
    place = F.row_number().over(Window.partitionBy(group, "part").orderBy(*order))
    found = cut.withColumn("place", place).join(starts, [group, "part"])
    return found.withColumn("pos", F.col("start") + F.col("place") - 1).drop("part", "place", "start")
