"""Scans of raw transaction text.

Two ways in give the same frame, nine string columns and ``_corrupt_record``:
:func:`read_raw_csv` for files and :func:`parse_csv_lines` for lines that are
already in a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cardwatch.functions.parsing import typed
from cardwatch.schema import (
    COMMENT_MARK,
    CORRUPT,
    RAW_SCHEMA_WITH_CORRUPT,
    TRANSACTION_COLUMNS,
)


def read_raw_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Positional scan of a file, folder or glob; no header, all fields text.

    Column pruning is off because the parser would otherwise judge a row only by
    the columns a query happens to use, and ``_corrupt_record`` would change with
    the query.
    """
    return (
        spark.read.schema(RAW_SCHEMA_WITH_CORRUPT)
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .csv(path)
    )


def parse_csv_lines(lines: DataFrame, column: str = "value", keep: bool = False) -> DataFrame:
    """Parse text lines as CSV rows; ``keep`` adds the text itself as ``line``.

    The row comes out of ``inline`` rather than a projection: filters on its fields
    then stay above the parser, which a pushed filter would call once per condition.
    Blank lines are skipped, as a file scan does.
    """
    lines = lines.filter(F.col(column).rlike(r"[^\x00-\x20]"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    row = F.from_csv(F.col(column), RAW_SCHEMA_WITH_CORRUPT.toDDL(), options)
    line = [F.col(column).alias("line")] if keep else []
    return lines.select(*line, F.inline(F.array(row)))


def read_text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines cut at commas and cast by position, without the header lines."""
    return split_lines(spark.read.text(path))


def split_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The profile's view of the file: typed, but the date still as text."""
    fields = lines.filter(~F.col(column).startswith(COMMENT_MARK)).select(
        F.split(column, ",").alias("fields")
    )
    picked = []
    for position, name in enumerate(TRANSACTION_COLUMNS):
        field = F.get("fields", F.lit(position))
        picked.append(field.alias(name) if name == "tx_datetime" else typed(name, field))
    return fields.select(F.inline(F.array(F.struct(*picked))))


def read_headed_csv(
    spark: SparkSession, path: str | list[str], schema: StructType | str | None = None
) -> DataFrame:
    """CSV with a header line.  Without a schema Spark reads the text twice."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)
