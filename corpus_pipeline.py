"""A corpus pipeline of five stages over the documents table.

Every stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the
next stage's docs.  The first three keep whole rows of documents, with their columns; mixing
repeats and drops rows; sharding adds the shard to each row of the mix.

Near copies and contamination are decided row by row: the stage numbers its rows, so rows that share an id, or have
none, are judged by their own text.  Of rows with equal or similar texts one stays, whatever their ids.  Mixing decides
row by row too; sharding goes by the id, or by the text where that is null.  Without labelled rows the quality stage
knows nothing and keeps all documents.  An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardwatch.llm import decontaminate, mixing, neardup, quality, sharding
from cardwatch.llm.labels import fold
from cardwatch.llm.store import table, written

QUALITY = 0.7
SHARDS = 16
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def _numbered(docs: DataFrame, label: str) -> DataFrame:
    """The rows with ``row``, a number of their own; written, as numbers hold for one reading only."""
    return written(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), label, "zstd")


def _by_row(rows: DataFrame) -> DataFrame:
    """The texts with their row's number for an id, as the operators take them."""
    return rows.select(F.col("row").alias("doc_id"), "text")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality classifier scores at 0.7 or more.

    It learns from the labelled rows outside the held-out quarter; if there are none, all documents stay.
    """
    train = fold(F.col("doc_id"), 4) != 2
    trees = quality.fit(docs, table(spark, sf_dir, "labels"), train)
    if not trees.rows:
        return _rows(docs)
    return quality.score_rows(_rows(docs), trees).filter(F.col("score") >= QUALITY).drop("score")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of near copies: five-word shingles, similarity 0.8.

    The one with the smallest id stays, one without id only if none has any.  Texts without words all stay.
    """
    rows = _numbered(docs, "near-rows")
    found = neardup.components_of(_by_row(rows), k=5, percent=80).filter("n_shingles > 0")
    found = found.select(F.col("doc_id").alias("row"), "component_id")
    named = rows.select("row", F.col("doc_id").isNull().alias("bare"), "doc_id").join(found, "row")
    stays = named.groupBy("component_id").agg(F.min(F.struct("bare", "doc_id", "row")).alias("first"))
    goes = named.join(stays, "component_id").filter("row <> first.row").select("row")
    return rows.join(goes, "row", "left_anti").select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the rows that hold a window similar to a benchmark item."""
    rows = _numbered(docs, "benchmark-rows")
    found = decontaminate.contaminated(_by_row(rows), table(spark, sf_dir, "benchmark"))
    held = found.select(F.col("doc_id").alias("row")).distinct()
    return rows.join(held, "row", "left_anti").select(*COLUMNS)


def _key() -> Column:
    """The id, or the hash of the text from 2^62 on where that is null."""
    of_text = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return F.coalesce(F.col("doc_id").cast("long"), of_text)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each row as often as the mix does: not at all, once or twice."""
    rows = _numbered(docs, "mix-rows")
    taken = (
        mixing.mix(rows.withColumn("doc_id", _key()), carried=["row"]).filter("taken > 0")
        .select("row", F.expr("taken div size").cast("int").alias("copies"))
    )
    rows = rows.join(taken, "row")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix with their shard and slot; copies of a document share a shard."""
    return sharding.place(docs.select(*COLUMNS, _key().alias("key")), [1.0] * SHARDS, key="key").drop("key")


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("sharding", sharding_stage),
]

#: Trained trees, SimHash windows and hashed draws are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
