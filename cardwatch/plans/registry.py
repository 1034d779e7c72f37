"""The table of model versions on shared storage: register, promote, load."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardwatch.operators.champions import CHALLENGER, CHAMPION, promote
from cardwatch.operators.modeling import load_model
from cardwatch.operators.rows import side_by_side
from cardwatch.sinks.tables import publish, read_current

VERSION_SCHEMA = (
    "model_name string, version int, run_id string, path string, "
    "auc double, accuracy double, f1 double, alias string, tag string"
)


def versions(spark: SparkSession, root: str) -> DataFrame:
    current = read_current(spark, root)
    return spark.createDataFrame([], VERSION_SCHEMA) if current is None else current


def register(
    spark: SparkSession, root: str, model_name: str, run_id: str, path: str, metrics: DataFrame
) -> DataFrame:
    """Add a version with its one row of metrics and give it an alias.

    The first version is champion, later ones only with a strictly higher AUC than
    the champion; any other becomes challenger.  An alias leaves its former holder.
    """
    known = versions(spark, root)
    mine = known.filter(F.col("model_name") == model_name)
    state = mine.agg(
        F.coalesce(F.max("version"), F.lit(0)).alias("last"),
        F.max(F.when(F.col("alias") == CHAMPION, F.col("auc"))).alias("best"),
    )
    wins = F.col("best").isNull() | (F.col("auc") > F.col("best"))
    added = side_by_side(metrics.select("auc", "accuracy", "f1"), state).select(
        F.lit(model_name).alias("model_name"),
        (F.col("last") + 1).alias("version"),
        F.lit(run_id).alias("run_id"),
        F.lit(path).alias("path"),
        "auc",
        "accuracy",
        "f1",
        F.when(wins, CHAMPION).otherwise(CHALLENGER).alias("alias"),
        F.lit(None).cast("string").alias("tag"),
    )
    taken = added.select("model_name", F.col("alias").alias("taken"))
    freed = known.join(taken, "model_name", "left").withColumn(
        "alias", F.when(~F.col("alias").eqNullSafe(F.col("taken")), F.col("alias"))
    )
    publish(freed.drop("taken").unionByName(added), root)
    return versions(spark, root)


def apply_decision(spark: SparkSession, root: str, model_name: str, decision: DataFrame) -> None:
    decisions = decision.select(F.lit(model_name).alias("model_name"), "decision")
    publish(promote(versions(spark, root), decisions), root)


def locate(spark: SparkSession, root: str, model_name: str, alias: str) -> tuple[int, str]:
    """Version and path of the model that holds ``alias``."""
    row = (
        versions(spark, root)
        .filter((F.col("model_name") == model_name) & (F.col("alias") == alias))
        .agg(F.max(F.struct("version", "path")).alias("held"))
        .first()
    )
    if row.held is None:
        raise LookupError(f"no version of {model_name} is {alias}")
    return row.held.version, row.held.path


def load_by_alias(spark: SparkSession, root: str, model_name: str, alias: str) -> PipelineModel:
    return load_model(locate(spark, root, model_name, alias)[1])
