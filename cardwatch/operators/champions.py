"""Which model version serves: lookup, history and promotion.

A versions table has one row per registered version: ``model_name``, ``version``,
``run_id``, ``alias`` and, where older tools wrote one, ``tag``.  It is partitioned by
``model_name`` throughout, so many models do not meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

CHAMPION, CHALLENGER = "champion", "challenger"


def current_champion(versions: DataFrame, metrics: DataFrame) -> DataFrame:
    """Each model's champion and its metrics: by alias, else by tag."""
    by_alias = F.coalesce(F.col("alias") == CHAMPION, F.lit(False))
    by_tag = F.coalesce(F.col("tag") == CHAMPION, F.lit(False))
    best = F.max_by(F.struct("version", "run_id"), F.struct(by_alias, "version"))
    found = versions.filter(by_alias | by_tag).groupBy("model_name").agg(best.alias("found"))
    return found.select("model_name", "found.*").join(metrics, "run_id")


def champion_history(versions: DataFrame) -> DataFrame:
    """What each version became when it was registered, in version order.

    The first version is champion; a later one only with a strictly higher ``auc``.
    ``improvement_percent`` is against the champion it replaced.
    """
    earlier = (
        Window.partitionBy("model_name")
        .orderBy("version")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    past = versions.withColumn("best_auc", F.max("auc").over(earlier))
    wins = F.col("best_auc").isNull() | (F.col("auc") > F.col("best_auc"))
    gain = F.when(wins, (F.col("auc") - F.col("best_auc")) / F.col("best_auc") * 100)
    up_to_now = earlier.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = past.select(
        "model_name",
        "version",
        "auc",
        F.when(wins, CHAMPION).otherwise(CHALLENGER).alias("alias"),
        gain.alias("improvement_percent"),
    )
    serving = F.max(F.when(F.col("alias") == CHAMPION, F.col("version"))).over(up_to_now)
    return ranked.withColumn("serving_version", serving)


def latest_aliases(history: DataFrame) -> DataFrame:
    """The alias column after all registrations: one champion, the newest challenger."""
    model = Window.partitionBy("model_name")
    newest = F.max(F.when(F.col("alias") == CHALLENGER, F.col("version"))).over(model)
    serving = F.max(F.when(F.col("alias") == CHAMPION, F.col("version"))).over(model)
    alias = F.when(F.col("version") == serving, CHAMPION).when(
        F.col("version") == newest, CHALLENGER
    )
    return history.withColumn("alias", alias)


def promote(versions: DataFrame, decisions: DataFrame) -> DataFrame:
    """Move ``champion`` to the challenger of each model decided PROMOTE.

    The old champion loses the alias and ``challenger`` is cleared.  A model without
    a challenger stays as it is.
    """
    promoted = decisions.filter(F.col("decision") == "PROMOTE").select("model_name").distinct()
    marked = versions.join(promoted.withColumn("promoted", F.lit(True)), "model_name", "left")
    is_challenger = F.coalesce(F.col("alias") == CHALLENGER, F.lit(False))
    moves = F.coalesce(F.col("promoted"), F.lit(False)) & F.max(is_challenger).over(
        Window.partitionBy("model_name")
    )
    moved = marked.withColumn("moves", moves)
    cleared = F.col("alias").isin(CHAMPION, CHALLENGER)
    alias = (
        F.when(~F.col("moves"), F.col("alias"))
        .when(is_challenger, CHAMPION)
        .when(~F.coalesce(cleared, F.lit(False)), F.col("alias"))
    )
    return moved.withColumn("alias", alias).select(versions.columns)
