"""Connected components of a distributed table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardwatch.llm.store import written


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, steps: int | None = None) -> DataFrame:
    """(node, label) of every node that has a link (u, v); the label is the least node of its component.

    Alternates two steps until nothing changes: every node hands its larger neighbours, then its
    smaller ones, to its least neighbour.  Each step is one aggregate and one join, so a node with
    very many links is combined before it is shuffled and its join can be split.  Links to itself
    and repeated links do no harm.  The work left halves with each round or faster.

    With ``steps`` it stops after as many rounds: nodes with one label are then of one component, but a component may have
    several labels.
    """
    pair = F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")
    state = written(links.select(*pair).filter("u <> v").distinct(), "links")
    before, done = None if steps else _state(state), 0
    while True:
        both = state.select("u", "v").union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u <> v"), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        state = written(small.filter("u <> v").distinct(), "small-star")
        done += 1
        if done == steps:
            break
        if steps is None:
            after = _state(state)
            if after == before:
                break
            before = after
    pairs = state.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("label"))
    return pairs.union(roots).groupBy("node").agg(F.min("label").alias("label"))
