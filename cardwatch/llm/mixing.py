"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target size; a document of the source gets a fractional number of copies,
target / source size.  The whole part is taken.  The fractions are rounded by the pivotal
method: two undecided documents pass words to each other at random until one of them is taken
not at all or once, the other carries the rest on.  Expected copies stay exact, and the words of a
source end within one document of its target (the last undecided one is rounded by itself).

The meetings form a reduction tree: blocks of about ``BLOCK`` documents of one source are folded
by themselves, large documents first, and leave one undecided document each, which meet at the
next level.  Draws are hashes of ids, so reruns agree whatever the
partitions.  Only DataFrame functions are used.

Null sources are a source of their own, last in order.  Null and empty texts have size 0 and
are never taken; a source without words has target 0.  Rows repeated with the same id, source
and size are rows of their own.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardwatch.llm.numbering import numbered
from cardwatch.llm.store import written

BLOCK = 256
WORD = r"[^\x20\x09-\x0D]+"
TINY = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """source, source_size and target of every source.

    ``weights`` repeat over the sources in code point order, null last.  No target exceeds
    ``cap`` times its source; the excess goes to the others by weight: each gets the smaller
    of its cap and weight times one common level.  The windows see one row per source.
    """
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    choices = F.array(*[F.lit(float(w)) for w in weights])
    sources = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(choices, ((F.row_number().over(order) - 1) % len(weights) + 1)))
        .withColumn("most", F.col("source_size") * F.lit(float(cap)))
    )
    before = (Window.orderBy((F.col("most") / F.col("weight")), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    return (
        sources.withColumn("level", left / open_weight)
        .withColumn("level", F.max("level").over(everything))
        .select("source", "source_size", F.least("most", F.col("weight") * F.col("level")).alias("target"))
    )


def _uniform(*keys: Column) -> Column:
    return (F.pmod(F.xxhash64(*keys), F.lit(1 << 40)).cast("double") + 0.5) / F.lit(float(1 << 40))


def _meet(carry: Column, item: Column, level: int, seed: int) -> Column:
    """One pivotal step of the fold.

    The accumulator has the decided documents and the undecided one: its place ``at`` (-1:
    none), ``size`` and probability ``p``.  Words move from one document to the other until
    one is whole; the direction is drawn so that both keep their expected copies, and the
    expected words of the two stay what they were whichever way they go.
    """
    a, b = carry["p"], item["p"]
    size_a, size_b = carry["size"].cast("double"), item["size"].cast("double")
    up = F.least((1 - a) * size_a, b * size_b)
    down = F.least(a * size_a, (1 - b) * size_b)
    raised = _uniform(item["ref"], F.lit(level), F.lit(seed)) * (up + down) < down
    moved = F.when(raised, up).otherwise(-down)
    pair = F.array(
        F.struct(carry["at"].alias("at"), carry["size"].alias("size"), (a + moved / size_a).alias("p")),
        F.struct(item["at"].alias("at"), item["size"].alias("size"), (b - moved / size_b).alias("p")),
    )
    alone = F.array(F.struct(item["at"].alias("at"), item["size"].alias("size"), b.alias("p")))

    def is_open(x: Column) -> Column:
        return (x["p"] > TINY) & (x["p"] < 1 - TINY)

    def next_state(state: Column, met: Column) -> Column:
        whole = F.filter(met, lambda x: ~is_open(x))
        bits = F.transform(whole, lambda x: F.struct(x["at"].alias("at"), F.round(x["p"]).cast("int").alias("bit")))
        rest = F.filter(met, is_open)
        none = F.struct(F.lit(-1).alias("at"), F.lit(0).cast("long").alias("size"), F.lit(0.0).alias("p"))
        held = F.coalesce(F.get(rest, F.lit(0)), none)
        return F.struct(F.concat(state["done"], bits).alias("done"), held["at"].alias("at"),
                        held["size"].alias("size"), held["p"].alias("p"))

    return next_state(carry, F.when(carry["at"] < 0, alone).otherwise(pair))


def _fold(rows: DataFrame, level: int, seed: int, block: int, *carried: str) -> DataFrame:
    """Fold blocks of undecided rows (source, size, ref, p); ``bit`` is null for the one left."""
    counts = rows.groupBy("source").agg(F.ceil(F.count("*") / block).alias("pieces"))
    other = counts.select(F.col("source").alias("of"), "pieces")
    placed = rows.join(other, F.col("source").eqNullSafe(F.col("of")))
    placed = placed.withColumn("piece", F.pmod(F.xxhash64("ref", F.lit(level), F.lit(seed)), F.col("pieces")))
    members = placed.groupBy("source", "piece").agg(
        F.sort_array(F.collect_list(F.struct("size", "ref", "p", *carried)), asc=False).alias("items"))
    numbered = members.withColumn("items", F.transform("items", lambda x, i: x.withField("at", i)))
    start = F.struct(
        F.array().cast("array<struct<at:int,bit:int>>").alias("done"), F.lit(-1).alias("at"),
        F.lit(0).cast("long").alias("size"), F.lit(0.0).alias("p"))
    folded = numbered.withColumn("fold", F.aggregate("items", start, lambda a, x: _meet(a, x, level, seed)))
    bits = folded.withColumn(
        "bits", F.map_from_arrays(F.transform("fold.done", lambda d: d["at"]), F.transform("fold.done", lambda d: d["bit"])))
    return bits.select(
        "source", "piece", F.col("fold.p").alias("rest"), "bits", F.explode("items").alias("item")
    ).select("source", "piece", "rest", F.element_at("bits", F.col("item.at")).alias("bit"), "item.*")


def _with_ref(rows: DataFrame) -> DataFrame:
    """The rows with ``ref``, on which their block and draws hang.

    Rows of equal id and size, such as many without id, are numbered apart: else they would all fall into one block and
    share one draw.  Which of them gets which number makes no difference.
    """
    if rows.groupBy("doc_id", "size").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return rows.withColumn("ref", F.xxhash64("doc_id", "size"))
    added = rows.select("*", F.monotonically_increasing_id().alias("_row"), F.lit("").alias("_all"))
    placed = numbered(written(added, "mix-repeated"), "_all", ["doc_id", "size", "source", "_row"], "mix-numbered")
    return placed.select(*rows.columns, F.xxhash64("doc_id", "size", "pos").alias("ref"))


def pivotal_rounding(rows: DataFrame, block: int = BLOCK, seed: int = 0, carried: Sequence[str] = ()) -> DataFrame:
    """Round the fractions ``p`` of (doc_id, source, size, p) to ``bit`` 0 or 1; ``carried`` columns stay."""
    first = written(_fold(_with_ref(rows), 0, seed, block, "doc_id", *carried), "mix-0")
    left = first.filter("bit is null").select(
        "source", "size", F.xxhash64("source", "piece").alias("ref"), F.col("rest").alias("p"))
    decided, level = [], 0
    while True:
        level += 1
        most = left.groupBy("source").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= 1:
            break
        left = left.withColumnRenamed("ref", "blocked").withColumn("ref", F.col("blocked"))
        folded = written(_fold(left, level, seed, block, "blocked"), f"mix-{level}")
        decided.append(folded.filter("bit is not null").select("blocked", "source", "bit"))
        left = folded.filter("bit is null").select("source", "size", F.col("blocked").alias("ref"), F.col("rest").alias("p"))
    last = left.select(F.col("ref").alias("blocked"), "source",
                       F.when(_uniform(F.col("ref"), F.lit(level), F.lit(seed)) < F.col("p"), 1).otherwise(0).alias("bit"))
    for part in decided:
        last = last.union(part)
    later = last.select("blocked", F.col("bit").alias("later"))
    keyed = first.withColumn("blocked", F.when(F.col("bit").isNull(), F.xxhash64("source", "piece")))
    return keyed.join(later, "blocked", "left").select(
        "doc_id", "source", "size", F.coalesce("bit", "later").alias("bit"), *carried)


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
    block: int = BLOCK, seed: int = 0, carried: Sequence[str] = (),
) -> DataFrame:
    """doc_id, size, source_size, target, taken (copies times size) and ``carried`` columns of every row."""
    sizes = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"),
                    *carried),
        "mix-sizes",
    )
    targets = written(source_targets(sizes, weights, share, cap), "mix-targets").select(
        F.col("source").alias("of"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("copies"))
    whole = F.floor(F.col("copies") + TINY)
    part = F.greatest(F.col("copies") - whole, F.lit(0.0))
    fractional = (targets.filter(part > TINY)
                  .select("of", part.alias("p")))
    open_rows = (
        sizes.filter("size > 0").join(fractional, F.col("source").eqNullSafe(F.col("of")))
        .select("doc_id", "source", "size", "p", *carried)
    )
    bits = pivotal_rounding(open_rows, block, seed, carried)
    rest = (
        sizes.join(fractional.select(F.col("of").alias("open_source"), F.lit(True).alias("open")),
                   F.col("source").eqNullSafe(F.col("open_source")), "left")
        .filter("size = 0 or open is null")
        .select("doc_id", "source", "size", F.lit(0).alias("bit"), *carried)
    )
    return (
        bits.union(rest).join(targets, F.col("source").eqNullSafe(F.col("of")))
        .select("doc_id", "size", "source_size", "target",
                ((whole + F.col("bit")) * F.col("size")).cast("long").alias("taken"), *carried)
    )
