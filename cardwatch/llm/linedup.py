"""Cross-site boilerplate lines by distinct-site spread.

A line that stands on many sites is navigation, a licence or another template.  Lines are
hashed; a HyperLogLog sketch of sites per line hash merges by aggregation; lines whose estimate
lies near the threshold get an exact distinct count; lines at or above it are removed everywhere.  Ten sites are
evidence of a template in a crawl of any size; inputs of few sites ask for half of theirs (``least_sites``).

A line is what stands between line feeds; blank lines are never removed.  Null texts have no
lines and stay null, null sites count as no site.  Rows repeated with the same id and text get the same answer each.
Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from cardwatch.llm.store import written

MOST_SITES = 10
BROADCAST_LINES, SALTS = 1_000_000, 16
LG_K = 12
SIGMAS = 6


def _lines(docs: DataFrame) -> DataFrame:
    return (
        docs.select("doc_id", F.xxhash64("text").alias("version"), F.col("source").alias("site"),
                    F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
        .filter(F.trim("line") != "")
        .select("doc_id", "version", "site", "at", F.xxhash64("line").alias("line"))
    )


def least_sites(docs: DataFrame) -> int:
    """Ten sites, or half of the input's sites where it has fewer than twenty; two at least."""
    sites = docs.select("source").distinct().filter("source is not null").limit(2 * MOST_SITES).count()
    return max(2, min(MOST_SITES, -(-sites // 2)))


def _of(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """The occurrences of the lines in ``keys``; few keys go to all executors, many meet salted occurrences."""
    if keys.count() <= BROADCAST_LINES:
        return lines.join(F.broadcast(keys), "line", "left_semi")
    salted = keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id", "version", "at"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["line", "salt"], "left_semi").drop("salt")


def spread_lines(lines: DataFrame, min_sites: int, lg_k: int = LG_K) -> DataFrame:
    """Line hashes on ``min_sites`` sites or more.

    The occurrences of lines that occur so often at all are sketched as they come; sketches of a line are begun in
    every task and merged, so a line that stands everywhere sends one sketch per task.  The sketch decides outside a band of
    ``SIGMAS`` standard errors around the threshold; for lines inside it the occurrences are read again and
    their sites counted exactly.
    """
    named = lines.filter("site is not null")
    frequent = written(named.groupBy("line").agg(F.count("*").alias("n")).filter(F.col("n") >= min_sites).select("line"), "line-frequent")
    sketched = written(
        _of(named, frequent).groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites")),
        "line-sketches",
    )
    band = max(1, math.ceil(min_sites * SIGMAS * 1.04 / math.sqrt(1 << lg_k)))
    near = written(sketched.filter(F.abs(F.col("sites") - min_sites) <= band).select("line"), "line-near")
    exact = _of(named, near).select("line", "site").distinct().groupBy("line").agg(F.count("*").alias("sites"))
    return sketched.filter(F.col("sites") > min_sites + band).select("line").union(
        exact.filter(F.col("sites") >= min_sites).select("line"))


def remove_boilerplate(docs: DataFrame, min_sites: int | None = None) -> DataFrame:
    """doc_id, n_lines, n_removed and the text without boilerplate lines, for every row."""
    lines = written(_lines(docs), "lines")
    spread = written(spread_lines(lines, least_sites(docs) if min_sites is None else min_sites), "spread-lines")
    hits = (
        lines.join(spread, "line").groupBy("doc_id", "version")
        .agg(F.sort_array(F.collect_set("at")).alias("gone"))
        .select(F.col("doc_id").alias("hit_id"), F.col("version").alias("hit_version"), "gone")
    )
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    parts = F.split("text", "\n", -1)
    joined = rows.join(
        hits, rows.doc_id.eqNullSafe(hits.hit_id) & (rows.version == hits.hit_version), "left")
    kept = F.filter(parts, lambda _, i: ~F.array_contains("gone", i))
    return joined.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
    )
