"""Rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair has a pseudo-random draw; the record goes to the shard with
the best weighted draw.  A shard that is added only takes records into itself, a shard
that is removed only gives its own away, and a changed weight moves records to or from
that shard alone.

Null keys count as one key, the empty string.  Repeated rows share a shard and get slots
of their own.  Null texts have size 1 and checksum 0.  An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardwatch.llm.store import written

SLOT_BUCKETS = 4096


def _cost(key: Column, shard: int, weight: float, seed: int) -> Column:
    """An exponential draw with rate ``weight``: the least cost wins a shard with its share."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"|{shard}|{seed}"))), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    return -F.log(uniform) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float], seed: int = 0) -> Column:
    """The shard of a key; shard ``i`` has ``weights[i]`` of the records in expectation."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    offers = [F.struct(_cost(text, i, w, seed).alias("cost"), F.lit(i).alias("shard"))
              for i, w in enumerate(weights) if w > 0]
    return (F.least(*offers) if len(offers) > 1 else offers[0])["shard"]


def with_slots(rows: DataFrame, order: Sequence[str], buckets: int = SLOT_BUCKETS) -> DataFrame:
    """Number the rows of each ``shard`` from 0 without gaps as ``slot``.

    A shard is numbered in ``buckets`` pieces by the hash of its rows; the piece starts come
    from a table of at most ``buckets`` counts per shard.
    """
    cut = rows.withColumn("_piece", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = cut.groupBy("shard", "_piece").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("shard", "_piece").orderBy(*order)
    return (
        cut.withColumn("_row", F.row_number().over(within))
        .join(starts, ["shard", "_piece"])
        .withColumn("slot", (F.col("_start") + F.col("_row") - 1).cast("long"))
        .drop("_piece", "_row", "_start")
    )


def assign(docs: DataFrame, weights: Sequence[float], added: float = 1.0, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, and the shard after one more of weight ``added``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col("doc_id"), weights, seed).cast("int").alias("shard"),
        rendezvous(F.col("doc_id"), [*weights, added], seed).cast("int").alias("grown_shard"),
    )
    return with_slots(written(rows, "sharded"), ["doc_id", "size", "text_crc32"])


def place(rows: DataFrame, weights: Sequence[float], seed: int = 0, key: str = "doc_id") -> DataFrame:
    """The rows with ``shard`` and ``slot`` (columns of these names are replaced) by their ``key``."""
    placed = rows.drop("shard", "slot", "_piece", "_row", "_start", "_n").withColumn(
        "shard", rendezvous(F.col(key), weights, seed).cast("int"))
    return with_slots(placed, [key])
