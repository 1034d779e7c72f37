"""Exact de-duplication by progressive refinement: length, then prefix hash, then full hash.

Texts are compared after every character of ``[\\x20\\x09-\\x0D]`` is deleted; null counts as
empty.  Rows are grouped by length, rows of repeated lengths by the hash of a prefix, and only
rows of groups that are still repeated get their whole content hashed (SHA-256).

Of equal texts the row with the most code points stays, then the smallest ``doc_id`` (null
last).  Rows repeated with the same id and code points are one record: they stay or go
together.  An empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardwatch.llm.store import written

PREFIX_CHARACTERS = 64
BROADCAST_KEYS = 1_000_000
SPACES = " \t\n\x0b\f\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _at_least_two(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys)


def _bounded(keys: DataFrame, most: int) -> DataFrame:
    """The keys for a join: sent to all executors while they are few, else left to a shuffle."""
    return F.broadcast(keys) if keys.count() <= most else keys


def repeated_keys(docs: DataFrame, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """The (length, prefix hash) pairs that more than one row has.

    The first round counts lengths alone; the second hashes prefixes of rows whose length is repeated.
    """
    rows = docs.select(normalised(F.col("text")).alias("text")).withColumn("length", F.octet_length("text"))
    lengths = _bounded(written(_at_least_two(rows, "length"), "exact-lengths"), broadcast_keys)
    prefix = F.xxhash64(F.substring("text", 1, PREFIX_CHARACTERS)).alias("prefix")
    return _at_least_two(rows.join(lengths, "length", "left_semi").select("length", prefix), "length", "prefix")


def refine(docs: DataFrame, digest_all: bool = False, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    The surviving keys are counted before they are joined: up to ``broadcast_keys`` of them
    (16 bytes each) go to all executors and no text moves; above that they are joined by a
    shuffle.  ``text_sha256`` is null outside the surviving groups unless ``digest_all``.
    """
    keys = written(repeated_keys(docs, broadcast_keys), "exact-keys")
    side = _bounded(keys.withColumn("repeated", F.lit(True)), broadcast_keys)
    text = normalised(F.col("text"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.char_length(F.coalesce(F.col("text"), F.lit(""))).alias("code_points"),
        F.octet_length(text).alias("length"),
        F.xxhash64(F.substring(text, 1, PREFIX_CHARACTERS)).alias("prefix"),
    )
    survives = F.coalesce(F.col("repeated"), F.lit(False))
    digest = F.sha2(F.encode("text", "UTF-8"), 256)
    hashed = written(
        rows.join(side, ["length", "prefix"], "left").select(
            "doc_id", "code_points", survives.alias("survives"),
            (digest if digest_all else F.when(survives, digest)).alias("text_sha256"),
        ),
        "exact-hashed",
    )
    best = F.min(F.struct((-F.col("code_points")).alias("fewer"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    groups = (
        hashed.filter("survives").groupBy("text_sha256")
        .agg(F.count("*").alias("group_size"), best.alias("best"))
        .filter("group_size > 1")
        .select("text_sha256", "group_size", F.col("best.doc_id").alias("keep_id"),
                (-F.col("best.fewer")).alias("most"))
    )
    single = F.col("group_size").isNull()
    return hashed.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("code_points") == F.col("most"))))
        .alias("kept"),
        "text_sha256",
    )
