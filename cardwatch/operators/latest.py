"""Latest feature values per key: build, extend, push to and look up."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest_per_key(
    source: DataFrame,
    key: str | list[str],
    *,
    time: str = "event_timestamp",
    created: str | None = "created",
) -> DataFrame:
    """The newest row of each key; ties by ``created`` if there is one, then by the other columns.

    Taken before the shuffle too, so a key with many rows sends one per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    first = [time] if created is None else [time, created]
    others = [c for c in source.columns if c not in (*keys, *first)]
    newest = F.max(F.struct(*first, *others)).alias("newest")
    return source.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(source.columns)


def fresh_rows(
    source: DataFrame, end, start=None, *, time: str = "event_timestamp", created: str | None = "created"
) -> DataFrame:
    """Rows up to ``end`` that were not there at ``start``: of a later time, or created later."""
    fresh = source.filter(F.col(time) <= F.lit(end))
    if start is None:
        return fresh
    since = F.col(time) > F.lit(start)
    return fresh.filter(since if created is None else since | (F.col(created) > F.lit(start)))


def materialize(
    source: DataFrame,
    previous: DataFrame | None,
    key: str | list[str],
    *,
    end,
    start=None,
    time: str = "event_timestamp",
    created: str | None = "created",
) -> DataFrame:
    """Latest values as of ``end``, from the previous table and rows in (start, end].

    Rows of an earlier time that were ``created`` after ``start`` came too late for the step
    before and are taken up as well; without ``created`` they are not seen.  The filters reach the scan.
    """
    fresh = fresh_rows(source, end, start, time=time, created=created)
    step = latest_per_key(fresh, key, time=time, created=created)
    if previous is None:
        return step
    return latest_per_key(previous.unionByName(step), key, time=time, created=created)


def lookup_latest(
    requests: DataFrame, latest: DataFrame, key: str | list[str], features: list[str]
) -> DataFrame:
    """Each request row with the key's latest values; nulls for an unknown key.

    No broadcast hint: either side may be large.  Spark broadcasts ``latest`` when
    its statistics are below the threshold and splits a skewed request key otherwise.
    """
    keys = [key] if isinstance(key, str) else list(key)
    joined = requests.join(latest.select(*keys, *features), keys, "left")
    return joined.select(*requests.columns, *features)
