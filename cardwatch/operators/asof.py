"""Point-in-time join of entity rows with a timestamped feature source.

For each entity row: the source row with the same key that is newest at the
entity's time, not older than the time-to-live; ties go to the newest ``created``.

Both sides are stacked and a running maximum over time carries the newest source row
to the entity rows: one shuffle in which every row travels once.  A window by key
alone would put all rows of a key into one task, so the keys are measured
first.  When one is too heavy, time is cut into slices and the window runs by (key,
slice).  What a slice inherits from earlier ones is one source row per key, found from
per-slice maxima that are combined before their shuffle; the heaviest key contributes
one row per slice there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardwatch.operators.latest import latest_per_key, lookup_latest

_AT, _SLICE, _NEWEST, _ENTITY = "__at", "__slice", "__newest", "__entity"
ROWS_PER_KEY = 4_000_000


@dataclass(frozen=True)
class Lookup:
    """Columns to take from the source under one time-to-live.

    ``columns`` maps output names to source columns.
    """

    columns: dict[str, str]
    ttl: timedelta | None = None


def _all_given(columns: list[str]) -> Column:
    """Plain null tests, which reach the scan."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def measured(rows: DataFrame, keys: list[str], at: str, rows_per_key: int) -> tuple[str | None, bool]:
    """A width that leaves no (key, slice) over the limit, None when no key exceeds it, and whether some slice
    of the least width still does.

    It starts from a quarter of the limit for every heavy key, as if its rows were spread
    evenly, and shrinks until the densest slice fits; rows at one instant cannot be cut.  All
    counts are combined before the shuffle and one row comes back.
    """
    per_key = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.timestamp_diff("SECOND", F.min(at), F.max(at)).alias("span")
    )
    even = F.floor(1000 * F.coalesce("span", F.lit(0)) * rows_per_key / (4 * F.col("n")))
    width = per_key.filter(F.col("n") > rows_per_key).agg(F.min(even)).first()[0]
    if width is None:
        return None, False
    width = max(1, width)
    while True:
        counts = rows.groupBy(*keys, F.window(at, f"{width} milliseconds")).agg(F.count(F.lit(1)).alias("n"))
        densest = counts.agg(F.max("n")).first()[0]
        if densest <= rows_per_key or width == 1:
            return f"{width} milliseconds", densest > rows_per_key
        width = max(1, min(width // 8, width * rows_per_key // (2 * densest)))


def slice_width_for(rows: DataFrame, keys: list[str], at: str, rows_per_key: int) -> str | None:
    return measured(rows, keys, at, rows_per_key)[0]


def _sliced(rows: DataFrame, width: str) -> DataFrame:
    return rows.withColumn(_SLICE, F.window(_AT, width).getField("start"))


def _inherited(feature_rows: DataFrame, entity_rows: DataFrame, keys: list[str], held: list[str]) -> DataFrame:
    """For each slice with entity rows, the newest row of each source of the slices before it."""
    per_slice = (
        feature_rows.select(*keys, _SLICE, *held, F.lit(False).alias("asked"))
        .unionByName(
            entity_rows.select(*keys, _SLICE, F.lit(True).alias("asked")),
            allowMissingColumns=True,
        )
        .groupBy(*keys, _SLICE)
        .agg(*[F.max(c).alias(c) for c in held], F.bool_or("asked").alias("asked"))
    )
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = [F.max(c).over(earlier).alias(c) for c in held]
    return (
        per_slice.select(*keys, _SLICE, "asked", *before)
        .filter(F.col("asked") & reduce(or_, [F.col(c).isNotNull() for c in held]))
        .select(*keys, _SLICE, F.col(_SLICE).alias(_AT), *held)
    )


def _feature_rows(
    source: DataFrame, lookups: list[Lookup], keys: list[str], held: str, time: str, created: str | None, as_known: bool
) -> DataFrame:
    """Keys, the instant from which a row counts, and the row as ``held``, ordered by its time and creation."""
    needed = sorted({c for lookup in lookups for c in lookup.columns.values()})
    ranked = [F.col(time).alias("at")]
    if created is not None:
        ranked.append(F.col(created).alias("created"))
    visible = F.greatest(time, created) if as_known and created else F.col(time)
    return source.filter(_all_given([*keys, time])).select(
        *keys, visible.alias(_AT), F.struct(*ranked, F.struct(*needed).alias("row")).alias(held))


def point_in_time_joins(
    entities: DataFrame,
    sides: list[tuple[DataFrame, list[Lookup]]],
    key: str | list[str],
    *,
    entity_time: str = "event_timestamp",
    source_time: str = "event_timestamp",
    created: str | None = "created",
    as_known: bool = False,
    slice_width: str | None = None,
    rows_per_key: int = ROWS_PER_KEY,
) -> DataFrame:
    """All columns of ``entities`` plus those of the lookups in each source, null when none applies.

    All sources are stacked with the entity rows and carried forward by one window, however many they are.
    ``as_known`` hides a source row until it was created, for corrections that were
    known only after the time they describe.  Give ``slice_width``, such as
    ``"1 hour"``, to slice without measuring the keys.

    When more than ``rows_per_key`` rows of a key fall on one instant, which no slice can part, every (key, instant) is
    answered once and the entity rows are joined to the answers; Spark splits that join where a key is heavy.
    """
    keys = [key] if isinstance(key, str) else list(key)
    for source, _ in sides:
        if entities.schema[entity_time].dataType != source.schema[source_time].dataType:
            raise ValueError(f"{entity_time} and {source_time} must have one timestamp type")
    held = [f"{_NEWEST}{i}" for i in range(len(sides))]
    features = [_feature_rows(source, lookups, keys, name, source_time, created, as_known)
                for (source, lookups), name in zip(sides, held)]
    feature_rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), features)
    # Rows without a key or time match nothing; they would pile up in one group.
    answerable = _all_given([*keys, entity_time])
    asking = entities.filter(answerable)
    entity_rows = asking.select(*keys, F.col(entity_time).alias(_AT), F.struct("*").alias(_ENTITY))

    crowded = False
    if slice_width is None:
        times = feature_rows.select(*keys, _AT).unionByName(entity_rows.select(*keys, _AT))
        slice_width, crowded = measured(times, keys, _AT, rows_per_key)
    if crowded:
        feature_rows = feature_rows.groupBy(*keys, _AT).agg(*[F.max(c).alias(c) for c in held])
        instants = asking.select(*keys, F.col(entity_time).alias(_AT)).distinct()
        entity_rows = instants.withColumn(_ENTITY, F.struct(_AT))
        times = feature_rows.select(*keys, _AT).unionByName(instants)
        slice_width = slice_width_for(times, keys, _AT, rows_per_key)
    if slice_width is None:
        group, stacked = keys, feature_rows
    else:
        group = [*keys, _SLICE]
        feature_rows = _sliced(feature_rows, slice_width)
        entity_rows = _sliced(entity_rows, slice_width)
        stacked = feature_rows.unionByName(_inherited(feature_rows, entity_rows, keys, held))

    # Rows at the same instant are peers, so a feature at the entity's time counts.
    so_far = Window.partitionBy(*group).orderBy(_AT)
    carried = stacked.unionByName(entity_rows, allowMissingColumns=True).select(
        *keys, _AT, _ENTITY, *[F.max(c).over(so_far).alias(c) for c in held])
    joined = carried.filter(F.col(_ENTITY).isNotNull())
    picked = [column for (_, lookups), name in zip(sides, held)
              for column in _pick(lookups, F.col(name).getField("at"), F.col(_AT), lambda c, name=name: F.col(f"{name}.row.{c}"))]
    names = [name for _, lookups in sides for lookup in lookups for name in lookup.columns]
    nothing = [F.lit(None).cast(source.schema[c].dataType).alias(name)
               for source, lookups in sides for lookup in lookups for name, c in lookup.columns.items()]
    if crowded:
        parts = [*keys, _AT]
        answers = joined.select(*[F.col(c).alias(f"__of_{i}") for i, c in enumerate(parts)], F.struct(*picked).alias(_NEWEST))
        same = [asking[c] == answers[f"__of_{i}"] for i, c in enumerate([*keys, entity_time])]
        answered = asking.join(answers, same).select(*[asking[c] for c in entities.columns], *[F.col(f"{_NEWEST}.{n}") for n in names])
    else:
        answered = joined.select(f"{_ENTITY}.*", *picked)
    return answered.unionByName(entities.filter(~answerable).select("*", *nothing))


def point_in_time_join(
    entities: DataFrame, source: DataFrame, lookups: list[Lookup], key: str | list[str], **options
) -> DataFrame:
    """:func:`point_in_time_joins` with one source."""
    return point_in_time_joins(entities, [(source, lookups)], key, **options)


def join_at(
    entities: DataFrame,
    source: DataFrame,
    lookups: list[Lookup],
    key: str | list[str],
    instant,
    *,
    source_time: str = "event_timestamp",
    created: str | None = "created",
    as_known: bool = False,
) -> DataFrame:
    """The same for entity rows that all ask for one instant, as batch scoring does.

    One instant needs no window: only the source rows inside the longest time-to-live
    are read, one per key is left, and the entity rows are joined to it.  Spark splits
    a key with many entity rows over several tasks of that join.
    """
    keys = [key] if isinstance(key, str) else list(key)
    now = F.lit(instant).cast(source.schema[source_time].dataType)
    recent = source.filter(_all_given(keys)).filter(F.col(source_time) <= now)
    spans = [lookup.ttl for lookup in lookups]
    if None not in spans:
        recent = recent.filter(F.col(source_time) >= now - F.lit(max(spans)))
    if as_known and created is not None:
        recent = recent.filter(F.col(created) <= now)
    needed = sorted({c for lookup in lookups for c in lookup.columns.values()})
    newest = latest_per_key(
        recent.select(*keys, source_time, *([created] if created else []), *needed), keys,
        time=source_time, created=created,
    )
    picked = _pick(lookups, F.col(source_time), now, F.col)
    names = [name for lookup in lookups for name in lookup.columns]
    return lookup_latest(entities, newest.select(*keys, *picked), keys, names)


def _pick(
    lookups: list[Lookup], feature_time: Column, entity_time: Column, value: Callable[[str], Column]
) -> list[Column]:
    """The looked-up columns, each null where its row is older than its time-to-live."""
    picked = []
    for lookup in lookups:
        fresh = F.lit(True)
        if lookup.ttl is not None:
            fresh = feature_time + F.lit(lookup.ttl) >= entity_time
        picked += [F.when(fresh, value(c)).alias(name) for name, c in lookup.columns.items()]
    return picked
