"""Named features: views of a source, on-demand views, feature sets, retrieval.

Features are asked for as ``view:feature``.  Retrieval makes one as-of pass, or one
lookup, per source, however many views of it are asked for; each view keeps its own
time-to-live.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from cardwatch.operators.asof import Lookup, join_at, point_in_time_joins
from cardwatch.operators.latest import lookup_latest


@dataclass(frozen=True)
class FeatureView:
    name: str
    source: str
    features: tuple[str, ...]
    ttl: timedelta | None
    tags: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class OnDemandView:
    """``compute`` gets the stored, then the request columns, in the stated order.

    It returns one aliased column per output.  To use pandas, return calls of a
    ``pandas_udf`` instead.
    """

    name: str
    view: str
    stored: tuple[str, ...]
    outputs: tuple[str, ...]
    compute: Callable[..., list[Column]]
    requested: tuple[str, ...] = ()


@dataclass(frozen=True)
class FeatureSet:
    name: str
    features: tuple[str, ...]


class Catalog:
    """Views, on-demand views and sets by name."""

    def __init__(self, views: Iterable[FeatureView], on_demand: Iterable[OnDemandView],
                 sets: Iterable[tuple[str, tuple[str, ...]]], key: str):
        self.key = key
        self.views = {v.name: v for v in views}
        self.on_demand = {v.name: v for v in on_demand}
        self.sets = {name: FeatureSet(name, self.expand(parts)) for name, parts in sets}

    def features_of(self, view: str) -> tuple[str, ...]:
        if view in self.views:
            return self.views[view].features
        if view in self.on_demand:
            return self.on_demand[view].outputs
        raise ValueError(f"no feature view named {view}")

    def expand(self, parts: Iterable[str]) -> tuple[str, ...]:
        """``view`` stands for all its features, ``view:feature`` for one."""
        references: list[str] = []
        for part in parts:
            whole = ":" not in part
            references += [f"{part}:{f}" for f in self.features_of(part)] if whole else [part]
        return tuple(references)

    def resolve(self, wanted: str | Iterable[str]) -> list[tuple[str, str]]:
        """A set's name or references, as (view, feature) pairs that exist."""
        if isinstance(wanted, str):
            if wanted not in self.sets:
                raise ValueError(f"no feature set named {wanted}")
            wanted = self.sets[wanted].features
        pairs = [tuple(reference.split(":", 1)) for reference in self.expand(wanted)]
        for view, feature in pairs:
            if feature not in self.features_of(view):
                raise ValueError(f"no feature {feature} in view {view}")
        return pairs

    def stored_columns(self, pairs: list[tuple[str, str]]) -> dict[str, dict[str, set[str]]]:
        """source -> view -> features to fetch, inputs of on-demand views included."""
        needed: dict[str, dict[str, set[str]]] = {}
        for name, feature in pairs:
            if name in self.views:
                view, columns = name, (feature,)
            else:
                view, columns = self.on_demand[name].view, self.on_demand[name].stored
            source = self.views[view].source
            needed.setdefault(source, {}).setdefault(view, set()).update(columns)
        return needed

    def outputs(
        self, pairs: list[tuple[str, str]], given: list[str], full_names: bool
    ) -> list[Column]:
        names = [f"{v}__{f}" if full_names else f for v, f in pairs]
        clash = {n for n in names if names.count(n) > 1 or n in given}
        if clash:
            raise ValueError(f"feature names used twice, ask for full_names: {sorted(clash)}")
        columns = []
        for (view, feature), name in zip(pairs, names):
            if view in self.views:
                columns.append(F.col(_held(view, feature)).alias(name))
                continue
            rule = self.on_demand[view]
            missing = [c for c in rule.requested if c not in given]
            if missing:
                raise ValueError(f"{view} needs the request columns {missing}")
            inputs = [F.col(_held(rule.view, c)) for c in rule.stored]
            inputs += [F.col(c) for c in rule.requested]
            columns.append(rule.compute(*inputs)[rule.outputs.index(feature)].alias(name))
        return columns


def _held(view: str, feature: str) -> str:
    return f"__{view}__{feature}"


def historical_features(
    catalog: Catalog,
    entities: DataFrame,
    wanted: str | Iterable[str],
    sources: dict[str, DataFrame],
    *,
    as_of=None,
    full_names: bool = False,
    **options,
) -> DataFrame:
    """Entity rows with the features as they were at each row's ``event_timestamp``.

    ``as_of`` puts every row at one instant instead, for batch scoring.
    """
    pairs = catalog.resolve(wanted)
    if as_of is not None:
        entities = entities.withColumn("event_timestamp", F.lit(as_of).cast("timestamp_ntz"))
    joined, sides = entities, []
    for source, views in catalog.stored_columns(pairs).items():
        lookups = [
            Lookup({_held(v, c): c for c in sorted(columns)}, catalog.views[v].ttl)
            for v, columns in views.items()
        ]
        if as_of is None:
            sides.append((sources[source], lookups))
        else:
            joined = join_at(joined, sources[source], lookups, catalog.key, as_of, **options)
    if sides:
        joined = point_in_time_joins(entities, sides, catalog.key, **options)
    outputs = catalog.outputs(pairs, entities.columns, full_names)
    return joined.select(*entities.columns, *outputs)


def latest_features(
    catalog: Catalog,
    requests: DataFrame,
    wanted: str | Iterable[str],
    latest: dict[str, DataFrame],
    *,
    full_names: bool = False,
) -> DataFrame:
    """Request rows with the newest stored values per key and on-demand features."""
    pairs = catalog.resolve(wanted)
    joined = requests
    for source, views in catalog.stored_columns(pairs).items():
        held = {_held(v, c): c for v, columns in views.items() for c in sorted(columns)}
        table = latest[source].select(catalog.key, *[F.col(c).alias(h) for h, c in held.items()])
        joined = lookup_latest(joined, table, catalog.key, list(held))
    outputs = catalog.outputs(pairs, requests.columns, full_names)
    return joined.select(*requests.columns, *outputs)
