import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cardwatch.operators import asof
from cardwatch.plans import jobs
from cardwatch.sinks import tables
from cardwatch.operators.asof import Lookup, join_at, point_in_time_join
from cardwatch.operators.latest import latest_per_key, lookup_latest, materialize

DAY = timedelta(days=1)
SOURCE = "k int, event_timestamp timestamp_ntz, created timestamp_ntz, v int"
ENTITY = "k int, event_timestamp timestamp_ntz, tag int"


def at(hour, minute=0, second=0, day=5):
    return datetime(2024, 1, day, hour, minute, second)


def values(spark, source, entities, ttl=DAY, **options):
    joined = point_in_time_join(
        spark.createDataFrame(entities, ENTITY),
        spark.createDataFrame(source, SOURCE),
        [Lookup({"v": "v"}, ttl)],
        "k",
        **options,
    )
    return {r.tag: r.v for r in joined.collect()}


@pytest.mark.parametrize("width", [None, "1 hour", "7 minutes"])
def test_boundaries(spark, width):
    source = [(1, at(10), at(10), 7)]
    entities = [
        (1, at(10), 1), (1, at(10, day=6), 2), (1, at(10, 0, 1, day=6), 3), (1, at(9, 59, 59), 4),
        (2, at(11), 5), (None, at(11), 6), (1, None, 7),
    ]
    got = values(spark, source, entities, slice_width=width)
    assert got == {1: 7, 2: 7, 3: None, 4: None, 5: None, 6: None, 7: None}


@pytest.mark.parametrize("width", [None, "1 hour"])
def test_tie_goes_to_the_newest_created(spark, width):
    source = [(1, at(10), at(10, 9), 2), (1, at(10), at(10, 5), 1), (1, at(9), at(12), 3)]
    assert values(spark, source, [(1, at(10), 1)], slice_width=width) == {1: 2}


@pytest.mark.parametrize("width", [None, "1 hour"])
def test_as_known_hides_later_corrections(spark, width):
    source = [(1, at(10), at(10), 1), (1, at(10), at(14), 2), (1, at(9), at(15), 3)]
    entities = [(1, at(13), 1), (1, at(14), 2), (1, at(16), 3)]
    assert values(spark, source, entities, slice_width=width) == {1: 2, 2: 2, 3: 2}
    known = values(spark, source, entities, slice_width=width, as_known=True)
    assert known == {1: 1, 2: 2, 3: 2}


def brute_force(source, entities, ttl):
    found = {}
    for key, time, tag in entities:
        rows = [s for s in source if s[0] == key and s[1] <= time]
        best = max(rows, key=lambda s: (s[1], s[2], s[3]), default=None)
        fresh = best is not None and (ttl is None or best[1] + ttl >= time)
        found[tag] = best[3] if fresh else None
    return found


@pytest.mark.parametrize("seed", range(3))
def test_random_rows_with_a_hot_key(spark, seed):
    draw = random.Random(seed)

    def instant():
        return datetime(2024, 1, 1) + timedelta(minutes=draw.randrange(14400))

    def key():
        return 0 if draw.random() < 0.5 else draw.randrange(1, 6)

    source = [(key(), instant(), instant(), i) for i in range(300)]
    entities = [(key(), instant(), i) for i in range(300)]
    for ttl in (None, timedelta(hours=6)):
        expected = brute_force(source, entities, ttl)
        assert values(spark, source, entities, ttl) == expected
        assert values(spark, source, entities, ttl, slice_width="3 hours") == expected
        assert values(spark, source, entities, ttl, rows_per_key=20) == expected


def test_more_time_never_gives_more_nulls(spark):
    source = [(1, at(h), at(h), h) for h in range(0, 20, 7)]
    entities = [(1, at(h), h) for h in range(24)]
    nulls = [
        sum(v is None for v in values(spark, source, entities, timedelta(hours=h)).values())
        for h in (1, 3, 6, 24)
    ]
    assert nulls == sorted(nulls, reverse=True) and nulls[0] > nulls[-1]


def test_entity_rows_are_kept_exactly(spark):
    entities = spark.createDataFrame([(1, at(10), 1)] * 3 + [(9, at(10), 2)], ENTITY)
    source = spark.createDataFrame([(1, at(9), at(9), 1)] * 2, SOURCE)
    joined = point_in_time_join(entities, source, [Lookup({"x": "v"}, DAY)], "k")
    assert joined.columns == [*entities.columns, "x"] and joined.count() == 4


def test_different_timestamp_types_are_refused(spark):
    entities = spark.createDataFrame([(1, at(10), 1)], ENTITY)
    source = spark.createDataFrame([(1, at(9), at(9), 1)], SOURCE)
    shifted = entities.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    with pytest.raises(ValueError):
        point_in_time_join(shifted, source, [Lookup({"v": "v"}, DAY)], "k")


def test_now_without_ttl_equals_the_latest_values(spark):
    draw = random.Random(5)
    source = spark.createDataFrame(
        [(draw.randrange(9), at(draw.randrange(24)), at(draw.randrange(24)), i) for i in range(99)],
        SOURCE,
    )
    entities = spark.range(12).selectExpr(
        "cast(id as int) k", "timestamp_ntz'2024-02-01' event_timestamp", "cast(id as int) tag"
    )
    now = point_in_time_join(entities, source, [Lookup({"v": "v"})], "k")
    looked_up = lookup_latest(entities, latest_per_key(source, "k"), "k", ["v"])
    columns = ["k", "tag", "v"]
    assert sorted(map(str, now.select(columns).collect())) == sorted(
        map(str, looked_up.select(columns).collect())
    )


def test_materializing_in_steps_equals_one_step(spark):
    source = spark.createDataFrame(
        [(i % 4, at(i % 24), at((i * 7) % 24), i) for i in range(60)], SOURCE
    )
    whole = materialize(source, None, "k", end=at(20))
    step = materialize(source, None, "k", end=at(8))
    step = materialize(source, step, "k", start=at(8), end=at(20))
    assert sorted(map(str, whole.collect())) == sorted(map(str, step.collect()))


@pytest.mark.parametrize("as_known", [False, True])
def test_one_instant_equals_the_general_join(spark, as_known):
    draw = random.Random(8)
    rows = [(draw.randrange(9), at(draw.randrange(24)), at(draw.randrange(24)), i) for i in range(200)]
    source = spark.createDataFrame(rows, SOURCE)
    now = at(12, day=5)
    entities = spark.createDataFrame([(i % 12, now, i) for i in range(60)] + [(None, now, 99)], ENTITY)
    lookups = [Lookup({"a": "v"}, timedelta(hours=2)), Lookup({"b": "v"}, timedelta(hours=6))]
    for asked in (lookups, [*lookups, Lookup({"c": "v"})]):
        general = point_in_time_join(entities, source, asked, "k", as_known=as_known)
        direct = join_at(entities, source, asked, "k", now, as_known=as_known)
        assert direct.columns == general.columns
        assert sorted(map(str, direct.collect())) == sorted(map(str, general.collect()))


def test_one_instant_reads_its_time_range_only(spark, tmp_path):
    path = f"file://{tmp_path}/source"
    spark.createDataFrame([(1, at(h), at(h), h) for h in range(24)], SOURCE).write.parquet(path)
    entities = spark.createDataFrame([(1, at(12), 1)], ENTITY)
    joined = join_at(entities, spark.read.parquet(path), [Lookup({"v": "v"}, DAY)], "k", at(12))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_timestamp" in plan and "LessThanOrEqual(event_timestamp" in plan


def test_no_slice_of_any_heavy_key_exceeds_the_limit(spark):
    """Heavy keys of different span and a burst: the width fits the densest of them."""
    start, limit = datetime(2020, 1, 1), 100
    rows = [(1, start + timedelta(days=3 * i)) for i in range(1000)]
    rows += [(2, start + timedelta(seconds=60 * i)) for i in range(999)]
    rows += [(3, start + timedelta(days=i)) for i in range(500)]
    rows += [(3, start + timedelta(days=7, milliseconds=20 * i)) for i in range(600)]
    frame = spark.createDataFrame(rows, "k int, t timestamp_ntz")
    width = asof.slice_width_for(frame, ["k"], "t", limit)
    counts = frame.groupBy("k", F.window("t", width)).count()
    assert counts.agg(F.max("count")).first()[0] <= limit
    assert asof.slice_width_for(frame, ["k"], "t", 5000) is None
    same = spark.createDataFrame([(1, start)] * 300, "k int, t timestamp_ntz")
    assert asof.slice_width_for(same, ["k"], "t", limit) == "1 milliseconds"


def test_null_tests_reach_the_scan(spark, tmp_path):
    path = f"file://{tmp_path}/source"
    spark.createDataFrame([(1, datetime(2020, 1, 1), datetime(2020, 1, 1), 2.0)], "k int, event_timestamp timestamp_ntz, created timestamp_ntz, v double").write.parquet(path)
    source = spark.read.parquet(path)
    entities = source.select("k", "event_timestamp")
    joined = asof.point_in_time_join(entities, source, [asof.Lookup({"v": "v"})], "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: []") == 0


def test_materialization_remembers_its_end_and_takes_late_rows(spark, tmp_path):
    def at(day):
        return datetime(2024, 1, day)

    schema = "k int, event_timestamp timestamp_ntz, created timestamp_ntz, v int"
    rows = [(1, at(1), at(1), 1), (1, at(3), at(9), 2), (2, at(2), at(2), 3), (2, at(12), at(12), 4)]
    root = f"file://{tmp_path}/latest"
    jobs.materialize_to(spark.createDataFrame([rows[0], rows[2]], schema), root, "k", at(5))
    jobs.materialize_to(spark.createDataFrame(rows, schema), root, "k", at(10))
    current = tables.read_current(spark, root)
    assert {r.k: (r.v, r.covered_until) for r in current.collect()} == {1: (2, at(10)), 2: (3, at(10))}
    bare = spark.createDataFrame(rows, schema).drop("created")
    assert {r.k: r.v for r in latest_per_key(bare, "k", created=None).collect()} == {1: 2, 2: 4}
    asked = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    got = join_at(asked, bare, [Lookup({"v": "v"})], "k", at(10), created=None)
    assert {r.k: r.v for r in got.collect()} == {1: 2, 2: 3, 3: None}


def _other(spark, rows):
    return spark.createDataFrame(rows, "k int, event_timestamp timestamp_ntz, created timestamp_ntz, w string")


@pytest.mark.parametrize("limit", [asof.ROWS_PER_KEY, 25])
def test_several_sources_in_one_window(spark, limit):
    """As many results as joining them one after the other, from a plan with one window."""
    rng = random.Random(limit)
    moment = lambda: at(rng.randrange(24), rng.randrange(60))
    sources = [spark.createDataFrame([(rng.randrange(3), moment(), moment(), i) for i in range(120)], SOURCE)]
    sources += [_other(spark, [(rng.randrange(3), moment(), moment(), f"{c}{i}") for i in range(60)]) for c in "xy"]
    entities = spark.createDataFrame([(rng.choice([0, 0, 1, 2, 9, None]), moment(), i) for i in range(150)], ENTITY)
    lookups = [[Lookup({"v": "v"}, DAY)], [Lookup({"w": "w"}, timedelta(hours=2))], [Lookup({"near": "w"}, timedelta(hours=1)), Lookup({"far": "w"})]]
    joined = asof.point_in_time_joins(entities, list(zip(sources, lookups)), "k", rows_per_key=limit)
    one_by_one = entities
    for source, wanted in zip(sources, lookups):
        one_by_one = point_in_time_join(one_by_one, source, wanted, "k")
    assert sorted(map(str, joined.collect())) == sorted(map(str, one_by_one.collect())) and joined.count() == 150
    if limit == asof.ROWS_PER_KEY:
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert sum(line.strip(" :+-").startswith("Window ") for line in plan.splitlines()) == 1


def test_very_many_rows_at_one_instant(spark):
    """No slice can part them: instants are answered once, and the plan has no window over the rows."""
    source = [(1, at(10), at(10), 7)] * 300 + [(1, at(9), at(9), 5), (2, at(8), at(8), 3)]
    entities = [(1, at(10), i) for i in range(500)] + [(1, at(9, 30), 900), (2, at(9), 901), (1, at(8), 902), (None, at(8), 903)]
    got = values(spark, source, entities, rows_per_key=50)
    assert got == {**{i: 7 for i in range(500)}, 900: 5, 901: 3, 902: None, 903: None}
    assert got == values(spark, source, entities)


def test_a_million_equal_instants(spark):
    entities = spark.range(1_000_000).select(F.lit(1).alias("k"), F.lit(at(10)).cast("timestamp_ntz").alias("event_timestamp"),
                                             F.col("id").cast("int").alias("tag"))
    source = spark.createDataFrame([(1, at(9), at(9), 4), (1, at(11), at(11), 5)], SOURCE)
    joined = point_in_time_join(entities, source, [Lookup({"v": "v"}, DAY)], "k", rows_per_key=10_000)
    assert joined.agg(F.count("*"), F.count_distinct("tag"), F.min("v"), F.max("v")).first()[:] == (1_000_000, 1_000_000, 4, 4)
