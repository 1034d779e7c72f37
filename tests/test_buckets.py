from datetime import datetime

import pytest

from cardwatch.operators.latest import latest_per_key
from cardwatch.sinks import buckets

SCHEMA = "driver bigint, event_timestamp timestamp_ntz, created timestamp_ntz, rate double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def at(day, driver, rate, created=None):
    return (driver, datetime(2024, 1, day), datetime(2024, 1, created or day), rate)


def table(spark, root):
    return sorted(tuple(r) for r in buckets.read_buckets(spark, buckets.directory(spark, root), frame(spark, []).schema).collect())


def test_an_update_rewrites_the_buckets_of_its_keys_only(spark, tmp_path):
    root = f"file://{tmp_path}/latest"
    first = [at(1, k, k / 10) for k in range(60)]
    fresh = [at(2, 3, 9.0), at(2, 100, 1.0), at(1, 5, 0.0, created=1)]
    assert len(buckets.merge_buckets(frame(spark, first), root, "driver", buckets=16)) > 12
    before = {e.bucket: e.folder for e in buckets.directory(spark, root)}
    touched = buckets.merge_buckets(frame(spark, fresh), root, "driver")
    after = {e.bucket: e.folder for e in buckets.directory(spark, root)}
    assert 0 < len(touched) <= 3
    assert all((after[b] == before[b]) == (b not in touched) for b in before)
    want = latest_per_key(frame(spark, first + fresh), "driver").collect()
    assert table(spark, root) == sorted(tuple(r) for r in want)


def test_a_request_leaves_other_buckets_unread(spark, tmp_path):
    """The files of buckets that are not asked for are broken; the request does not notice."""
    root = f"file://{tmp_path}/latest"
    buckets.merge_buckets(frame(spark, [at(1, k, k / 10) for k in range(60)]), root, "driver", buckets=16)
    requests = spark.createDataFrame([(3, "a"), (3, "b"), (None, "c")], "driver bigint, note string")
    asked = buckets._asked(requests, ["driver"], 16)
    for entry in buckets.directory(spark, root):
        if entry.bucket not in asked:
            folder = tmp_path / entry.folder.removeprefix(f"file://{tmp_path}/")
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"broken")
    got = buckets.lookup_buckets(requests, root, "driver", frame(spark, []).schema, ["rate"])
    assert sorted((r.note, r.rate) for r in got.collect()) == [("a", 0.3), ("b", 0.3), ("c", None)]
    assert len(got.inputFiles()) <= len(asked) == 2
    with pytest.raises(Exception):
        table(spark, root)


def test_steps_remember_where_they_ended(spark, tmp_path):
    root = f"file://{tmp_path}/latest"
    rows = [at(1, 1, 0.1), at(2, 2, 0.2), at(3, 1, 0.3), at(1, 2, 0.9, created=4), at(5, 3, 0.5)]
    buckets.materialize_buckets(frame(spark, rows[:2]), root, "driver", "2024-01-02 12:00:00", buckets=8)
    assert buckets.materialize_buckets(frame(spark, []), root, "driver", "2024-01-02 18:00:00") == []
    written = buckets.materialize_buckets(frame(spark, rows), root, "driver", "2024-01-04 12:00:00")
    assert 1 <= len(written) <= 2
    assert [(r[0], r[3]) for r in table(spark, root)] == [(1, 0.3), (2, 0.2)]


def test_nothing_written_and_nothing_asked(spark, tmp_path):
    root = f"file://{tmp_path}/latest"
    assert buckets.merge_buckets(frame(spark, []), root, "driver") == [] and table(spark, root) == []
    requests = spark.createDataFrame([(1,)], "driver bigint")
    assert buckets.lookup_buckets(requests, root, "driver", frame(spark, []).schema, ["rate"]).first().rate is None
