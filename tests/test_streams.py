from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cardwatch.operators.monitoring import daily_cells
from cardwatch.session import sibling_session
from cardwatch.sinks import tables
from cardwatch.sinks.observed import written_counts
from cardwatch.sources.messages import as_messages, decode, read_message_stream, unique_messages
from cardwatch.streaming import days, push, quality, scoring
from cardwatch.streaming.progress import SentLog
from cardwatch.streaming.runs import append_stream, finish, read_batches

SCORED = "at timestamp_ntz, y int, p int"


def send(spark, topic, values):
    tables.write_messages(spark.createDataFrame([(v,) for v in values], "value string"), path=topic)


def collect_stream(spark, stream, tmp_path, name):
    out = f"file://{tmp_path}/{name}"
    finish(scoring.sink_messages(stream, f"file://{tmp_path}/{name}-checkpoint", path=out))
    return sorted(r.value for r in spark.read.text(out).collect())


def test_start_position(spark, tmp_path):
    topic = f"file://{tmp_path}/topic"
    send(spark, topic, ["old"])
    earliest = read_message_stream(spark, path=topic)
    checkpoint = f"file://{tmp_path}/late-checkpoint"
    latest = read_message_stream(spark, path=topic, start="latest", checkpoint=checkpoint)
    import time

    time.sleep(1.1)
    send(spark, topic, ["new"])
    assert collect_stream(spark, earliest, tmp_path, "all") == ["new", "old"]
    assert collect_stream(spark, latest, tmp_path, "late") == ["new"]
    send(spark, topic, ["while it was down"])
    again = read_message_stream(spark, path=topic, start="latest", checkpoint=checkpoint)
    assert collect_stream(spark, again, tmp_path, "late") == ["new", "while it was down"]
    with pytest.raises(ValueError):
        read_message_stream(spark, path=topic, start="middle")
    with pytest.raises(ValueError):
        read_message_stream(spark, path=topic, start="latest")


def test_a_new_checkpoint_overwrites_nothing(spark, tmp_path):
    topic, out = f"file://{tmp_path}/topic", f"file://{tmp_path}/out"
    rows = [(datetime(2024, 1, 1), 1, 1), (datetime(2024, 1, 1), 0, 0)]
    spark.createDataFrame(rows, SCORED).write.parquet(topic)
    for name in ("a", "b", "b"):
        stream = spark.readStream.schema(spark.createDataFrame([], SCORED).schema).parquet(topic)
        finish(quality.start_daily_quality(stream, "at", "y", "p", out, f"file://{tmp_path}/{name}"))
    assert quality.read_daily_quality(spark, out).first().transactions == 4


def test_ids_of_messages_with_equal_offsets(spark):
    frame = spark.createDataFrame([(None, 0, 7, "x"), (None, 1, 7, "x"), (None, None, None, "x"), ("t", 0, 7, "x")],
                                  "given string, partition int, offset long, value string")
    got = [r.i for r in frame.select(scoring.message_id(F.col("given"), F.col("partition"), F.col("offset"), F.col("value")).alias("i")).collect()]
    assert got[:2] == ["unknown_0_7", "unknown_1_7"] and got[2].startswith("unknown_2d71") and got[3] == "t"


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    topic = f"file://{tmp_path}/topic"
    send(spark, topic, ["a", "b"])
    assert collect_stream(spark, read_message_stream(spark, path=topic), tmp_path, "x") == ["a", "b"]
    send(spark, topic, ["c"])
    got = collect_stream(spark, read_message_stream(spark, path=topic), tmp_path, "x")
    assert got == ["a", "b", "c"]


def test_decoding_marks_what_is_wrong(spark):
    schema = spark.createDataFrame([], "a bigint, b string").schema
    values = ['{"a": 1, "b": "x"}', "{bad", '{"a": "x"}', "", None, "{}"]
    frame = spark.createDataFrame([(v,) for v in values], "value string")
    got = {r.value: r.problem for r in decode(frame, schema).collect()}
    assert got['{"a": 1, "b": "x"}'] is None and got["{}"] is None
    assert got["{bad"] == got['{"a": "x"}'] == "malformed"
    assert got[None] == "empty" and got[""] is not None


def test_messages_leave_out_the_label_and_keep_nulls(spark):
    frame = spark.createDataFrame([(1, None, 0)], "id int, note string, fraud int")
    assert as_messages(frame).first().value == '{"id":1,"note":null}'


def test_daily_quality_over_several_batches(spark, tmp_path):
    rows = [(datetime(2024, 1, 1) + timedelta(hours=5 * i), i % 2, int(i % 3 == 0)) for i in range(40)]
    source = f"file://{tmp_path}/scored"
    for part in (rows[30:], rows[15:30], rows[:15]):
        spark.createDataFrame(part, SCORED).coalesce(1).write.mode("append").parquet(source)
    stream = (
        spark.readStream.schema(spark.createDataFrame([], SCORED).schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(source)
    )
    out = f"file://{tmp_path}/daily"
    finish(quality.start_daily_quality(stream, "at", "y", "p", out, f"file://{tmp_path}/checkpoint"))
    got = {r.day: r.transactions for r in quality.read_daily_quality(spark, out).collect()}
    expected = {}
    for at, _, _ in rows:
        expected[at.date()] = expected.get(at.date(), 0) + 1
    assert got == expected
    assert read_batches(spark, out, quality.DAY_SCHEMA).select("batch_id").distinct().count() == 3


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_days_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([("2024-01-05 23:30:00",), ("2024-01-05 00:10:00",)], "t string")
        rows = frame.select(F.col("t").cast("timestamp_ntz").alias("t"), F.lit(1).alias("y"))
        days = daily_cells(rows, "t", "y", "y").select(F.col("day").cast("string").alias("d")).collect()
        assert {r.d for r in days} == {"2024-01-05"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_time_limit_ends_a_running_query(spark, tmp_path):
    topic, out = f"file://{tmp_path}/topic", f"file://{tmp_path}/out"
    send(spark, topic, ["a"])
    stream = read_message_stream(spark, path=topic)
    query = scoring.sink_messages(
        stream, f"file://{tmp_path}/checkpoint", path=out, every="1 second"
    )
    assert finish(query, 8) is False
    assert not query.isActive
    assert [r.value for r in spark.read.text(out).collect()] == ["a"]


def _close(spark, tmp_path, parts, lateness="1 day"):
    """Close days over files that arrive in order, restarting after each."""
    source, out = f"file://{tmp_path}/scored", f"file://{tmp_path}/days"
    schema = spark.createDataFrame([], f"{SCORED}, amount double").schema
    for part in parts:
        spark.createDataFrame(part, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        finish(days.start_closed_days(stream, "at", "y", "p", out, f"file://{tmp_path}/checkpoint", amount="amount", lateness=lateness))
    return out


def _on(day, *hours, label=0, call=0, amount=1.5):
    return [(datetime(2024, 1, day, h), label, call, amount) for h in hours]


def test_a_day_closes_once_and_later_rows_are_counted_as_late(spark, tmp_path):
    out = _close(spark, tmp_path, [
        _on(1, 0, 23, label=1) + _on(2, 5), _on(1, 7, call=1) + _on(3, 1), _on(1, 9) + _on(4, 2), _on(1, 3) + _on(2, 8, 9) + [(None, 1, 1, 1.0)],
    ])
    got = {str(r.day): r.asDict() for r in days.closed_cells(spark, out).collect()}
    # The newest time is day 4, 02:00; a day behind it, days 1 and 2 are over.
    assert set(got) == {"2024-01-01", "2024-01-02"}
    assert (got["2024-01-01"]["fn"], got["2024-01-01"]["fp"], got["2024-01-01"]["tn"], got["2024-01-01"]["missed_loss"]) == (2, 1, 0, 3.0)
    assert got["2024-01-02"]["tn"] == 1
    late = {str(r.day): r.transactions for r in days.late_days(spark, out).collect()}
    assert late == {"2024-01-01": 2, "2024-01-02": 2, "None": 1}
    assert read_batches(spark, out, days.DAY_SCHEMA).filter("kind = 'closed'").groupBy("day").count().filter("count > 1").isEmpty()
    alerts = {(r.period, r.metric) for r in days.closed_day_alerts(spark, out).collect()}
    assert ("2024-01-01", "recall") in alerts and ("2024-01-01", "fpr") in alerts and not any(p == "2024-01-03" for p, _ in alerts)


def test_nothing_closes_without_rows(spark, tmp_path):
    out = _close(spark, tmp_path, [[]])
    assert days.closed_days(spark, out).count() == 0 and days.late_days(spark, out).count() == 0


def test_parts_of_a_busy_day_are_one_day(spark, tmp_path):
    busy = [(datetime(2024, 1, 1, i % 24, i % 60, i % 59), i % 2, i % 3 == 0 and 1 or 0, 1.0) for i in range(3000)]
    out = _close(spark, tmp_path, [busy, _on(9, 1)])
    assert [r.transactions for r in days.closed_days(spark, out).collect()] == [3000]


def test_the_state_is_sent_sums(spark, tmp_path):
    """Rows are summed by day before the shuffle: a busy day is one state, and amounts that are no number count nothing."""
    source, schema = f"file://{tmp_path}/scored", spark.createDataFrame([], f"{SCORED}, amount double").schema
    busy = [(datetime(2024, 1, 1 + i % 2, i % 24, i % 60), 1, 0, float("nan") if i % 10 == 0 else 2.0) for i in range(2000)]
    spark.createDataFrame(busy, schema).write.parquet(source)
    out = f"file://{tmp_path}/days"
    query = days.start_closed_days(spark.readStream.schema(schema).parquet(source), "at", "y", "p", out, f"file://{tmp_path}/checkpoint",
                                   amount="amount", lateness="0 days")
    finish(query)
    assert [(r.fn, r.missed_loss) for r in days.closed_cells(spark, out).collect()] == [(1000, 1600.0)]
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators) < 16


def test_sums_of_many_days_are_held_in_part(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(days, "HELD_ROWS", 4)
    batches = [pa.RecordBatch.from_pydict({"day_end": [d, d, None], "tp": [1, 1, 1], "fp": [0, 0, 0], "fn": [0, 0, 0], "tn": [0, 0, 0],
                                           "missed_loss": [0.5, 0.5, 0.5]}) for d in (1, 2, 1, 3, 4, 1)]
    found = {}
    for row in (r for b in days._summed(iter(batches)) for r in b.to_pylist()):
        found[row["day_end"]] = found.get(row["day_end"], 0) + row["tp"]
    assert found == {1: 6, 2: 2, 3: 2, 4: 2, None: 6}


FEATURES = "driver int, event_timestamp timestamp_ntz, created timestamp_ntz, rate double, note string"


def _latest(spark, tmp_path, parts, ttl=None):
    source, root = f"file://{tmp_path}/features", f"file://{tmp_path}/root"
    for part in parts:
        spark.createDataFrame(part, FEATURES).write.mode("append").parquet(source)
        stream = spark.readStream.schema(spark.createDataFrame([], FEATURES).schema).parquet(source)
        finish(push.start_latest(stream, root, "driver", f"file://{tmp_path}/checkpoint", ttl=ttl))
    schema = spark.createDataFrame([], FEATURES).schema
    changes = read_batches(spark, f"{root}/changes", schema).select("driver", "note").collect()
    return push.read_latest(spark, root, "driver", schema), sorted(map(tuple, changes), key=str)


def test_newest_rows_as_state(spark, tmp_path):
    """Older rows change nothing, also after a restart; ties by the later columns, nulls lowest."""
    at = [datetime(2024, 1, d) for d in range(1, 6)]
    newest, changes = _latest(spark, tmp_path, [
        [(1, at[1], at[1], 0.5, "a"), (1, at[0], at[4], 0.9, "old"), (2, at[2], None, None, "b"), (None, at[0], at[0], 1.0, "none")],
        [(1, at[1], at[1], 0.4, "lower"), (1, at[1], at[0], 0.9, "created before"), (2, at[2], at[0], 0.1, "created")],
        [(1, at[3], None, None, None), (2, at[2], at[0], 0.1, "crease"), (2, at[0], at[0], 0.1, "x"), (2, at[2], at[0], 0.1, "d")],
    ])
    assert {(r.driver, r.note) for r in newest.collect()} == {(1, None), (2, "d"), (None, "none")}
    assert changes == sorted([(1, "a"), (2, "b"), (None, "none"), (2, "created"), (1, None), (2, "d")], key=str)


def test_newest_rows_are_kept_by_an_aggregation(spark, tmp_path):
    """No Python runs for a key; a row that is sent again is no change; large numbers beside nulls stay exact."""
    schema = "driver int, event_timestamp timestamp_ntz, created timestamp_ntz, trips bigint, note string"
    source, root = f"file://{tmp_path}/features", f"file://{tmp_path}/root"
    day, large = datetime(2024, 1, 2), 2**53 + 1
    for part in ([(1, day, day, large, "a"), (1, day, day, None, "b"), (2, None, None, None, None)], [(1, day, day, large, "a"), (2, None, None, None, None)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(spark.createDataFrame([], schema).schema).parquet(source)
        query = push.start_latest(stream, root, "driver", f"file://{tmp_path}/checkpoint")
        finish(query)
    changes = read_batches(spark, f"{root}/changes", spark.createDataFrame([], schema).schema)
    assert sorted((r.driver, r.trips, r.batch_id) for r in changes.collect()) == [(1, large, 0), (2, None, 0)]
    assert {o.operatorName for p in query.recentProgress for o in p.stateOperators} == {"stateStoreSave"}


def test_quiet_state_expires(spark, tmp_path):
    """After the time to live the key is new: its next row is a change although an older one was kept longer."""
    import time

    row = [(1, datetime(2024, 1, 2), datetime(2024, 1, 2), 0.5, "a")]
    older = [(1, datetime(2024, 1, 1), datetime(2024, 1, 1), 0.5, "older")]
    _latest(spark, tmp_path, [row], timedelta(seconds=2))
    time.sleep(3)
    newest, changes = _latest(spark, tmp_path, [older], timedelta(seconds=2))
    assert changes == [(1, "a"), (1, "older")] and [r.note for r in newest.collect()] == ["a"]


def test_repeats_are_dropped_over_a_restart(spark, tmp_path):
    source, out = f"file://{tmp_path}/topic", f"file://{tmp_path}/out"
    schema = "id string, at timestamp, n int"
    rows = [("a", datetime(2024, 1, 1, 0), 1), ("b", datetime(2024, 1, 1, 0), 2), (None, datetime(2024, 1, 1, 0), 3)]
    for part in (rows + rows[:1], rows, [("a", datetime(2024, 1, 1, 0, 30), 9), ("c", datetime(2024, 1, 1, 1), 4)]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        finish(append_stream(unique_messages(stream, "id", "at"), out, f"file://{tmp_path}/checkpoint"))
    got = sorted((r.id or "") for r in spark.read.parquet(out).collect())
    assert got == ["", "", "a", "b", "c"]


def test_sent_figures_come_from_the_batches(spark, tmp_path):
    topic, out = f"file://{tmp_path}/topic", f"file://{tmp_path}/out"
    log = SentLog(spark)
    try:
        for values in (["aa", "b"], ["ccc"]):
            send(spark, topic, values)
            query = scoring.sink_messages(read_message_stream(spark, path=topic), f"file://{tmp_path}/checkpoint", path=out)
            finish(query)
            assert log.settled(query)
        row = log.table().first()
        assert (row.messages, row.bytes, row.batches) == (3, 6, 2)
        log.add(row.query_id, row.last_batch, 100, 100)
        assert log.table().first().messages == 3
    finally:
        log.stop()


def test_observed_counts_read_nothing_back(spark, tmp_path):
    """One query runs: the write, which counts the rows it writes; no rows count 0."""
    beside = sibling_session(spark)
    assert beside.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    rows = beside.range(1000, numPartitions=6).withColumn("id", F.col("id") * 1)
    store = spark._jsparkSession.sharedState().statusStore()
    for name, some, want in (("all", rows, {"n": 1000, "total": 499500}), ("none", rows.filter("id % 2 = 3"), {"n": 0, "total": 0})):
        before = store.executionsCount()
        counts = written_counts(some, F.count(F.lit(1)).alias("n"), F.sum("id").alias("total"),
                                write=lambda r: r.write.parquet(f"file://{tmp_path}/{name}"))
        assert counts == want and store.executionsCount() == before + 1
