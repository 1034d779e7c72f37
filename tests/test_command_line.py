from datetime import datetime

import pytest

from cardwatch.__main__ import main
from cardwatch.plans import jobs, registry
from cardwatch.sinks import tables
from test_cleaning import lines
from test_models import table


def test_clean_and_profile(spark, tmp_path, capsys):
    source, target, log = (f"file://{tmp_path}/{n}" for n in ("in", "out", "log"))
    tables.write_log(lines(spark), source)
    main(["clean", "--input", source, "--output", target, "--log", log])
    assert "lines_read: 11" in [r.value for r in spark.read.text(log).collect()]
    assert jobs.read_clean(spark, target).count() == 3
    main(["profile", "--input", source, "--rejects", f"file://{tmp_path}/rejects"])
    assert "duplicate_ids" in capsys.readouterr().out


def test_train_compare_replay_and_score(spark, tmp_path):
    source, root, topic, out, checkpoint = (
        f"file://{tmp_path}/{n}" for n in ("csv", "registry", "topic", "out", "checkpoint")
    )
    table(spark, 300).write.option("header", True).csv(source)
    model = ["--registry", root, "--model-name", "fraud"]
    for run in ("one", "two"):
        main(["train", "--input", source, *model, "--run-id", run, "--key", "tx",
              "--model-type", "lr"])
    assert registry.locate(spark, root, "fraud", "champion")[0] == 1
    report = f"file://{tmp_path}/report"
    main(["ab-test", "--input", source, *model, "--key", "tx", "--report", report])
    assert spark.read.json(report).first().decision == "KEEP_CHAMPION"
    main(["replay", "--input", source, "--path", topic])
    main(["score-stream", *model, "--schema", "tx bigint, amount double, hour int",
          "--path", topic, "--output", out, "--checkpoint", checkpoint])
    assert spark.read.parquet(f"{out}/messages").filter("status = 'scored'").count() == 300


def test_features_materialize_and_lookup(spark, tmp_path):
    source, entities, requests, root, out = (f"file://{tmp_path}/{n}" for n in ("stats", "entities", "requests", "root", "out"))
    day = [datetime(2024, 1, d) for d in (1, 2, 3)]
    stats = "driver_id bigint, event_timestamp timestamp_ntz, created timestamp_ntz, conv_rate double, acc_rate double, avg_daily_trips bigint"
    spark.createDataFrame([(1, day[0], day[0], 0.1, 0.5, 3), (1, day[1], day[1], 0.2, 0.5, 4), (2, day[2], day[2], 0.3, 0.5, 5)], stats).write.parquet(source)
    spark.createDataFrame([(1, day[1]), (2, day[1])], "driver_id bigint, event_timestamp timestamp_ntz").write.parquet(entities)
    spark.createDataFrame([(1, 10, 20), (2, 10, 20), (3, 10, 20)], "driver_id bigint, val_to_add bigint, val_to_add_2 bigint").write.parquet(requests)
    main(["features", "--entities", entities, "--source", source, "--features", "driver_hourly_stats:conv_rate", "--output", out])
    assert {r.driver_id: r.conv_rate for r in spark.read.parquet(out).collect()} == {1: 0.2, 2: None}
    for end in ("2024-01-02 00:00:00", "2024-01-02 12:00:00"):
        main(["materialize", "--source", source, "--root", root, "--end", end, "--buckets", "4"])
    main(["lookup", "--requests", requests, "--root", root, "--features", "driver_hourly_stats:acc_rate,transformed_conv_rate:conv_rate_plus_val1",
          "--output", f"{out}-served"])
    served = {r.driver_id: (r.acc_rate, r.conv_rate_plus_val1) for r in spark.read.parquet(f"{out}-served").collect()}
    assert served[1] == (0.5, 10.2) and served[3][0] is None


def test_unknown_job_is_refused():
    with pytest.raises(SystemExit):
        main(["nothing"])
