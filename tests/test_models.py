import random

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from cardwatch.operators import abtest, champions, confusion, modeling
from cardwatch.plans import jobs, registry
from cardwatch.sinks import tables
from cardwatch.sources.messages import read_message_stream
from cardwatch.streaming import scoring
from cardwatch.streaming.runs import finish


def table(spark, rows=600):
    draw = random.Random(1)
    data = []
    for i in range(rows):
        amount, hour = draw.random() * 100, draw.randrange(24)
        data.append((i, amount, hour, "text", int(amount + hour + draw.random() * 20 > 90)))
    return spark.createDataFrame(data, "tx bigint, amount double, hour int, note string, fraud int")


def paired(spark, rows):
    return spark.createDataFrame(rows, "label int, a int, b int")


def compare_sides(spark, rows, iterations=400):
    cells = confusion.joint_cells(paired(spark, rows), "label", "a", "b")
    return abtest.decide(abtest.significance(abtest.bootstrap_f1(cells, iterations))).first()


def test_identical_predictions_keep_the_champion(spark):
    rows = [(1, 1, 1)] * 40 + [(1, 0, 0)] * 5 + [(0, 0, 0)] * 200 + [(0, 1, 1)] * 3
    got = compare_sides(spark, rows)
    assert got.f1_improvement == 0 and got.effect_size == 0
    assert got.p_value == pytest.approx(1.0)
    assert not got.is_significant and got.decision == "KEEP_CHAMPION"


def test_no_spread_has_no_effect_size(spark):
    got = compare_sides(spark, [(1, 1, 1)] * 30)
    assert got.effect_size is None and got.p_value == 1.0 and got.decision == "KEEP_CHAMPION"


def test_swapping_sides_flips_gain_and_effect(spark):
    rows = [(1, 1, 1)] * 40 + [(1, 0, 1)] * 20 + [(0, 0, 0)] * 200 + [(0, 1, 0)] * 3
    better = compare_sides(spark, rows)
    worse = compare_sides(spark, [(y, b, a) for y, a, b in rows])
    assert better.decision == "PROMOTE" and worse.decision == "KEEP_CHAMPION"
    assert better.f1_improvement == pytest.approx(-worse.f1_improvement)
    assert better.effect_size == pytest.approx(-worse.effect_size)
    assert better.gain_low > 0


def test_cell_draws_follow_row_resampling(spark):
    draw = random.Random(3)
    rows = [(int(draw.random() < 0.2), int(draw.random() < 0.3), int(draw.random() < 0.3))
            for _ in range(500)]

    def f1(sample):
        tp = sum(y and a for y, a, _ in sample)
        wrong = sum(y != a for y, a, _ in sample)
        return 2 * tp / (2 * tp + wrong)

    scores = [f1(draw.choices(rows, k=len(rows))) for _ in range(1500)]
    mean = sum(scores) / len(scores)
    std = (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5
    cells = confusion.joint_cells(paired(spark, rows), "label", "a", "b")
    got = abtest.significance(abtest.bootstrap_f1(cells, 1500)).first()
    assert got.champion_f1_mean == pytest.approx(mean, abs=4 * std / 1500**0.5 * 1.5)
    assert got.champion_f1_std == pytest.approx(std, rel=0.1)
    again = abtest.significance(abtest.bootstrap_f1(cells.repartition(5), 1500)).first()
    assert again.champion_f1_mean == pytest.approx(got.champion_f1_mean, abs=1e-12)


def test_champion_history(spark):
    versions = spark.createDataFrame(
        [("m", i + 1, auc) for i, auc in enumerate([0.90, 0.92, 0.92, 0.91, 0.95, 0.94])],
        "model_name string, version int, auc double",
    )
    rows = champions.champion_history(versions).orderBy("version").collect()
    assert [r.alias for r in rows] == ["champion", "champion", "challenger", "challenger",
                                       "champion", "challenger"]
    assert [r.serving_version for r in rows] == [1, 2, 2, 2, 5, 5]
    assert rows[1].improvement_percent == pytest.approx(100 * 0.02 / 0.90)


def test_promotion_moves_one_alias(spark):
    versions = spark.createDataFrame(
        [("m", 1, "champion"), ("m", 2, "challenger"), ("m", 3, None), ("n", 1, "champion")],
        "model_name string, version int, alias string",
    )
    decisions = spark.createDataFrame(
        [("m", "PROMOTE"), ("n", "PROMOTE")], "model_name string, decision string"
    )
    got = {(r.model_name, r.version): r.alias
           for r in champions.promote(versions, decisions).collect()}
    assert got == {("m", 1): None, ("m", 2): "champion", ("m", 3): None, ("n", 1): "champion"}
    kept = champions.promote(versions, decisions.withColumn("decision", F.lit("KEEP_CHAMPION")))
    assert sorted(map(str, kept.collect())) == sorted(map(str, versions.collect()))


def test_prediction_decoding(spark):
    schema = StructType([StructField("p", DoubleType()), StructField("v", VectorUDT()),
                         StructField("i", IntegerType())])
    rows = [(None, Vectors.dense(0.3, 0.7), 1), (1.0, Vectors.dense(0.4), 2), (0.0, None, 3)]
    got = spark.createDataFrame(rows, schema).select(
        "i", modeling.decode_prediction(F.col("p")), modeling.fraud_probability(F.col("v"))
    )
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == {1: (-1, 0.7), 2: (1, 0.4), 3: (0, None)}


def test_features_are_chosen_by_type(spark):
    df = table(spark).withColumn("flag", F.lit(True)).withColumn("at", F.current_timestamp())
    assert modeling.numeric_features(df, "fraud", ("tx",)) == ["amount", "hour", "flag"]


def test_unknown_model_type_is_refused():
    with pytest.raises(ValueError):
        modeling.classifier("svm", "fraud")


def test_publishing_keeps_the_old_version_readable(spark, tmp_path):
    root = f"file://{tmp_path}/versions"
    assert tables.read_current(spark, root) is None
    tables.publish(spark.range(3), root)
    before = tables.read_current(spark, root)
    assert tables.publish(before.unionAll(before), root) == 2
    assert before.count() == 3 and tables.read_current(spark, root).count() == 6


def test_train_compare_and_score_a_stream(spark, tmp_path):
    """Two models, an A/B test between them, then a stream scored by the champion."""
    root = f"file://{tmp_path}/registry"
    rows = table(spark)
    first = jobs.train(rows, root, "fraud", "r1", key="tx", kind="lr", folds=2).first()
    assert first.auc > 0.8
    record = spark.read.parquet(f"{root}/runs/r1/record").collect()
    assert len(record) == 3 and sum(r.is_best for r in record) == 1
    assert max(record, key=lambda r: r.auc).auc == next(r.auc for r in record if r.is_best)
    assert record[0].train_rows + record[0].test_rows == rows.count()
    jobs.train(rows, root, "fraud", "r2", key="tx", kind="lr", folds=2)
    held = {r.alias: r.version for r in registry.versions(spark, root).collect()}
    assert held == {"champion": 1, "challenger": 2}

    report = jobs.ab_test(rows, root, "fraud", key="tx", iterations=100).first()
    assert report.decision == "KEEP_CHAMPION" and report.f1_improvement == 0
    assert report.champion_auc == report.challenger_auc
    assert len(report) == 16

    topic, out, checkpoint = (f"file://{tmp_path}/{n}" for n in ("topic", "out", "checkpoint"))
    jobs.replay(rows.drop("note"), path=topic)
    extra = [("{bad",), ('{"tx": 9, "hour": 3}',), ('{"tx": 9, "amount": "x", "hour": 3}',)]
    tables.write_messages(spark.createDataFrame(extra, "value string"), path=topic)
    schema = StructType([f for f in rows.schema.fields if f.name not in ("note", "fraud")])

    def run():
        stream = read_message_stream(spark, path=topic)
        finish(jobs.score_stream(stream, root, "fraud", schema, out, checkpoint), 120)
        return scoring.read_outputs(spark, out)

    assert run().count() == 603
    again = run()
    assert again.count() == 603
    reasons = again.filter("status = 'rejected'").groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in reasons} == {"malformed": 2, "missing_feature": 1}
    progress = scoring.read_progress(spark, out).first()
    assert (progress.processed, progress.errors) == (600, 3)
    assert progress.messages_per_second > 0

    sent = again.filter("status = 'scored'").select(
        F.from_json("value", "transaction_id string, probability double, model_alias string, "
                             "input_features struct<tx bigint, amount double, hour int>").alias("m")
    ).select("m.*")
    assert sent.filter("transaction_id not like 'unknown_%'").isEmpty()
    model = registry.load_by_alias(spark, root, "fraud", "champion")
    expected = {r.tx: r.p for r in model.transform(rows).select(
        "tx", modeling.fraud_probability(F.col("probability")).alias("p")).collect()}
    for row in sent.collect():
        assert row.probability == pytest.approx(expected[row.input_features.tx])


def test_promoted_model_takes_over_at_the_next_batch():
    loads = []
    state = {"at": (1, "one")}
    current = scoring.reloading(lambda: state["at"], lambda path: loads.append(path) or path)
    assert current() == current() == "one"
    state["at"] = (2, "two")
    assert current() == "two" and loads == ["one", "two"]


def test_missing_alias_is_named(spark, tmp_path):
    with pytest.raises(LookupError, match="champion"):
        registry.locate(spark, f"file://{tmp_path}/none", "fraud", "champion")
