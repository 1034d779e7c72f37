import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from cardwatch.functions.hashing import key_bucket
from cardwatch.functions.stats import cohens_d, student_two_sided_p
from cardwatch.operators import confusion, monitoring, quality, ranking, splits


def scored(spark, seed, rows=600, values=None):
    draw = random.Random(seed)
    data = []
    for i in range(rows):
        score = draw.choice(values) if values else draw.random()
        score = 0.5 if draw.random() < 0.3 else score
        label = int(draw.random() < 0.2 + 0.5 * score)
        data.append((i, "ab"[i % 2], score, label, int(score > 0.6)))
    return spark.createDataFrame(data, "id int, side string, score double, label int, called int")


@pytest.mark.parametrize("values", [None, [0.1, 0.5, 0.9]])
@pytest.mark.parametrize("slices", [2, 16, 1000])
def test_auc_equals_the_evaluator(spark, values, slices):
    df = scored(spark, 1, values=values)
    exact = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", numBins=0
    ).evaluate(df)
    got = ranking.area_under_roc(df, "score", "label", slices=slices).first().auc
    assert got == pytest.approx(exact, abs=1e-12)


def test_auc_by_group_and_without_a_class(spark):
    df = scored(spark, 2)
    by_side = {r.side: r.auc for r in ranking.area_under_roc(df, "score", "label", ("side",)).collect()}
    for side in "ab":
        alone = ranking.area_under_roc(df.filter(F.col("side") == side), "score", "label")
        assert by_side[side] == pytest.approx(alone.first().auc, abs=1e-12)
    assert ranking.area_under_roc(df.filter("label = 0"), "score", "label").first().auc is None
    extreme = df.withColumn("score", F.when(F.col("id") < 5, float("inf")).otherwise(F.col("score")))
    assert ranking.area_under_roc(extreme, "score", "label").first().auc is not None


def test_running_counts_do_not_depend_on_slices(spark):
    df = scored(spark, 3)
    tables = [
        sorted(map(tuple, ranking.ranked_counts(df, "score", "label", slices=s).collect()))
        for s in (2, 7, 300)
    ]
    assert tables[0] == tables[1] == tables[2]


def test_threshold_equals_trying_all(spark):
    df = scored(spark, 4, values=[i / 50 for i in range(50)])
    rows = [(r.score, r.label) for r in df.collect()]
    positives = sum(label for _, label in rows)
    best = (-1.0, -1.0)
    for limit in {s for s, _ in rows}:
        tp = sum(label for s, label in rows if s >= limit)
        fp = sum(1 - label for s, label in rows if s >= limit)
        if fp / (len(rows) - positives) > 0.05:
            continue
        precision, recall = tp / (tp + fp), tp / positives
        score = 1.25 * precision * recall / (0.25 * precision + recall) if tp else 0.0
        best = max(best, (score, limit))
    got = ranking.select_threshold(df, "score", "label", slices=8).first()
    assert (got.f_beta, got.threshold) == pytest.approx(best)


def test_threshold_metrics_equal_the_evaluators(spark):
    df = scored(spark, 5).withColumn("prediction", F.col("called").cast("double"))
    got = confusion.metric_table(df, "label", "called").first()

    def evaluate(metric, **options):
        return MulticlassClassificationEvaluator(
            labelCol="label", metricName=metric, **options
        ).evaluate(df)

    assert got.accuracy == pytest.approx(evaluate("accuracy"))
    assert got.f1_weighted == pytest.approx(evaluate("f1"))
    assert got.f1_fraud == pytest.approx(evaluate("fMeasureByLabel", metricLabel=1.0))
    assert got.f_beta == pytest.approx(evaluate("fMeasureByLabel", metricLabel=1.0, beta=0.5))


def test_empty_denominators_give_zero(spark):
    df = spark.createDataFrame([(0, 0)] * 4, "label int, called int")
    got = confusion.metric_table(df, "label", "called").first()
    assert (got.f1_fraud, got.precision, got.recall, got.f_beta) == (0, 0, 0, 0)
    assert got.f1_weighted == 1.0


def test_f_beta_value(spark):
    value = spark.range(1).select(ranking.f_beta(F.lit(0.8), F.lit(0.5), 0.5)).first()[0]
    assert value == pytest.approx(0.714286, abs=1e-6)


# Two-sided tail values from printed t tables and closed forms for 1 and 2 degrees.
@pytest.mark.parametrize("t, df, p", [(1.0, 1.0, 0.5), (2.0, 2.0, 0.18350342), (2.228139, 10.0, 0.05),
                                      (1.959964, 1e7, 0.05), (0.0, 5.0, 1.0), (60.0, 1998.0, 0.0)])
def test_student_tail(spark, t, df, p):
    value = spark.range(1).select(student_two_sided_p(F.lit(t), F.lit(df))).first()[0]
    assert value == pytest.approx(p, abs=2e-6)


def test_effect_size_without_spread_is_null(spark):
    args = [F.lit(x).cast("double") for x in (0.5, 0.0, 0.6, 0.0)]
    assert spark.range(1).select(cohens_d(*args)).first()[0] is None


def test_split_ignores_partitioning(spark):
    rows = spark.range(2000).withColumnRenamed("id", "k")
    one, many = (splits.with_split(rows.repartition(n), "k") for n in (1, 13))
    assert one.exceptAll(many).isEmpty()
    share = one.filter("split = 'test'").count() / 2000
    assert 0.17 < share < 0.23
    assert spark.range(1).select(key_bucket(F.lit(7))).first()[0] == 0x8F14E45F


def test_alerts_and_monthly_loss(spark):
    rows = [("2024-01-05 10:00:00", 1, 0, 600_000.0)] + [("2024-02-05 10:00:00", 0, 0, 1.0)] * 60
    df = spark.createDataFrame(rows, "at string, y int, p int, amount double").withColumn(
        "at", F.col("at").cast("timestamp_ntz")
    )
    alerts = monitoring.quality_alerts(df, "at", "y", "p", "amount").collect()
    assert {(a.period, a.metric) for a in alerts} == {
        ("2024-01-05", "recall"), ("2024-01-05", "fraud_per_100"), ("2024-01", "missed_loss")
    }
    loss = {r.month: r.within_limit for r in
            monitoring.monthly_missed_loss(df, "at", "y", "p", "amount").collect()}
    assert loss == {"2024-01": False, "2024-02": True}


def test_approximate_summary_has_the_same_columns(spark):
    df = spark.createDataFrame(
        [(1, 2, 3.0, 0), (2, 2, 4.0, 1)],
        "customer_id bigint, terminal_id bigint, tx_amount double, tx_fraud int",
    )
    assert quality.summary(df, True).first() == quality.summary(df).first()


def test_more_slices_than_the_least(spark):
    rows = spark.range(3000).selectExpr("(id * 7919 % 3000) / 3000 as s", "cast(id % 3 = 0 as int) as y")
    few = ranking.area_under_roc(rows, "s", "y").first().auc
    counts = ranking.ranked_counts(rows, "s", "y", rows_per_slice=5)
    assert ranking.area_under_roc(rows, "s", "y", slices=600).first().auc == pytest.approx(few, abs=1e-12)
    assert counts.count() == 3000 and counts.agg({"true_positives": "max"}).first()[0] == 1000


def test_sketches_of_days_merge_to_a_range_within_the_stated_error(spark):
    """The rank of a percentile over 40 merged days is as exact as that of one sketch."""
    from cardwatch.operators import sketches

    days, per_day = 40, 5000
    rows = spark.range(days * per_day).selectExpr(
        f"timestamp_ntz'2024-01-01' + make_dt_interval(cast(id div {per_day} as int)) as t",
        "cast(pow(pmod(xxhash64(id), 1000000) / 1000000.0, 3) * 5000 as bigint) as ms", "id % 7000 as who")
    rows = rows.unionByName(spark.createDataFrame([(None, None, None)], rows.schema))
    daily = sketches.daily_delays(rows, "t", "ms", ("who",))
    assert daily.count() == days
    whole = sketches.read_delays(sketches.merge_days(sketches.merge_days(daily, "day", ids=("who",)), ids=("who",)), ("who",)).first()
    assert whole.decisions == days * per_day and abs(whole.whos - 7000) <= 4 * sketches.distinct_error() * 7000
    for value, rank in ((whole.median_ms, 0.5), (whole.p95_ms, 0.95)):
        below, upto = rows.filter(F.col("ms") < value).count(), rows.filter(F.col("ms") <= value).count()
        error = 2 * sketches.rank_error()
        assert below / whole.decisions - error <= rank <= upto / whole.decisions + error


def test_the_input_of_a_ranking_is_read_once(spark, tmp_path):
    """Counts, cuts and totals come from the counted scores: the input can be gone by then."""
    import shutil

    path = f"{tmp_path}/scores"
    spark.createDataFrame([(i % 37 / 37, i % 3 % 2) for i in range(500)], "s double, y int").write.parquet(f"file://{path}")
    counts = ranking.ranked_counts(spark.read.parquet(f"file://{path}"), "s", "y")
    shutil.rmtree(path)
    assert counts.count() == 37 and counts.agg(F.max("true_positives")).first()[0] == 167
