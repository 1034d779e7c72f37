"""One query per operator, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cardwatch.functions import on_demand, parsing
from cardwatch.functions.hashing import fold_number, key_bucket
from cardwatch.operators import (
    abtest, champions, cleaning, confusion, feature_views, latest, modeling, monitoring, quality,
    ranking, sketches, splits,
)
from cardwatch.operators.rows import side_by_side
from cardwatch.operators.asof import Lookup, point_in_time_join, point_in_time_joins
from cardwatch.plans import jobs, registry
from cardwatch.plans.driver_features import BATCH, CATALOG, KEY, PUSHED
from cardwatch.session import scratch_path
from cardwatch.sinks import buckets, tables
from cardwatch.sources import features as feature_sources, messages, transactions
from cardwatch.streaming import days, push, quality as stream_quality, scoring
from cardwatch.streaming.progress import SentLog
from cardwatch.streaming.runs import append_stream, finish
from workload import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

IDS = ("transaction_id", "customer_id")
AS_OF = "2024-01-20 12:00:00"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _raw(spark, sf):
    return transactions.parse_csv_lines(views.raw_lines(spark, sf))


def _typed(spark, sf):
    return cleaning.typed_projection(cleaning.drop_malformed(_raw(spark, sf)))


def _profiled(spark, sf):
    return transactions.split_lines(views.raw_lines(spark, sf))


def _raw_file(spark, sf):
    path = scratch_path(spark, "raw-text")
    tables.write_log(views.raw_lines(spark, sf), path)
    return path


# --- scans and sources


@query
def scan_raw_csv(spark, sf):
    raw = transactions.read_raw_csv(spark, _raw_file(spark, sf))
    return raw.drop("_corrupt_record")


@query
def scan_text_lines(spark, sf):
    return transactions.read_text_lines(spark, _raw_file(spark, sf))


@query
def scan_header_csv(spark, sf):
    path = scratch_path(spark, "headed-csv")
    views.training(views.tx(spark, sf)).write.option("header", True).csv(path)
    table = transactions.read_headed_csv(spark, path)
    # The inferred integer width follows the data; the time is inferred with a zone.
    wide = [F.col(c).cast("bigint").alias(c) for c, t in table.dtypes if t in ("int", "bigint")]
    return table.select(*wide, F.col("tx_datetime").cast("timestamp_ntz"), "tx_amount")


@query
def scan_feature_source(spark, sf):
    path = scratch_path(spark, "feature-source")
    tables.write_table(views.driver_stats(spark, sf), path)
    return feature_sources.read_feature_source(spark, path)


@query
def entity_rows_literal(spark, sf):
    rows = [
        {"driver_id": 1, "at": "2024-01-05 10:59:42", "satisfaction": 1},
        {"driver_id": 2, "at": "2024-01-12 08:12:10", "satisfaction": 5},
        {"driver_id": 7, "at": "2024-01-20 16:40:26", "satisfaction": 3},
        {"driver_id": -1, "at": "2024-01-20 16:40:26", "satisfaction": 4},
    ]
    literal = feature_sources.entity_rows(
        spark, rows, "driver_id bigint, at string, satisfaction int"
    )
    asked = literal.select(
        "driver_id", F.col("at").cast("timestamp_ntz").alias("event_timestamp"), "satisfaction"
    )
    return feature_views.historical_features(
        CATALOG, asked, ["driver_hourly_stats"], {BATCH: views.driver_stats(spark, sf)}
    )


@query
def stream_json_source(spark, sf):
    topic, out = scratch_path(spark, "topic"), scratch_path(spark, "decoded")
    tables.write_messages(views.messages(views.tx(spark, sf), with_faults=False), path=topic)
    stream = messages.read_message_stream(spark, path=topic)
    decoded = messages.decode(stream, views.MESSAGE_SCHEMA).filter(F.col("problem").isNull())
    started = (
        decoded.select("message.*")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    finish(started)
    return spark.read.schema(views.MESSAGE_SCHEMA).parquet(out)


@query
def replay_as_json(spark, sf):
    topic = scratch_path(spark, "topic")
    jobs.replay(views.training(views.tx(spark, sf)), path=topic)
    sent = spark.read.text(topic)
    schema = (
        "transaction_id bigint, tx_datetime timestamp_ntz, customer_id bigint, terminal_id bigint,"
        " tx_amount double, tx_time_seconds bigint, tx_time_days bigint, fraud int"
    )
    return sent.select(F.from_json("value", schema).alias("m")).select("m.*")


# --- sinks


@query
def sink_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "clean")
    tables.write_table(cleaning.clean(_raw(spark, sf)), path)
    return spark.read.parquet(path)


@query
def sink_rejects_csv(spark, sf):
    path = scratch_path(spark, "rejects")
    tables.write_rejects(cleaning.quarantine(_profiled(spark, sf)), path)
    schema = (
        "transaction_id bigint, tx_datetime string, customer_id bigint, terminal_id bigint,"
        " tx_amount double, tx_time_seconds bigint, tx_time_days bigint, tx_fraud int,"
        " tx_fraud_scenario int, reasons string"
    )
    return transactions.read_headed_csv(spark, path, schema)


def _comparison(spark, sf):
    return abtest.compare_metrics(
        views.scored(spark, sf),
        "tx_fraud",
        {"champion": "pred_a", "challenger": "pred_b"},
        {"champion": "score_a", "challenger": "score_b"},
    )


def _decision(spark, sf):
    return abtest.decide(abtest.significance(views.f1_samples(spark, sf)))


@query
def sink_report_json(spark, sf):
    path = scratch_path(spark, "report")
    names = {"champion": "rule@champion", "challenger": "rule@challenger"}
    tables.write_report(
        abtest.report(_comparison(spark, sf), _decision(spark, sf), names), path
    )
    written = spark.read.schema(jobs.REPORT_SCHEMA).json(path)
    metrics = [f"{s}_{m}" for s in abtest.SIDES for m in ("auc", "f1", "accuracy")]
    return written.select(
        *[F.round(c, 9).alias(c) for c in (*metrics, "f1_improvement")],
        "is_significant",
        "decision",
        "test_set_size",
        "champion_model",
        "challenger_model",
    )


@query
def sink_log_text(spark, sf):
    path = scratch_path(spark, "log")
    tables.write_log(jobs.funnel_log(cleaning.funnel(_raw(spark, sf))), path)
    return spark.read.text(path).withColumnRenamed("value", "message")


@query
def model_save_load(spark, sf):
    """Rows of the test part, and on how many the saved model agrees with itself."""
    table = views.training(views.tx(spark, sf))
    path = scratch_path(spark, "model")
    model = fit(table, "lr")
    modeling.save_model(model, path)
    before = modeling.score(model, views.test_part(table))
    again = modeling.load_model(path).transform(
        before.drop("features_raw", "features", "rawPrediction", "probability").withColumnRenamed(
            "prediction", "before"
        )
    )
    return again.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("before") == F.col("prediction")).alias("agreeing"),
    )


@query
def model_load_by_alias(spark, sf):
    """The same model registered twice: equal AUC leaves the first one champion."""
    table = views.training(views.tx(spark, sf))
    path, root = scratch_path(spark, "model"), scratch_path(spark, "registry")
    modeling.save_model(fit(table, "lr"), path)
    metrics = _evaluated(spark, modeling.load_model(path), table)
    # Registered from one written row: computed twice, the metrics might differ in the
    # last digit and the versions would not be equal.
    tables.write_table(metrics, f"{root}/metrics")
    for run in ("first", "second"):
        registry.register(spark, root, "fraud", run, path, spark.read.parquet(f"{root}/metrics"))
    model = registry.load_by_alias(spark, root, "fraud", champions.CHAMPION)
    champion = registry.locate(spark, root, "fraud", champions.CHAMPION)[0]
    challenger = registry.locate(spark, root, "fraud", champions.CHALLENGER)[0]
    return model.transform(views.test_part(table)).agg(
        F.lit(champion).alias("champion_version"),
        F.lit(challenger).alias("challenger_version"),
        F.count_if(F.col("prediction").isin(0.0, 1.0)).alias("rows_scored"),
    )


@query
def log_served_features(spark, sf):
    path = scratch_path(spark, "served")
    served = feature_views.latest_features(
        CATALOG,
        views.requests(spark, sf),
        "driver_activity_v1",
        {BATCH: views.latest_stats(spark, sf)},
    )
    tables.log_served(served, path)
    logged = spark.read.parquet(path)
    return _rounded(
        logged.withColumn("is_stamped", F.col("served_at").isNotNull()).drop("served_at")
    )


def _rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(
        [F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns]
    )


# --- projections and filters


@query
def typed_projection(spark, sf):
    return _typed(spark, sf)


@query
def filter_malformed(spark, sf):
    return cleaning.malformed_counts(_raw(spark, sf))


@query
def filter_not_null(spark, sf):
    return cleaning.keep_not_null(_typed(spark, sf))


@query
def filter_business_rules(spark, sf):
    return cleaning.keep_business_ranges(_typed(spark, sf))


@query
def filter_fraud_scenario(spark, sf):
    return cleaning.keep_explained_fraud(_typed(spark, sf))


@query
def quarantine_rows(spark, sf):
    bad = cleaning.quarantine(_profiled(spark, sf))
    return bad.withColumn("reasons", F.array_join("reasons", ";"))


@query
def select_features(spark, sf):
    """The feature columns chosen by type, each with its nulls in the training part."""
    table = views.training(views.tx(spark, sf))
    chosen = modeling.numeric_features(table, "fraud", IDS)
    return quality.null_counts(views.train_part(table), chosen)


@query
def feature_refs_projection(spark, sf):
    wanted = [
        "driver_hourly_stats:conv_rate",
        "driver_hourly_stats:acc_rate",
        "driver_hourly_stats:avg_daily_trips",
        "transformed_conv_rate:conv_rate_plus_val1",
        "transformed_conv_rate:conv_rate_plus_val2",
    ]
    return _rounded(_historical(spark, sf, wanted))


def _historical(spark, sf, wanted, **options):
    stats = views.driver_stats(spark, sf)
    return feature_views.historical_features(
        CATALOG, views.entities(spark, sf), wanted, {BATCH: stats, PUSHED: stats}, **options
    )


def _feature_set(name: str) -> Query:
    return lambda spark, sf: _rounded(_historical(spark, sf, name))


QUERIES["feature_set_v1"] = _feature_set("driver_activity_v1")
QUERIES["feature_set_v2"] = _feature_set("driver_activity_v2")
QUERIES["feature_set_v3"] = _feature_set("driver_activity_v3")
QUERIES["feature_set_v4"] = _feature_set("driver_activity_v4")
QUERIES["feature_set_realtime"] = _feature_set("driver_performance_realtime")


@query
def prediction_envelope(spark, sf):
    """Every tenth message has no id and gets one from its offset."""
    rows = views.scored(spark, sf)
    given = F.when(F.col("transaction_id") % 10 != 0, F.col("transaction_id"))
    body = F.struct(
        given.alias("transaction_id"),
        F.col("tx_datetime").cast("string").alias("timestamp"),
        "tx_amount",
        "terminal_id",
        "tx_time_seconds",
        "tx_time_days",
    )
    framed = rows.select(
        body.alias("message"),
        F.to_json(body).alias("value"),
        F.lit(None).cast("int").alias("partition"),
        F.col("transaction_id").alias("offset"),
        F.col("pred_a").cast("double").alias("prediction"),
        (F.col("score_a") / 1000).alias("fraud_probability"),
    )
    sent = framed.select(
        F.to_json(scoring.envelope(views.MESSAGE_SCHEMA, "champion")).alias("value")
    )
    schema = (
        "transaction_id string, original_timestamp string, processed_at string, prediction int,"
        " probability double, model_alias string, input_features struct<tx_amount double,"
        " terminal_id bigint, tx_time_seconds bigint, tx_time_days bigint>"
    )
    got = sent.select(F.from_json("value", schema).alias("m")).select("m.*")
    return _rounded(got.select("*", "input_features.*").drop("input_features", "processed_at"))


@query
def prediction_decode(spark, sf):
    """Some predictions are missing; probabilities have two elements, one, or none."""
    rows = views.scored(spark, sf)
    third = F.col("transaction_id") % 3
    share = F.col("score_a") / 1000
    parts = F.when(third == 0, F.array(1 - share, share)).when(third == 1, F.array(share))
    vector = array_to_vector(F.coalesce(parts, F.array(F.lit(0.0))))
    prediction = F.when(F.col("transaction_id") % 5 != 0, F.col("pred_a").cast("double"))
    decoded = rows.select(
        "transaction_id",
        modeling.decode_prediction(prediction).alias("prediction"),
        F.when(parts.isNotNull(), vector).alias("vector"),
    )
    return _rounded(
        decoded.select(
            "transaction_id",
            "prediction",
            modeling.fraud_probability(F.col("vector")).alias("probability"),
        )
    )


# --- de-duplication and limits


@query
def dedup_transactions(spark, sf):
    return cleaning.clean(_raw(spark, sf))


@query
def preview_rows(spark, sf):
    return splits.preview(views.tx(spark, sf), ["tx_datetime", "transaction_id"], 5)


# --- feature joins


@query
def pit_join(spark, sf):
    stats = CATALOG.views["driver_hourly_stats"]
    lookup = Lookup({c: c for c in stats.features}, stats.ttl)
    return _rounded(
        point_in_time_join(views.entities(spark, sf), views.driver_stats(spark, sf), [lookup], KEY)
    )


@query
def pit_join_multi_view(spark, sf):
    wanted = [
        "driver_reliability:conv_rate",
        "driver_reliability:acc_rate",
        "driver_activity:avg_daily_trips",
        "driver_risk_adjusted_performance:risk_adjusted_score",
        "driver_risk_adjusted_performance:engagement_level",
    ]
    return _rounded(_historical(spark, sf, wanted))


@query
def pit_join_two_sources(spark, sf):
    """Daily rates and the driver's last error of the six hours before, in one pass."""
    stats = CATALOG.views["driver_hourly_stats"]
    errors = views.events(spark, sf).filter(F.col("event_type") == "error").select(
        F.col("user_id").alias(KEY), F.col("ts").alias("event_timestamp"), F.col("ts").alias("created"), "value")
    sides = [
        (views.driver_stats(spark, sf), [Lookup({c: c for c in stats.features}, stats.ttl)]),
        (errors, [Lookup({"error_value": "value"}, timedelta(hours=6))]),
    ]
    return _rounded(point_in_time_joins(views.entities(spark, sf), sides, KEY))


@query
def pit_join_as_of_now(spark, sf):
    return _rounded(_historical(spark, sf, ["driver_hourly_stats"], as_of=AS_OF))


@query
def latest_features_lookup(spark, sf):
    return _rounded(
        feature_views.latest_features(
            CATALOG,
            views.requests(spark, sf),
            ["driver_hourly_stats"],
            {BATCH: views.latest_stats(spark, sf)},
        )
    )


@query
def latest_with_request(spark, sf):
    wanted = [
        "driver_hourly_stats:acc_rate",
        "transformed_conv_rate:conv_rate_plus_val1",
        "transformed_conv_rate:conv_rate_plus_val2",
    ]
    return _rounded(
        feature_views.latest_features(
            CATALOG, views.requests(spark, sf), wanted, {BATCH: views.latest_stats(spark, sf)}
        )
    )


# --- aggregations


@query
def dq_null_counts(spark, sf):
    return quality.null_counts(_profiled(spark, sf))


@query
def dq_rule_violations(spark, sf):
    return quality.rule_violations(_profiled(spark, sf))


@query
def dq_invalid_dates(spark, sf):
    return quality.invalid_dates(_profiled(spark, sf))


@query
def dq_fraud_without_scenario(spark, sf):
    return quality.fraud_without_scenario(_profiled(spark, sf))


@query
def dq_duplicate_ids(spark, sf):
    return quality.duplicate_ids(_profiled(spark, sf))


@query
def dq_summary(spark, sf):
    return quality.summary(_profiled(spark, sf))


@query
def dq_profile(spark, sf):
    return quality.profile(_profiled(spark, sf))


@query
def clean_funnel(spark, sf):
    return cleaning.funnel(_raw(spark, sf))


@query
def clean_job(spark, sf):
    """The whole cleaning job on files; its funnel as it can be read from what it wrote."""
    target = scratch_path(spark, "by-outcome")
    jobs.clean_files(spark, _raw_file(spark, sf), target)
    return jobs.written_funnel(spark, target)


@query
def clean_observed(spark, sf):
    """The cleaning job; its funnel as the write counted it."""
    return jobs.clean_files(spark, _raw_file(spark, sf), scratch_path(spark, "by-outcome"))


@query
def split_sizes(spark, sf):
    return splits.split_sizes(splits.with_split(views.tx(spark, sf), "transaction_id"))


# --- functions


def _known_features(spark, sf):
    """Entity rows with features; a missing one stays null."""
    return _historical(spark, sf, ["driver_hourly_stats"])


@query
def odf_conv_rate_plus(spark, sf):
    rows = _known_features(spark, sf)
    plus = on_demand.conv_rate_plus(*[F.col(c) for c in ("conv_rate", "val_to_add", "val_to_add_2")])
    return _rounded(rows.select("event_id", *plus))


@query
def odf_performance(spark, sf):
    rows = _known_features(spark, sf)
    inputs = [F.col(c) for c in ("conv_rate", "acc_rate", "avg_daily_trips")]
    return _rounded(rows.select("event_id", *on_demand.performance(*inputs)))


@query
def odf_risk_adjusted(spark, sf):
    rows = _known_features(spark, sf)
    inputs = [F.col(c) for c in ("conv_rate", "acc_rate", "avg_daily_trips")]
    return _rounded(rows.select("event_id", *on_demand.risk_adjusted(*inputs)))


def _fields(spark, sf):
    """The raw fields without the header line."""
    return cleaning.drop_malformed(_raw(spark, sf))


@query
def coerce_numeric(spark, sf):
    return _fields(spark, sf).select(
        F.col("transaction_id").alias("raw_id"),
        "tx_amount",
        parsing.coerce_numeric(F.col("transaction_id")).alias("id_number"),
        parsing.coerce_numeric(F.col("customer_id")).alias("customer_number"),
    )


@query
def parse_timestamps(spark, sf):
    return _fields(spark, sf).select(
        F.col("transaction_id").alias("raw_id"),
        "tx_datetime",
        parsing.parse_timestamp(F.col("tx_datetime")).alias("parsed"),
    )


@query
def json_roundtrip(spark, sf):
    sent = views.messages(views.tx(spark, sf))
    got = messages.decode(sent, views.MESSAGE_SCHEMA)
    return got.select("problem", "message.*")


# --- models


@query
def split_train_test(spark, sf):
    rows = views.tx(spark, sf).select(
        "transaction_id", key_bucket(F.col("transaction_id")).alias("bucket")
    )
    return splits.with_split(rows, "transaction_id")


@query
def assign_folds(spark, sf):
    rows = views.tx(spark, sf).select("transaction_id")
    return splits.with_fold(rows, "transaction_id")


@query
def assemble_features(spark, sf):
    table = views.training(views.tx(spark, sf))
    chosen = modeling.numeric_features(table, "fraud", IDS)
    vectors = modeling.assemble(chosen).transform(table)
    return _elements(vectors, "features_raw", chosen)


def _elements(df: DataFrame, vector: str, names: list[str]) -> DataFrame:
    parts = df.select("transaction_id", vector_to_array(vector).alias("parts"))
    return parts.select(
        "transaction_id",
        *[F.round(F.get("parts", F.lit(i)), 6).alias(n) for i, n in enumerate(names)],
    )


@query
def scale_features(spark, sf):
    table = views.training(views.tx(spark, sf))
    chosen = modeling.numeric_features(table, "fraud", IDS)
    assembler = modeling.assemble(chosen)
    fitted = modeling.standardize().fit(assembler.transform(views.train_part(table)))
    return _elements(fitted.transform(assembler.transform(table)), "features", chosen)


def fit(table: DataFrame, kind: str) -> PipelineModel:
    chosen = modeling.numeric_features(table, "fraud", IDS)
    return modeling.model_stages(chosen, "fraud", kind).fit(views.train_part(table))


def _calls(spark, model: PipelineModel, table: DataFrame) -> DataFrame:
    """The model's calls on the held-out part, written once and read by several metrics."""
    path = scratch_path(spark, "calls")
    tables.write_table(modeling.calls(modeling.score(model, views.test_part(table)), "fraud"), path)
    return spark.read.parquet(path)


def _evaluated(spark, model: PipelineModel, table: DataFrame) -> DataFrame:
    return modeling.evaluate(_calls(spark, model, table))


def _trained(kind: str) -> Query:
    """How a fit does on the held-out part: its size, and whether the figures are those of a model that learnt."""

    def run(spark, sf):
        table = views.training(views.tx(spark, sf))
        model = fit(table, kind)
        made = _calls(spark, model, table)
        share = F.avg("label")
        sizes = made.agg(F.count(F.lit(1)).alias("rows"), F.sum("label").alias("fraud"), F.greatest(share, 1 - share).alias("usual"))
        found = side_by_side(sizes, modeling.evaluate(made)).select(
            "rows", "fraud", (F.col("auc") > 0.6).alias("ranks_well"),
            (F.col("accuracy") >= F.col("usual") - 0.01).alias("calls_well"))
        if kind == "rf":
            return found
        seen = modeling.calls(modeling.score(model, views.train_part(table)), "fraud")
        rate = seen.agg((F.abs(F.avg("score") - F.avg("label")) < 0.001).alias("keeps_base_rate"))
        return side_by_side(found, rate)

    return run


QUERIES["train_forest"] = _trained("rf")
QUERIES["train_logistic"] = _trained("lr")


def _tuned(spark, sf):
    table = views.training(views.tx(spark, sf))
    chosen = modeling.numeric_features(table, "fraud", IDS)
    folded = splits.with_fold(views.train_part(table), "transaction_id")
    return modeling.cross_validate(folded, chosen, "fraud", parallelism=4)


@query
def cross_validate(spark, sf):
    """Every grid point; the one refitted is one of the best by its mean AUC."""
    results = modeling.grid_results(_tuned(spark, sf), spark)
    best = Window.partitionBy(F.lit(0))
    return results.select(
        F.col("params.numTrees").alias("num_trees"),
        F.col("params.maxDepth").alias("max_depth"),
        F.col("auc").between(0.6, 1.0).alias("ranks_well"),
        (F.max(F.when(F.col("is_best"), F.col("auc"))).over(best) == F.max("auc").over(best)).alias("best_is_refitted"),
    )


@query
def run_record(spark, sf):
    """What the training job keeps of its grid: every point, one of them chosen."""
    root = scratch_path(spark, "registry")
    jobs.train(views.training(views.tx(spark, sf)), root, "fraud", "r1", key=IDS[0], exclude=IDS[1:], parallelism=4)
    record = spark.read.parquet(f"{root}/runs/r1/record")
    return record.select(
        F.col("params.numTrees").alias("num_trees"),
        F.col("params.maxDepth").alias("max_depth"),
        F.col("auc").between(0.5, 1.0).alias("is_plausible"),
        F.sum(F.col("is_best").cast("bigint")).over(Window.partitionBy("run_id")).alias("best_points"),
        (F.col("train_rows") + F.col("test_rows")).alias("rows"),
    )


@query
def best_params(spark, sf):
    """The chosen point: in the grid, and the one that the refitted model has."""
    tuned = _tuned(spark, sf)
    best = spark.createDataFrame([modeling.best_params(tuned.bestModel)], "numTrees double, maxDepth double")
    chosen = modeling.grid_results(tuned, spark).orderBy(F.desc("auc")).limit(1)
    return best.join(chosen).select(
        (F.col("numTrees").isin(10.0, 20.0) & F.col("maxDepth").isin(5.0, 10.0)).alias("is_in_grid"),
        ((F.col("numTrees") == F.col("params.numTrees")) & (F.col("maxDepth") == F.col("params.maxDepth"))
         | ~F.col("is_best")).alias("is_arg_max"))


@query
def batch_score(spark, sf):
    """Each held-out transaction: sound, and scored alike by the model and by what was saved of it."""
    table, path = views.training(views.tx(spark, sf)), scratch_path(spark, "model")
    model = fit(table, "rf")
    modeling.save_model(model, path)

    def scored(by: PipelineModel, suffix: str) -> DataFrame:
        return modeling.score(by, views.test_part(table)).select(
            "transaction_id", modeling.decode_prediction(F.col("prediction")).alias(f"call{suffix}"),
            modeling.fraud_probability(F.col("probability")).alias(f"p{suffix}"))

    both = scored(model, "").join(scored(modeling.load_model(path), "_loaded"), "transaction_id")
    return both.select(
        "transaction_id", (F.col("call").isin(0, 1) & F.col("p").between(0, 1)).alias("is_sound"),
        ((F.col("call") == (F.col("p") > 0.5).cast("int")) | (F.col("p") == 0.5)).alias("call_follows_probability"),
        ((F.col("call") == F.col("call_loaded")) & (F.col("p") == F.col("p_loaded"))).alias("is_same_when_loaded"))


@query
def metric_auc(spark, sf):
    rows = views.scored(spark, sf)
    sides = F.array(
        F.struct(F.lit("a").alias("model"), F.col("score_a").alias("score")),
        F.struct(F.lit("b").alias("model"), F.col("score_b").alias("score")),
    )
    long = rows.select("tx_fraud", F.inline(sides))
    return _rounded(ranking.area_under_roc(long, "score", "tx_fraud", ("model",)), 12)


def _metrics(spark, sf):
    return confusion.metric_table(views.scored(spark, sf), "tx_fraud", "pred_b")


def _metric(*names: str) -> Query:
    return lambda spark, sf: _rounded(_metrics(spark, sf).select(*names))


QUERIES["metric_accuracy"] = _metric("accuracy")
QUERIES["metric_f1_weighted"] = _metric("f1_weighted")
QUERIES["metric_f1_fraud"] = _metric("f1_fraud")
QUERIES["metric_rates"] = _metric("tp", "fp", "fn", "tn", "fpr", "recall", "precision")
QUERIES["metric_fbeta"] = _metric("f_beta")


@query
def ab_metrics(spark, sf):
    return _rounded(_comparison(spark, sf))


@query
def ab_joint_cells(spark, sf):
    return confusion.joint_cells(views.scored(spark, sf), "tx_fraud", "pred_a", "pred_b")


@query
def bootstrap_f1(spark, sf):
    return _rounded(abtest.bootstrap_f1(ab_joint_cells(spark, sf)))


@query
def ab_significance(spark, sf):
    return _rounded(abtest.significance(views.f1_samples(spark, sf)), 6)


@query
def ab_decision(spark, sf):
    return _decision(spark, sf).select("is_significant", "decision")


def _aliased(spark, sf):
    history = champions.champion_history(views.model_versions(spark, sf))
    return champions.latest_aliases(history).select(
        "model_name",
        "version",
        F.concat_ws("-", "model_name", "version").alias("run_id"),
        "auc",
        "alias",
        F.lit(None).cast("string").alias("tag"),
    )


@query
def champion_lookup(spark, sf):
    """Click models carry the mark in the older ``tag`` column instead."""
    by_tag = F.col("model_name") == "click"
    versions = _aliased(spark, sf).select(
        "model_name",
        "version",
        "run_id",
        F.when(by_tag, None).otherwise(F.col("alias")).alias("alias"),
        F.when(by_tag, F.col("alias")).alias("tag"),
    )
    metrics = views.model_versions(spark, sf).select("run_id", "auc")
    return _rounded(champions.current_champion(versions, metrics))


@query
def champion_history(spark, sf):
    return _rounded(champions.champion_history(views.model_versions(spark, sf)))


@query
def promote_alias(spark, sf):
    """Two of the five models are decided PROMOTE."""
    versions = _aliased(spark, sf)
    decisions = versions.select("model_name").distinct().select(
        "model_name",
        F.when(F.col("model_name").isin("error", "purchase"), abtest.PROMOTE)
        .otherwise(abtest.KEEP)
        .alias("decision"),
    )
    moved = champions.promote(versions, decisions)
    return _rounded(moved.select("model_name", "version", "auc", "alias"))


# --- streams


def message_stream(spark, sf):
    return views.messages(views.transactions(views.events_stream(spark, sf)))


def _scored_stream(spark, sf, runs: int = 1) -> str:
    """Train, then score the message stream; ``runs`` restarts on one checkpoint."""
    model = fit(views.training(views.tx(spark, sf)), "rf")
    out, checkpoint = scratch_path(spark, "predictions"), scratch_path(spark, "checkpoint")
    for _ in range(runs):
        finish(
            scoring.start_scoring(
                message_stream(spark, sf), lambda: model, views.MESSAGE_SCHEMA, out, checkpoint
            )
        )
    return out


def _predictions(spark, out: str) -> DataFrame:
    schema = "transaction_id string, prediction int, probability double, model_alias string"
    rows = scoring.read_outputs(spark, out).filter(F.col("status") == scoring.SCORED)
    return rows.select(F.from_json("value", schema).alias("m")).select("m.*")


@query
def stream_score(spark, sf):
    rows = _predictions(spark, _scored_stream(spark, sf))
    sound = F.col("prediction").isin(0, 1) & F.col("probability").between(0, 1)
    return rows.select("transaction_id", "model_alias", sound.alias("is_sound"))


@query
def stream_against_batch(spark, sf):
    """The stream's predictions beside batch scoring by the same model, number by number."""
    rows = views.training(views.tx(spark, sf))
    model, out = fit(rows, "rf"), scratch_path(spark, "predictions")
    finish(scoring.start_scoring(
        message_stream(spark, sf), lambda: model, views.MESSAGE_SCHEMA, out, scratch_path(spark, "checkpoint")))
    batch = modeling.score(model, rows).select(
        F.col("transaction_id").cast("string").alias("transaction_id"), modeling.decode_prediction(F.col("prediction")).alias("call"),
        modeling.fraud_probability(F.col("probability")).alias("p"))
    both = _predictions(spark, out).join(batch, "transaction_id")
    differs = (F.col("prediction") != F.col("call")) | (F.abs(F.col("probability") - F.col("p")) > 1e-12)
    return both.agg(F.count(F.lit(1)).alias("compared"), F.count_if(differs).alias("differences"))


@query
def stream_scored_topic(spark, sf):
    """The predictions as they reach the topic."""
    model, topic = fit(views.training(views.tx(spark, sf)), "rf"), scratch_path(spark, "topic")
    finish(scoring.start_scoring(
        message_stream(spark, sf), lambda: model, views.MESSAGE_SCHEMA, scratch_path(spark, "predictions"),
        scratch_path(spark, "checkpoint"), sink="text", path=topic))
    schema = "transaction_id string, prediction int, probability double, model_alias string"
    rows = spark.read.text(topic).select(F.from_json("value", schema).alias("m")).select("m.*")
    sound = F.col("prediction").isin(0, 1) & F.col("probability").between(0, 1)
    return rows.select("transaction_id", "model_alias", sound.alias("is_sound"))


@query
def stream_new_checkpoint(spark, sf):
    """Two queries with checkpoints of their own add their batches to one history."""
    root, rows = scratch_path(spark, "pushed"), views.events_stream(spark, sf).select("user_id", "event_id", "ts")
    fresh = rows.select(F.col("user_id").alias(KEY), F.col("ts").alias("event_timestamp"), F.col("ts").alias("created"), "event_id")
    for _ in range(2):
        finish(push.start_push(fresh, root, KEY, scratch_path(spark, "checkpoint")))
    history = push.read_history(spark, root, fresh.schema)
    return history.groupBy(KEY).agg(F.count(F.lit(1)).alias("history_rows"))


@query
def stream_exactly_once(spark, sf):
    rows = scoring.read_outputs(spark, _scored_stream(spark, sf, runs=2))
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("messages"))


@query
def stream_dead_letter(spark, sf):
    rows = scoring.read_outputs(spark, _scored_stream(spark, sf))
    return rows.filter(F.col("status") == scoring.REJECTED).select("value", "reason")


@query
def stream_progress(spark, sf):
    rows = scoring.read_progress(spark, _scored_stream(spark, sf))
    return rows.select("processed", "errors", (F.col("messages_per_second") > 0).alias("has_rate"))


@query
def stream_observed_progress(spark, sf):
    """What the job that sends messages reports of itself, over two runs on one checkpoint."""
    log, topic, checkpoint = SentLog(spark), scratch_path(spark, "topic"), scratch_path(spark, "checkpoint")
    try:
        for _ in range(2):
            sending = scoring.sink_messages(message_stream(spark, sf), checkpoint, path=topic)
            finish(sending)
            log.settled(sending)
        return log.table().select("messages", (F.col("bytes") > F.col("messages")).alias("has_size"))
    finally:
        log.stop()


@query
def stream_sink_json(spark, sf):
    topic = scratch_path(spark, "topic")
    finish(
        scoring.sink_messages(
            message_stream(spark, sf), scratch_path(spark, "checkpoint"), path=topic
        )
    )
    decoded = messages.decode(spark.read.text(topic), views.MESSAGE_SCHEMA)
    return decoded.select("problem", "message.*")


@query
def push_features(spark, sf):
    """The statistics, then each event as a pushed row; the latest values of both."""
    root = scratch_path(spark, "pushed")
    fresh = views.events_stream(spark, sf).select(
        F.col("user_id").alias("driver_id"),
        F.col("ts").alias("event_timestamp"),
        F.col("ts").alias("created"),
        (F.col("value") / 1000).alias("conv_rate"),
        F.lit(1.0).alias("acc_rate"),
        F.col("event_id").alias("avg_daily_trips"),
    )
    push.push_batch(views.driver_stats(spark, sf), -1, root, KEY)
    finish(push.start_push(fresh, root, KEY, scratch_path(spark, "checkpoint")))
    schema = views.driver_stats(spark, sf).schema
    newest = push.read_latest(spark, root, KEY, schema)
    history = push.read_history(spark, root, schema)
    pushed = history.groupBy(KEY).agg(F.count(F.lit(1)).alias("history_rows"))
    return _rounded(newest.join(pushed, KEY))


def _pushed(rows: DataFrame) -> DataFrame:
    """Events as feature rows."""
    return rows.select(
        F.col("user_id").alias("driver_id"), F.col("ts").alias("event_timestamp"), F.col("ts").alias("created"),
        (F.col("value") / 1000).alias("conv_rate"), F.lit(1.0).alias("acc_rate"), F.col("event_id").alias("avg_daily_trips"))


@query
def stream_latest_state(spark, sf):
    """The newest row per driver as state, over arrivals out of order and a restart after each."""
    root, checkpoint = scratch_path(spark, "pushed"), scratch_path(spark, "checkpoint")
    push.push_batch(views.driver_stats(spark, sf), -1, root, KEY)
    views.in_stages(spark, sf, scratch_path(spark, "arrivals"),
                    lambda arrived: finish(push.start_latest(_pushed(arrived), root, KEY, checkpoint)))
    return _rounded(push.read_latest(spark, root, KEY, views.driver_stats(spark, sf).schema))


@query
def stream_unique_predictions(spark, sf):
    """Predictions as a receiver sees them that drops repeats: the sender sends everything twice."""
    out, topic, seen = _scored_stream(spark, sf), scratch_path(spark, "topic"), scratch_path(spark, "seen")
    checkpoint = scratch_path(spark, "checkpoint")
    sent = scoring.read_outputs(spark, out).filter(F.col("status") == scoring.SCORED)
    schema = "transaction_id string, prediction int, probability double, processed_at timestamp"
    for attempt in range(2):
        scoring.send_messages(sent, "text", f"{topic}/attempt={attempt}")
        received = messages.read_message_stream(spark, path=topic).select(F.from_json("value", schema).alias("m")).select("m.*")
        once = messages.unique_messages(received, "transaction_id", "processed_at")
        finish(append_stream(once, seen, checkpoint))
    return spark.read.parquet(seen).groupBy("transaction_id").agg(F.count(F.lit(1)).alias("received"))


@query
def materialize_incremental(spark, sf):
    """Two steps: up to one instant, then from there to a later one."""
    stats, middle = views.driver_stats(spark, sf), "2024-01-12 00:00:00"
    root = scratch_path(spark, "latest")
    instants = [F.lit(t).cast("timestamp_ntz") for t in (middle, AS_OF)]
    tables.publish(latest.materialize(stats, None, KEY, end=instants[0]), root)
    before = tables.read_current(spark, root)
    after = latest.materialize(stats, before, KEY, start=instants[0], end=instants[1])
    tables.publish(after, root)
    return _rounded(tables.read_current(spark, root))


@query
def materialize_remembered(spark, sf):
    """Two calls that name their end only; rows created late are taken up by the second."""
    stats, root = views.driver_stats(spark, sf), scratch_path(spark, "latest")
    middle, last = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-12 00:00:00", AS_OF))
    on_time = F.col("created") <= middle
    jobs.materialize_to(stats.filter(on_time), root, KEY, middle)
    jobs.materialize_to(stats, root, KEY, last)
    return _rounded(tables.read_current(spark, root).drop("covered_until"))


@query
def materialize_buckets(spark, sf):
    """Two steps that rewrite only the buckets with fresh keys; rows created late are taken up by the second."""
    stats, root = views.driver_stats(spark, sf), scratch_path(spark, "latest")
    middle = "2024-01-12 00:00:00"
    buckets.materialize_buckets(stats.filter(F.col("created") <= F.lit(middle).cast("timestamp_ntz")), root, KEY, middle)
    buckets.materialize_buckets(stats, root, KEY, AS_OF)
    return _rounded(buckets.read_buckets(spark, buckets.directory(spark, root), stats.schema))


@query
def lookup_buckets(spark, sf):
    """Requests answered from the buckets of their keys."""
    newest, root = views.latest_stats(spark, sf), scratch_path(spark, "latest")
    buckets.merge_buckets(newest, root, KEY)
    features = list(CATALOG.views["driver_hourly_stats"].features)
    return _rounded(buckets.lookup_buckets(views.requests(spark, sf), root, KEY, newest.schema, features))


@query
def stream_daily_quality(spark, sf):
    out = scratch_path(spark, "daily")
    stream = views.with_scores(views.transactions(views.events_stream(spark, sf)))
    finish(stream_quality.start_daily_quality(
        stream, "tx_datetime", "tx_fraud", "pred_b", out, scratch_path(spark, "checkpoint")))
    return _rounded(stream_quality.read_daily_quality(spark, out))


def _closing(spark, sf) -> str:
    """Close days over arrivals out of order, restarting on one checkpoint after each."""
    out, checkpoint = scratch_path(spark, "days"), scratch_path(spark, "checkpoint")

    def run(arrived: DataFrame) -> None:
        finish(days.start_closed_days(
            views.with_scores(views.transactions(arrived)), "tx_datetime", "tx_fraud", "pred_b", out, checkpoint,
            amount="tx_amount", lateness="2 days"))

    views.in_stages(spark, sf, scratch_path(spark, "arrivals"), run)
    return out


@query
def stream_closed_days(spark, sf):
    """Final figures of the closed days, and the rows that came after their day had closed."""
    out = _closing(spark, sf)
    closed = days.closed_days(spark, out).select(F.lit(days.CLOSED).alias("kind"), "*")
    late = days.late_days(spark, out).select(F.lit(days.LATE).alias("kind"), "*")
    return _rounded(closed.unionByName(late, allowMissingColumns=True), 6)


@query
def closed_day_alerts(spark, sf):
    return _rounded(days.closed_day_alerts(spark, _closing(spark, sf)), 6)


# --- monitoring


@query
def select_threshold(spark, sf):
    return _rounded(ranking.select_threshold(views.scored(spark, sf), "score_b", "tx_fraud"))


@query
def monthly_missed_loss(spark, sf):
    lost = monitoring.monthly_missed_loss(
        views.scored(spark, sf), "tx_datetime", "tx_fraud", "pred_b", "tx_amount"
    )
    return _rounded(lost, 2)


@query
def fraud_rate(spark, sf):
    return _rounded(monitoring.fraud_rate(views.tx(spark, sf), "tx_fraud"))


@query
def daily_quality(spark, sf):
    return _rounded(
        monitoring.daily_quality(views.scored(spark, sf), "tx_datetime", "tx_fraud", "pred_b")
    )


@query
def quality_alerts(spark, sf):
    alerts = monitoring.quality_alerts(
        views.scored(spark, sf), "tx_datetime", "tx_fraud", "pred_b", "tx_amount"
    )
    return _rounded(alerts, 6)


@query
def throughput_profile(spark, sf):
    return _rounded(monitoring.throughput_profile(views.tx(spark, sf), "tx_datetime"))


@query
def latency_share(spark, sf):
    delays = views.tx(spark, sf).select((F.col("transaction_id") * 37 % 260).alias("delay_ms"))
    return _rounded(monitoring.latency_share(delays, "delay_ms"))


@query
def latency_sketch(spark, sf):
    """Months merged from daily sketches, beside the exact ranks of what they report."""
    delays = views.tx(spark, sf).withColumn("delay_ms", F.col("transaction_id") * 37 % 260)
    kept, ids = scratch_path(spark, "sketches"), ("customer_id",)
    tables.write_table(sketches.daily_delays(delays, "tx_datetime", "delay_ms", ids), kept)
    month = F.date_format("day", "yyyy-MM").alias("month")
    months = sketches.read_delays(sketches.merge_days(spark.read.parquet(kept), month, ids=ids), ids)
    named = delays.select(F.date_format("tx_datetime", "yyyy-MM").alias("month"), "delay_ms", "customer_id")

    def below(column: str, strictly: bool) -> Column:
        reached = F.col("delay_ms") < F.col(column) if strictly else F.col("delay_ms") <= F.col(column)
        return F.count_if(reached) / F.count(F.lit(1))

    exact = named.join(months, "month").groupBy("month").agg(
        *[F.first(c).alias(c) for c in ("decisions", "share_in_time", "max_ms", "customer_ids")],
        F.count_distinct("customer_id").alias("customers"),
        *[((below(c, True) - 2 * sketches.rank_error() <= rank) & (rank <= below(c, False) + 2 * sketches.rank_error())).alias(f"{c}_in_bound")
          for c, rank in (("median_ms", F.lit(0.5)), ("p95_ms", F.lit(0.95)))])
    off = F.abs(F.col("customer_ids") - F.col("customers")) <= 4 * sketches.distinct_error() * F.col("customers") + 1
    return _rounded(exact.select("month", "decisions", "share_in_time", "max_ms", "median_ms_in_bound", "p95_ms_in_bound",
                                 off.alias("customers_in_bound")))
