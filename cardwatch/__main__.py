"""Command line of the jobs: ``spark-submit`` or ``python -m cardwatch JOB ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cardwatch.operators.feature_views import historical_features, latest_features
from cardwatch.plans import jobs
from cardwatch.plans.driver_features import BATCH, CATALOG, KEY, PUSHED
from cardwatch.sinks import buckets, tables
from cardwatch.sources.features import read_feature_source
from cardwatch.sources.messages import EARLIEST, LATEST, read_message_stream
from cardwatch.sources.transactions import read_headed_csv
from cardwatch.streaming.runs import finish
from cardwatch.streaming.scoring import read_progress


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _table(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return read_headed_csv(spark, args.input, args.schema)


def clean(spark, args):
    return jobs.clean_files(spark, args.input, args.output, args.strict)


def profile(spark, args):
    return jobs.profile_files(spark, args.input, args.rejects)


def train(spark, args):
    return jobs.train(
        _table(spark, args), args.registry, args.model_name, args.run_id,
        key=args.key, label=args.label, kind=args.model_type, exclude=tuple(args.exclude),
        parallelism=args.parallelism,
    )


def ab_test(spark, args):
    return jobs.ab_test(
        _table(spark, args), args.registry, args.model_name,
        key=args.key, label=args.label, report_path=args.report,
    )


def replay(spark, args):
    table = _table(spark, args)
    jobs.replay(table, label=args.label, sink=args.sink, path=args.path,
                options=_options(args.option))
    return table.agg(F.count(F.lit(1)).alias("sent"))


def score_stream(spark, args):
    stream = read_message_stream(
        spark, args.source, path=args.path, start=args.read_mode, checkpoint=args.checkpoint,
        options=_options(args.option),
    )
    schema = StructType.fromDDL(args.schema)
    query = jobs.score_stream(
        stream, args.registry, args.model_name, schema, args.output, args.checkpoint,
        alias=args.alias, every=args.every, sink=args.sink, path=args.sink_path,
        options=_options(args.sink_option),
    )
    finish(query, args.timeout_seconds)
    return read_progress(spark, args.output)


def _wanted(text: str) -> str | list[str]:
    """The name of a feature set, or references parted by commas."""
    names = text.split(",")
    return names[0] if len(names) == 1 and ":" not in text else names


def features(spark, args):
    """Training rows: entities with their features as they were, or as of one instant."""
    sources = {BATCH: read_feature_source(spark, args.source), PUSHED: read_feature_source(spark, args.pushed or args.source)}
    rows = historical_features(CATALOG, spark.read.parquet(args.entities), _wanted(args.features), sources, as_of=args.as_of)
    tables.write_table(rows, args.output)
    return spark.read.parquet(args.output).agg(F.count(F.lit(1)).alias("rows"))


def materialize(spark, args):
    """Bring the bucketed latest values up to an instant."""
    written = buckets.materialize_buckets(
        read_feature_source(spark, args.source), args.root, KEY, args.end, buckets=args.buckets)
    return spark.range(1).select(F.lit(len(written)).alias("buckets_written"))


def lookup(spark, args):
    """Request rows with the latest values of their keys and on-demand features."""
    requests = spark.read.parquet(args.requests)
    held = buckets.asked_rows(requests, args.root, KEY)
    rows = latest_features(CATALOG, requests, _wanted(args.features), {BATCH: held, PUSHED: held})
    tables.write_table(rows, args.output)
    return spark.read.parquet(args.output).agg(F.count(F.lit(1)).alias("rows"))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cardwatch")
    jobs_of = top.add_subparsers(dest="job", required=True)

    def job(name, run, *required):
        sub = jobs_of.add_parser(name)
        sub.set_defaults(run=run)
        sub.add_argument("--log", help="folder for the result as text lines")
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    sub = job("clean", clean, "input", "output")
    sub.add_argument("--strict", action="store_true")
    job("profile", profile, "input").add_argument("--rejects")

    def models(sub):
        sub.add_argument("--label", default="fraud")
        sub.add_argument("--schema", help="columns as DDL; inferred when left out")
        return sub

    sub = models(job("train", train, "input", "registry", "model-name", "run-id", "key"))
    sub.add_argument("--model-type", choices=["rf", "lr"], default="rf")
    sub.add_argument("--exclude", nargs="*", default=[])
    sub.add_argument("--parallelism", type=int, default=2)
    models(job("ab-test", ab_test, "input", "registry", "model-name", "key")).add_argument("--report")
    sub = models(job("replay", replay, "input"))
    sub.add_argument("--sink", default="text")
    sub.add_argument("--path")
    sub.add_argument("--option", action="append", default=[], help="name=value")

    sub = job("features", features, "entities", "source", "features", "output")
    sub.add_argument("--pushed", help="pushed feature rows, where they are kept apart")
    sub.add_argument("--as-of", help="one instant for all rows")
    sub = job("materialize", materialize, "source", "root", "end")
    sub.add_argument("--buckets", type=int, default=buckets.BUCKETS, help="of the first version")
    job("lookup", lookup, "requests", "root", "features", "output")

    sub = job("score-stream", score_stream, "registry", "model-name", "schema", "output", "checkpoint")
    sub.add_argument("--source", default="text")
    sub.add_argument("--path")
    sub.add_argument("--option", action="append", default=[], help="name=value")
    sub.add_argument("--read-mode", choices=[EARLIEST, LATEST], default=EARLIEST)
    sub.add_argument("--alias", default="champion")
    sub.add_argument("--sink", help="kafka or a file format: predictions go there too")
    sub.add_argument("--sink-path")
    sub.add_argument("--sink-option", action="append", default=[], help="name=value")
    sub.add_argument("--every", help="trigger interval; without it, take what is there and stop")
    sub.add_argument("--timeout-seconds", type=int)
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"cardwatch-{args.job}").getOrCreate()
    result = args.run(spark, args)
    result.show(truncate=False, vertical=True)
    if args.log:
        shown = result.select([F.col(c).cast("string").alias(c) for c in result.columns])
        tables.write_log(jobs.funnel_log(shown), args.log)


if __name__ == "__main__":
    main()
