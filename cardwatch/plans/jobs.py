"""The jobs: clean, profile, train, compare, replay and score a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cardwatch.operators import abtest, cleaning, latest, modeling, quality, splits
from cardwatch.operators.champions import CHALLENGER, CHAMPION
from cardwatch.operators.confusion import joint_cells
from cardwatch.operators.rows import side_by_side
from cardwatch.plans import registry
from cardwatch.schema import TRANSACTION_COLUMNS
from cardwatch.session import scratch_path, sibling_session
from cardwatch.sinks import tables
from cardwatch.sinks.observed import written_counts
from cardwatch.sources.messages import as_messages
from cardwatch.sources.transactions import parse_csv_lines, read_text_lines
from cardwatch.streaming.scoring import reloading, start_scoring

# Names and order of the report fields.
REPORT_SCHEMA = (
    "champion_auc double, champion_f1 double, champion_accuracy double, challenger_auc double, "
    "challenger_f1 double, challenger_accuracy double, f1_improvement double, p_value double, "
    "effect_size double, is_significant boolean, decision string, test_set_size bigint, "
    "run_id string, champion_model string, challenger_model string, timestamp string"
)


def funnel_log(funnel: DataFrame) -> DataFrame:
    """The funnel as text lines, ``stage: rows``."""
    counts = funnel.unpivot([], funnel.columns, "stage", "rows")
    return counts.select(F.concat_ws(": ", "stage", F.col("rows").cast("string")).alias("value"))


def clean_files(spark: SparkSession, source: str, target: str, strict: bool = False) -> DataFrame:
    """Sort the lines of text files into ``target/outcome=kept`` and one folder per reason.

    One scan and one shuffle.  Valid lines meet by id and the first one stays; a
    rejected line meets its own copies only.  Both are combined before the shuffle, so
    neither a hot id nor a hot line fills a task, and nothing is lost: ``copies`` says
    how many lines a row stands for.  Returns the funnel as the write itself counted it; see ``written_counts``.
    """
    lines = parse_csv_lines(sibling_session(spark).read.text(source), keep=True)
    rows = cleaning.classify(lines, strict, keep=("line",))
    kept = F.col("outcome") == cleaning.KEPT
    ranked = cleaning.earliest_first(list(TRANSACTION_COLUMNS), "transaction_id", ("tx_datetime",))
    # The id leads the sort of the aggregate: long values that rarely tie.
    grouped = rows.groupBy(
        F.when(kept, F.col("transaction_id")).alias("transaction_id"),
        F.when(~kept, F.col("line")).alias("line"),
        "outcome",
    ).agg(
        F.min(F.when(kept, F.struct(*ranked))).alias("first"), F.count(F.lit(1)).alias("copies")
    )
    first = [
        F.col(c if c == "transaction_id" else f"first.{c}").alias(c) for c in TRANSACTION_COLUMNS
    ]
    table = grouped.select(*first, "line", "copies", "outcome")
    counts = written_counts(table, *_funnel_counts(), write=lambda rows: tables.write_table(rows, target, partition_by=("outcome",)))
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()])


def read_clean(spark: SparkSession, target: str) -> DataFrame:
    """The clean table; the folder filter is a partition filter."""
    rows = spark.read.parquet(target).filter(F.col("outcome") == cleaning.KEPT)
    return rows.select(*TRANSACTION_COLUMNS)


def _funnel_counts() -> list[Column]:
    """The funnel as aggregates over rows of ``outcome`` and ``copies``."""
    kept = F.col("outcome") == cleaning.KEPT
    lines = F.coalesce(F.sum("copies"), F.lit(0))

    def dropped(reason: str) -> Column:
        lines_here = F.when(F.col("outcome") == reason, F.col("copies")).otherwise(0)
        return F.coalesce(F.sum(lines_here), F.lit(0)).alias(f"dropped_{reason}")

    repeats = F.coalesce(F.sum(F.when(kept, F.col("copies") - 1)), F.lit(0))
    return [
        lines.alias("lines_read"),
        *[dropped(reason) for reason in cleaning.REJECTIONS],
        repeats.alias("dropped_duplicate"),
        F.count_if(kept).alias("rows_kept"),
    ]


def written_funnel(spark: SparkSession, target: str) -> DataFrame:
    """The funnel of an earlier run, from its written counts."""
    return spark.read.parquet(target).agg(*_funnel_counts())


def profile_files(spark: SparkSession, source: str, rejects: str | None = None) -> DataFrame:
    """Profile of text files in one row; rows for quarantine go to ``rejects`` as CSV.

    The text is read and parsed once; the three results come from the parsed columns.
    """
    parsed = scratch_path(spark, "parsed")
    tables.write_table(read_text_lines(spark, source), parsed)
    rows = spark.read.parquet(parsed)
    if rejects is not None:
        tables.write_rejects(cleaning.quarantine(rows), rejects)
    return side_by_side(quality.profile(rows), quality.duplicate_ids(rows))


def train(
    table: DataFrame,
    root: str,
    model_name: str,
    run_id: str,
    *,
    key: str,
    label: str = "fraud",
    kind: str = "rf",
    exclude: tuple[str, ...] = (),
    folds: int = 3,
    parallelism: int = 2,
) -> DataFrame:
    """Tune, evaluate on the held-out part, save, register; returns one row of metrics.

    Below ``{root}/runs/{run_id}`` stay both parts, written once before all fits, the calls on the test
    part, and ``record``: the grid with its scores, the chosen point and the sizes of the parts.
    """
    spark = table.sparkSession
    features = modeling.numeric_features(table, label, (key, *exclude))
    train_part, test_part = splits.train_test(table.select(key, *features, label), key)
    run = f"{root}/runs/{run_id}"
    tables.write_table(splits.with_fold(train_part, key, folds), f"{run}/train")
    tables.write_table(test_part, f"{run}/test")
    folded, test_part = spark.read.parquet(f"{run}/train"), spark.read.parquet(f"{run}/test")
    tuned = modeling.cross_validate(
        folded, features, label, kind, folds=folds, parallelism=parallelism
    )
    path = f"{root}/models/{run_id}"
    modeling.save_model(tuned.bestModel, path)
    sizes = {"train_rows": folded.count(), "test_rows": test_part.count()}
    record = modeling.grid_results(tuned, spark).select(
        F.lit(run_id).alias("run_id"), F.lit(kind).alias("kind"), "*", *[F.lit(n).alias(c) for c, n in sizes.items()])
    tables.write_table(record, f"{run}/record")
    scored = f"{run}/test-calls"
    tables.write_table(modeling.calls(modeling.score(tuned.bestModel, test_part), label), scored)
    measured = f"{root}/metrics/{run_id}"
    tables.write_table(modeling.evaluate(spark.read.parquet(scored)), measured)
    registry.register(spark, root, model_name, run_id, path, spark.read.parquet(measured))
    return spark.read.parquet(measured)


def score_both(
    test: DataFrame, root: str, model_name: str, label: str = "fraud"
) -> DataFrame:
    """Calls and scores of champion and challenger side by side, one pass."""
    spark = test.sparkSession
    scored, done = test, []
    for side in (CHAMPION, CHALLENGER):
        model = registry.load_by_alias(spark, root, model_name, side)
        scored = model.transform(scored).select(
            *test.columns,
            *done,
            F.col("prediction").cast("int").alias(f"{side}_call"),
            modeling.fraud_probability(F.col("probability")).alias(f"{side}_score"),
        )
        done += [f"{side}_call", f"{side}_score"]
    return scored.select(F.col(label).cast("int").alias("label"), *done)


def ab_test(
    table: DataFrame,
    root: str,
    model_name: str,
    *,
    key: str,
    label: str = "fraud",
    iterations: int = 1000,
    seed: int = 42,
    report_path: str | None = None,
) -> DataFrame:
    """Compare, decide, report, and promote when the challenger is better.

    Both models score the test part once; the comparison reads the written calls.
    """
    spark = table.sparkSession
    test = splits.train_test(table, key)[1]
    path = scratch_path(spark, "ab-scores")
    tables.write_table(score_both(test, root, model_name, label), path)
    scored = spark.read.parquet(path)
    metrics = abtest.compare_metrics(
        scored,
        "label",
        {side: f"{side}_call" for side in abtest.SIDES},
        {side: f"{side}_score" for side in abtest.SIDES},
    )
    cells = joint_cells(scored, "label", "champion_call", "challenger_call")
    decided = abtest.decide(abtest.significance(abtest.bootstrap_f1(cells, iterations, seed)))
    names = {side: f"models:/{model_name}@{side}" for side in abtest.SIDES}
    report_path = report_path or scratch_path(spark, "report")
    tables.write_report(abtest.report(metrics, decided, names), report_path)
    written = spark.read.schema(REPORT_SCHEMA).json(report_path)
    registry.apply_decision(spark, root, model_name, written)
    return written


def replay(
    table: DataFrame,
    *,
    label: str = "fraud",
    sink: str = "text",
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Send every row as a JSON message, without the label, from the executors."""
    tables.write_messages(as_messages(table, label), sink, path, options)


def score_stream(
    messages: DataFrame,
    root: str,
    model_name: str,
    schema: StructType,
    out: str,
    checkpoint: str,
    *,
    alias: str = CHAMPION,
    every: str | None = None,
    sink: str | None = None,
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Score a message stream with whichever version holds ``alias`` at each batch.

    ``sink``, ``path`` and ``options`` name where predictions go besides ``out``.
    """
    spark = messages.sparkSession
    supplier = reloading(
        lambda: registry.locate(spark, root, model_name, alias), modeling.load_model
    )
    return start_scoring(messages, supplier, schema, out, checkpoint, alias=alias, every=every,
                         sink=sink, path=path, options=options)


def materialize_to(
    source: DataFrame,
    root: str,
    key: str | list[str],
    end,
    *,
    time: str = "event_timestamp",
    created: str | None = "created",
) -> int:
    """Publish the latest values as of ``end`` below ``root`` and remember how far they reach.

    The next call starts from there, so only its end has to be given.  Returns the version.
    """
    spark = source.sparkSession
    previous = tables.read_current(spark, root)
    reached = None if previous is None else previous.select("covered_until").limit(1).first()
    before = None if previous is None else previous.drop("covered_until")
    rows = latest.materialize(
        source, before, key, start=None if reached is None else reached[0], end=end, time=time, created=created
    )
    kind = source.schema[time].dataType
    return tables.publish(rows.withColumn("covered_until", F.lit(end).cast(kind)), root)
