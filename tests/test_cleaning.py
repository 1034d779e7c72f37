from pyspark.sql import functions as F

from cardwatch.operators import cleaning, quality
from cardwatch.plans import jobs
from cardwatch.sinks import tables
from cardwatch.sources import transactions

GOOD = "5,2019-08-22 10:00:00,7,8,12.5,100,1,0,0"
LINES = [
    "#transaction_id | tx_datetime",
    GOOD,
    "5,2019-08-22 09:00:00,7,8,99.0,100,1,0,0",
    "6,2019-08-22 24:00:00,7,8,12.5,100,1,0,0",
    "7,2019-08-22 10:00:00,7,8,12.5,100,1,0",
    "8,2019-08-22 10:00:00,7,8,12.5,100,1,0,0,extra",
    "9,2019-08-22 10:00:00,7,8,0,100,1,0,0",
    "10,2019-08-22 10:00:00,7,8,3,100,1,1,0",
    "11,2019-08-22 10:00:00,7,8,3,100,1,2,1",
    "12,2019-08-22 10:00:00,,8,3,100,1,0,0",
    '13,"2019-08-22 10:00:00",7,8,3,100,1,1,2',
]


def lines(spark, values=LINES):
    return spark.createDataFrame([(v,) for v in values], "value string")


def raw(spark, values=LINES):
    return transactions.parse_csv_lines(lines(spark, values))


def ids(df):
    return sorted(r.transaction_id for r in df.collect())


def test_keeps_valid_rows_and_the_earliest_copy(spark):
    rows = {r.transaction_id: r for r in cleaning.clean(raw(spark)).collect()}
    assert sorted(rows) == [5, 8, 13]
    assert rows[5].tx_amount == 99.0


def test_strict_drops_rows_with_an_extra_field(spark):
    assert ids(cleaning.clean(raw(spark), strict=True)) == [5, 13]


def test_files_and_lines_parse_alike(spark, tmp_path):
    path = f"file://{tmp_path}/raw"
    tables.write_log(lines(spark), path)
    scanned = transactions.read_raw_csv(spark, path)
    assert sorted(map(str, scanned.collect())) == sorted(map(str, raw(spark).collect()))
    marked = scanned.filter(F.col("_corrupt_record").isNotNull()).select("transaction_id")
    assert {r[0][:1] for r in marked.collect()} == {"#", "7", "8"}


def test_cleaning_twice_changes_nothing(spark):
    once = cleaning.clean(raw(spark))
    again = cleaning.deduplicate(
        cleaning.keep_explained_fraud(cleaning.keep_business_ranges(cleaning.keep_not_null(once)))
    )
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))


def test_funnel_adds_up_and_agrees_with_the_file_job(spark, tmp_path):
    path = f"file://{tmp_path}/raw"
    tables.write_log(lines(spark, LINES + [GOOD] * 500 + ["# again"] * 300), path)
    scanned = transactions.read_raw_csv(spark, path)
    for strict in (False, True):
        expected = cleaning.funnel(scanned, strict).first().asDict()
        target = f"file://{tmp_path}/out-{strict}"
        assert jobs.clean_files(spark, path, target, strict).first().asDict() == expected
        assert expected["lines_read"] == sum(v for k, v in expected.items() if k != "lines_read")
        kept = jobs.read_clean(spark, target)
        wanted = cleaning.clean(scanned, strict)
        assert sorted(map(str, kept.collect())) == sorted(map(str, wanted.collect()))


def test_first_row_limit_runs_before_the_shuffle(spark):
    plan = cleaning.deduplicate(cleaning.typed_projection(raw(spark)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def test_quarantine_names_all_reasons(spark):
    rows = transactions.split_lines(lines(spark, ["abc,x,1,1,-5,1,1,3,0", GOOD]))
    bad = cleaning.quarantine(rows).collect()
    assert [r.reasons for r in bad] == [["id_missing", "amount_not_positive", "label_unknown"]]


def test_short_rows_are_nulls_in_the_profile(spark):
    rows = transactions.split_lines(lines(spark, ["7,2019-08-22 10:00:00,7", "# x"]))
    got = {r["column"]: r.nulls for r in quality.null_counts(rows).collect()}
    assert got["customer_id"] == 0 and got["tx_fraud_scenario"] == 1 and got["tx_datetime"] == 0


def test_null_operands_violate_no_rule(spark):
    rows = transactions.split_lines(lines(spark, ["abc,x,1,1,y,z,1,q,w"]))
    assert {r.violations for r in quality.rule_violations(rows).collect()} == {0}
    assert quality.duplicate_ids(rows.union(rows)).first()[0] == 0


def test_profile_job_writes_rejects(spark, tmp_path):
    path, rejects = f"file://{tmp_path}/raw", f"file://{tmp_path}/rejects"
    tables.write_log(lines(spark), path)
    got = jobs.profile_files(spark, path, rejects).first()
    assert got.transactions == 10 and got.duplicate_ids == 1 and got.fraud_without_scenario == 1
    # Quotes are ordinary characters in this view, so the quoted date does not parse.
    assert got.invalid_dates == 2
    back = spark.read.option("header", True).csv(rejects)
    assert {r.transaction_id for r in back.collect()} == {"9", "11"}


def test_headed_csv_with_and_without_schema(spark, tmp_path):
    path = f"file://{tmp_path}/headed"
    spark.range(5).selectExpr("id", "id * 0.5 as half").write.option("header", True).csv(path)
    assert dict(transactions.read_headed_csv(spark, path).dtypes)["half"] == "double"
    stated = transactions.read_headed_csv(spark, path, "id bigint, half string")
    assert stated.dtypes == [("id", "bigint"), ("half", "string")]


def test_both_scans_and_both_paths_agree(spark, tmp_path):
    """NaN, infinite and blank faults get one answer from every way of cleaning."""
    odd = [GOOD, "", "   ", "\t", "21,2019-08-22 10:00:00,1,1,NaN,1,1,0,0", "22,2019-08-22 10:00:00,1,1,Infinity,1,1,0,0",
           "23,2019-08-22 10:00:00,1,1,-Infinity,1,1,0,0"]
    path, out = f"file://{tmp_path}/raw", f"file://{tmp_path}/clean"
    tables.write_log(lines(spark, odd), path)
    parsed, scanned = transactions.parse_csv_lines(lines(spark, odd)), transactions.read_raw_csv(spark, path)
    assert sorted(map(str, parsed.collect())) == sorted(map(str, scanned.collect()))
    for rows in (parsed, scanned):
        funnel = cleaning.funnel(rows).first()
        assert (funnel.lines_read, funnel.dropped_type, funnel.rows_kept) == (4, 3, 1)
        assert cleaning.clean(rows).count() == 1
    report = jobs.clean_files(spark, path, out)
    assert report.first().rows_kept == jobs.read_clean(spark, out).count() == 1


def test_models_can_be_fitted_after_the_cleaning_job(spark, tmp_path):
    """The job observes its write in a session of its own; the session itself can still be shipped with a fresh model."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    source, target = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    tables.write_log(lines(spark), source)
    jobs.clean_files(spark, source, target)
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(float(i), float(i > 5)) for i in range(10)], "x double, label double"))
    assert LogisticRegression(maxIter=3).fit(rows).transform(rows).select("probability").count() == 10
    assert LogisticRegression(maxIter=3).fit(rows).transform(rows).select("probability").collect()
