"""Every registered query beside its SQL."""

import pytest

import __spark_entry__ as contract
import compare
from workload import oracle, queries

SF = "/root/testdata/sf0.001"
QUERIES, SQL = queries.QUERIES, oracle.oracle_sql()
WITHOUT_SQL = set()


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    got = compare.spark_rows(QUERIES[name](spark, SF))
    assert got == compare.sql_rows(compare.connect(SF), SQL[name])


def test_entry(spark):
    assert contract.entry(spark).count() == 202


def test_known_counts(spark):
    """The dirty file and the as-of join at the next scale have known sizes."""
    sf = "/root/testdata/sf0.01"
    funnel = QUERIES["clean_funnel"](spark, sf).first().asDict()
    assert funnel == {
        "lines_read": 10099, "dropped_comment": 1, "dropped_field_count": 0, "dropped_type": 300,
        "dropped_range": 300, "dropped_scenario": 100, "dropped_duplicate": 91, "rows_kept": 9307,
    }
    joined = QUERIES["pit_join"](spark, sf)
    assert joined.count() == 1981 and joined.filter("conv_rate is null").count() == 297
