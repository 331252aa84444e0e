"""Every registered query against its DuckDB SQL on the smallest tables, and the driver contract."""

import pytest

import __spark_entry__ as entry
from check import compare, oracle_connection

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    note, _, good = compare(spark, con, SF, name, QUERIES[name], ORACLES.get(name))
    assert good, note


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "fail_rate" in df.columns
