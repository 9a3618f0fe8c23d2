"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import pytest

import __spark_entry__ as E
from courtside.oracles import ORACLES
from courtside.registry import QUERIES
from tests.oracle_compare import compare, duck


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_dir, name):
    r = compare(spark, con, name, sf_dir, QUERIES, ORACLES)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:4] == ["cutoff_date", "season_id", "metric_name", "rank"]
    assert df.count() >= 0
