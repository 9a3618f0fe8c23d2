import pytest

from courtside.llm import queries
from tests.oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, sf_dir, name):
    r = compare(spark, duck(sf_dir), name, sf_dir, queries.QUERIES, queries.ORACLES)
    assert r["cols_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"], r
