"""Every registered query against its SQL on DuckDB, at the smallest scale that has rows."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLES:
        problem = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
        if problem == "no rows":
            problem = compare(spark, connect(LARGER), name, QUERIES[name], ORACLES[name], LARGER)
        assert problem is None, problem
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    rows = {r["rule_id"]: r for r in entry.entry(spark).collect()}
    assert len(rows) == 5 and rows[3]["outcome"] == "PASS" and rows[2]["outcome"] == "FAIL"
