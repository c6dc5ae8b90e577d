"""Every contract query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.oracle import compare, duck_connect
from tripmart.plans import registry

QUERIES = registry.queries()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, SF_ORACLE, QUERIES[name], SQL.get(name))
    assert res["ok"], res.get("why")
    assert "types" not in res, res["types"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert df.columns == ["company", "total_fare"]


def test_sample_is_repeatable(spark):
    a = QUERIES["o5_sample"](spark, SF_SMALL).collect()
    b = QUERIES["o5_sample"](spark, SF_SMALL).collect()
    assert a == b and len(a) == 100
