"""Registered queries against their SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from wikicells.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "conversations"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_all_are_registered():
    assert QUERIES.keys() | {"pipeline"} <= entry.queries().keys()
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, sql, name):
    actual = QUERIES[name](spark, SF).toPandas()
    expected = sql.sql(ORACLES[name]).df()
    columns = sorted(actual.columns)
    assert columns == sorted(expected.columns)
    assert [str(actual[c].dtype) for c in columns] == [str(expected[c].dtype) for c in columns]
    rows = [sorted(map(tuple, df[columns].astype(str).to_numpy())) for df in (actual, expected)]
    assert rows[0] == rows[1] and len(rows[0]) > 0


@pytest.mark.parametrize("name", ["op2_chat_formatting", "op4_mixture", "op5_sharding"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian"))
