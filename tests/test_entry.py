"""All registered queries against their SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from fixtures import render
from fixtures.oracles import ORACLES
from fixtures.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, name):
    actual = entry.queries()[name](spark, SF).toPandas()
    expected = sql.sql(entry.oracle_sql()[name]).df()
    columns = sorted(actual.columns)
    assert columns == sorted(expected.columns)
    assert [str(actual[c].dtype) for c in columns] == [str(expected[c].dtype) for c in columns]
    rows = [sorted(map(tuple, df[columns].astype(str).to_numpy())) for df in (actual, expected)]
    assert rows[0] == rows[1] and len(rows[0]) > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 9000


def test_large_tables_get_many_tasks(spark, monkeypatch, tmp_path):
    """Rows a task, not bytes: small columns become large pages."""
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    monkeypatch.setattr(render, "ROWS_A_TASK", 90)
    rows = render.table(spark, str(tmp_path), "t")
    sizes = [len(part) for part in rows.rdd.glom().collect()]
    assert sum(sizes) == rows.distinct().count() == 1000 and len(sizes) == 12 and max(sizes) <= 90
