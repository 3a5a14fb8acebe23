"""Registered corpus queries against their SQL on the smallest given tables."""

import duckdb
import pytest
from tallyweave.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = connection.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    want = sorted(result.fetchall())
    got = queries.QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == want


def test_one_query_for_each_operator():
    numbers = sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES if q.startswith("op"))
    assert numbers == list(range(1, 11)) and "pipeline" in queries.QUERIES
