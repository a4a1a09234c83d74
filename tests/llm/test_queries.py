"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from lexispark.llm.oracle import oracle_sql
from lexispark.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    sql = con.sql(oracle_sql()[name])
    assert sorted(sql.columns) == sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in sql.columns)) for r in df.collect())
    assert got == sorted(repr(tuple(r)) for r in sql.fetchall())


def test_registered():
    names = contract.queries()
    assert {f"op{n}" for n in range(1, 14)} >= {n.split("_")[0] for n in QUERIES} and set(QUERIES) | {"pipeline"} <= set(names)
