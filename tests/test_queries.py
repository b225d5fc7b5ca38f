"""Every driver query with SQL against DuckDB, on the smallest driver tables."""

import os

import pytest

from registrylake.plans.pipeline_queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def rows_of(frame):
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    return columns, sorted(repr([float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in r]) for r in plain.values.tolist())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    assert rows_of(QUERIES[name](spark, SF).toPandas()) == rows_of(duck.sql(SQL[name]).df())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
