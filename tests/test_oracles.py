"""Every registered query against its SQL in DuckDB, names, types and values."""

import os

import duckdb
import pytest

from afterglow.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "array<bigint>": "BIGINT[]"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no generated tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    return round(value, 9) + 0.0 if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    cursor = duck.execute(catalogue.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    assert sorted(df.columns) == sorted(names)
    order = [names.index(c) for c in df.columns]
    got = sorted((repr([plain(v) for v in r]) for r in df.collect()))
    assert got == sorted(repr([plain(r[i]) for i in order]) for r in want)
    kinds = {r[0]: r[1] for r in duck.execute("DESCRIBE " + catalogue.oracle_sql()[name]).fetchall()}
    assert {c: TYPES[t] for c, t in df.dtypes} == {c: kinds[c] for c in df.columns}


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_other_queries_give_rows(spark, name):
    assert catalogue.queries()[name](spark, SF).limit(1).count() == 1
