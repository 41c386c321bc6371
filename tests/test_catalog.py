"""Every catalogue query against its DuckDB oracle on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.compare import TABLES, rows_of

SF = "/root/testdata/sf0.001"
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "topic", "count", "rank"]
    assert df.count() > 0


def test_every_query_has_a_builder():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    rel = duck.sql(E.oracle_sql()[name])
    types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in df.schema.fields} == types
    res = duck.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    assert sorted(scols) == sorted(dcols)
    assert rows_of(scols, srows) == rows_of(dcols, res.fetchall())


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF).count() > 0
