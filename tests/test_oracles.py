"""Every registered query against its DuckDB oracle on the smallest data
set (the external check runs the same at sf0.01)."""

import math

import duckdb
import pytest

from __spark_entry__ import entry
from ingot.queries import all_oracles, all_queries
from ingot.sources.tables import TEST_TABLES
from conftest import SF_SMALL


def _canon(cols, rows):
    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6)
        if hasattr(v, "isoformat"):
            return v.isoformat()
        return v
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0


# Spark type name → DuckDB type name, for the schema part of the check.
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "float": "FLOAT", "smallint": "SMALLINT"}


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_matches_oracle(spark, duck, name):
    df = all_queries()[name](spark, SF_SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(all_oracles()[name])
    want = _canon(rel.columns, rel.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
    spark_types = {n: SPARK_TO_DUCK.get(t, t) for n, t in df.dtypes}
    duck_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
