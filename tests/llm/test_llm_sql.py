"""Corpus queries with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from conftest import SF_SMALL
from ingot.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    rel = con.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    at = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)
    assert got == want
