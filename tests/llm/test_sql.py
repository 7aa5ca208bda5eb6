"""Queries of the training-data operators that SQL can express, against DuckDB."""

from collections import Counter

import duckdb
import pytest

from tessera.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    rows = Counter(tuple(r[names.index(c)] for c in columns) for r in want.fetchall())
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == rows
