"""Every registered query of the engine against its SQL in DuckDB."""

from collections import Counter

import duckdb
import pytest

from tessera.plans import catalog, domain, formats, registry  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(rows):
    def one(x):
        if isinstance(x, float):
            return None if x != x else float(f"{x:.9g}")
        return str(x) if hasattr(x, "year") else x

    return Counter(tuple(one(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.execute(registry.ORACLES[name])
    assert sorted(d[0] for d in want.description) == columns
    order = [[d[0] for d in want.description].index(c) for c in columns]
    rows = [tuple(r[k] for k in order) for r in want.fetchall()]
    assert plain(map(tuple, got.select(*columns).collect())) == plain(rows)


def test_permutation(spark):
    rows = catalog.seeded_shuffle(spark, SF).collect()
    again = catalog.seeded_shuffle(spark, SF).collect()
    assert {r.o_orderkey: r.position for r in rows} == {r.o_orderkey: r.position for r in again}
    assert sorted(r.position for r in rows) == list(range(1, len(rows) + 1))


def test_entry():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
