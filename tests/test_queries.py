"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import duckdb
import pytest

from scripts.check_oracle import TABLES, key, norm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _names():
    from partsmith.plans import registry
    registry.load_all()
    return list(registry.QUERIES)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns[0] == "sku"
    assert len(rows) <= 20


def test_every_query_has_an_oracle_or_is_listed():
    import __spark_entry__ as E
    assert set(_names()) - set(E.oracle_sql()) == set()
    assert set(_names()) <= set(E.queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF)
    cols = df.columns
    rows = sorted([tuple(norm(x) for x in r) for r in df.collect()], key=key)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    perm = [ocols.index(c) for c in cols]
    orows = sorted([tuple(norm(r[i]) for i in perm) for r in res.fetchall()], key=key)
    assert rows == orows
