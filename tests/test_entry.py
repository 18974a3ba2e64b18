import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plain(v):
    if isinstance(v, float):
        return f"{v:.6g}"
    return str(v)


@pytest.fixture(scope="module")
def duck():
    import os

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql()))
def test_against_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    res = duck.execute(entry.oracle_sql()[name])
    at = [[d[0] for d in res.description].index(c) for c in cols]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in res.fetchall())
