"""Every query of the engine against its SQL."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from lineloom.plans import queries as own

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def _rows(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) and not math.isnan(v) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(own.ORACLE))
def test_query(name, spark, sf, duck):
    df = own.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = _rows(tuple(r[c] for c in cols) for r in df.collect())
    r = duck.execute(own.ORACLE[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    assert got == _rows(tuple(x[names.index(c)] for c in cols) for x in r.fetchall())


def test_every_query_has_sql():
    assert set(own.QUERIES) == set(own.ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
