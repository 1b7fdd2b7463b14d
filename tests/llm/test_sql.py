"""Queries of this subpackage against their SQL."""

import duckdb
import pytest

from lineloom.llm import queries

SMALL = [q for q in queries.ORACLE]


@pytest.mark.parametrize("name", SMALL)
def test_query(name, spark, sf):
    con = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    r = con.execute(queries.ORACLE[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    assert sorted((tuple(x[c] for c in cols) for x in df.collect()), key=repr) == sorted((tuple(x[names.index(c)] for c in cols) for x in r.fetchall()), key=repr)
