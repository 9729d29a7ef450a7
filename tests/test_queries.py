"""Registered queries against their SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from caseloom.plans import decision_queries, queries, source_queries  # noqa: F401 - they register theirs

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for p in DATA.glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


def plain(v):
    return repr(round(v, 6)) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, db, name):
    df = queries.QUERIES[name](spark, str(DATA))
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name not in queries.SQL:
        return
    rel = db.execute(queries.SQL[name])
    names = [x[0] for x in rel.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
