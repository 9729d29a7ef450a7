"""The pN_ queries on the smallest tables, against SQL where there is some."""

from pathlib import Path

import duckdb
import pytest

from caseloom.llm import queries

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")
COLUMNS = {
    "p1_found": ["group_case_id", "case_id"], "p2_found": ["case_id", "consensus_decision"], "p3_found": ["request_sha256"], "p4_found": ["case_id_a", "case_id_b"], "p5_found": ["diagnosis_label", "fold"],
    "p6_found": ["case_id"], "p7_found": ["doc_id"], "p8_found": ["source"], "p9_found": ["doc_id"],
}


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, db, name):
    df = queries.queries()[name](spark, str(DATA))
    got = [tuple(r) for r in df.collect()]
    if name in COLUMNS:
        assert df.columns == COLUMNS[name] and len(got) == len(set(got))
    sql = queries.oracle_sql().get(name)
    if sql:
        rel = db.execute(sql)
        names = [x[0] for x in rel.description]
        assert sorted(got) == sorted(tuple(r[names.index(c)] for c in df.columns) for r in rel.fetchall())
