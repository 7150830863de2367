"""Core queries against their SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from textloom import catalog

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def cell(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.5f}"
    return str(v)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, db, name):
    got = catalog.queries()[name](spark, str(DATA))
    cur = db.execute(catalog.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(got.columns)
    want = sorted(tuple(cell(v) for v in r) for r in cur.fetchall())
    have = sorted(tuple(cell(r[c]) for c in cols) for r in got.collect())
    assert have == want


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql()) - {"train_baseline"}))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, str(DATA)).count() > 0
