"""The duplicate queries against their SQL on the smallest tables, and the report of reading levels."""

from pathlib import Path

import pytest

from textloom.llm import queries, readability

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    cur = con.execute(queries.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    got = queries.queries()[name](spark, str(DATA))
    assert sorted(cols) == sorted(got.columns)
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(cur.fetchall())


def test_reading_levels_by_source(spark):
    got = {r["source"]: r for r in queries.p9_report(spark, str(DATA)).collect()}
    assert "*" in got and sum(r["documents"] for s, r in got.items() if s != "*") in (0, got["*"]["documents"])
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    none = readability.by_source(docs, spark.createDataFrame([], "doc_id bigint, band int")).collect()
    assert [(r["source"], r["documents"], r["agreement"]) for r in none] == [("*", 0, None)]
