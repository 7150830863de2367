"""Recall and precision of the duplicate queries against their SQL: ``python -m textloom.llm.recall FOLDER``.

The SQL joins texts on all word triples, however common, so nothing is left out of what is compared with.
"""

from __future__ import annotations

import sys
from pathlib import Path


def compared(folder: str, names: tuple[str, ...] = ("p3_found", "p4_found", "p6_found")) -> dict[str, dict[str, int]]:
    """Of each query: rows by SQL, rows found, and rows that are in both."""
    import duckdb

    from textloom.llm import queries
    from textloom.session import get_spark, ship

    spark = ship(get_spark("recall"))
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    out = {}
    for name in names:
        cur = con.execute(queries.oracle_sql()[name])
        cols = [d[0] for d in cur.description]
        want = set(cur.fetchall())
        have = {tuple(r[c] for c in cols) for r in queries.queries()[name](spark, folder).collect()}
        out[name] = {"true": len(want), "found": len(have), "both": len(want & have)}
    return out


if __name__ == "__main__":
    for query, n in compared(sys.argv[1]).items():
        print(query, n, flush=True)
