"""Runs a query and its SQL over the same tables and compares rows."""

from __future__ import annotations

import math
from pathlib import Path

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (list, tuple)):
        return "[" + ",".join(map(plain, x)) + "]"
    if isinstance(x, (int, float)) or type(x).__name__ == "Decimal":
        return f"{float(x):.5f}".replace("-0.00000", "0.00000")
    return str(x)


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        if (p := Path(sf_dir, f"{t}.parquet")).exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def differences(df, con, sql: str) -> list[str]:
    """What differs between a Spark result and a DuckDB statement's."""
    con.execute(sql)
    names = [c[0] for c in con.description]
    theirs = con.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} and {sorted(names)}"]
    order = sorted(names)
    mine = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in theirs)
    if mine == theirs:
        return []
    a, b = set(mine) - set(theirs), set(theirs) - set(mine)
    return [f"{len(mine)} and {len(theirs)} rows; {len(a)} only here, {len(b)} only in SQL", f"here {order}: {sorted(a)[:3]}", f"SQL: {sorted(b)[:3]}"]
