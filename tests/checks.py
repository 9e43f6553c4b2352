"""Compare a registered query with its check SQL."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def check_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set threads to 4")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    want = _rows(names, expected.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows / {sum(want.values())} expected; "
        f"{sum(extra.values())} extra {list(extra)[:2]}; {sum(missing.values())} missing {list(missing)[:2]}"
    )
