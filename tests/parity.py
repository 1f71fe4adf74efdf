"""Compare Spark results with an independent SQL engine, value by value."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(data, key=repr)


_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def difference(df, con, sql):
    """None when equal, else a short description."""
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = normal(cols, cur.fetchall())
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    if want[0] != got[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(want[1]) != len(got[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"row {a} != {b}"
    for name, kind in df.dtypes:
        if _KINDS.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} vs {kinds[name]}"
    return None
