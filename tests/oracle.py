"""Compare a registered query with its SQL twin in DuckDB."""

from __future__ import annotations

import math

import duckdb
import numpy as np

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer)):
        return int(v)
    if isinstance(v, (float, np.floating)):
        return None if math.isnan(v) else float(v)
    if hasattr(v, "asDict"):
        return plain(v.asDict())
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        v = v.replace(tzinfo=None)
    return v


def mark(v):
    return "\0" if v is None else repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda r: [mark(x) for x in r])


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_cols, want = rows_of(names, cur.fetchall())
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows; spark {got[:2]} sql {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}"
    kinds = [(c, type(g), type(w)) for c, g, w in zip(got_cols, got[0], want[0]) if g is not None and w is not None and type(g) is not type(w)] if got else []
    return f"types {kinds}" if kinds else None
