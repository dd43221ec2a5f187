"""Compare registered queries with their SQL run by DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

from saltmill.session import STAR_TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in STAR_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    return (type(v).__name__, v)


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    names = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} against {sorted(want_names)}"
    a, b = _bag(names, got), _bag(want_names, want)
    if a != b:
        return f"rows {len(got)} against {len(want)}; only here {list((a - b).items())[:3]}; only SQL {list((b - a).items())[:3]}"
    return None
