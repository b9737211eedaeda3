"""Compare registered queries with their check SQL in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, decimal.Decimal):
        return f"decimal:{value}"
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if hasattr(value, "asDict"):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def difference(spark, sf_dir: str, query, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    df = query(spark, sf_dir)
    got = df.collect()
    con = connect(sf_dir)
    try:
        cur = con.execute(sql)
        names = [c[0] for c in cur.description]
        want = cur.fetchall()
    finally:
        con.close()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    for x, y in zip(a, b):
        if repr(x) != repr(y):
            return f"{sorted(names)}\n spark {str(x)[:600]}\n sql   {str(y)[:600]}"
    return None
