"""Runs a query in Spark and its SQL in DuckDB over the same tables and compares the rows."""

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return value
    return str(value) if not hasattr(value, "__float__") else round(float(value), 6) + 0.0


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(v[i]) for i in order) for v in values), key=repr)


def difference(df, con, sql):
    """None if all rows agree, else a few that do not."""
    want = con.execute(sql)
    columns = [d[0] for d in want.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    a, b = rows(df.columns, [tuple(r) for r in df.collect()]), rows(columns, want.fetchall())
    if len(a) == len(b) and all(x == y or _near(x, y) for x, y in zip(a, b)):
        return None
    return f"{len(a)} and {len(b)} rows; {[x for x in a if x not in b][:3]} / {[x for x in b if x not in a][:3]}"


def _near(x, y):
    return all(p == q or (isinstance(p, (int, float)) and isinstance(q, (int, float)) and abs(p - q) <= 2e-6 * max(1, abs(p))) for p, q in zip(x, y))
