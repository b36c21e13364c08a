"""Order-insensitive comparison of a Spark result with a DuckDB oracle result,
modelled on the driver's check (row count, column names, value multiset)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        # exact: 1.50 and 1.5000 compare equal, 1.500001 does not
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple(
        ("" if x is None else x) for x in t)), sorted(cols)


def compare(spark_df, con, sql: str):
    """Returns (ok, message)."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: {sorted(s_cols)} vs {sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row count {len(s_rows)} vs {len(d_rows)}"
    a, _ = rows_of(s_cols, s_rows)
    b, _ = rows_of(d_cols, d_rows)
    if a != b:
        diff_a = [r for r in a if r not in b][:5]
        diff_b = [r for r in b if r not in a][:5]
        return False, f"values differ; spark-only {diff_a}; oracle-only {diff_b}"
    return True, f"{len(a)} rows equal"
