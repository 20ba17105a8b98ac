"""Side-by-side check of a Spark query and its DuckDB statement.

Mirrors the correctness gate: same row count, same column names, and the same multiset
of rows. Columns are sorted by name; floats are compared after rounding to ``digits``
decimals, or exactly with ``digits=None`` (results are already rounded where summation
order matters, so the registered queries pass exactly).
"""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from keelson.sources.tables import TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v, digits: int | None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return (v if digits is None else round(v, digits)) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime()
    return v


def rows_of(columns: list[str], rows: list[tuple], digits: int | None) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i], digits) for i in order) for r in rows)


def compare(spark_df, con, sql: str, digits: int | None = 6) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_of(s_cols, s_rows, digits), rows_of(d_cols, d_rows, digits)
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        return False, f"values differ; spark-only={only_s} duck-only={only_d}"
    return True, f"{len(s_rows)} rows"
