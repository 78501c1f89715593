"""Compare a Spark result with DuckDB's on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _row(row) -> tuple:
    return tuple(("f", round(v, 6)) if isinstance(v, float) and not math.isnan(v) else v
                 for v in row)


def rows(columns, data) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    return sorted((_row([r[i] for i in order]) for r in data), key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both results are equal, else a short account."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want = rows(names, result.fetchall())
    have = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(n.lower() for n in names) != sorted(n.lower() for n in spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    if len(have) != len(want):
        return f"{len(have)} rows against {len(want)}; first: {have[:2]} / {want[:2]}"
    for a, b in zip(have, want):
        if a != b:
            return f"{a} against {b}"
    return None
