"""Comparing a Spark result with DuckDB's answer to the twin SQL."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(con, df, sql: str) -> str | None:
    """None when equal, else a short account of the difference."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = rows_of(names, expected.fetchall())
    got = rows_of(df.columns, df.collect())
    if want == got:
        return None
    extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
    return f"rows {sum(got.values())} against {sum(want.values())}; only here {extra}; only there {missing}"
