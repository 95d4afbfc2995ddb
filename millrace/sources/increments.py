"""Reading only the rows that were added since the last read."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows fetched at a time and seconds between polls.
BATCH_ROWS = 500
POLL_SECONDS = 60


def rows_after(table: DataFrame, column: str, last: int | None, upto: int | None) -> DataFrame:
    """Rows with ``last < column <= upto``; both bounds are pushed to the scan."""
    bounded = table.where(F.col(column) <= F.lit(upto))
    return bounded if last is None else bounded.where(F.col(column) > F.lit(last))


def next_increment(table: DataFrame, column: str, last: int | None = None, upto: int | None = None) -> tuple[DataFrame, int | None]:
    """The new rows and the mark to pass next time.

    The upper bound is taken once before the rows are read (or given as ``upto``), so rows that
    arrive in between are left for the next call.
    """
    if upto is not None:
        return rows_after(table, column, last, upto), upto
    fresh = table if last is None else table.where(F.col(column) > F.lit(last))
    top = fresh.agg(F.max(column).alias("top")).first()["top"]
    if top is None:
        return table.where(F.lit(False)), last
    return rows_after(table, column, last, top), top


def jdbc_bounds_query(table: str, column: str, last: int | None) -> str:
    """The statement that asks the database for the ends of the next increment."""
    newer = "" if last is None else f" WHERE {column} > {int(last)}"
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}{newer}"


def jdbc_rows_query(table: str, column: str, last: int | None, upto: int) -> str:
    newer = "" if last is None else f"{column} > {int(last)} AND "
    return f"(SELECT * FROM {table} WHERE {newer}{column} <= {int(upto)}) increment"


def jdbc_increment(spark: SparkSession, url: str, table: str, column: str, last: int | None = None, upto: int | None = None, *,
                   allowed: Sequence[str], options: Mapping[str, str] | None = None,
                   partitions: int = 8) -> tuple[DataFrame | None, int | None]:
    """New rows of a database table and the next mark; ``None`` rows when nothing is new.

    ``allowed`` is the list of tables that may be read. The increment is read in
    ``partitions`` ranges of ``column`` at once. Names go into statements, so only plain
    ones are taken.
    """
    if table not in allowed:
        raise ValueError(f"table {table!r} is not in the list of allowed tables")
    for name in (*table.split("."), column):
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
            raise ValueError(f"{name!r} is not a plain name")
    base = {"url": url, "fetchsize": str(BATCH_ROWS), **(options or {})}
    bounds = spark.read.format("jdbc").options(**base).option(
        "query", jdbc_bounds_query(table, column, last)).load().toDF("low", "high").first()
    if bounds["high"] is None:
        return None, last
    if upto is not None:
        bounds = {"low": bounds["low"], "high": upto}
    rows = spark.read.format("jdbc").options(**base).option(
        "dbtable", jdbc_rows_query(table, column, last, bounds["high"]))
    if partitions > 1:
        rows = rows.options(partitionColumn=column, lowerBound=str(bounds["low"]),
                            upperBound=str(bounds["high"] + 1), numPartitions=str(partitions))
    return rows.load(), int(bounds["high"])


def topic_for(table: str, prefix: str) -> str:
    """Rows of a table are published on the prefix followed by the table name."""
    return prefix + table
