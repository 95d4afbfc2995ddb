"""Row selection and routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contains(df: DataFrame, column: str, text: str) -> DataFrame:
    return df.where(F.col(column).contains(text))


def lacks(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose text does not contain ``text``; a null text is dropped, as in SQL."""
    return df.where(~F.col(column).contains(text))


def at_least(df: DataFrame, column: str, bound: float) -> DataFrame:
    return df.where(F.col(column) >= bound)


def above(df: DataFrame, column: str, bound: float) -> DataFrame:
    return df.where(F.col(column) > bound)


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where all of ``columns`` are set."""
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df


def flagged(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column))


def equals(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.where(F.col(column) == value)


def topic_between(topic: Column, prefix: str, suffix: str) -> Column:
    """Whether a topic name has both the prefix and the suffix."""
    return topic.startswith(prefix) & topic.endswith(suffix)


def route(df: DataFrame, column: str, values: Sequence[str]) -> dict[str | None, DataFrame]:
    """One frame per value; key ``None`` holds the rows no branch takes (nulls too)."""
    branches: dict[str | None, DataFrame] = {value: df.where(F.col(column) == value) for value in values}
    branches[None] = df.where(~F.coalesce(F.col(column).isin(*values), F.lit(False)))
    return branches


def route_label(column: Column, values: Sequence[str], other: str | None = None) -> Column:
    """The branch of each row as a column, so that one pass serves all branches."""
    return F.when(column.isin(*values), column).otherwise(F.lit(other))


def fan_out(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Send every row to every branch: one copy per value, named in ``column``."""
    return df.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))
