"""Counting letters in a text file."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.aggregates import count_containing


def letter_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """How many lines contain ``d`` and how many contain ``s``, in one pass."""
    return count_containing(lines, column, {"num_d": "d", "num_s": "s"})
