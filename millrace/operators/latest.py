"""Latest and first value per key.

Both are aggregates, so each task first reduces its own rows to one per key: a key that
holds a large share of all rows sends only one row per task through the shuffle. Being
aggregates they also run on streams in update mode, where the engine's state store keeps
the current row of every key and each update is emitted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from .keyed import KeyedTable


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` of each key. ``order`` must be a total order."""
    return latest_table(df, keys, order).rows()


def latest_table(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> KeyedTable:
    """``latest_by_key`` as a table that a stream keeps."""
    return _pick(df, keys, order, F.max, F.max_by)


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` of each key."""
    return _pick(df, keys, order, F.min, F.min_by).rows()


def _pick(df, keys, order, extreme, extreme_by) -> KeyedTable:
    rest = [c for c in df.columns if c not in keys and c not in order]
    if any(_has_map(df.schema[c].dataType) for c in rest):
        row = extreme_by(F.struct(*order, *rest), F.struct(*order))
    else:
        # One struct with the order in front: each value is carried and sent once.
        row = extreme(F.struct(*order, *rest))
    names = df.columns
    return KeyedTable(df.groupBy(*keys).agg(row.alias("_row")), lambda picked: picked.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in names]))


def _has_map(kind: DataType) -> bool:
    # Maps have no order, so they cannot be part of a compared struct.
    if isinstance(kind, StructType):
        return any(_has_map(field.dataType) for field in kind)
    if isinstance(kind, ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, MapType)


def latest_overall(df: DataFrame, order: Sequence[str], **defaults: object) -> DataFrame:
    """One row: the latest value of each named column, or its default before any row."""
    picked = df.agg(F.max(F.struct(*order, *defaults)).alias("_row"))
    return picked.select(*[F.coalesce(F.col(f"_row.{name}"), F.lit(value)).alias(name)
                           for name, value in defaults.items()])
