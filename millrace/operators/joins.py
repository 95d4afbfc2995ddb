"""Joins of streams with each other and with current state.

No side is marked for broadcast: on tables the engine measures each side at run time and
broadcasts only below ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and it splits
skewed partitions of a sort-merge join. Streams have no run-time re-planning: there a
``Split`` spreads the keys that were measured to be hot over several tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .latest import first_by_key

# Groups that a hot key is split into, and the share of all rows from which a key is hot.
GROUPS, HOT_SHARE = 4, 0.05
# Tells the records of one key apart, whichever of their fields are set.
RECORD = "_record_hash"


@dataclass(frozen=True)
class Split:
    """How a join spreads keys: those in ``hot``, or all if that is None, over ``groups`` tasks.

    The state of a stream is laid out by it, so a stream keeps the same one over restarts.
    """

    groups: int = GROUPS
    hot: tuple[str, ...] | None = None

    def is_split(self, key: Column) -> Column:
        if self.hot is None:
            return F.lit(True)
        return F.coalesce(key.cast("string").isin(*self.hot), F.lit(False)) if self.hot else F.lit(False)


def measured_split(rows: DataFrame, key: str, share: float = HOT_SHARE, groups: int = GROUPS) -> Split:
    """The keys that hold more than ``share`` of the rows, nulls aside: at most 1 / share of them."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    total = rows.count()
    hot = counts.where(F.col("rows") > F.lit(share * total)).select("key").collect()
    return Split(groups, tuple(sorted(r["key"] for r in hot)))


def split_for(records: DataFrame, split: int | Split | None) -> tuple[DataFrame, Split, tuple[str, ...]]:
    """The records, how their keys are split, and the column to carry for it.

    A number splits every key; without one none is split, and on tables the engine splits the
    keys that prove to be hot. Records are told apart by place and value, so those without
    an offset are spread too.
    """
    chosen = split if isinstance(split, Split) else Split(split or 1)
    if chosen.groups <= 1 or chosen.hot == ():
        return records, Split(1), ()
    return records.withColumn(RECORD, F.xxhash64("topic", "partition", "offset", "value")), chosen, (RECORD,)


def inner_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, *,
               split: int | Split = 1, split_by: Sequence[str] = ()) -> DataFrame:
    """All pairs of rows with equal keys; both sides may repeat a key, nulls never match.

    With a split the left rows of a split key are spread over its groups by a hash of
    ``split_by`` (columns that differ between its rows, dropped from the result), and each right
    row of such a key is copied to every group; other keys have one group. The result is the
    same. Put the side with the hot keys on the left.
    """
    condition = F.col(left_key) == F.col(right_key)
    split = split if isinstance(split, Split) else Split(split)
    if split.groups <= 1:
        return left.join(right, condition, "inner")
    if not split_by:
        raise ValueError("split needs split_by columns that tell the left rows of one key apart")
    group = F.when(split.is_split(F.col(left_key)), F.pmod(F.xxhash64(*split_by), F.lit(split.groups))).otherwise(F.lit(0).cast("long"))
    last = F.when(split.is_split(F.col(right_key)), F.lit(split.groups - 1)).otherwise(F.lit(0)).cast("long")
    spread = left.withColumn("_left_group", group)
    copied = right.withColumn("_right_group", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return (spread.join(copied, condition & (F.col("_left_group") == F.col("_right_group")), "inner")
            .drop("_left_group", "_right_group", *split_by))


def bounded_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str,
                 right_time: str, delay: str, within: str) -> DataFrame:
    """``inner_join`` for unending streams: pairs at most ``within`` apart in event time.

    Watermarks of ``delay`` on both sides let the engine drop old join state.
    """
    early = F.col(right_time) - F.expr(f"INTERVAL {within}")
    late = F.col(right_time) + F.expr(f"INTERVAL {within}")
    return left.withWatermark(left_time, delay).join(
        right.withWatermark(right_time, delay),
        (F.col(left_key) == F.col(right_key)) & F.col(left_time).between(early, late), "inner")


def known_only(events: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Events whose key is in the current state; the others are dropped."""
    return events.join(state.select(*keys), list(keys), "left_semi")


def with_defaults(rows: DataFrame, details: DataFrame, keys: Sequence[str],
                  defaults: Mapping[str, object]) -> DataFrame:
    """Keep every row; take the named details where there are any, else the defaults."""
    joined = rows.join(details.select(*keys, *defaults), list(keys), "left")
    return joined.select(*rows.columns, *[
        F.coalesce(F.col(name), F.lit(value)).alias(name) for name, value in defaults.items()])


def lookup_first(facts: DataFrame, dimension: DataFrame, keys: Sequence[str], order: Sequence[str],
                 how: str = "inner") -> DataFrame:
    """Look facts up in a dimension, using its first row per key when a key repeats."""
    return facts.join(first_by_key(dimension, keys, order), list(keys), how)
