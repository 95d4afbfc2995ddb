"""Counts and sums, running and windowed. Each works on tables and, in update mode, on streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from .keyed import KeyedTable
from .latest import latest_by_key


def count_containing(df: DataFrame, column: str, texts: Mapping[str, str]) -> DataFrame:
    """One pass, one row: how many rows contain each text, under the given names."""
    return df.agg(*[F.count_if(F.col(column).contains(text)).alias(name) for name, text in texts.items()])


def running_sum(df: DataFrame, key: str, value: str | Column, name: str = "total") -> DataFrame:
    """Sum per key from zero; on a stream every change of a sum is a row."""
    return running_sum_table(df, key, value, name).rows()


def running_sum_table(df: DataFrame, key: str, value: str | Column, name: str = "total") -> KeyedTable:
    column = F.col(value) if isinstance(value, str) else value
    return KeyedTable(df.groupBy(key).agg(F.sum(column).alias(name)),
                      lambda sums: sums.withColumn(name, F.coalesce(F.col(name), F.lit(0))))


# Seconds per unit in window lengths; other units go the general way.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
# Window starts per block of time, at least, when hopping sums are built from panes.
BLOCK_STARTS = 100


def windowed_sum(df: DataFrame, time: str, key: str, value: str, size: str, slide: str | None = None,
                 watermark: str | None = None, name: str = "total") -> DataFrame:
    """Sum per key and epoch-aligned window ``[window_start, window_end)``.

    Without ``slide`` windows tumble; with it each row counts in every window it falls in.
    Without ``watermark`` no row is ever too late and the state keeps growing; with it a
    stream drops windows older than the watermark. On a stream with a watermark hopping
    windows are a second aggregate over sums of one hop, so a row changes one state row
    and not one for each window; such a stream gives each window once, in append mode.
    """
    length, step = _seconds(size), _seconds(slide)
    by_panes = bool(slide and length and step and length % step == 0 and length != step)
    if not by_panes or not isinstance(df.schema[time].dataType, TimestampType) or df.isStreaming and watermark is None:
        return _summed(df, time, key, value, size, slide, watermark, name).rows()
    if df.isStreaming:
        panes = _watermarked(df, time, watermark).groupBy(F.window(time, slide).alias("_pane"), key).agg(F.sum(value).alias("_sum"))
        hops = panes.groupBy(F.window(F.window_time("_pane"), size, slide).alias("_window"), key).agg(F.sum("_sum").alias(name))
        return _shown(hops, key, name)
    return windowed_sum_table(df, time, key, value, size, slide, name).rows()


def windowed_sum_table(df: DataFrame, time: str, key: str, value: str, size: str, slide: str | None = None,
                       name: str = "total", watermark: str | None = None) -> KeyedTable:
    """``windowed_sum`` as a table that a stream keeps. Hopping windows are kept as sums of one hop
    and put together when the table is read; with a ``watermark`` windows have to tumble."""
    length, step = _seconds(size), _seconds(slide)
    if not slide or length == step:
        return _summed(df, time, key, value, size, None, watermark, name)
    if watermark is not None:
        raise ValueError("hopping windows behind a watermark are a stream, not a table: use windowed_sum")
    whole = _summed(df, time, key, value, size, slide, None, name)
    if not length or not step or length % step or not isinstance(df.schema[time].dataType, TimestampType):
        return whole
    kind = whole.grouped.schema[name].dataType
    return _summed(df, time, key, value, slide, None, None, "_sum").then(
        lambda panes: _hops_from_panes(panes, key, length, step, name).withColumn(name, F.col(name).cast(kind)))


def _watermarked(df: DataFrame, time: str, watermark: str | None) -> DataFrame:
    return df if watermark is None else df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark)


def _summed(df, time, key, value, size, slide, watermark, name) -> KeyedTable:
    window = F.window(time, size, slide) if slide else F.window(time, size)
    grouped = _watermarked(df, time, watermark).groupBy(window.alias("_window"), key).agg(F.sum(value).alias(name))
    return KeyedTable(grouped, lambda sums: _shown(sums, key, name))


def _shown(sums: DataFrame, key: str, name: str) -> DataFrame:
    return sums.select(key, F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), name)


def _hops_from_panes(panes: DataFrame, key: str, length: int, step: int, name: str) -> DataFrame:
    """Hopping sums from sums over panes of one step.

    A row is then summed once instead of once per window, and panes cross the network, not
    rows times windows. Panes go to the key and block of time their windows start in
    (two blocks at a border), where all windows of the block are summed in place; a block
    holds a limited number of panes, however hot the key.
    """
    hops = length // step
    starts_per_block = max(BLOCK_STARTS, hops)
    pane = (F.unix_seconds("window_start") / step).cast("long")

    def block(start: Column) -> Column:
        return F.floor(start / starts_per_block)

    numbered = panes.select(key, "_sum", pane.alias("_last")).withColumn("_first", F.col("_last") - (hops - 1))
    placed = numbered.withColumn("_block", F.explode(F.array_distinct(F.array(
        block(F.col("_first")), block(F.col("_last")))))).repartition(key, "_block")
    starts = F.sequence(F.greatest("_first", F.col("_block") * starts_per_block),
                        F.least("_last", (F.col("_block") + 1) * starts_per_block - 1))
    hopping = placed.select(key, "_block", "_sum", F.explode(starts).alias("_start")) \
        .groupBy(key, "_block", "_start").agg(F.sum("_sum").alias(name))
    begin = F.col("_start") * step
    return hopping.select(key, F.timestamp_seconds(begin).alias("window_start"),
                          F.timestamp_seconds(begin + length).alias("window_end"), name)


def _seconds(text: str | None) -> int | None:
    number, _, unit = (text or "").partition(" ")
    known = UNIT_SECONDS.get(unit.rstrip("s"))
    return int(number) * known if known and number.isdigit() else None


def current_window(windowed: DataFrame, key: str) -> DataFrame:
    """The latest-starting window of each key of a ``windowed_sum``."""
    return latest_by_key(windowed, [key], ["window_start"])


def current_window_table(df: DataFrame, time: str, key: str, value: str, size: str, slide: str,
                         name: str = "total") -> KeyedTable:
    """``current_window`` of a ``windowed_sum_table``, as a table that a stream keeps.

    The latest-starting hopping window of a key starts in the key's last pane of one slide, and no
    later pane of the key exists: its sum is that pane's. So only panes are summed and kept, and
    a key's newest one is picked when the table is read; no pane is spread over its windows.
    """
    length, step = _seconds(size), _seconds(slide)
    if not length or not step or length % step or not isinstance(df.schema[time].dataType, TimestampType):
        return windowed_sum_table(df, time, key, value, size, slide, name).then(lambda sums: current_window(sums, key))
    kind = _summed(df, time, key, value, size, slide, None, name).grouped.schema[name].dataType

    def newest(panes: DataFrame) -> DataFrame:
        begin = F.unix_seconds("window_start")
        last = latest_by_key(panes.select(key, begin.alias("_start"), "_sum"), [key], ["_start"])
        return last.select(key, F.timestamp_seconds("_start").alias("window_start"),
                           F.timestamp_seconds(F.col("_start") + length).alias("window_end"), F.col("_sum").cast(kind).alias(name))

    return _summed(df, time, key, value, slide, None, None, "_sum").then(newest)


def keyed_count(df: DataFrame, key: str, counted: str | None = None, name: str = "count") -> DataFrame:
    """Rows per key whose ``counted`` column (the key by default) is not null."""
    return keyed_count_table(df, key, counted, name).rows()


def keyed_count_table(df: DataFrame, key: str, counted: str | None = None, name: str = "count") -> KeyedTable:
    return KeyedTable(df.groupBy(key).agg(F.count(counted or key).alias(name)))


def count_latest_by_key(df: DataFrame, record_key: Sequence[str], order: Sequence[str], group: str,
                        name: str = "count") -> DataFrame:
    """Count over a table: a later row of a record key replaces the earlier before counting."""
    return keyed_count(latest_by_key(df, record_key, order), group, name=name)


def distinct_in_order(df: DataFrame, column: str, order: str, group: Sequence[str] = ()) -> DataFrame:
    """Distinct values with the smallest ``order`` at which each appears."""
    return df.groupBy(*group, column).agg(F.min(order).alias(order))


def with_progress(df: DataFrame, observation: Observation) -> DataFrame:
    """Count the rows that pass this point, readable from ``observation`` after the action."""
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))
