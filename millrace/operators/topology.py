"""Lines as ordered stations with their neighbours."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import LINE_PRECEDENCE
from ..session import fresh_folder


def neighbours(df: DataFrame, group: str, order: Sequence[str], column: str, chunks: int | None = None) -> DataFrame:
    """``prev_<column>`` and ``next_<column>`` of each row within its group.

    ``order`` must be unique within a group. One range shuffle deals the rows by group and order,
    so no task sorts more than its share however large a group is; each task walks its sorted
    rows once. The rows at the ends of the tasks' shares, two a task, are a small table in which they
    find their outer neighbours: in order, a share's first row follows the last one before it.
    The rows are written below ``spark.checkpoint.dir`` in between, so that both parts see the same
    shares. ``chunks`` fixes the number of shares; else the engine chooses.
    """
    keys = [group, *order]
    dealt = df.repartitionByRange(chunks, *keys) if chunks else df.repartitionByRange(*keys)
    added = [T.StructField("_prev", df.schema[column].dataType), T.StructField("_next", df.schema[column].dataType),
             T.StructField("_share", T.IntegerType()), T.StructField("_head", T.BooleanType()), T.StructField("_tail", T.BooleanType())]
    walked = dealt.sortWithinPartitions(*keys).mapInArrow(_walker(group, column), T.StructType([*df.schema.fields, *added]))
    path = fresh_folder(df.sparkSession, "neighbours")
    walked.write.parquet(path)
    rows = df.sparkSession.read.schema(walked.schema).parquet(path)
    across = Window.partitionBy(group).orderBy("_share", "_tail")
    outer = F.when(F.col("_head"), F.lag(column).over(across)).otherwise(F.col("_prev")), \
        F.when(F.col("_tail"), F.lead(column).over(across)).otherwise(F.col("_next"))
    at_end = F.col("_head") | F.col("_tail")
    names = [f"prev_{column}", f"next_{column}"]
    middle = rows.where(~at_end).select(*df.columns, F.col("_prev").alias(names[0]), F.col("_next").alias(names[1]))
    ends = rows.where(at_end).select(*df.columns, outer[0].alias(names[0]), outer[1].alias(names[1]))
    return middle.unionByName(ends)


def _walker(group: str, column: str):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = TaskContext.get().partitionId()
        held, before = None, None  # the last row so far, and the row before it

        def shown(rows: pa.Table, before: pa.Table | None, after: pa.Table | None) -> Iterator[pa.RecordBatch]:
            n = rows.num_rows
            around = pa.concat_tables([t for t in (before, rows, after) if t is not None]).combine_chunks()
            start = 0 if before is None else 1
            here = around.slice(start, n)

            def beside(step: int) -> pa.Array:
                at = pa.array([i if 0 <= i < around.num_rows else None for i in range(start + step, start + step + n)], pa.int64())
                other, own = around.column(group).take(at), here.column(group)
                same = pc.or_(pc.fill_null(pc.equal(other, own), False), pc.and_(pc.is_null(other), pc.is_null(own)))
                return pc.if_else(same, around.column(column).take(at), pa.scalar(None, around.schema.field(column).type))

            flags = [[before is None and i == 0 for i in range(n)], [after is None and i == n - 1 for i in range(n)]]
            full = here
            for name, values in (("_prev", beside(-1)), ("_next", beside(1)), ("_share", pa.array([share] * n, pa.int32())),
                                 ("_head", pa.array(flags[0])), ("_tail", pa.array(flags[1]))):
                full = full.append_column(name, values)
            yield from full.to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows])
            if rows.num_rows > 1:
                yield from shown(rows.slice(0, rows.num_rows - 1), before, rows.slice(rows.num_rows - 1))
                before = rows.slice(rows.num_rows - 2, 1)
            held = rows.slice(rows.num_rows - 1)
        if held is not None:
            yield from shown(held, before, None)

    return walk


def line_topology(stations: DataFrame, chunks: int | None = None) -> DataFrame:
    """Stations of each line in order, with previous and next station id.

    A station is on every line whose flag it has. Stations are told apart by name: of
    several ids under one name the first in line order is kept, and ``shared_name`` marks it.
    """
    colors = F.array_compact(F.array(*[F.when(F.col(c), F.lit(c)) for c in LINE_PRECEDENCE]))
    on_lines = stations.select(F.explode(colors).alias("line"), "station_name", "station_id", "order", "stop_id")
    named = on_lines.groupBy("line", "station_name").agg(
        F.min_by(F.struct("station_id", "order"), F.struct("order", "stop_id")).alias("_first"),
        (F.min("station_id") != F.max("station_id")).alias("shared_name"))
    rows = named.select("line", "station_name", "_first.station_id", "_first.order", "shared_name")
    return neighbours(rows, "line", ["order", "station_id", "station_name"], "station_id", chunks)


def line_hops(topology: DataFrame) -> DataFrame:
    """Hops from end to end of each line: one fewer than its stations."""
    return topology.groupBy("line").agg((F.count(F.lit(1)) - 1).alias("hops"))
