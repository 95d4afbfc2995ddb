"""Starting and stopping stream programs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.joins import Split
from ..operators.keyed import KeyedTable
from ..session import fresh_folder, shared_folder
from .progress import follow, progress_of
from .tables import current, keeper


def checkpoint_for(spark: SparkSession, query_name: str) -> str:
    """The checkpoint folder of a named query; no two names share one."""
    return f"{shared_folder(spark)}/checkpoints/{query_name}"


def replay_checkpoint(spark: SparkSession, query_name: str) -> str:
    """A checkpoint folder not used before: the query starts again from its start position."""
    return fresh_folder(spark, f"checkpoints/{query_name}")


def kept_split(spark: SparkSession, checkpoint: str, measure: Callable[[], Split]) -> Split:
    """The split that the query of a checkpoint began with: measured and stored the first time."""
    path = f"{checkpoint}-split"
    try:
        rows = spark.read.schema("groups int, hot string").parquet(path).collect()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        split = measure()
        spark.createDataFrame([(split.groups, key) for key in (None, *(split.hot or ()))], "groups int, hot string").coalesce(1).write.parquet(path)
        return split
    return Split(rows[0]["groups"], tuple(sorted(r["hot"] for r in rows if r["hot"] is not None)))


def run_forever(writer: DataStreamWriter, name: str, every: str | None = None) -> None:
    """Start and block until the query is stopped or fails."""
    writer = writer.queryName(name)
    if every:
        writer = writer.trigger(processingTime=every)
    writer.start().awaitTermination()


def run_available(writer: DataStreamWriter, name: str | None = None) -> StreamingQuery:
    """Process everything there is now, then stop."""
    if name:
        writer = writer.queryName(name)
    follow(SparkSession.active())
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def batch_sizes(query: StreamingQuery) -> list[int]:
    """Rows read by each micro-batch of a run."""
    return [progress["numInputRows"] for progress in progress_of(query)]


def late_rows(query: StreamingQuery) -> int:
    """Rows that the micro-batches of a run dropped because they came behind the watermark."""
    return sum(state["numRowsDroppedByWatermark"] for progress in progress_of(query) for state in progress["stateOperators"])


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows in the state of each stateful operator after the last micro-batch."""
    return [state["numRowsTotal"] for state in progress_of(query)[-1]["stateOperators"]]


def keep_table(table: KeyedTable, label: str) -> DataFrame:
    """Run a keyed stream over what is available and return the table in its state."""
    checkpoint = fresh_folder(table.grouped.sparkSession, f"{label}-checkpoint")
    run_available(keeper(table, checkpoint))
    return current(table, checkpoint)


def row_writer(rows: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    """Stores the rows of an append-only stream as parquet; the engine's file log makes each count once."""
    return rows.writeStream.outputMode("append").format("parquet").option("path", folder).option("checkpointLocation", checkpoint)


def keep_rows(rows: DataFrame, label: str) -> DataFrame:
    """Run an append-only stream over what is available and return all rows it emitted."""
    spark, folder = rows.sparkSession, fresh_folder(rows.sparkSession, f"{label}-rows")
    run_available(row_writer(rows, folder, f"{folder}-checkpoint"))
    return spark.read.schema(rows.schema).parquet(folder)


class ClosingWindows:
    """Windows behind a watermark: closed ones leave the state as rows, open ones are in it."""

    def __init__(self, spark: SparkSession, label: str):
        self.folder = fresh_folder(spark, f"{label}-windows")

    def run(self, table: KeyedTable) -> StreamingQuery:
        """Process what is available now; a later call goes on from there."""
        return run_available(row_writer(table.grouped, self.folder, f"{self.folder}-checkpoint"))

    def rows(self, table: KeyedTable) -> DataFrame:
        """All windows so far, each once."""
        closed = table.grouped.sparkSession.read.schema(table.grouped.schema).parquet(self.folder)
        return table.finish(closed).unionByName(current(table, f"{self.folder}-checkpoint"))
