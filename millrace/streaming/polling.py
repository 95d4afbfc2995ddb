"""Regular reads of a growing table into a topic, with a stored mark."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.decode import json_value
from ..sources.increments import POLL_SECONDS
from ..sources.topics import Broker
from .sinks import write_batch

Reader = Callable[[int | None, int | None], tuple[DataFrame | None, int | None]]


@dataclass(frozen=True)
class Marks:
    """The range of the growing column that each micro-batch publishes, in a folder beside the
    query's checkpoint. A range is written before its rows are published, so a micro-batch that
    is run again publishes the same rows to the same place."""

    folder: str

    def ranges(self, spark: SparkSession, table: str) -> DataFrame:
        """(batch, low, high) of a table, low excluded."""
        stored = spark.read.schema("batch long, low long, high long").option("recursiveFileLookup", "true")
        try:
            return stored.parquet(f"{self.folder}/{table}")
        except Exception as error:
            if "PATH_NOT_FOUND" in str(error):
                return spark.createDataFrame([], "batch long, low long, high long")
            raise

    def last(self, spark: SparkSession, table: str, before: int | None = None) -> int | None:
        """The highest value that a micro-batch (one before ``before``) publishes."""
        rows = self.ranges(spark, table)
        return (rows if before is None else rows.where(F.col("batch") < before)).agg(F.max("high")).first()[0]

    def of(self, spark: SparkSession, table: str, batch: int) -> tuple[int | None, int] | None:
        found = self.ranges(spark, table).where(F.col("batch") == batch).first()
        return found and (found["low"], found["high"])

    def save(self, spark: SparkSession, table: str, batch: int, low: int | None, high: int) -> None:
        row = spark.createDataFrame([(batch, low, high)], "batch long, low long, high long").coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.folder}/{table}/batch-{batch}")


def poll_once(spark: SparkSession, table: str, read: Reader, key: str, broker: Broker, topic: str,
              marks: Marks, batch: int = 0) -> int | None:
    """Publish the rows added since the last micro-batch as JSON.

    ``read(low, high)`` gives the rows above ``low`` up to ``high`` (up to what is there now if that
    is None) and their highest value. The range is kept before the rows go out: after a failure
    anywhere the same micro-batch publishes the same range again, and in a topic of files it
    replaces what it had written. A broker may get its records twice.
    """
    kept = marks.of(spark, table, batch)
    low, high = kept or (marks.last(spark, table, batch), None)
    rows, top = read(low, high)
    if rows is None or top == low:
        return low
    if kept is None:
        marks.save(spark, table, batch, low, top)
        # Rows that came in between are left for the next time.
        rows, top = read(low, top)
    write_batch(json_value(rows, key), broker, topic, batch)
    return top


def polling_writer(spark: SparkSession, step: Callable[[int], object], checkpoint: str,
                   seconds: int = POLL_SECONDS) -> DataStreamWriter:
    """A stream that calls ``step`` with the number of each micro-batch; its one-row clock carries no data."""
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (clock.writeStream.foreachBatch(lambda batch, batch_id: step(batch_id) and None)
            .trigger(processingTime=f"{seconds} seconds").option("checkpointLocation", checkpoint))
