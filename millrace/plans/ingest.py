"""Publishing new rows of a table as topic records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from ..functions.decode import json_value
from ..sources.increments import POLL_SECONDS, jdbc_increment, next_increment, topic_for
from ..sources.topics import Broker
from ..streaming.polling import Marks, Reader, poll_once, polling_writer


def ingest_increment(table: DataFrame, column: str, last: int | None = None,
                     key: str | None = None) -> tuple[DataFrame, int | None]:
    """New rows as JSON keyed by ``key`` (the increasing column by default), and the next mark."""
    rows, mark = next_increment(table, column, last)
    return json_value(rows, key or column), mark


def jdbc_reader(spark: SparkSession, url: str, table: str, column: str, allowed: Sequence[str],
                options: dict[str, str] | None = None, partitions: int = 8) -> Reader:
    """Reader of a database table for ``polling.poll_once``."""
    return lambda last, upto: jdbc_increment(spark, url, table, column, last, upto, allowed=allowed, options=options,
                                             partitions=partitions)


def ingest_writer(spark: SparkSession, table: str, column: str, broker: Broker, prefix: str, checkpoint: str, *, path: str = "",
                  url: str = "", allowed: Sequence[str] = (), seconds: int = POLL_SECONDS) -> DataStreamWriter:
    """Publish the rows added to a table, of parquet files or of a database, every so many seconds.

    The ranges are kept beside the checkpoint, so a replay from a new one publishes all rows again.
    """
    if not table or not column or bool(path) == bool(url):
        raise ValueError("ingest needs a table, its growing column, and either files or a database")
    read = jdbc_reader(spark, url, table, column, allowed) if url else \
        lambda last, upto: next_increment(spark.read.parquet(f"{path}/{table}.parquet"), column, last, upto)
    marks = Marks(f"{checkpoint}-marks")
    return polling_writer(spark, lambda batch: poll_once(spark, table, read, column, broker, topic_for(table, prefix), marks, batch), checkpoint, seconds)
