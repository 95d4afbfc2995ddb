"""Writers. Each takes a frame of results and returns a configured stream writer, or
writes at once when the frame is a table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.decode import encode_avro, json_value
from ..sources.topics import Broker, as_topic


def console(df: DataFrame, mode: str = "append", show: Callable[[str], object] = print) -> DataStreamWriter:
    """Print every row whole; ``update`` mode prints each change of an aggregate."""
    return df.writeStream.outputMode(mode).foreachBatch(lambda batch, batch_id: print_rows(batch, show))


def print_rows(rows: DataFrame, show: Callable[[str], object] = print) -> None:
    """Each row as a line of JSON, or a single text column as it is, partition after partition."""
    single = rows.dtypes[0][1] == "string" and len(rows.columns) == 1
    text = F.col(rows.columns[0]) if single else F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    for row in rows.select(text).toLocalIterator():
        show(row[0])


def kafka_sink_options(broker: Broker, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": broker.servers, "topic": topic, **broker.options}


def topic_writer(records: DataFrame, broker: Broker, topic: str, checkpoint: str,
                 mode: str = "append") -> DataStreamWriter:
    """Publish ``(key, value)`` records. Kafka delivery is at least once."""
    if not broker.is_files:
        return (records.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
                .writeStream.outputMode(mode).format("kafka")
                .options(**kafka_sink_options(broker, topic)).option("checkpointLocation", checkpoint))

    return _file_writer(records, broker, topic, checkpoint, mode)


def _file_writer(records: DataFrame, broker: Broker, topic: str, checkpoint: str, mode: str) -> DataStreamWriter:
    return records.writeStream.outputMode(mode).foreachBatch(
        lambda batch, batch_id: write_batch(batch, broker, topic, batch_id)).option("checkpointLocation", checkpoint)


def write_batch(batch: DataFrame, broker: Broker, topic: str, batch_id: int) -> None:
    """One micro-batch to a topic; in files a batch that is run again replaces its own folder."""
    if not broker.is_files:
        write_topic(batch, broker, topic)
        return
    rows = as_topic(batch, topic, F.col("key"), F.col("value"), F.current_timestamp(), F.monotonically_increasing_id())
    rows.write.mode("overwrite").format(broker.file_format).save(f"{broker.folder}/{topic}/batch-{batch_id}")


def late_writer(rows: DataFrame, time: str, delay: str, size: str, key: str, broker: Broker, topic: str, late: str,
                checkpoint: str) -> DataStreamWriter:
    """Rows as JSON to ``topic``, but those whose window of ``size`` has passed the watermark to ``late``.

    The watermark of a micro-batch is the greatest time of the ones before it less ``delay``, as the
    engine has it. Sums over ``topic`` with that delay then drop nothing: every row is in a sum
    or in ``late``. The greatest time of each micro-batch is kept beside the checkpoint, so that a
    micro-batch that is run again is cut at the same place.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            spark.createDataFrame(batch.agg(F.lit(batch_id).cast("long").alias("batch"), F.max(time).cast("timestamp").alias("top")).collect(),
                                  "batch long, top timestamp").coalesce(1).write.mode("overwrite").parquet(f"{checkpoint}-times/batch-{batch_id}")
            tops = spark.read.schema("batch long, top timestamp").option("recursiveFileLookup", "true").parquet(f"{checkpoint}-times")
            top = tops.where(F.col("batch") < batch_id).agg(F.max("top")).first()[0]
            passed = F.lit(False) if top is None else F.coalesce(
                F.window(time, size)["end"] <= F.lit(top) - F.expr(f"INTERVAL {delay}"), F.lit(False))
            marked = batch.withColumn("_late", passed)
            write_batch(json_value(marked.where("NOT _late").drop("_late"), key), broker, topic, batch_id)
            write_batch(json_value(marked.where("_late").drop("_late"), key), broker, late, batch_id)
        finally:
            batch.unpersist()

    return for_each_batch(rows, handle, checkpoint)


def split_writer(judged: DataFrame, broker: Broker, topic: str, rejects: str, key: str, checkpoint: str) -> DataStreamWriter:
    """One pass over ``judged_records``: valid records as JSON to ``topic``, the others with their reason to ``rejects``.

    The batch is kept while both are written, so its source is read once.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            valid = batch.where(F.col("reason").isNull()).select("_record.*")
            write_batch(json_value(valid, key), broker, topic, batch_id)
            bad = batch.where(F.col("reason").isNotNull()).select(F.col("reason").alias("key"), F.col("_text").alias("value"))
            write_batch(bad, broker, rejects, batch_id)
        finally:
            batch.unpersist()

    return for_each_batch(judged, handle, checkpoint)


def write_topic(records: DataFrame, broker: Broker, topic: str) -> None:
    """Append the ``(key, value)`` records of a table to a topic at once."""
    if broker.is_files:
        as_topic(records, topic, F.col("key"), F.col("value"), F.current_timestamp(), F.monotonically_increasing_id()) \
            .write.mode("append").format(broker.file_format).save(f"{broker.folder}/{topic}")
    else:
        records.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")) \
            .write.format("kafka").options(**kafka_sink_options(broker, topic)).save()


def publish_json(df: DataFrame, key: str, broker: Broker, topic: str, checkpoint: str,
                 mode: str = "append") -> DataStreamWriter:
    """Rows as JSON under a text key."""
    return topic_writer(json_value(df, key), broker, topic, checkpoint, mode)


def publish_text(df: DataFrame, key: str, value: str, broker: Broker, topic: str, checkpoint: str) -> DataStreamWriter:
    """Two text columns passed through as key and value."""
    return topic_writer(df.select(F.col(key).alias("key"), F.col(value).alias("value")), broker, topic, checkpoint)


def upper_names(df: DataFrame) -> DataFrame:
    """Column names in capitals, as a created-as-select topic has them."""
    return df.toDF(*[c.upper() for c in df.columns])


def publish_summary(df: DataFrame, key: str, broker: Broker, topic: str, checkpoint: str) -> DataStreamWriter:
    """A keyed aggregate as a JSON topic with capital names; each change is a record."""
    return publish_json(upper_names(df), key.upper(), broker, topic, checkpoint, "update")


def publish_avro(df: DataFrame, time: str, key_schema: str, key_id: int, columns: Sequence[str],
                 value_schema: str, value_id: int, broker: Broker, topic: str, checkpoint: str) -> DataStreamWriter:
    """Rows as registry-framed Avro, keyed by epoch milliseconds. Needs the spark-avro package."""
    records = encode_avro(df, F.col(time), key_schema, key_id, columns, value_schema, value_id)
    return publish_bytes(records, broker, topic, checkpoint)


def publish_bytes(records: DataFrame, broker: Broker, topic: str, checkpoint: str) -> DataStreamWriter:
    """Publish ``(key, value)`` records whose key and value are bytes."""
    if broker.is_files:
        return _file_writer(records, broker, topic, checkpoint, "append")
    return (records.writeStream.outputMode("append").format("kafka")
            .options(**kafka_sink_options(broker, topic)).option("checkpointLocation", checkpoint))


def for_each_batch(df: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str,
                   mode: str = "append") -> DataStreamWriter:
    """Hand each micro-batch to ``handler(rows, batch_id)``; it must tolerate a repeat."""
    return df.writeStream.outputMode(mode).foreachBatch(handler).option("checkpointLocation", checkpoint)


def by_topic(handlers: Mapping[str, Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """A batch handler that gives each topic's rows to that topic's handler.

    The batch is kept while its topics are handled, so it is read once.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for topic, handler in handlers.items():
                handler(batch.where(F.col("topic") == topic), batch_id)
        finally:
            batch.unpersist()

    return handle
