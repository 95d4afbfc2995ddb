"""Topics as DataFrames of broker records.

``read_topic`` has two back-ends with one result layout: ``kafka``, and ``files`` for
topics kept as parquet or JSON-lines files of broker records. Programs written against
one run unchanged on the other.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.decode import decode_avro, flatten_json
from ..operators.latest import latest_by_key
from ..schemas import ENVELOPE


@dataclass(frozen=True)
class Broker:
    """Where topics live. ``servers`` selects Kafka, ``folder`` the file back-end."""

    servers: str = ""
    folder: str = ""
    file_format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)

    @property
    def is_files(self) -> bool:
        return bool(self.folder)


def subscription(topics: str | Sequence[str] = (), pattern: str = "") -> dict[str, str]:
    """One topic, several topics, or every topic whose whole name fits ``pattern``."""
    if pattern:
        # The broker client matches whole names, so an open-ended pattern needs a tail.
        body = pattern.removeprefix("^")
        return {"subscribePattern": body if body.endswith(("$", ".*")) else body + ".*"}
    names = [topics] if isinstance(topics, str) else list(topics)
    return {"subscribe": ",".join(names)}


def kafka_options(broker: Broker, topics: str | Sequence[str] = (), pattern: str = "",
                  start: str = "earliest", max_records: int | None = None) -> dict[str, str]:
    """Options of the Kafka source as plain data."""
    options = {"kafka.bootstrap.servers": broker.servers, **subscription(topics, pattern),
               "startingOffsets": start, **broker.options}
    if max_records is not None:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return options


def read_topic(spark: SparkSession, broker: Broker, topics: str | Sequence[str] = (), *, pattern: str = "",
               start: str = "earliest", max_records: int | None = None, max_files: int | None = None,
               streaming: bool = True) -> DataFrame:
    """Broker records of one or more topics.

    ``start`` counts only for a query without a checkpoint: to replay a topic from its
    beginning, start the query with a new checkpoint folder.
    """
    if not broker.is_files:
        reader = spark.readStream if streaming else spark.read
        return reader.format("kafka").options(**kafka_options(broker, topics, pattern, start, max_records)).load()
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(ENVELOPE).format(broker.file_format).options(**broker.options)
    reader = reader.option("recursiveFileLookup", "true")
    if streaming and max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if pattern:
        # A path pattern is looked up anew for each micro-batch, so topics that come later are read too.
        return topics_like(reader.load(f"{broker.folder}/{folder_pattern(pattern)}"), pattern)
    names = [topics] if isinstance(topics, str) else list(topics)
    return reader.load(f"{broker.folder}/{names[0]}" if len(names) == 1
                       else f"{broker.folder}/{{{','.join(names)}}}")


def folder_pattern(pattern: str) -> str:
    """A path pattern for the folders of all topics whose name starts with a match of ``pattern``, and
    perhaps of others: its literal beginning, in which a dot is any one character."""
    start = re.match(r"(?:[A-Za-z0-9_-]|\.|\\\.)*", pattern.removeprefix("^"))
    body, rest = start.group(), pattern.removeprefix("^")[start.end():]
    if rest[:1] in ("*", "?", "{"):  # the last character may be missing
        body = re.sub(r"(\\?.)$", "", body)
    if "|" in rest:
        body = ""
    return re.sub(r"\\?\.", "?", body) + "*"


def topics_like(df: DataFrame, pattern: str) -> DataFrame:
    """Records whose topic name starts with a match of ``pattern``."""
    return df.where(F.col("topic").rlike("^" + pattern.removeprefix("^")))


def as_topic(df: DataFrame, topic: str | Column, key: Column, value: Column,
             timestamp: Column | None = None, offset: Column | None = None) -> DataFrame:
    """Rows as broker records, for publishing to files or feeding programs from a table."""
    name = F.lit(topic) if isinstance(topic, str) else topic
    return df.select(
        _bytes(df, key).alias("key"), value.cast("binary").alias("value"),
        name.alias("topic"), F.lit(0).alias("partition"),
        (offset if offset is not None else F.lit(None)).cast("long").alias("offset"),
        (timestamp if timestamp is not None else F.lit(None)).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"))


def _bytes(df: DataFrame, key: Column) -> Column:
    """A key of bytes as it is, any other as the bytes of its text."""
    return key if df.select(key).dtypes[0][1] == "binary" else key.cast("string").cast("binary")


def merge_topics(*streams: DataFrame) -> DataFrame:
    """Several topics as one frame; the ``topic`` column tells them apart."""
    first, *rest = streams
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def declare_table(records: DataFrame, name: str, schema: StructType | None = None, avro: str | None = None,
                  key: str | None = None, order: Sequence[str] = ("timestamp", "partition", "offset"),
                  ) -> DataFrame:
    """Name a topic as a SQL view with declared columns, in JSON or registry-framed Avro.

    With ``key`` the view is a table: the latest row of each key. Without, it is the
    stream of all rows.
    """
    keep = list(order) if key else []
    rows = decode_avro(records, avro, keep=keep) if avro else flatten_json(records, schema, keep=keep)
    if key:
        rows = latest_by_key(rows, [key], order).drop(*order)
    rows.createOrReplaceTempView(name)
    return rows


def topic_sql(spark: SparkSession, statement: str) -> DataFrame:
    """A SQL statement over declared tables; they read from the start of their topics."""
    return spark.sql(statement)
