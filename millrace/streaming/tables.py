"""Tables kept up to date by a stream, read from the stream's own state.

The state store of a grouped stream holds one row for each key and commits it with the
checkpoint. Nothing is stored a second time: a table is read as of the last committed
micro-batch by the engine's state reader, while the stream runs or after it.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..operators.keyed import KeyedTable


def keeper(table: KeyedTable, checkpoint: str) -> DataStreamWriter:
    """A writer that keeps the table in the checkpoint's state and publishes nothing."""
    return table.grouped.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)


def current(table: KeyedTable, checkpoint: str, operator: int = 0) -> DataFrame:
    """The table that a stream of it has under ``checkpoint``, whatever its sink is.

    ``operator`` is the number of the stateful operator, if the stream has more than one. Groups
    that a watermark has dropped are not in it. Before the first micro-batch it has no rows.
    """
    spark, kinds = table.grouped.sparkSession, table.grouped.schema
    try:
        state = spark.read.format("statestore").option("operatorId", str(operator)).load(checkpoint)
    except PySparkException as error:
        if (error.getCondition() or "") in ("STDS_COMMITTED_BATCH_UNAVAILABLE", "PATH_NOT_FOUND"):
            return table.finish(spark.createDataFrame([], kinds))
        raise
    halves = [state.schema[side].dataType.fields for side in ("key", "value")]
    if [f.dataType.simpleString() for half in halves for f in half] != [f.dataType.simpleString() for f in kinds]:
        raise TypeError(f"the state holds {state.schema.simpleString()}, not the rows {kinds.simpleString()}")
    # The engine names fields by function, several alike; a struct is cast field by field.
    key, value = T.StructType(kinds.fields[:len(halves[0])]), T.StructType(kinds.fields[len(halves[0]):])
    nullable = lambda fields: T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    return table.finish(state.select(F.col("key").cast(nullable(key)), F.col("value").cast(nullable(value))).select("key.*", "value.*"))
