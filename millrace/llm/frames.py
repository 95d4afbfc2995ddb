"""Helpers of the text operators: row-wise Arrow functions and checkpointed tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.session import fresh_folder

#: Text handled at once inside a task, in bytes; one longer text forms a slice of its own. What
#: a slice needs beside its text is a multiple of it that a worker keeps for later tasks.
SLICE_BYTES = 256 << 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of the frame has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
        taken.add(name.lower())
    return out


def saved(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The frame written below ``spark.checkpoint.dir``, which all executors share, and read
    back: later uses neither recompute it nor depend on the executors that made it."""
    path = fresh_folder(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes the files of a frame that ``saved`` gave and nothing reads from now on."""
    for file in {name.rpartition("/")[0] for name in df.inputFiles()}:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut so that each part holds about ``most`` bytes of the column."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def with_columns(df: DataFrame, text: str, added: list[T.StructField],
                 make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
                 drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``df`` with columns that a function of Arrow batches computes.

    ``make`` runs once a task and returns the function; that gets slices of a bounded
    number of bytes of ``text``. An input column with the name of an added one is replaced.
    When the task ends the function's ``close`` is called, if it has one.
    """
    names = {f.name.lower() for f in added} | {d.lower() for d in drop}
    kept = [f.name for f in df.schema if f.name.lower() not in names]
    schema = T.StructType([*(f for f in df.schema if f.name in kept), *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        try:
            for batch in batches:
                for part in slices(batch, text):
                    columns = [part.column(name) for name in kept] + work(part)
                    yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])
        finally:
            getattr(work, "close", lambda: None)()

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]
