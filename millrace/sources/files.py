"""Text lines and CSV tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def text_lines(spark: SparkSession, path: str, reuse: bool = False) -> DataFrame:
    """One row per line. ``reuse`` keeps the lines for several actions, spilling to disk."""
    lines = spark.read.text(path)
    return lines.persist(StorageLevel.MEMORY_AND_DISK) if reuse else lines


def appended_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """A stream of the lines of new files in ``folder``; writers roll files, not append."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.text(folder)


def csv_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A CSV file with a header and quoted commas as a typed table."""
    return spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').csv(path)
