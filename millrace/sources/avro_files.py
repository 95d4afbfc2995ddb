"""Avro container files: schema and rows in one file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.decode import avro_available
from ..schemas import spark_schema

# The file format ships with the engine; only its short name comes with the external package.
_FORMAT_CLASS = "org.apache.spark.sql.avro.AvroFileFormat"


def avro_format(spark: SparkSession) -> str:
    return "avro" if avro_available(spark) else _FORMAT_CLASS


def write_avro(df: DataFrame, path: str, schema_json: str) -> None:
    """Rows as container files with the given record schema."""
    fields = spark_schema(schema_json).names
    df.select(*fields).write.mode("overwrite").format(avro_format(df.sparkSession)).option(
        "avroSchema", schema_json).save(path)


def read_avro(spark: SparkSession, path: str, schema_json: str) -> DataFrame:
    return (spark.read.format(avro_format(spark)).schema(spark_schema(schema_json))
            .option("avroSchema", schema_json).load(path))
