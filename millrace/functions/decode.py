"""Turning broker bytes into typed columns and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import CHANGE_FEED


def as_text(df: DataFrame, key: str = "key", value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Broker key and value bytes as strings, under the given names."""
    return df.select(F.col("key").cast("string").alias(key), F.col("value").cast("string").alias(value), *keep)


def flatten_json(df: DataFrame, schema: StructType, column: str = "value",
                 keep: Sequence[str] = ()) -> DataFrame:
    """Parse ``column`` by ``schema`` and make its fields the columns.

    A missing field is null and an unreadable text is a row of nulls; no row is lost.
    """
    return _parse_once(df, F.from_json(F.col(column).cast("string"), schema), keep)


def _parse_once(df: DataFrame, parsed: Column, keep: Sequence[str]) -> DataFrame:
    # As a generator with one row per row the text is parsed once. A plain projection lets
    # the optimizer move later filters and join-key checks below it, with a parse in each.
    return df.select(F.inline_outer(F.array(parsed)), *keep)


def required_split(df: DataFrame, schema: StructType, required: Sequence[str], column: str = "value",
                   keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Split rows into ``(valid, rejected)`` by the presence of required keys.

    An explicit null counts as present. ``rejected`` keeps the text and a ``reason``:
    the first missing key, or ``malformed`` where the text is no JSON object.
    """
    return _split(df, schema, column, keep, required_faults(required))


def required_faults(required: Sequence[str]) -> list[Column]:
    """Which required keys a record read as ``_present`` lacks."""
    return [F.when(~F.map_contains_key("_present", key), F.lit(key)) for key in required]


def typed_split(df: DataFrame, schema: StructType, column: str = "value", keep: Sequence[str] = (),
                optional: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Split rows into ``(valid, rejected)`` by record validation.

    A field fails when it is absent (unless in ``optional``) or when a given value does
    not read as its declared type.
    """
    return _split(df, schema, column, keep, typed_faults(schema, optional))


def typed_faults(schema: StructType, optional: Sequence[str] = ()) -> list[Column]:
    """What is wrong with a record read as ``_present`` (a map of its texts) and ``_record``."""
    absent = [F.when(~F.map_contains_key("_present", f.name), F.lit(f"missing {f.name}"))
              for f in schema if f.name not in optional]
    mistyped = [F.when(F.element_at("_present", f.name).isNotNull() & F.col("_record").getField(f.name).isNull(),
                       F.lit(f"type of {f.name}")) for f in schema]
    return absent + mistyped


def _split(df, schema, column, keep, faults):
    """Valid rows as columns, and the texts of the others with the first fault found.

    ``faults`` look at ``_present`` (the object's keys with their text) and ``_record``.
    """
    judged = judged_records(df, schema, column, keep, faults)
    return (judged.where(F.col("reason").isNull()).select("_record.*", *keep),
            judged.where(F.col("reason").isNotNull()).select(F.col("_text").alias(column), "reason", *keep))


def judged_records(df: DataFrame, schema: StructType, column: str = "value", keep: Sequence[str] = (),
                   faults: Sequence[Column] | None = None) -> DataFrame:
    """Each row once, as ``_text``, ``_record`` and ``reason`` (null for a valid record), so
    that one pass can write the valid and the rejected rows."""
    text = F.col(column).cast("string")
    read = F.struct(text.alias("_text"), F.from_json(text, "map<string,string>").alias("_present"),
                    F.from_json(text, schema).alias("_record"))
    rows = df.select(*keep, F.inline_outer(F.array(read)))
    faults = typed_faults(schema) if faults is None else faults
    reason = F.when(F.col("_present").isNull(), F.lit("malformed")).otherwise(F.coalesce(*faults))
    return rows.withColumn("reason", reason)


def counted_rejects(judged: DataFrame, name: str) -> DataFrame:
    """The valid rows of ``judged_records``; the number of the others is counted on the way
    and shows as the observed metric ``name`` of each run or micro-batch."""
    return judged.observe(name, F.count_if(F.col("reason").isNotNull()).alias("rows")).where(F.col("reason").isNull())


def strict_json(df: DataFrame, schema: StructType, column: str = "value",
                keep: Sequence[str] = ()) -> DataFrame:
    """As ``flatten_json``, but the first unreadable text ends the query."""
    return _parse_once(df, F.from_json(F.col(column).cast("string"), schema, {"mode": "FAILFAST"}), keep)


def base64_text(column: Column) -> Column:
    """Text behind base64, which may hold stray characters; null where it cannot be read."""
    strict = F.try_to_binary(column, F.lit("base64"))
    bare = F.try_to_binary(F.regexp_replace(column, "[^A-Za-z0-9+/=]", ""), F.lit("base64"))
    return F.coalesce(strict, bare).cast("string")


def first_entry(column: Column, field: str = "element") -> Column:
    """A field of the first array element; null for an empty or absent array."""
    return F.get(column, F.lit(0)).getField(field)


def part_of(column: Column, separator: str, index: int) -> Column:
    """One piece of a split text, null when there is no such piece."""
    return F.get(F.split(column, separator), F.lit(index))


def change_feed_text(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Feed key and the decoded text of the first set entry, one row per message."""
    # Of the feed's fields only these two are used, so only they are built.
    feed = flatten_json(df, StructType([CHANGE_FEED["key"], CHANGE_FEED["zSetEntries"]]), keep=keep)
    return feed.select("key", base64_text(first_entry(F.col("zSetEntries"))).alias("entity"), *keep)


def decode_change_feed(df: DataFrame, entity_schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Change-feed messages to entity columns; undecodable messages become null rows."""
    return flatten_json(change_feed_text(df, keep), entity_schema, "entity", keep)


def json_value(df: DataFrame, key: str | Column, columns: Sequence[str] = ("*",), nulls: bool = False,
               keep: Sequence[str] = ()) -> DataFrame:
    """Rows as ``(key string, value JSON)``; null fields are left out unless ``nulls``."""
    options = {"ignoreNullFields": "false"} if nulls else {}
    key_column = F.col(key) if isinstance(key, str) else key
    return df.select(key_column.cast("string").alias("key"),
                     F.to_json(F.struct(*columns), options).alias("value"), *keep)


def pretty_json(df: DataFrame, columns: Sequence[str] = ("*",)) -> DataFrame:
    """Rows as indented JSON text."""
    return df.select(F.to_json(F.struct(*columns), {"pretty": "true"}).alias("value"))


def map_entries(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per entry of a map column: ``name`` and the fields of the value."""
    return df.select(*keep, F.explode(column).alias("name", "_entry")).select(*keep, "name", "_entry.*")


# Registry framing of Avro messages: magic byte 0, 4-byte big-endian schema id, payload.
_MAGIC = "00"


def framed_schema_id(value: Column) -> Column:
    """The schema id in a framed message, null when the frame is not valid."""
    number = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")
    return F.when(is_framed(value), number)


def framed_payload(value: Column) -> Column:
    return F.when(is_framed(value), F.substr(value, F.lit(6)))


def is_framed(value: Column) -> Column:
    return (F.length(value) >= 5) & (F.hex(F.substring(value, 1, 1)) == _MAGIC)


def frame(payload: Column, schema_id: int) -> Column:
    """Put the registry header before an Avro payload."""
    header = F.unhex(F.lit(_MAGIC + format(schema_id, "08x")))
    return F.concat(header, payload)


def avro_available(spark) -> bool:
    """Whether the session has the external package behind ``from_avro`` and ``to_avro``."""
    try:
        spark._jvm.java.lang.Class.forName(
            "org.apache.spark.sql.avro.AvroDataToCatalyst", False,
            spark._jvm.java.lang.Thread.currentThread().getContextClassLoader())
        return True
    except Exception:  # py4j wraps ClassNotFoundException
        return False


def avro_record(value: Column, schema: str) -> Column:
    """The record in registry-framed Avro bytes. Needs the spark-avro package."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(framed_payload(value), schema, {"mode": "PERMISSIVE"})


def decode_avro(df: DataFrame, schemas: str | Mapping[int, str], column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Registry-framed Avro to columns. Needs the spark-avro package.

    ``schemas`` maps schema ids to the schemas the bytes were written with, the last of which
    is the layout of the result; its messages with other ids become rows of nulls, and
    ``unknown_schema`` gives them whole. One schema alone stands for every id.
    """
    from pyspark.sql.avro.functions import from_avro

    payload = framed_payload(F.col(column))
    if isinstance(schemas, str):
        return _parse_once(df, from_avro(payload, schemas, {"mode": "PERMISSIVE"}), keep)
    reader = list(schemas.values())[-1]
    number = framed_schema_id(F.col(column))
    read = F.coalesce(*[F.when(number == known, from_avro(payload, writer, {"mode": "PERMISSIVE", "avroSchema": reader}))
                        for known, writer in schemas.items()])
    return _parse_once(df, read, keep)


def unknown_schema(df: DataFrame, known: Sequence[int], column: str = "value") -> DataFrame:
    """Messages without a valid frame or with a schema id that is not known, with the reason."""
    number = framed_schema_id(F.col(column))
    reason = F.when(number.isNull(), F.lit("no frame")).when(~number.isin(*known), F.concat(F.lit("schema "), number))
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def encode_avro(df: DataFrame, key: Column, key_schema: str, key_id: int, columns: Sequence[str],
                value_schema: str, value_id: int) -> DataFrame:
    """Rows as framed Avro key and value. Needs the spark-avro package."""
    from pyspark.sql.avro.functions import to_avro

    return df.select(
        frame(to_avro(F.struct(key.alias("timestamp")), key_schema), key_id).alias("key"),
        frame(to_avro(F.struct(*columns), value_schema), value_id).alias("value"))
