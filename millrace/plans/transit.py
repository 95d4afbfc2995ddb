"""Transit topics: station table, entry summary and status board.

Arrivals, entries and weather travel as registry-framed Avro, stations and summaries as
JSON. Each program takes records already read as columns by the ``*_rows`` functions, so
the format is chosen in one place (``avro=True`` needs the spark-avro package).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decode import avro_record, counted_rejects, decode_avro, flatten_json, judged_records, typed_faults, typed_split
from ..functions.scalars import line_color, topic_name
from ..operators.aggregates import count_latest_by_key, keyed_count_table
from ..operators.filters import present, topic_between
from ..operators.keyed import KeyedTable
from ..operators.latest import latest_table
from ..operators.positions import (ARRIVAL_RANK, COUNT_RANK, STATION_RANK, arrival_changes, current_weather, message_order,
                                   position_state, state_table)
from ..schemas import (ARRIVAL, ARRIVAL_AVRO, ENTRY_SUMMARY, LINES, STATION, STATION_ROW, TURNSTILE, TURNSTILE_AVRO,
                       WEATHER, WEATHER_AVRO)

PLACE = ("timestamp", "topic", "partition", "offset")


@dataclass(frozen=True)
class TransitTopics:
    """Topic names below the operator's own name space, such as ``org.example.``."""

    space: str
    summary: str = "TURNSTILE_SUMMARY"

    @property
    def arrival_prefix(self) -> str:
        return f"{self.space}arrival."

    @property
    def arrival_suffix(self) -> str:
        return ".v3"

    @property
    def arrival_pattern(self) -> str:
        """Dots are left as they are, so they fit any character."""
        return f"^{self.arrival_prefix}*.v3"

    @property
    def stations(self) -> str:
        return f"{self.space}v3.stations"

    @property
    def station_table(self) -> str:
        return f"{self.space}station.table.v3"

    @property
    def turnstile(self) -> str:
        return f"{self.space}turnstile.v3"

    @property
    def weather(self) -> str:
        return f"{self.space}weather.v3"

    def arrival_topic(self, station_name: Column) -> Column:
        return topic_name(station_name, self.arrival_prefix, self.arrival_suffix)

    def is_arrival(self, topic: Column) -> Column:
        return topic_between(topic, self.arrival_prefix, self.arrival_suffix)


def _rows(records, schema, avro_schema, avro, keep):
    return decode_avro(records, avro_schema, keep=keep) if avro else flatten_json(records, schema, keep=keep)


def station_rows(records: DataFrame, keep: Sequence[str] = PLACE) -> DataFrame:
    """Valid station records, trimmed to four columns with the line as text.

    A station without a color flag has a null line and is kept.
    """
    judged = judged_records(records, STATION, keep=keep)
    stations = counted_rejects(judged, "rejected_stations").select("_record.*", *keep)
    return stations.select("station_id", "station_name", "order", line_color().alias("line"), *keep)


def station_table(rows: DataFrame, by_line: bool = False) -> DataFrame:
    """Latest row of each station. Keyed by id alone a station on two lines keeps only its
    last line; ``by_line`` keeps one row per station and line."""
    return kept_stations(rows, by_line).rows()


def kept_stations(rows: DataFrame, by_line: bool = False) -> KeyedTable:
    """``station_table`` as a table that a stream keeps."""
    keys = ["station_id", "line"] if by_line else ["station_id"]
    return latest_table(rows, keys, PLACE).then(lambda stations: stations.select(*STATION_ROW.names))


def turnstile_rows(records: DataFrame, avro: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    return _rows(records, TURNSTILE, TURNSTILE_AVRO, avro, keep)


def turnstile_summary(rows: DataFrame) -> DataFrame:
    """Entries per station; on a stream each change of a count is a row."""
    return turnstile_summary_table(rows).rows()


def turnstile_summary_table(rows: DataFrame) -> KeyedTable:
    return keyed_count_table(present(rows, "station_id"), "station_id")


def turnstile_table_summary(rows: DataFrame, record_key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Entries per station when a later row of a record key replaces the earlier one."""
    return count_latest_by_key(present(rows, "station_id"), record_key, order, "station_id")


def weather_now(records: DataFrame, topics: TransitTopics, avro: bool = False) -> DataFrame:
    mine = records.where(F.col("topic") == topics.weather)
    return current_weather(_rows(mine, WEATHER, WEATHER_AVRO, avro, PLACE), list(PLACE))


def registrations(records: DataFrame, topics: TransitTopics) -> DataFrame:
    """Station table records as registrations; unreadable ones are left out."""
    mine = records.where(F.col("topic") == topics.station_table)
    rows = typed_split(mine, STATION_ROW, keep=PLACE, optional=("line",))[0]
    return rows.select("line", "station_id", "station_name", "order", message_order(STATION_RANK).alias("at"))


def arrivals(records: DataFrame, topics: TransitTopics, avro: bool = False) -> DataFrame:
    mine = records.where(topics.is_arrival(F.col("topic")))
    # An arrival without a station still empties the slot that the train left.
    rows = _rows(mine, ARRIVAL, ARRIVAL_AVRO, avro, PLACE)
    return rows.select(*ARRIVAL.names, message_order(ARRIVAL_RANK).alias("at"))


def summary_counts(records: DataFrame, topics: TransitTopics) -> DataFrame:
    mine = records.where(F.col("topic") == topics.summary)
    rows = flatten_json(mine, ENTRY_SUMMARY, keep=PLACE)
    return present(rows, "STATION_ID").select(
        F.col("STATION_ID").alias("station_id"), F.col("COUNT").alias("count"), message_order(COUNT_RANK).alias("at"))


def board_messages(records: DataFrame, topics: TransitTopics, avro: bool = False) -> DataFrame:
    """The board's messages from one frame of its topics: each record is read and parsed once."""
    topic, text = F.col("topic"), F.col("value").cast("string")
    station, arrival, count = topic == topics.station_table, topics.is_arrival(topic), topic == topics.summary
    read = F.struct(
        F.when(station, F.from_json(text, "map<string,string>")).alias("_present"),
        F.when(station, F.from_json(text, STATION_ROW)).alias("_record"),
        F.when(arrival, avro_record(F.col("value"), ARRIVAL_AVRO) if avro else F.from_json(text, ARRIVAL)).alias("_arrival"),
        F.when(count, F.from_json(text, ENTRY_SUMMARY)).alias("_count"))
    rows = records.where(station | arrival | count).select(*PLACE, F.inline_outer(F.array(read)))
    fault = F.coalesce(*typed_faults(STATION_ROW, optional=("line",)))

    def message(line: Column, kind: Column, step: Column, rank: int, station_id: Column, **more: Column) -> Column:
        empty = {"station_name": "string", "order": "int", "train_id": "string", "status": "string", "entries": "bigint"}
        return F.struct(line.alias("line"), station_id.cast("int").alias("station_id"), kind.alias("kind"), step.cast("int").alias("step"),
                        message_order(rank).alias("at"), *[more.get(n, F.lit(None)).cast(t).alias(n) for n, t in empty.items()])

    record, counted = F.col("_record"), F.col("_count")
    registered = F.when(F.col("_present").isNotNull() & fault.isNull(), message(
        record["line"], F.lit("station"), F.lit(0), STATION_RANK, record["station_id"],
        station_name=record["station_name"], order=record["order"]))
    moved = [F.when(change.isNotNull(), message(F.col("_arrival.line"), change["kind"], change["step"], ARRIVAL_RANK, change["station_id"],
                                                train_id=change["train_id"], status=change["status"]))
             for change in arrival_changes(F.col("_arrival"))]
    entered = [F.when(counted["STATION_ID"].isNotNull(), message(F.lit(line), F.lit("count"), F.lit(0), COUNT_RANK, counted["STATION_ID"],
                                                                entries=counted["COUNT"])) for line in LINES]
    return (rows.select(F.explode(F.array(registered, *moved, *entered)).alias("_message")).where(F.col("_message").isNotNull())
            .select("_message.*").where(F.col("line").isin(*LINES)))


def board_state(records: DataFrame, topics: TransitTopics, avro: bool = False) -> DataFrame:
    """State behind the status board from one frame of all its topics, in one pass.

    Each kind of message is picked by topic name. Show the state with ``status_board``.
    """
    return board_table(records, topics, avro).rows()


def board_table(records: DataFrame, topics: TransitTopics, avro: bool = False) -> KeyedTable:
    """The same as a table that a stream keeps."""
    return state_table(board_messages(records, topics, avro))


def board_state_of(station_records: DataFrame, arrival_records: DataFrame, summary_records: DataFrame,
                   topics: TransitTopics, avro: bool = False) -> DataFrame:
    """The same from one frame per kind of topic, so that each topic is read once."""
    return position_state(registrations(station_records, topics), arrivals(arrival_records, topics, avro),
                          summary_counts(summary_records, topics))
