"""The programs by name: which topics they read, what they compute, where results go.

``build_program`` gives the result frame of a program on a broker, ``program_writer`` the
stream writer that publishes or prints it. Topic names can be replaced at the call.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from ..functions.decode import flatten_json, json_value
from ..operators.joins import HOT_SHARE, Split, measured_split
from ..operators.keyed import KeyedTable
from ..operators.positions import status_board, weather_line
from ..schemas import BANK_DEPOSIT, BANK_WITHDRAWAL, RISK_EVENT, VEHICLE_STATUS, VEHICLE_STATUS_TEXT
from ..sources.topics import Broker, merge_topics, read_topic
from ..streaming import sinks
from . import bank, change_feed, clicks, risk, transit, vehicles


@dataclass(frozen=True)
class Program:
    """``build`` takes one frame of records per topic, and the options named in ``takes``.

    Results without ``out`` go to the console; else they are ``(key, value)`` records. With
    ``rejects`` the result is a frame of judged records, whose valid rows go to ``out`` under
    ``key`` and the others, with their reason, to ``rejects``. Topic names may hold
    ``{space}``, the name space of the transit topics.
    """

    topics: tuple[str, ...]
    build: Callable[..., DataFrame]
    out: str = ""
    mode: str = "append"
    takes: tuple[str, ...] = ()
    rejects: str = ""
    key: str = ""
    # The option with which results are final and come once.
    final_with: str = ""
    # The join key of the first topic's records, for measuring hot keys.
    joined_by: Callable[[DataFrame], DataFrame] | None = None


def _gear_updates(records: DataFrame) -> DataFrame:
    gears = vehicles.gear_position(records)
    return gears.withColumnsRenamed({"truckId": "key", "gearPosition": "value"})


def _station_changes(records: DataFrame) -> DataFrame:
    table = transit.station_table(transit.station_rows(records))
    return json_value(table, "station_id", nulls=True)


def _summary_changes(records: DataFrame, avro: bool = True) -> DataFrame:
    summary = sinks.upper_names(transit.turnstile_summary(transit.turnstile_rows(records, avro=avro)))
    return json_value(summary, "STATION_ID")


def _key_of(layout: StructType, key: str) -> Callable[[DataFrame], DataFrame]:
    return lambda records: flatten_json(records, layout).select(F.col(key).alias("key"))


PROGRAMS = {
    "fuel-level": Program(("fuel-level",), vehicles.fuel_level),
    "balance-updates": Program(("balance-updates",), bank.balance_updates),
    "gear-position": Program(("gear-position",), _gear_updates, "gear-position-updates"),
    "atm-visits": Program(("atm-visits",), bank.atm_visits, "atm-visit-updates"),
    "vehicle-status": Program(("vehicle-status",), vehicles.vehicle_status),
    "bank-deposits": Program(("bank-deposits",), bank.bank_deposits),
    "vehicle-check-in": Program(("vehicle-status", "check-in"), vehicles.vehicle_check_in, takes=("split",), joined_by=_key_of(VEHICLE_STATUS, "truckNumber")),
    "large-deposits": Program(("bank-deposits", "bank-customers"), bank.large_deposits, takes=("split",), joined_by=_key_of(BANK_DEPOSIT, "accountNumber")),
    "large-deposits-within": Program(("bank-deposits", "bank-customers"), bank.bounded_deposits, takes=("delay", "within")),
    "check-in-status": Program(("vehicle-status", "check-in"), vehicles.vehicle_check_in_topic, "checkin-status",
                               takes=("split",), joined_by=_key_of(VEHICLE_STATUS_TEXT, "truckNumber")),
    "withdrawal-locations": Program(("bank-withdrawals", "atm-withdrawals"), bank.withdrawal_location_topic,
                                    "withdrawals-location", takes=("split",), joined_by=_key_of(BANK_WITHDRAWAL, "transactionId")),
    "truck-reservations": Program(("redis-server",), change_feed.truck_reservations),
    "customer-locations": Program(("redis-server",), change_feed.customer_locations),
    "payments": Program(("redis-server",), change_feed.payment_topic, "payment-json"),
    "current-country": Program(("redis-server",), change_feed.country_now_and_home, takes=("split",)),
    "customer-risk": Program(("risk-events",), risk.customer_risk),
    "email-birth-year": Program(("redis-server",), change_feed.email_and_birth_year),
    "risk-metrics": Program(("risk-events", "redis-server"), risk.risk_topic, "risk-metrics", takes=("split",), joined_by=_key_of(RISK_EVENT, "customer")),
    "click-text": Program(("clickevents",), clicks.click_text),
    "click-print": Program(("clickevents",), clicks.click_print),
    "click-sanitize": Program(("clickevents",), clicks.sanitized_clicks, "clickevents.sanitized"),
    "click-popular": Program(("clickevents",), clicks.popular_clicks, "clickevents.popular"),
    "click-score": Program(("clickevents",), clicks.scored_clicks, "clickevents.scored"),
    "click-required": Program(("clickevents",), lambda records: clicks.required_clicks(records)[0]),
    "click-rejected": Program(("clickevents",), lambda records: clicks.required_clicks(records)[1]),
    "click-split": Program(("clickevents",), clicks.judged_clicks, "clickevents.required", rejects="clickevents.rejected", key="uri"),
    "click-valid": Program(("clickevents",), clicks.typed_clicks, "clickevents.valid", rejects="clickevents.invalid", key="uri"),
    "click-attributes": Program(("clickevents",), clicks.click_attributes),
    "uri-sums": Program(("clickevents",), clicks.uri_sums, mode="update"),
    "uri-sums-tumbling": Program(("clickevents",), clicks.tumbling_uri_sums, mode="update", takes=("watermark",)),
    "uri-sums-hopping": Program(("clickevents",), clicks.hopping_uri_sums, mode="update", takes=("watermark",), final_with="watermark"),
    "station-table": Program(("{space}v3.stations",), _station_changes, "{space}station.table.v3", "update"),
    "turnstile-summary": Program(("{space}turnstile.v3",), _summary_changes, "TURNSTILE_SUMMARY", "update", ("avro",)),
}


def build_program(spark: SparkSession, name: str, broker: Broker, topics: Sequence[str] = (), *, space: str = "",
                  options: Mapping[str, object] | None = None, **reading: object) -> DataFrame:
    """The result of a program; ``topics`` replaces its topic names, in order.

    ``options`` are passed on if the program takes them: ``split`` (groups a key is spread
    over in a join), ``watermark`` (windows), ``delay`` and ``within`` (bounded joins), ``avro``.
    """
    program = PROGRAMS[name]
    names = tuple(topics) or tuple(topic.format(space=space) for topic in program.topics)
    if len(names) != len(program.topics):
        raise ValueError(f"{name} reads {len(program.topics)} topics: {', '.join(program.topics)}")
    unknown = sorted(set(options or ()) - set(program.takes))
    if unknown:
        raise ValueError(f"{name} takes no {', '.join(unknown)}")
    return program.build(*[read_topic(spark, broker, topic, **reading) for topic in names], **(options or {}))


def program_split(spark: SparkSession, name: str, broker: Broker, topics: Sequence[str] = (), share: float = HOT_SHARE) -> Split:
    """The hot keys among the records that the first topic of a join holds now."""
    program = PROGRAMS[name]
    if program.joined_by is None:
        raise ValueError(f"{name} has no measured join key")
    return measured_split(program.joined_by(read_topic(spark, broker, (topics or program.topics)[0], streaming=False)), "key", share)


def program_writer(result: DataFrame, name: str, broker: Broker, checkpoint: str, out: str = "", space: str = "",
                   options: Mapping[str, object] | None = None) -> DataStreamWriter:
    """Writer of a program's result, built with ``options``: to ``out``, its own topic, or the console."""
    program = PROGRAMS[name]
    mode = "append" if program.final_with in (options or ()) else program.mode
    topic = out or program.out.format(space=space)
    if program.rejects:
        return sinks.split_writer(result, broker, topic, program.rejects, program.key, checkpoint)
    if not topic:
        return sinks.console(result, mode).option("checkpointLocation", checkpoint)
    if not program.out:
        result = json_value(result, result.columns[0])
    return sinks.topic_writer(result, broker, topic, checkpoint, mode)


def board_stream(spark: SparkSession, broker: Broker, topics: transit.TransitTopics, avro: bool = True,
                 **reading: object) -> KeyedTable:
    """The board's state over its live topics; each topic is read once."""
    records = merge_topics(read_topic(spark, broker, [topics.station_table, topics.summary], **reading),
                           read_topic(spark, broker, pattern=topics.arrival_pattern, **reading))
    return transit.board_table(records, topics, avro)


def weather_stream(spark: SparkSession, broker: Broker, topics: transit.TransitTopics, avro: bool = True,
                   **reading: object) -> DataFrame:
    """The weather line of the board, once for each change."""
    return weather_line(transit.weather_now(read_topic(spark, broker, topics.weather, **reading), topics, avro))


def board_writer(board: KeyedTable, checkpoint: str, show: Callable[[DataFrame], object]) -> DataStreamWriter:
    """Hand the lines that each micro-batch changes, in display order, to ``show``.

    The whole board is ``tables.current(board, checkpoint)``, from the stream's own state.
    """
    return sinks.for_each_batch(board.rows(), lambda batch, batch_id: show(status_board(batch)), checkpoint, "update")
