"""Train positions, entry counts and the status board.

Every message carries ``at``, a struct that orders all messages; the reader of the topics
builds it with ``message_order``. The state of a station on a line is then four
"greatest ``at`` wins" values: its registration, the train in direction a, the train in
direction b, and its entry count. A value shows only if it is newer than the
registration, which is how a repeated registration resets a station.

The four values are one aggregate over the union of the three inputs, so the whole state
takes one shuffle, a busy station is reduced inside each task first, repeated or shuffled
delivery changes nothing, and the same function keeps the state of a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (DEFAULT_TEMPERATURE, DEFAULT_WEATHER, NO_TRAIN, color_code, or_default,
                                 status_text, title_text, whole_number)
from ..schemas import LINES
from .filters import fan_out
from .keyed import KeyedTable
from .latest import latest_overall

# At equal record time stations come before arrivals before counts.
STATION_RANK, ARRIVAL_RANK, COUNT_RANK = 0, 1, 2


def message_order(rank: int) -> Column:
    """Total order of broker records: record time, kind of topic, then place in the topic."""
    return F.struct("timestamp", F.lit(rank).alias("rank"), "topic", "partition", "offset")


def slot_changes(arrivals: DataFrame) -> DataFrame:
    """Each arrival as changes of train slots: empty the slot it left, fill the one it reached.

    Nothing is emptied when either previous field is null, and nothing is filled when the
    arrival names no station. The emptying does not look at
    which train stands there. Any direction other than ``a`` is the second one.
    """
    arrival = F.struct(*[c for c in arrivals.columns if c not in ("line", "at")])
    return (arrivals.select("line", "at", F.explode(F.array(*arrival_changes(arrival))).alias("_change"))
            .where(F.col("_change").isNotNull())
            .select("line", "at", "_change.*"))


def slot_change(station: Column, direction: Column, step: int, train: Column, status: Column) -> Column:
    """One change of a train slot. Any direction other than ``a`` is the second one."""
    return F.struct(station.alias("station_id"), F.when(direction == "a", F.lit("a")).otherwise(F.lit("b")).alias("kind"),
                    F.lit(step).alias("step"), train.alias("train_id"), status.alias("status"))


def arrival_changes(arrival: Column) -> list[Column]:
    """The changes of an arrival (a struct): empty the slot it left, fill the one it reached."""
    nothing = F.lit(None).cast("string")
    leave = F.when(arrival["prev_station_id"].isNotNull() & arrival["prev_direction"].isNotNull(), slot_change(
        arrival["prev_station_id"], arrival["prev_direction"], 0, nothing, nothing))
    reach = F.when(arrival["station_id"].isNotNull(), slot_change(
        arrival["station_id"], arrival["direction"], 1, arrival["train_id"], status_text(arrival["train_status"])))
    return [leave, reach]


def position_state(registrations: DataFrame, arrivals: DataFrame, counts: DataFrame) -> DataFrame:
    """Current state of every registered station on every line, from one frame a kind.

    ``registrations``: line, station_id, station_name, order, at.
    ``arrivals``: line, station_id, train_id, direction, train_status, prev_station_id,
    prev_direction, at. ``counts``: station_id, count, at. Messages of unknown lines are
    left out, a count goes to each line that has the station, and messages about a
    station that is not registered, or not yet, have no effect.
    """
    on_lines = F.col("line").isin(*LINES)
    messages = (
        registrations.where(on_lines).select(
            "line", "station_id", F.lit("station").alias("kind"), F.lit(0).alias("step"), "at",
            "station_name", "order")
        .unionByName(slot_changes(arrivals.where(on_lines)), allowMissingColumns=True)
        .unionByName(fan_out(counts, "line", LINES).select(
            "line", "station_id", F.lit("count").alias("kind"), F.lit(0).alias("step"), "at",
            F.col("count").cast("long").alias("entries")), allowMissingColumns=True))
    return state_of(messages)


def state_of(messages: DataFrame) -> DataFrame:
    """The same from messages: line, station_id, kind, step, at, station_name, order, train_id, status, entries."""
    return state_table(messages).rows()


def state_table(messages: DataFrame) -> KeyedTable:
    """The same as a table that a stream keeps."""
    def newest(kind: str, *fields: str) -> Column:
        # The order leads the struct, so the greatest struct is the newest message's.
        return F.max(F.when(F.col("kind") == kind, F.struct("at", "step", *fields)))

    state = messages.groupBy("line", "station_id").agg(
        newest("station", "station_name", "order").alias("_station"),
        newest("a", "train_id", "status").alias("_a"),
        newest("b", "train_id", "status").alias("_b"),
        newest("count", "entries").alias("_count"))

    def shown(slot: str, field: str) -> Column:
        return F.when(F.col(f"{slot}.at") > F.col("_station.at"), F.col(f"{slot}.{field}"))

    return KeyedTable(state, lambda kept: kept.where(F.col("_station").isNotNull()).select(
        "line", "station_id", F.col("_station.station_name").alias("station_name"),
        F.col("_station.order").alias("order"),
        shown("_a", "train_id").alias("train_a"), shown("_a", "status").alias("status_a"),
        shown("_b", "train_id").alias("train_b"), shown("_b", "status").alias("status_b"),
        F.coalesce(shown("_count", "entries"), F.lit(0)).alias("entries")))


def board_order() -> list[Column]:
    """Lines in the fixed order of ``LINES``, then station order, then station id."""
    place = F.coalesce(*[F.when(F.col("line") == line, F.lit(i)) for i, line in enumerate(LINES)])
    return [place, F.col("order"), F.col("station_id")]


def status_board(state: DataFrame) -> DataFrame:
    """The state as the board shows it, in display order."""
    return state.orderBy(*board_order()).select(
        "line", color_code(F.col("line")).alias("color"), "station_id", "order", "station_name",
        or_default(F.col("train_a"), NO_TRAIN).alias("direction_a"),
        or_default(F.col("train_b"), NO_TRAIN).alias("direction_b"), "entries")


def current_weather(weather: DataFrame, order: list[str]) -> DataFrame:
    """One row: the latest weather, or the defaults before any report."""
    return latest_overall(weather, order, temperature=DEFAULT_TEMPERATURE, status=DEFAULT_WEATHER)


def weather_line(weather: DataFrame) -> DataFrame:
    """The weather as the board shows it: whole degrees and a titled status."""
    return weather.select(whole_number(F.col("temperature")).alias("degrees"),
                          title_text(F.col("status")).alias("sky"))
