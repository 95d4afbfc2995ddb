"""Results for each message: operators whose state is read and written message by message.

Each is a processor over the engine's keyed state. The messages of a key are applied in their
order. Those of one micro-batch are sorted; with ``wait`` messages are held in the state until
the watermark has passed their time, so that disorder across micro-batches up to that length
changes nothing. A message behind the watermark is dropped by the engine, which counts it.

The engine keeps such state in the RocksDB store only, so that is set for the session's later streams.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.latest import latest_by_key
from ..session import SETTINGS

PROVIDER = "spark.sql.streaming.stateStore.providerClass"

# The column a message is held back by, and its place among the messages of its key.
TIME = "_time"


def _sort_key(row: Row, order: Sequence[str]) -> list:
    """Nulls first, as the engine sorts."""
    return [(row[c] is not None, row[c]) for c in order]


class Ordered(StatefulProcessor):
    """Applies the messages of a key in order; subclasses say what one message does.

    ``load`` reads the key's state, ``apply`` changes it and gives the row of a message, ``save``
    writes it back, each once for a micro-batch but ``apply``.
    """

    def __init__(self, rows: T.StructType, order: Sequence[str], held: bool):
        self.names, self.rows, self.order, self.held = rows.names, rows, list(order), held

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        if self.held:
            self.waiting = handle.getListState("waiting", self.rows)
        self.open(handle)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if not self.held:
            yield from self._in_order(key, rows)
            return
        new = list(rows)
        self.waiting.appendList([tuple(r) for r in new])
        self.handle.registerTimer(_millis(min(r[TIME] for r in new)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.waiting.exists():
            return
        passed = timerValues.getCurrentWatermarkInMs()
        due, left = [], []
        for values in self.waiting.get():
            row = Row(*self.names)(*values)
            (due if _millis(row[TIME]) <= passed else left).append(row)
        if not due:
            return
        if left:
            self.waiting.put([tuple(r) for r in left])
            self.handle.registerTimer(_millis(min(r[TIME] for r in left)))
        else:
            self.waiting.clear()
        yield from self._in_order(key, due)

    def _in_order(self, key, rows) -> Iterator[Row]:
        state = self.load(key)
        for row in sorted(rows, key=lambda r: _sort_key(r, self.order)):
            state, out = self.apply(state, row)
            if out is not None:
                yield out
        self.save(state)

    def close(self) -> None:
        pass


def _millis(time) -> int:
    """Whole milliseconds, rounded up: a message is due once the watermark has reached it."""
    return -(-int(round(time.timestamp() * 1_000_000)) // 1000)


def _run(messages: DataFrame, keys: Sequence[str], processor: StatefulProcessor, out: str | T.StructType, held: bool = False) -> DataFrame:
    messages.sparkSession.conf.set(PROVIDER, SETTINGS[PROVIDER])
    return messages.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=out, outputMode="Append", timeMode="EventTime" if held else "None")


# --- train positions --------------------------------------------------------------------

OUTCOMES = ("line string, station_id int, topic string, partition int, offset long, timestamp timestamp, kind string, step int, "
            "outcome string, train_a string, status_a string, train_b string, status_b string, entries long")
_OUTCOME = Row(*(f.split()[0] for f in OUTCOMES.split(",")))
_STATION = "train_a string, status_a string, train_b string, status_b string, entries long"
_ORDER = ("timestamp", "rank", "topic", "partition", "offset", "step")


class _Station(Ordered):
    """A station of a line: unknown until it is registered, then two train slots and a count."""

    def open(self, handle) -> None:
        self.state = handle.getValueState("station", _STATION)

    def load(self, key):
        kept = self.state.get()  # one call to the state store: None when the key has no state
        return None if kept is None else tuple(kept)

    def save(self, state) -> None:
        if state is not None:
            self.state.update(state)

    def apply(self, state, m):
        if m["kind"] == "station":
            outcome, state = "registered" if state is None else "reset", (None, None, None, None, 0)
        elif state is None:
            outcome = "unknown"
        elif m["kind"] == "count":
            outcome, state = "counted", (*state[:4], m["entries"])
        else:
            outcome = "applied" if m["step"] else "cleared"
            train = (m["train_id"], m["status"])
            state = (*train, *state[2:]) if m["kind"] == "a" else (*state[:2], *train, state[4])
        return state, _OUTCOME(m["line"], m["station_id"], m["topic"], m["partition"], m["offset"], m["timestamp"], m["kind"], m["step"],
                               outcome, *(state or (None,) * 5))


def message_outcomes(messages: DataFrame, wait: str | None = None) -> DataFrame:
    """What each message of ``transit.board_messages`` does, at the moment it is applied.

    One row for each change of a station: registered, reset (a repeated registration empties the
    station), applied (a train stands there), cleared (the slot a train left is emptied), counted,
    or unknown (the station is not registered yet: the message has no effect), with the
    station's slots and entries after it. The state is kept by line and station.
    """
    flat = messages.select("line", "station_id", "kind", "step", "station_name", "order", "train_id", "status", "entries", "at.*")
    if wait is not None:
        flat = flat.withColumn(TIME, F.col("timestamp")).withWatermark(TIME, wait)
    return _run(flat, ["line", "station_id"], _Station(flat.schema, _ORDER, wait is not None), OUTCOMES, wait is not None)


# --- current window values --------------------------------------------------------------

class _Panes(Ordered):
    """The sums of a key's newest panes, one hop long each, as a ring that moves with time."""

    def __init__(self, rows, order, held, key: str, value: str, hop: int, hops: int, late: int):
        super().__init__(rows, order, held)
        self.key, self.value, self.hop, self.hops, self.kept = key, value, hop, hops, hops + late
        self.others = [c for c in self.names if c != TIME]
        self.out = Row(*self.others, TIME, "current", "oldest")

    def open(self, handle) -> None:
        self.ring = handle.getValueState("panes", "newest long, sums array<long>")

    def load(self, key):
        kept = self.ring.get()
        return None if kept is None else (kept[0], list(kept[1]))

    def save(self, state) -> None:
        if state is not None:
            self.ring.update(state)

    def apply(self, state, e):
        pane = int(e[TIME].timestamp() // self.hop)
        newest, sums = state or (pane, [0])
        if pane > newest:
            sums = ([0] * min(pane - newest, self.kept) + sums)[:self.kept]
            newest = pane
        back = newest - pane
        if back >= self.kept:
            return (newest, sums), self.out(*(e[c] for c in self.others), e[TIME], None, None)
        sums += [0] * (back + 1 - len(sums))
        sums[back] += e[self.value] or 0
        # The newest window with the event starts with its pane, the oldest one ends with it.
        return (newest, sums), self.out(*(e[c] for c in self.others), e[TIME],
                                        sum(sums[max(0, back - self.hops + 1):back + 1]), sum(sums[back:back + self.hops]))


def current_values(events: DataFrame, key: str, value: str, order: Sequence[str], hop: int, hops: int = 1,
                   late: int | None = None, wait: str | None = None) -> DataFrame:
    """Each event with the value of its windows when it has been added.

    ``events`` has its time in ``_time``, whole-number ``value`` and the columns of ``order``. Windows
    are ``hops`` panes of ``hop`` seconds long and one starts with each pane. ``current`` is
    the sum of the newest window that holds the event, ``oldest`` of the oldest one; with one
    hop, tumbling windows, they are the same. State is a ring of ``hops`` + ``late`` panes a key; an event
    further behind its key's newest is not added and has nulls. ``wait`` orders events
    across micro-batches.
    """
    rows = events if wait is None else events.withWatermark(TIME, wait)
    out = T.StructType([*(f for f in events.schema if f.name != TIME), events.schema[TIME],
                        T.StructField("current", T.LongType()), T.StructField("oldest", T.LongType())])
    processor = _Panes(rows.schema, [TIME, *order], wait is not None, key, value, hop, hops, hops if late is None else late)
    return _run(rows, [key], processor, out, wait is not None)


# --- counts over a table ----------------------------------------------------------------

class _Replaced(Ordered):
    """The newest row of a record key: what it replaces is taken back."""

    def __init__(self, rows, order, group: str):
        super().__init__(rows, order, False)
        self.group, self.out = group, Row(group, "delta")

    def open(self, handle) -> None:
        fields = [self.rows[c] for c in (*self.order, self.group)]
        self.newest = handle.getValueState("newest", T.StructType([T.StructField(f"f{i}", f.dataType) for i, f in enumerate(fields)]))

    def load(self, key):
        kept = self.newest.get()
        return None if kept is None else tuple(kept)

    def save(self, state) -> None:
        self.newest.update(state)

    def _in_order(self, key, rows) -> Iterator[Row]:
        before = self.load(key)
        row = max(rows, key=lambda r: _sort_key(r, self.order))
        now = tuple(row[c] for c in (*self.order, self.group))
        rank = lambda values: [(v is not None, v) for v in values[:-1]]
        if before is not None and rank(now) <= rank(before):
            return
        self.save(now)
        if before is None or before[-1] != now[-1]:
            if before is not None and before[-1] is not None:
                yield self.out(before[-1], -1)
            if now[-1] is not None:
                yield self.out(now[-1], 1)


class _Count(StatefulProcessor):
    """A group's running count; ``change`` numbers its rows."""

    def __init__(self, group: str):
        self.out = Row(group, "count", "change")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("count", "count long, change long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        count, change = self.kept.get() or (0, 0)
        delta = sum(r["delta"] for r in rows)
        if delta:
            self.kept.update((count + delta, change + 1))
            yield self.out(key[0], count + delta, change + 1)

    def close(self) -> None:
        pass


def running_table_count(rows: DataFrame, record_key: Sequence[str], order: Sequence[str], group: str) -> DataFrame:
    """Count over a table on a stream: (group, count, change), a row for each change of a count.

    A later row of a record key replaces the earlier one: the group it had loses one, the new
    one gains one; rows that come out of order change nothing. What the keys of a task change is
    summed by group before it is dealt, so that a group which many keys join or leave gets one
    row from each task. A null group counts nowhere. ``latest_counts`` gives the counts as they stand.
    """
    kind = rows.schema[group].dataType.simpleString()
    used = rows.select(*dict.fromkeys((*record_key, *order, group)))
    changes = _run(used, record_key, _Replaced(used.schema, order, group), f"`{group}` {kind}, delta long")

    def summed(frames):
        sums: dict = {}
        for frame in frames:
            for name, delta in zip(frame.column(group).to_pylist(), frame.column("delta").to_pylist(), strict=True):
                sums[name] = sums.get(name, 0) + delta
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), frame.schema.field(group).type), pa.array(list(sums.values()), pa.int64())],
                                             [group, "delta"])

    return _run(changes.mapInArrow(summed, changes.schema), [group], _Count(group), f"`{group}` {kind}, count long, change long")


def latest_counts(changes: DataFrame, group: str, name: str = "count") -> DataFrame:
    """The counts that the rows of ``running_table_count`` lead to; groups that nobody is left in have none."""
    return latest_by_key(changes, [group], ["change"]).where("count > 0").select(group, F.col("count").alias(name))
