"""Click events.

The windowed programs use the broker's record time; pass ``time`` to use another column
carried along with ``keep``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.decode import (as_text, counted_rejects, flatten_json, json_value, judged_records, map_entries, pretty_json,
                                required_faults, required_split, typed_split)
from ..functions.scalars import random_score
from ..operators.aggregates import current_window, current_window_table, running_sum_table, windowed_sum, windowed_sum_table
from ..operators.filters import at_least
from ..operators.keyed import KeyedTable
from ..schemas import ATTRIBUTED_CLICK, CLICK, CLICK_PLAIN, SANITIZED_CLICK
from ..streaming.stateful import current_values

# Popularity bound, window length and hop.
POPULAR = 100
TUMBLING_SECONDS, HOPPING_SECONDS, HOP_SECONDS = 10, 60, 10
TUMBLING, HOPPING, HOP = (f"{n} seconds" for n in (TUMBLING_SECONDS, HOPPING_SECONDS, HOP_SECONDS))


def click_text(records: DataFrame) -> DataFrame:
    """Clicks as they came."""
    return as_text(records).select("value")


def click_events(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Clicks that pass record validation."""
    judged = judged_records(records, CLICK, keep=keep)
    return counted_rejects(judged, "rejected_clicks").select("_record.*", *keep)


def invalid_clicks(records: DataFrame) -> DataFrame:
    return typed_split(records, CLICK)[1]


def click_print(records: DataFrame) -> DataFrame:
    """Valid clicks as indented JSON."""
    return pretty_json(click_events(records))


def sanitized_clicks(records: DataFrame) -> DataFrame:
    """Clicks without the e-mail address, as JSON keyed by uri."""
    return json_value(flatten_json(records, CLICK).select(*SANITIZED_CLICK.names), "uri")


def popular_clicks(records: DataFrame, minimum: int = POPULAR) -> DataFrame:
    """Clicks whose number is at least ``minimum``, as JSON keyed by uri."""
    return json_value(at_least(flatten_json(records, CLICK), "number", minimum), "uri")


def score_clicks(clicks: DataFrame, identity: Sequence[str] = (), seed: int = 0) -> DataFrame:
    """Add a score from 1 to 100 to each click."""
    return clicks.withColumn("score", random_score(*[F.col(c) for c in identity], seed=seed))


def scored_clicks(records: DataFrame, seed: int = 0) -> DataFrame:
    """Scored clicks as JSON keyed by uri. The score follows from the record's place in its topic."""
    place = ("topic", "partition", "offset")
    scored = flatten_json(records, CLICK, keep=place).transform(score_clicks, place, seed)
    return json_value(scored.drop(*place), "uri")


def uri_sums(records: DataFrame) -> DataFrame:
    """Running sum of ``number`` per uri."""
    return uri_sums_table(records).rows()


def uri_sums_table(records: DataFrame) -> KeyedTable:
    return running_sum_table(flatten_json(records, CLICK), "uri", "number")


def tumbling_uri_sums(records: DataFrame, time: str = "timestamp", watermark: str | None = None) -> DataFrame:
    return _window_sums(records, time, TUMBLING, None, watermark)


def hopping_uri_sums(records: DataFrame, time: str = "timestamp", watermark: str | None = None) -> DataFrame:
    return _window_sums(records, time, HOPPING, HOP, watermark)


def _window_sums(records, time, size, slide, watermark):
    return windowed_sum(timed_clicks(records, time), "_time", "uri", "number", size, slide, watermark)


def tumbling_uri_sums_table(records: DataFrame, time: str = "timestamp", watermark: str | None = None) -> KeyedTable:
    return windowed_sum_table(timed_clicks(records, time), "_time", "uri", "number", TUMBLING, watermark=watermark)


def hopping_uri_sums_table(records: DataFrame, time: str = "timestamp") -> KeyedTable:
    return windowed_sum_table(timed_clicks(records, time), "_time", "uri", "number", HOPPING, HOP)


def timed_clicks(records: DataFrame, time: str = "timestamp", keep: Sequence[str] = ()) -> DataFrame:
    """Clicks with the record's time as ``_time``: the click has a text field of the same name."""
    return flatten_json(records.withColumn("_time", F.col(time)), CLICK, keep=["_time", *keep])


def current_tumbling(timed: DataFrame, wait: str | None = None) -> DataFrame:
    """Clicks of ``timed_clicks`` with ``offset``, each with its uri's sum in its window so far."""
    return current_values(timed, "uri", "number", ["offset"], TUMBLING_SECONDS, wait=wait)


def current_hopping(timed: DataFrame, wait: str | None = None) -> DataFrame:
    """The same for hopping windows, of which each click is in six: the newest and the oldest."""
    return current_values(timed, "uri", "number", ["offset"], HOP_SECONDS, HOPPING_SECONDS // HOP_SECONDS, wait=wait)


def current_uri_sums(windowed: DataFrame) -> DataFrame:
    """The newest window of each uri."""
    return current_window(windowed, "uri")


def current_uri_sums_table(records: DataFrame, time: str = "timestamp") -> KeyedTable:
    """The newest hopping window of each uri, from sums of one hop alone."""
    return current_window_table(timed_clicks(records, time), "_time", "uri", "number", HOPPING, HOP)


def required_clicks(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clicks that have all three keys, and the rest with the reason."""
    return required_split(records, CLICK_PLAIN, ("email", "uri", "timestamp"))


def judged_clicks(records: DataFrame) -> DataFrame:
    """All clicks in one pass, each with the first of the three keys it lacks, if any."""
    return judged_records(records, CLICK_PLAIN, faults=required_faults(("email", "uri", "timestamp")))


def typed_clicks(records: DataFrame) -> DataFrame:
    """All clicks in one pass, each with what record validation finds, if anything."""
    return judged_records(records, CLICK)


def click_attributes(records: DataFrame) -> DataFrame:
    """One row per attribute of a click."""
    return map_entries(flatten_json(records, ATTRIBUTED_CLICK), "attributes", ["email", "uri", "number"])
