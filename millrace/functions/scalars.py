"""Scalar rules, all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Replacements applied one after the other to the lower-cased name.
SLUG_RULES = (("/", "_and_"), (" ", "_"), ("-", "_"), ("'", ""))
# Order in which a station's color flags decide its line.
LINE_PRECEDENCE = ("red", "green", "blue")
# Display colors.
COLOR_CODES = {"blue": "#1E90FF", "red": "#DC143C", "green": "#32CD32"}
DEFAULT_COLOR_CODE = "0xFFFFFF"
# What the board shows before anything has arrived.
NO_TRAIN = "---"
DEFAULT_TEMPERATURE = 70.0
DEFAULT_WEATHER = "sunny"
# Text time formats found in messages.
TIME_FORMATS = ("MMM d, yyyy, h:mm:ss a", "MMM d, yyyy h:mm:ss a")


def slug(name: Column) -> Column:
    result = F.lower(name)
    for old, new in SLUG_RULES:
        result = F.replace(result, F.lit(old), F.lit(new))
    return result


def topic_name(name: Column, prefix: str, suffix: str) -> Column:
    """Per-station topic: prefix, slug of the station name, suffix."""
    return F.concat(F.lit(prefix), slug(name), F.lit(suffix))


def line_color(flags: dict[str, Column] | None = None) -> Column:
    """Line of a station from its flags; null when none is set."""
    flags = flags or {color: F.col(color) for color in LINE_PRECEDENCE}
    return F.coalesce(*[F.when(flags[color], F.lit(color)) for color in LINE_PRECEDENCE])


def color_code(line: Column) -> Column:
    codes = [F.when(line == color, F.lit(code)) for color, code in COLOR_CODES.items()]
    return F.coalesce(*codes, F.lit(DEFAULT_COLOR_CODE))


def status_text(status: Column) -> Column:
    return F.replace(status, F.lit("_"), F.lit(" "))


def title_text(status: Column) -> Column:
    return F.initcap(status_text(status))


def whole_number(value: Column) -> Column:
    """Drop the fraction, toward zero."""
    return value.cast("int")


def or_default(value: Column, default: object) -> Column:
    return F.coalesce(value, F.lit(default))


def epoch_millis(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp, rounded to the nearest as event keys are."""
    return F.round(F.unix_micros(ts) / F.lit(1000)).cast("long")


def from_epoch_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def random_score(*identity: Column, seed: int = 0) -> Column:
    """A score from 1 to 100.

    With ``identity`` the score is a hash of those columns, so a task that is run again
    after a lost executor gives each record the same score; without it, ``rand``.
    """
    if identity:
        digest = F.md5(F.concat_ws("/", F.lit(str(seed)), *[c.cast("string") for c in identity]).cast("binary"))
        return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100 + 1).cast("int")
    return (F.floor(F.rand(seed) * 100) + 1).cast("int")


def parse_time(text: Column) -> Column:
    """Timestamp of a message's text time, null when no known format fits."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in TIME_FORMATS])
