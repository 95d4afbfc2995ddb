"""Expected entries per station from daily riders and an hourly curve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import lookup_first
from .latest import first_by_key

# Fixed value: the divisor for a step of five minutes.
FIVE_MINUTE_STEPS = 300
# Column of the daily riders for each kind of day.
DAY_COLUMNS = {"weekday": "avg_weekday_rides", "saturday": "avg_saturday_rides",
               "sunday": "avg_sunday-holiday_rides"}


def daily_riders(kind: Column) -> Column:
    """Riders of the given kind of day, halves rounded to even."""
    return F.coalesce(*[F.when(kind == day, F.bround(F.col(f"`{column}`"), 0)) for day, column in DAY_COLUMNS.items()])


def entries(riders: Column, ratio: Column, steps: int) -> Column:
    return F.greatest(F.floor(riders * ratio / F.lit(steps)), F.lit(0)).cast("long")


def hour_curve(curve: DataFrame) -> DataFrame:
    """First ratio of each hour 0 to 23."""
    return first_by_key(curve.where(F.col("hour").between(0, 23)), ["hour"], ["ridership_ratio"])


def expected_entries(seed: DataFrame, curve: DataFrame, steps: int = FIVE_MINUTE_STEPS) -> DataFrame:
    """Entries per station, kind of day and hour."""
    hours = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    days = F.explode(F.array(*[F.lit(day) for day in DAY_COLUMNS])).alias("day")
    spread = seed.select("*", days).select("*", hours)
    # The curve has at most 24 rows, so it is safe to send to every task.
    return spread.join(F.broadcast(hour_curve(curve)), "hour").select(
        "station_id", "day", "hour",
        entries(daily_riders(F.col("day")), F.col("ridership_ratio"), steps).alias("entries"))


def entries_at(moments: DataFrame, seed: DataFrame, curve: DataFrame, time: str = "ts",
               steps: int = FIVE_MINUTE_STEPS) -> DataFrame:
    """Entries expected in the step at each ``(station_id, time)``; null for an unknown station or hour."""
    number = F.dayofweek(time)
    kind = F.when(number == 1, F.lit("sunday")).when(number == 7, F.lit("saturday")).otherwise(F.lit("weekday"))
    timed = moments.withColumn("hour", F.hour(time)).join(F.broadcast(hour_curve(curve)), "hour", "left")
    found = lookup_first(timed, seed.select("station_id", *[F.col(f"`{c}`") for c in DAY_COLUMNS.values()]),
                         ["station_id"], ["avg_weekday_rides"], "left")
    expected = entries(daily_riders(kind), F.col("ridership_ratio"), steps)
    known = F.col("ridership_ratio").isNotNull() & daily_riders(kind).isNotNull()
    return found.select(*moments.columns, F.when(known, expected).alias("entries"))
