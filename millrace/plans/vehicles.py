"""Vehicle topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.decode import as_text, flatten_json, json_value
from ..operators.joins import Split, inner_join, split_for
from ..schemas import CHECK_IN, VEHICLE_STATUS, VEHICLE_STATUS_TEXT


def fuel_level(records: DataFrame) -> DataFrame:
    return as_text(records)


def gear_position(records: DataFrame) -> DataFrame:
    """Truck id and gear as text."""
    return as_text(records, key="truckId", value="gearPosition")


def vehicle_status(records: DataFrame, schema: StructType = VEHICLE_STATUS) -> DataFrame:
    return flatten_json(records, schema)


def vehicle_check_in(status_records: DataFrame, check_in_records: DataFrame,
                     schema: StructType = VEHICLE_STATUS, split: int | Split | None = None) -> DataFrame:
    """Every status of a truck with every check-in of the same truck."""
    status_records, split, keep = split_for(status_records, split)
    status = flatten_json(status_records, schema, keep=keep).withColumnRenamed("truckNumber", "statusTruckNumber")
    check_in = flatten_json(check_in_records, CHECK_IN).select(
        "reservationId", "locationName", F.col("truckNumber").alias("checkinTruckNumber"), "status")
    return inner_join(status, check_in, "statusTruckNumber", "checkinTruckNumber",
                      split=split, split_by=keep)


def vehicle_check_in_topic(status_records: DataFrame, check_in_records: DataFrame, split: int | Split | None = None) -> DataFrame:
    """``vehicle_check_in`` with all fields as text, as JSON keyed by the truck."""
    return json_value(vehicle_check_in(status_records, check_in_records, VEHICLE_STATUS_TEXT, split), "statusTruckNumber")
