"""Record layouts. Nothing is inferred: every topic and file has a declared schema.

The field names and types here are fixed values: they must equal what producers write.
Some topics are declared twice, once typed and once as text, because programs read them
both ways and the results differ (a JSON number read as text keeps its literal digits).
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import types as T

STRING = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
FLOAT = T.FloatType()
DOUBLE = T.DoubleType()
BOOLEAN = T.BooleanType()
BINARY = T.BinaryType()
TIMESTAMP = T.TimestampType()


def record(**fields: T.DataType) -> T.StructType:
    """A struct of nullable fields in the given order."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def text_record(*names: str) -> T.StructType:
    return record(**{name: STRING for name in names})


# Broker record, as the Kafka source delivers it.
ENVELOPE = record(
    key=BINARY, value=BINARY, topic=STRING, partition=INT, offset=LONG,
    timestamp=TIMESTAMP, timestampType=INT,
)

# Vehicles
VEHICLE_STATUS = record(truckNumber=STRING, destination=STRING, milesFromShop=INT, odometerReading=INT)
VEHICLE_STATUS_TEXT = text_record("truckNumber", "destination", "milesFromShop", "odometerReading")
CHECK_IN = text_record("reservationId", "locationName", "truckNumber", "status")

# Bank
BANK_DEPOSIT = record(accountNumber=STRING, amount=FLOAT, dateAndTime=STRING)
BANK_DEPOSIT_TEXT = text_record("accountNumber", "amount", "dateAndTime")
BANK_CUSTOMER = text_record("customerName", "email", "phone", "birthDay", "accountNumber", "location")
BANK_WITHDRAWAL = text_record("accountNumber", "amount", "dateAndTime", "transactionId")
ATM_WITHDRAWAL = text_record("transactionDate", "transactionId", "atmLocation")

# Change feed of a key-value store: the entity is base64 JSON inside the first set entry.
CHANGE_FEED = record(
    key=STRING, value=STRING, expiredType=STRING, expiredValue=STRING, existType=STRING,
    ch=STRING, incr=BOOLEAN, zSetEntries=T.ArrayType(text_record("element", "score")),
)
RESERVATION = text_record(
    "reservationId", "customerId", "customerName", "truckNumber", "reservationDate",
    "checkInStatus", "origin", "destination",
)
CUSTOMER_LOCATION = text_record("accountNumber", "location")
PAYMENT = text_record("reservationId", "customerName", "date", "amount")
FITNESS_CUSTOMER = text_record("customerName", "email", "phone", "birthDay")
RISK_EVENT = record(customer=STRING, score=FLOAT, riskDate=STRING)

# Clicks and purchases
CLICK_PLAIN = text_record("email", "timestamp", "uri")
CLICK = record(email=STRING, timestamp=STRING, uri=STRING, number=LONG)
SCORED_CLICK = record(email=STRING, timestamp=STRING, uri=STRING, number=LONG, score=LONG)
SANITIZED_CLICK = record(timestamp=STRING, uri=STRING, number=LONG)
ATTRIBUTED_CLICK = record(
    email=STRING, timestamp=STRING, uri=STRING, number=INT,
    attributes=T.MapType(STRING, text_record("element", "content")),
)
PURCHASE = record(username=STRING, currency=STRING, amount=INT)

# Transit
STATION = record(
    stop_id=INT, direction_id=STRING, stop_name=STRING, station_name=STRING,
    station_descriptive_name=STRING, station_id=INT, order=INT,
    red=BOOLEAN, blue=BOOLEAN, green=BOOLEAN,
)
STATION_ROW = record(station_id=INT, station_name=STRING, order=INT, line=STRING)
ARRIVAL = record(
    station_id=INT, train_id=STRING, direction=STRING, line=STRING, train_status=STRING,
    prev_station_id=INT, prev_direction=STRING,
)
TURNSTILE = record(station_id=INT, station_name=STRING, line=STRING)
WEATHER = record(temperature=FLOAT, status=STRING)
MESSAGE_KEY = record(timestamp=LONG)
ENTRY_SUMMARY = record(STATION_ID=INT, COUNT=LONG)
RIDERSHIP_SEED = record(**{
    "station_id": INT, "stationame": STRING, "month_beginning": STRING,
    "avg_weekday_rides": DOUBLE, "avg_saturday_rides": DOUBLE,
    "avg_sunday-holiday_rides": DOUBLE, "monthtotal": LONG,
})
RIDERSHIP_CURVE = record(hour=INT, ridership_ratio=DOUBLE)

# Allowed values of enumerated text fields.
LINES = ("blue", "green", "red")
TRAIN_STATUSES = ("out_of_service", "in_service", "broken_down")
WEATHER_STATUSES = ("sunny", "partly_cloudy", "cloudy", "windy", "precipitation")


_AVRO_NAMES = {STRING: "string", INT: "int", LONG: "long", FLOAT: "float", DOUBLE: "double",
               BOOLEAN: "boolean", BINARY: "bytes"}
_SPARK_TYPES = {name: kind for kind, name in _AVRO_NAMES.items()}


def _avro_type(kind: T.DataType, name: str) -> object:
    if isinstance(kind, T.StructType):
        return {"type": "record", "name": name, "fields": [
            {"name": f.name, "type": _avro_type(f.dataType, f"{name}_{f.name}")} for f in kind]}
    if isinstance(kind, T.MapType):
        return {"type": "map", "values": _avro_type(kind.valueType, f"{name}_value")}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": _avro_type(kind.elementType, f"{name}_item")}
    return _AVRO_NAMES[kind]


def avro_schema(name: str, schema: T.StructType, optional: tuple[str, ...] = (),
                namespace: str | None = None) -> str:
    """Avro record schema of ``schema``; ``optional`` fields become unions with null."""
    fields = []
    for field in schema:
        kind = _avro_type(field.dataType, f"{name}_{field.name}".replace(".", "_"))
        fields.append({"name": field.name, "type": ["null", kind] if field.name in optional else kind})
    head = {"namespace": namespace} if namespace else {}
    return json.dumps({**head, "type": "record", "name": name, "fields": fields})


def spark_schema(avro: str | Mapping) -> T.StructType:
    """The StructType an Avro record schema describes; unions with null are nullable."""
    declared = json.loads(avro) if isinstance(avro, str) else avro
    kind, _ = _spark_type(declared)
    return kind


def _spark_type(declared: object) -> tuple[T.DataType, bool]:
    if isinstance(declared, list):
        (inner,) = [branch for branch in declared if branch != "null"]
        return _spark_type(inner)[0], "null" in declared
    if isinstance(declared, str):
        return _SPARK_TYPES[declared], False
    if declared["type"] == "record":
        fields = []
        for field in declared["fields"]:
            kind, nullable = _spark_type(field["type"])
            fields.append(T.StructField(field["name"], kind, nullable))
        return T.StructType(fields), False
    if declared["type"] == "map":
        kind, nullable = _spark_type(declared["values"])
        return T.MapType(STRING, kind, nullable), False
    if declared["type"] == "array":
        kind, nullable = _spark_type(declared["items"])
        return T.ArrayType(kind, nullable), False
    return _spark_type(declared["type"])


ARRIVAL_AVRO = avro_schema("arrival.value", ARRIVAL, optional=("prev_station_id", "prev_direction"))
TURNSTILE_AVRO = avro_schema("turnstile.value", TURNSTILE)
WEATHER_AVRO = avro_schema("weather.value", WEATHER)
CLICK_AVRO = avro_schema("click_event", record(email=STRING, timestamp=STRING, uri=STRING, number=INT))
ATTRIBUTED_CLICK_AVRO = avro_schema("click_event", ATTRIBUTED_CLICK)


def key_avro(name: str) -> str:
    return avro_schema(name, MESSAGE_KEY)
