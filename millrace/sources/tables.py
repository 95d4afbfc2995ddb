"""The star-schema and event tables, as tables and as topics.

The programs of this library read broker records. The functions here turn rows of the
given tables into such records, one record per row, so that every program can run over
whole tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .topics import as_topic

TEXT_TIME = "MMM d, yyyy, h:mm:ss a"


# A session may set this to deal each table out over so many partitions when it is read;
# the bench does, because its tables are one file each.
PARTITIONS = "spark.millrace.table.partitions"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    partitions = spark.conf.get(PARTITIONS, None)
    return df.repartition(int(partitions)) if partitions else df


def table_stream(spark: SparkSession, folder: str, name: str, max_files: int = 1000) -> DataFrame:
    """The files of a table as a stream."""
    schema = table(spark, folder, name).schema
    # Written as a pattern because a stream takes a folder or a pattern, not a single file.
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", str(max_files))
            .parquet(f"{folder}/{name}[.]parquet"))


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(name) for name, c in fields.items()]))


def user_email(user: Column) -> Column:
    return F.concat(F.lit("user"), user.cast("string"), F.lit("@test.com"))


def deposit_records(orders: DataFrame) -> DataFrame:
    value = _json(accountNumber=_text("o_custkey"), amount=F.col("o_totalprice"),
                  dateAndTime=F.date_format("o_orderdate", TEXT_TIME))
    return as_topic(orders, "bank-deposits", F.col("o_orderkey"), value, F.col("o_orderdate"), F.col("o_orderkey"))


def _customer_json() -> Column:
    # Ten customers share an e-mail address.
    return _json(customerName=F.col("c_name"), email=user_email(F.expr("c_custkey DIV 10")),
                 phone=F.lpad(_text("c_custkey"), 10, "0"),
                 birthDay=F.concat(F.lit("19"), F.lpad(_text(F.col("c_custkey") % 100), 2, "0"), F.lit("-01-02")),
                 accountNumber=_text("c_custkey"), location=F.concat(F.lit("NATION_"), _text("c_nationkey")))


def customer_records(customer: DataFrame) -> DataFrame:
    return as_topic(customer, "bank-customers", F.col("c_custkey"), _customer_json(), offset=F.col("c_custkey"))


def bank_withdrawal_records(lineitem: DataFrame) -> DataFrame:
    value = _json(accountNumber=_text("l_suppkey"), amount=F.col("l_extendedprice"),
                  dateAndTime=F.date_format("l_shipdate", TEXT_TIME), transactionId=F.col("l_orderkey"))
    return as_topic(lineitem, "bank-withdrawals", F.col("l_orderkey"), value, F.col("l_shipdate"))


def atm_withdrawal_records(orders: DataFrame) -> DataFrame:
    value = _json(transactionDate=F.date_format("o_orderdate", TEXT_TIME), transactionId=F.col("o_orderkey"),
                  atmLocation=F.col("o_orderpriority"))
    return as_topic(orders, "atm-withdrawals", F.col("o_orderkey"), value, F.col("o_orderdate"))


def vehicle_status_records(lineitem: DataFrame) -> DataFrame:
    value = _json(truckNumber=_text("l_orderkey"), destination=F.col("l_returnflag"),
                  milesFromShop=F.col("l_quantity").cast("int"), odometerReading=F.col("l_partkey"))
    return as_topic(lineitem, "vehicle-status", F.col("l_orderkey"), value, F.col("l_shipdate"))


def check_in_records(orders: DataFrame) -> DataFrame:
    value = _json(reservationId=_text("o_orderkey"), locationName=F.col("o_orderpriority"),
                  truckNumber=_text("o_orderkey"), status=F.col("o_orderstatus"))
    return as_topic(orders, "check-in", F.col("o_orderkey"), value, F.col("o_orderdate"))


def _feed_record(df: DataFrame, kind: str, entity: Column, offset: Column) -> DataFrame:
    entry = F.struct(F.base64(entity.cast("binary")).alias("element"), F.lit(0.0).alias("score"))
    value = _json(key=F.base64(F.lit(kind).cast("binary")), existType=F.lit("NONE"), Ch=F.lit(False),
                  Incr=F.lit(False), zSetEntries=F.array(entry))
    return as_topic(df, "redis-server", F.lit(kind), value, offset=offset)


def feed_records(orders: DataFrame, lineitem: DataFrame, customer: DataFrame, events: DataFrame) -> DataFrame:
    """Change feed of reservations (orders), payments (items), customers and visited places (events)."""
    reservations = _json(
        reservationId=_text("o_orderkey"), customerId=_text("o_custkey"),
        customerName=F.concat(F.lit("Customer#"), _text("o_custkey")), truckNumber=_text(F.col("o_orderkey") % 1000),
        reservationDate=F.date_format("o_orderdate", "yyyy-MM-dd"), checkInStatus=F.col("o_orderstatus"),
        origin=F.col("o_orderpriority"), destination=F.lit("NATION_0"))
    payments = _json(
        reservationId=_text("l_orderkey"), customerName=F.concat(F.lit("Supplier#"), _text("l_suppkey")),
        date=F.date_format("l_shipdate", "yyyy-MM-dd"), amount=_text(F.col("l_quantity").cast("int")))
    places = _json(accountNumber=_text("user_id"), location=F.concat(F.lit("NATION_"), _text(F.col("event_id") % 25)))
    parts = [
        _feed_record(orders, "Reservation", reservations, F.col("o_orderkey")),
        _feed_record(lineitem, "Payment", payments, F.col("l_orderkey")),
        _feed_record(customer, "Customer", _customer_json(), F.col("c_custkey")),
        _feed_record(events, "CustomerLocation", places, F.col("event_id")),
    ]
    return reduce(DataFrame.unionByName, parts)


def risk_records(events: DataFrame) -> DataFrame:
    value = _json(customer=user_email(F.col("user_id")), score=F.col("value"),
                  riskDate=F.date_format("ts", "yyyy-MM-dd"))
    return as_topic(events, "risk-events", F.col("user_id"), value, F.col("ts"), F.col("event_id"))


def event_number() -> Column:
    return F.floor(F.col("value")).cast("long")


def event_uri() -> Column:
    return F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), _text("user_id"))


def event_time_text() -> Column:
    return F.date_format("ts", "yyyy-MM-dd HH:mm:ss")


def click_records(events: DataFrame) -> DataFrame:
    value = _json(email=user_email(F.col("user_id")), timestamp=event_time_text(), uri=event_uri(),
                  number=event_number())
    return _click_topic(events, value)


def _click_topic(events, value):
    return as_topic(events, "clicks", F.col("user_id"), value, F.col("ts"), F.col("event_id"))


def mixed_click_records(events: DataFrame) -> DataFrame:
    """Clicks of which some name the e-mail otherwise, some have it null, some hold text
    for the number and some are cut off."""
    email, when, uri = user_email(F.col("user_id")), event_time_text(), event_uri()
    number, turn = event_number(), F.col("event_id")
    good = _json(email=email, timestamp=when, uri=uri, number=number)
    value = (
        F.when(turn % 7 == 0, _json(user_email=email, timestamp=when, uri=uri, number=number))
        .when(turn % 11 == 0, F.concat(F.lit('{"email":null,"timestamp":"'), when, F.lit('","uri":"'), uri,
                                       F.lit('","number":'), number.cast("string"), F.lit("}")))
        .when(turn % 13 == 0, _json(email=email, timestamp=when, uri=uri, number=F.lit("many")))
        .when(turn % 17 == 0, F.concat(F.lit('{"email":'), F.col("event_type")))
        .otherwise(good))
    return _click_topic(events, value)


def attributed_clicks(events: DataFrame) -> DataFrame:
    attribute = F.struct(F.col("event_type").alias("element"), F.col("props").alias("content"))
    return events.select(
        user_email(F.col("user_id")).alias("email"), event_time_text().alias("timestamp"),
        event_uri().alias("uri"), event_number().cast("int").alias("number"),
        F.create_map(F.lit("first"), attribute, F.concat(F.lit("k"), event_k().cast("string")), attribute)
        .alias("attributes"))


def attributed_click_records(events: DataFrame) -> DataFrame:
    rows = attributed_clicks(events)
    return as_topic(rows, "clicks", F.col("uri"), F.to_json(F.struct(*rows.columns)))


def event_k() -> Column:
    """The number in an event's properties."""
    return F.get_json_object("props", "$.k").cast("int")


def is_type(*kinds: str) -> Column:
    return F.col("event_type").isin(*kinds)


def station_records(events: DataFrame, topic: str) -> DataFrame:
    """Each event registers a stop: the user is the station, the type sets its flags."""
    value = _json(
        stop_id=F.col("event_id") % 1_000_000, direction_id=F.lit("E"), stop_name=F.concat(F.lit("Stop "), _text("event_id")),
        station_name=F.concat(F.lit("Station "), _text("user_id")),
        station_descriptive_name=F.concat(F.lit("Station "), _text("user_id"), F.lit(" Line")),
        station_id=F.col("user_id"), order=event_k(), red=is_type("click", "purchase"),
        blue=is_type("view"), green=is_type("purchase", "signup"))
    return as_topic(events, topic, F.col("user_id"), value, F.col("ts"), F.col("event_id"))


def turnstile_records(events: DataFrame, topic: str) -> DataFrame:
    value = _json(station_id=F.col("user_id"), station_name=F.concat(F.lit("Station "), _text("user_id")),
                  line=F.col("event_type"))
    return as_topic(events, topic, F.unix_millis(F.col("ts").cast("timestamp")), value, F.col("ts"), F.col("event_id"))


def board_line(number: Column) -> Column:
    """One of the three lines or an unknown one, by a number."""
    return F.element_at(F.array(*[F.lit(c) for c in ("blue", "green", "red", "brown")]), (number % 4 + 1).cast("int"))


def board_records(events: DataFrame, names) -> DataFrame:
    """All topics of the status board in one frame, one record per event.

    Sign-ups register the user as a station, views and clicks are arrivals, purchases are
    entry counts and errors are weather reports. Every ninth arrival names no station.
    """
    number, k = F.col("event_id"), event_k()
    station = _json(station_id=F.col("user_id"), station_name=F.concat(F.lit("Station "), _text("user_id")),
                    order=k, line=board_line(number))
    arrival = _json(
        station_id=F.when(number % 9 != 0, F.col("user_id")), train_id=F.concat(F.lit("T"), F.lpad(_text(number % 1000), 3, "0")),
        direction=F.when(number % 2 == 0, F.lit("a")).otherwise(F.lit("b")), line=board_line(number + k),
        train_status=F.when(k % 3 == 0, F.lit("out_of_service")).otherwise(F.lit("in_service")),
        prev_station_id=F.when(k % 10 != 0, k),
        prev_direction=F.when(k % 15 != 1, F.when(number % 3 == 0, F.lit("b")).otherwise(F.lit("a"))))
    count = _json(STATION_ID=F.col("user_id"), COUNT=k)
    weather = _json(temperature=F.col("value"), status=F.when(k % 2 == 0, F.lit("partly_cloudy")).otherwise(F.lit("windy")))
    topic = (F.when(is_type("signup"), F.lit(names.station_table))
             .when(is_type("view", "click"), names.arrival_topic(F.concat(F.lit("Station "), _text("user_id"))))
             .when(is_type("purchase"), F.lit(names.summary)).otherwise(F.lit(names.weather)))
    value = (F.when(is_type("signup"), station).when(is_type("view", "click"), arrival)
             .when(is_type("purchase"), count).otherwise(weather))
    return as_topic(events, topic, F.col("user_id"), value, F.col("ts"), F.col("event_id"))


def customer_stations(customer: DataFrame) -> DataFrame:
    """Two stops per station; the nation decides the lines, and some names repeat."""
    nation = F.col("c_nationkey")
    station = F.expr("CAST(c_custkey DIV 2 AS INT)")
    return customer.select(
        F.col("c_custkey").cast("int").alias("stop_id"), station.alias("station_id"),
        F.concat(F.lit("Station "), _text(F.when(station % 10 == 9, station - 1).otherwise(station)))
        .alias("station_name"),
        (F.col("c_custkey") % 997).cast("int").alias("order"),
        (nation % 3 == 0).alias("red"), (nation % 3 == 1).alias("blue"), (nation % 2 == 0).alias("green"))


def supplier_ridership(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.col("s_suppkey").cast("int").alias("station_id"), F.abs("s_acctbal").alias("avg_weekday_rides"),
        (F.abs("s_acctbal") / 2).alias("avg_saturday_rides"), (F.abs("s_acctbal") / 4).alias("avg_sunday-holiday_rides"))


def event_curve(events: DataFrame) -> DataFrame:
    """Share of the events in each hour of the day."""
    hours = events.groupBy(F.hour("ts").alias("hour")).count()
    # At most 24 rows reach the window.
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))
    return hours.select("hour", (F.col("count") / total).alias("ridership_ratio"))
