"""Every operator and program, run over the whole given tables.

Each entry takes ``(spark, folder)``. Entries whose name starts with ``stream_`` run the
same functions as Structured Streaming queries over the table files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import decode, scalars
from ..operators import aggregates, filters, joins, latest, positions, ridership, topology
from ..schemas import (ATTRIBUTED_CLICK_AVRO, BANK_CUSTOMER, DOUBLE, ENTRY_SUMMARY, INT, LONG, PURCHASE, STATION_ROW, STRING, TURNSTILE,
                       record)
from ..session import fresh_folder
from ..sources import avro_files, files, growing, increments, tables, topics
from ..streaming import polling, run, sinks, stateful
from ..streaming.tables import current, keeper
from . import bank, change_feed, clicks, ingest, lines_of_text, risk, transit, vehicles

Query = Callable[[SparkSession, str], DataFrame]
TOPICS = transit.TransitTopics("org.example.")
# About half of the orders are above this.
HALF_OF_ORDERS = 250_000.0


_CATALOG: dict[str, Query] = {}


def query(function: Query) -> Query:
    _CATALOG[function.__name__] = function
    return function


def _t(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tables.table(spark, folder, name)


def _s(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tables.table_stream(spark, folder, name)


def _plain_time(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.withColumn(column, F.col(column).cast("timestamp_ntz"))
    return df


def _as_double(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("double"))


# --- text -------------------------------------------------------------------------------

@query
def letter_counts(spark, folder):
    return lines_of_text.letter_counts(_t(spark, folder, "documents"), "text")


@query
def line_letter_counts(spark, folder):
    """The texts written as text files and counted line by line."""
    path = fresh_folder(spark, "lines")
    _t(spark, folder, "documents").select("text").write.text(path)
    return lines_of_text.letter_counts(files.text_lines(spark, path))


# --- passing text through ---------------------------------------------------------------

def _event_props(events):
    return tables.as_topic(events, "events", F.col("user_id"), F.col("props"), F.col("ts"), F.col("event_id"))


@query
def fuel_level(spark, folder):
    return vehicles.fuel_level(_event_props(_t(spark, folder, "events")))


@query
def balance_updates(spark, folder):
    customer = _t(spark, folder, "customer")
    return bank.balance_updates(tables.as_topic(customer, "balance-updates", F.col("c_custkey"), F.col("c_name")))


@query
def gear_position(spark, folder):
    lineitem = _t(spark, folder, "lineitem")
    vehicles.gear_position(tables.as_topic(lineitem, "gear-position", F.col("l_suppkey"), F.col("l_returnflag"))) \
        .createOrReplaceTempView("gears_now")
    return spark.sql("SELECT truckId, gearPosition FROM gears_now")


@query
def atm_visits(spark, folder):
    orders = _t(spark, folder, "orders")
    bank.atm_visits(tables.as_topic(orders, "atm-visits", F.col("o_custkey"), F.col("o_orderpriority"))) \
        .createOrReplaceTempView("machine_visits")
    return spark.sql("SELECT key, value FROM machine_visits")


# --- typed JSON -------------------------------------------------------------------------

@query
def vehicle_status(spark, folder):
    return vehicles.vehicle_status(tables.vehicle_status_records(_t(spark, folder, "lineitem")))


@query
def bank_deposits(spark, folder):
    return bank.bank_deposits(tables.deposit_records(_t(spark, folder, "orders")))


@query
def json_flatten(spark, folder):
    return decode.flatten_json(_t(spark, folder, "events"), record(k=INT), "props", ["event_id"])


@query
def purchase_json(spark, folder):
    """Rows as JSON with the purchase layout, null amounts written out."""
    events = _t(spark, folder, "events")
    rows = events.select(
        tables.user_email(F.col("user_id")).alias("username"), F.lit("USD").alias("currency"),
        F.when(tables.is_type("purchase"), tables.event_k()).alias("amount"), "event_id")
    return decode.json_value(rows, "event_id", PURCHASE.names, nulls=True)


# --- joins ------------------------------------------------------------------------------

@query
def large_deposit_join(spark, folder):
    joined = bank.large_deposits(tables.deposit_records(_t(spark, folder, "orders")),
                                 tables.customer_records(_t(spark, folder, "customer")), HALF_OF_ORDERS)
    return _as_double(joined, "amount")


@query
def large_deposit_join_split(spark, folder):
    """The same with each account's deposits spread over four groups."""
    joined = bank.large_deposits(tables.deposit_records(_t(spark, folder, "orders")),
                                 tables.customer_records(_t(spark, folder, "customer")), HALF_OF_ORDERS, split=4)
    return _as_double(joined, "amount")


@query
def vehicle_check_in(spark, folder):
    return vehicles.vehicle_check_in(tables.vehicle_status_records(_t(spark, folder, "lineitem")),
                                     tables.check_in_records(_t(spark, folder, "orders")))


@query
def vehicle_check_in_topic(spark, folder):
    return vehicles.vehicle_check_in_topic(tables.vehicle_status_records(_t(spark, folder, "lineitem")),
                                           tables.check_in_records(_t(spark, folder, "orders")))


@query
def withdrawal_location_topic(spark, folder):
    return bank.withdrawal_location_topic(tables.bank_withdrawal_records(_t(spark, folder, "lineitem")),
                                          tables.atm_withdrawal_records(_t(spark, folder, "orders")))


@query
def bounded_deposit_join(spark, folder):
    """Items shipped within 30 days of their order, as a time-bounded join."""
    orders = _t(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ordered"))
    items = _t(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("timestamp").alias("shipped"))
    joined = joins.bounded_join(items, orders, "l_orderkey", "o_orderkey", "shipped", "ordered", "1 day", "30 days")
    return _plain_time(joined, "ordered", "shipped")


@query
def known_only(spark, folder):
    """Events of users that have signed up."""
    events = _t(spark, folder, "events")
    signed = filters.equals(events, "event_type", "signup").select("user_id").distinct()
    return joins.known_only(events, signed, ["user_id"]).select("event_id", "user_id", "event_type")


@query
def left_defaults(spark, folder):
    """Every customer with the number and newest status of their orders."""
    orders = _t(spark, folder, "orders")
    details = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("o_custkey").alias("n_orders"),
        F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus"))["o_orderstatus"].alias("o_orderstatus"))
    return joins.with_defaults(_t(spark, folder, "customer").select("c_custkey", "c_name"), details, ["c_custkey"],
                               {"n_orders": 0, "o_orderstatus": "---"})


@query
def lookup_first(spark, folder):
    """Orders with the first item (lowest line, then part) of each."""
    items = _t(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    return joins.lookup_first(
        _t(spark, folder, "orders").select("o_orderkey", "o_custkey"), items, ["o_orderkey"],
        ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]).select(
            "o_orderkey", "o_custkey", "l_linenumber", "l_partkey")


# --- change feed ------------------------------------------------------------------------

def _feed(spark, folder):
    return tables.feed_records(*[_t(spark, folder, n) for n in ("orders", "lineitem", "customer", "events")])


@query
def truck_reservations(spark, folder):
    return change_feed.truck_reservations(_feed(spark, folder))


@query
def customer_locations(spark, folder):
    return change_feed.customer_locations(_feed(spark, folder))


@query
def payment_topic(spark, folder):
    return change_feed.payment_topic(_feed(spark, folder))


@query
def country_now_and_home(spark, folder):
    return change_feed.country_now_and_home(_feed(spark, folder))


@query
def country_now_and_home_split(spark, folder):
    return change_feed.country_now_and_home(_feed(spark, folder), split_entities=True)


@query
def email_and_birth_year(spark, folder):
    return change_feed.email_and_birth_year(_feed(spark, folder))


@query
def birth_year_split(spark, folder):
    orders = _t(spark, folder, "orders")
    return orders.select("o_orderkey", scalars.status_text(
        decode.part_of(F.date_format("o_orderdate", "yyyy-MM-dd"), "-", 0)).alias("year"))


@query
def change_feed_decode(spark, folder):
    """Every message of the feed read as a customer; other entities are rows of nulls or of shared fields."""
    return decode.decode_change_feed(_feed(spark, folder), BANK_CUSTOMER)


@query
def customer_risk(spark, folder):
    return _as_double(risk.customer_risk(tables.risk_records(_t(spark, folder, "events"))), "score")


@query
def risk_by_birth_year(spark, folder):
    joined = risk.risk_by_birth_year(tables.risk_records(_t(spark, folder, "events")), _feed(spark, folder))
    return _as_double(joined, "score")


@query
def risk_topic(spark, folder):
    """The published records, with the score read back from the JSON."""
    published = risk.risk_topic(tables.risk_records(_t(spark, folder, "events")), _feed(spark, folder))
    layout = record(customer=STRING, score=DOUBLE, email=STRING, birthYear=STRING)
    return decode.flatten_json(published, layout, "value", ["key"])


# --- clicks -----------------------------------------------------------------------------

def _clicks(spark, folder):
    return tables.click_records(_t(spark, folder, "events"))


def _mixed(spark, folder):
    return tables.mixed_click_records(_t(spark, folder, "events"))


@query
def click_text(spark, folder):
    return clicks.click_text(_clicks(spark, folder))


@query
def click_print(spark, folder):
    return clicks.click_print(_clicks(spark, folder))


@query
def click_events(spark, folder):
    return clicks.click_events(_mixed(spark, folder))


@query
def invalid_clicks(spark, folder):
    return clicks.invalid_clicks(_mixed(spark, folder))


@query
def required_clicks_valid(spark, folder):
    return clicks.required_clicks(_mixed(spark, folder))[0]


@query
def required_clicks_rejected(spark, folder):
    return clicks.required_clicks(_mixed(spark, folder))[1]


@query
def sanitized_clicks(spark, folder):
    return clicks.sanitized_clicks(_clicks(spark, folder))


@query
def popular_clicks(spark, folder):
    return clicks.popular_clicks(_clicks(spark, folder))


@query
def scored_clicks(spark, folder):
    return clicks.scored_clicks(_clicks(spark, folder))


@query
def uri_sums(spark, folder):
    return clicks.uri_sums(_clicks(spark, folder))


@query
def tumbling_uri_sums(spark, folder):
    return _plain_time(clicks.tumbling_uri_sums(_clicks(spark, folder)), "window_start", "window_end")


@query
def hopping_uri_sums(spark, folder):
    return _plain_time(clicks.hopping_uri_sums(_clicks(spark, folder)), "window_start", "window_end")


@query
def current_uri_sums(spark, folder):
    return _plain_time(clicks.current_uri_sums_table(_clicks(spark, folder)).rows(), "window_start", "window_end")


@query
def click_attributes(spark, folder):
    return clicks.click_attributes(tables.attributed_click_records(_t(spark, folder, "events")))


@query
def avro_click_attributes(spark, folder):
    """Clicks written as Avro files with a map column and read back."""
    path = fresh_folder(spark, "clicks-avro")
    avro_files.write_avro(tables.attributed_clicks(_t(spark, folder, "events")), path, ATTRIBUTED_CLICK_AVRO)
    stored = avro_files.read_avro(spark, path, ATTRIBUTED_CLICK_AVRO)
    return decode.map_entries(stored, "attributes", ["email", "uri", "number"])


# --- counts and latest values -----------------------------------------------------------

@query
def running_sum(spark, folder):
    return aggregates.running_sum(_t(spark, folder, "events"), "event_type", tables.event_k())


@query
def keyed_count(spark, folder):
    return aggregates.keyed_count(_t(spark, folder, "events"), "user_id")


@query
def count_latest_by_key(spark, folder):
    return aggregates.count_latest_by_key(_t(spark, folder, "events"), ["user_id", "event_type"],
                                          ["ts", "event_id"], "user_id")


@query
def latest_by_key(spark, folder):
    return latest.latest_by_key(_t(spark, folder, "events"), ["user_id"], ["ts", "event_id"])


@query
def latest_item_by_part(spark, folder):
    """Newest shipment of every part."""
    items = _t(spark, folder, "lineitem").select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey",
                                                 "l_quantity", "l_extendedprice")
    return latest.latest_by_key(items, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey",
                                                       "l_quantity", "l_extendedprice"])


@query
def distinct_in_order(spark, folder):
    return aggregates.distinct_in_order(_t(spark, folder, "lineitem"), "l_partkey", "l_shipdate", ["l_returnflag"])


@query
def progress_count(spark, folder):
    """Events per type, beside the progress figure: all rows counted on the way."""
    seen = Observation("progress")
    counts = aggregates.keyed_count(aggregates.with_progress(_t(spark, folder, "events"), seen), "event_type")
    path = fresh_folder(spark, "progress")
    counts.write.parquet(path)
    return spark.read.parquet(path).withColumn("progress", F.lit(seen.get["rows"]).cast("long"))


# --- selection and routing --------------------------------------------------------------

@query
def text_without(spark, folder):
    return filters.lacks(_t(spark, folder, "documents"), "text", "the").select("doc_id", "lang")


@query
def topic_match(spark, folder):
    named = _t(spark, folder, "events").select(
        "event_id", F.concat(F.lit("org.example."), F.when(tables.event_k() % 2 == 0, F.lit("arrival.")).otherwise(
            F.lit("weather.")), "event_type", F.when(tables.event_k() % 3 == 0, F.lit(".v3")).otherwise(F.lit(".v2")))
        .alias("topic"))
    return named.where(TOPICS.is_arrival(F.col("topic")))


@query
def topic_pattern(spark, folder):
    records = tables.board_records(_t(spark, folder, "events"), TOPICS)
    return topics.topics_like(records, TOPICS.arrival_pattern).select("topic", "offset")


@query
def route_by_value(spark, folder):
    """Rows per branch, unknown values as their own branch."""
    label = filters.route_label(F.col("event_type"), ("view", "click", "purchase"), "other")
    return _t(spark, folder, "events").select("event_id", label.alias("branch"))


@query
def flagged_parts(spark, folder):
    """Parts whose large flag is set."""
    flags = _t(spark, folder, "part").select("p_partkey", F.when(F.col("p_size") % 7 != 0, F.col("p_size") > 25).alias("large"))
    return filters.flagged(flags, "large").select("p_partkey")


@query
def route_label(spark, folder):
    events = _t(spark, folder, "events")
    label = filters.route_label(F.col("event_type"), ("view", "click", "purchase"), "other")
    return events.groupBy(label.alias("branch")).agg(F.count(F.lit(1)).alias("rows"), F.sum(tables.event_k()).alias("k"))


@query
def fan_out(spark, folder):
    return filters.fan_out(_t(spark, folder, "events").select("event_id", "user_id"), "line", ("blue", "green", "red"))


# --- scalar rules -----------------------------------------------------------------------

@query
def slug_topics(spark, folder):
    part = _t(spark, folder, "part")
    name = F.concat_ws("/", F.initcap("p_name"), F.concat("p_brand", F.lit("'s-"), "p_type"))
    return part.select("p_partkey", scalars.slug(name).alias("slug"), TOPICS.arrival_topic(name).alias("topic"))


@query
def line_colors(spark, folder):
    size = F.col("p_size")
    flags = {"red": size > 40, "green": (size > 20) & (size < 45), "blue": size < 25}
    return _t(spark, folder, "part").select(
        "p_partkey", scalars.line_color(flags).alias("line"),
        scalars.color_code(scalars.line_color({**flags, "blue": size < 15})).alias("color"))


@query
def status_texts(spark, folder):
    status = F.concat_ws("_", F.lower("l_returnflag"), F.lower("l_linestatus"), F.lit("in_service"))
    return _t(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", scalars.status_text(status).alias("status"),
        scalars.title_text(status).alias("title"),
        scalars.whole_number(F.col("l_extendedprice") - 50000).alias("whole"),
        scalars.or_default(F.when(F.col("l_linenumber") > 2, F.col("l_returnflag")), "---").alias("flag"))


@query
def epoch_keys(spark, folder):
    # The event times have no zone; they are taken as UTC whatever the session's zone is.
    ts = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    keyed = _t(spark, folder, "events").select("event_id", scalars.epoch_millis(ts).alias("millis"))
    at = scalars.from_epoch_millis(F.col("millis")).cast("timestamp_ntz")
    return keyed.withColumn("at", F.convert_timezone(F.current_timezone(), F.lit("UTC"), at))


@query
def text_times(spark, folder):
    """Both text time formats read back."""
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", scalars.TIME_FORMATS[0])) \
        .otherwise(F.date_format("o_orderdate", scalars.TIME_FORMATS[1]))
    rows = _t(spark, folder, "orders").select("o_orderkey", scalars.parse_time(text).alias("at"))
    return _plain_time(rows, "at")


@query
def frame_ids(spark, folder):
    """Schema id and payload of registry-framed bytes; ids follow the priority."""
    orders = _t(spark, folder, "orders")
    payload = F.col("o_orderpriority").cast("binary")
    framed = F.when(F.col("o_orderstatus") == "F", decode.frame(payload, 258)).when(
        F.col("o_orderstatus") == "O", decode.frame(payload, 70000)).otherwise(payload)
    return orders.select("o_orderkey", framed.alias("framed")).select(
        "o_orderkey", decode.framed_schema_id(F.col("framed")).alias("schema_id"),
        decode.framed_payload(F.col("framed")).cast("string").alias("payload"))


# --- transit ----------------------------------------------------------------------------

def _stations(spark, folder):
    return transit.station_rows(tables.station_records(_t(spark, folder, "events"), TOPICS.stations))


@query
def station_table(spark, folder):
    return transit.station_table(_stations(spark, folder))


@query
def station_table_by_line(spark, folder):
    return transit.station_table(_stations(spark, folder), by_line=True)


@query
def station_rows(spark, folder):
    return _stations(spark, folder).select(*STATION_ROW.names, "offset")


def _turnstiles(spark, folder):
    return transit.turnstile_rows(tables.turnstile_records(_t(spark, folder, "events"), TOPICS.turnstile),
                                  keep=["offset"])


@query
def turnstile_summary(spark, folder):
    return sinks.upper_names(transit.turnstile_summary(_turnstiles(spark, folder)))


@query
def turnstile_table_summary(spark, folder):
    return transit.turnstile_table_summary(_turnstiles(spark, folder), ["line", "station_id"], ["offset"])


@query
def declared_table_sql(spark, folder):
    """The summary as a SQL statement over a declared table."""
    records = tables.turnstile_records(_t(spark, folder, "events"), TOPICS.turnstile)
    topics.declare_table(records, "turnstile", TURNSTILE)
    return topics.topic_sql(spark, "SELECT line, COUNT(station_id) AS entries, COUNT(DISTINCT station_id) AS stations "
                                   "FROM turnstile GROUP BY line")


@query
def declared_keyed_table(spark, folder):
    records = tables.turnstile_records(_t(spark, folder, "events"), TOPICS.turnstile)
    topics.declare_table(records, "turnstile_by_station", TURNSTILE, key="station_id", order=("timestamp", "offset"))
    return topics.topic_sql(spark, "SELECT station_id, station_name, line FROM turnstile_by_station")


def _board(spark, folder):
    return tables.board_records(_t(spark, folder, "events"), TOPICS)


@query
def position_state(spark, folder):
    return transit.board_state(_board(spark, folder), TOPICS)


@query
def status_board(spark, folder):
    return positions.status_board(transit.board_state(_board(spark, folder), TOPICS))


@query
def status_board_order(spark, folder):
    """The place of every line of the board, counted over the rows in the order the board has them."""
    board = positions.status_board(transit.board_state(_board(spark, folder), TOPICS))
    place = F.monotonically_increasing_id()
    # The sorted rows come partition after partition, so the place grows along the board.
    path = fresh_folder(spark, "board-order")
    board.select("line", "station_id", place.alias("place")).write.parquet(path)
    rows = spark.read.parquet(path)
    return rows.select("line", "station_id", F.rank().over(Window.partitionBy("line").orderBy("place")).alias("rank"))


@query
def weather_line(spark, folder):
    return positions.weather_line(transit.weather_now(_board(spark, folder), TOPICS))


@query
def line_topology(spark, folder):
    return topology.line_topology(tables.customer_stations(_t(spark, folder, "customer")))


@query
def line_hops(spark, folder):
    return topology.line_hops(topology.line_topology(tables.customer_stations(_t(spark, folder, "customer"))))


@query
def expected_entries(spark, folder):
    return ridership.expected_entries(tables.supplier_ridership(_t(spark, folder, "supplier")),
                                      tables.event_curve(_t(spark, folder, "events")), steps=3)


def _moments(spark, folder):
    return _t(spark, folder, "events").select("event_id", F.col("user_id").cast("int").alias("station_id"), "ts")


@query
def entries_at(spark, folder):
    return ridership.entries_at(_moments(spark, folder), tables.supplier_ridership(_t(spark, folder, "supplier")),
                                tables.event_curve(_t(spark, folder, "events")), steps=3)


# --- ingest -----------------------------------------------------------------------------

@query
def incremental_ingest(spark, folder):
    """The orders published in two increments: up to the middle key, then the rest."""
    orders = _t(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    middle = orders.agg(F.floor(F.avg("o_orderkey")).alias("m")).first()["m"]
    first, mark = ingest.ingest_increment(orders.where(F.col("o_orderkey") <= middle), "o_orderkey")
    second, _ = ingest.ingest_increment(orders, "o_orderkey", mark)
    return first.withColumn("increment", F.lit(1)).unionByName(second.withColumn("increment", F.lit(2)))


@query
def csv_parts(spark, folder):
    """Parts written as CSV with a header and read back with declared types."""
    part = _t(spark, folder, "part").withColumn("p_name", F.concat_ws(", ", "p_name", "p_brand"))
    path = fresh_folder(spark, "parts-csv")
    part.write.option("header", True).option("escape", '"').csv(path)
    return files.csv_table(spark, path, part.schema)


# --- the same functions as streams ------------------------------------------------------

@query
def stream_uri_sums(spark, folder):
    return run.keep_table(clicks.uri_sums_table(tables.click_records(_s(spark, folder, "events"))), "uri-sums")


@query
def stream_tumbling_uri_sums(spark, folder):
    kept = run.keep_table(clicks.tumbling_uri_sums_table(tables.click_records(_s(spark, folder, "events"))), "tumbling")
    return _plain_time(kept, "window_start", "window_end")


@query
def stream_hopping_uri_sums(spark, folder):
    """The state holds sums of one hop; the windows are put together when it is read."""
    kept = run.keep_table(clicks.hopping_uri_sums_table(tables.click_records(_s(spark, folder, "events"))), "hopping")
    return _plain_time(kept, "window_start", "window_end")


@query
def stream_large_deposit_join(spark, folder):
    joined = bank.large_deposits(tables.deposit_records(_s(spark, folder, "orders")),
                                 tables.customer_records(_s(spark, folder, "customer")), HALF_OF_ORDERS)
    return _as_double(run.keep_rows(joined, "large-deposits"), "amount")


@query
def stream_deposits_of_hot_accounts(spark, folder):
    """The same join with the accounts split that hold more than a thousandth of the orders."""
    hot = joins.measured_split(_t(spark, folder, "orders"), "o_custkey", 0.001)
    joined = bank.large_deposits(tables.deposit_records(_s(spark, folder, "orders")),
                                 tables.customer_records(_s(spark, folder, "customer")), HALF_OF_ORDERS, split=hot)
    return _as_double(run.keep_rows(joined, "hot-deposits"), "amount")


@query
def stream_country_now_and_home(spark, folder):
    feed = tables.feed_records(*[_s(spark, folder, n) for n in ("orders", "lineitem", "customer", "events")])
    return run.keep_rows(change_feed.country_now_and_home(feed), "countries")


@query
def stream_station_table(spark, folder):
    rows = transit.station_rows(tables.station_records(_s(spark, folder, "events"), TOPICS.stations))
    return run.keep_table(transit.kept_stations(rows), "stations")


@query
def stream_turnstile_summary(spark, folder):
    records = tables.turnstile_records(_s(spark, folder, "events"), TOPICS.turnstile)
    return run.keep_table(transit.turnstile_summary_table(transit.turnstile_rows(records)), "turnstile")


@query
def stream_status_board(spark, folder):
    records = tables.board_records(_s(spark, folder, "events"), TOPICS)
    return positions.status_board(run.keep_table(transit.board_table(records, TOPICS), "board"))


def _slices(spark, folder, label, slices=4):
    """The click events as a topic that gets one more slice of time with each step."""
    records = tables.click_records(_t(spark, folder, "events"))
    bounds = records.select(F.unix_micros("timestamp").alias("t")).approxQuantile("t", [i / slices for i in range(1, slices)], 0.01)
    part = sum((F.unix_micros("timestamp") > F.lit(b)).cast("int") for b in bounds)
    broker = topics.Broker(folder=fresh_folder(spark, f"slices-{label}"))
    for i in range(slices):
        records.where(part == i).write.parquet(f"{broker.folder}/clicks/slice{i}")
        yield topics.read_topic(spark, broker, "clicks")


@query
def stream_tumbling_bounded(spark, folder):
    """Tumbling sums whose state is dropped behind a watermark, over events that come in time
    order in four slices, each a run of its own; none is late, which the engine's count shows."""
    windows, late, table = run.ClosingWindows(spark, "tumbling-bounded"), 0, None
    for records in _slices(spark, folder, "bounded"):
        table = clicks.tumbling_uri_sums_table(records, watermark="1 hour")
        late += run.late_rows(windows.run(table))
    return _plain_time(windows.rows(table).withColumn("late_rows", F.lit(late).cast("long")), "window_start", "window_end")


@query
def restarted_sums(spark, folder):
    """Running sums of a stream that is stopped and started again before each of four slices."""
    checkpoint, table = fresh_folder(spark, "checkpoints/restarted"), None
    for records in _slices(spark, folder, "restarted"):
        table = clicks.uri_sums_table(records)
        run.run_available(keeper(table, checkpoint))
    return current(table, checkpoint)


@query
def stream_current_uri_sums(spark, folder):
    """The newest window of each uri, from the windows in a stream's state."""
    sums = clicks.hopping_uri_sums_table(tables.click_records(_s(spark, folder, "events")))
    return _plain_time(run.keep_table(sums.then(clicks.current_uri_sums), "windows"), "window_start", "window_end")


@query
def stream_turnstile_table_summary(spark, folder):
    """Entries per station where a later row of a key replaces the earlier one, as a running count."""
    records = tables.turnstile_records(_s(spark, folder, "events"), TOPICS.turnstile)
    rows = filters.present(transit.turnstile_rows(records, keep=["offset"]), "station_id")
    changes = stateful.running_table_count(rows, ["line", "station_id"], ["offset"], "station_id")
    return stateful.latest_counts(run.keep_rows(changes, "turnstile-counts"), "station_id")


@query
def stream_users_by_latest_event(spark, folder):
    """Users by the type of their latest event: each event may take its user from one count to another."""
    rows = _s(spark, folder, "events").select("user_id", "event_type", "ts", "event_id")
    changes = stateful.running_table_count(rows, ["user_id"], ["ts", "event_id"], "event_type")
    return stateful.latest_counts(run.keep_rows(changes, "event-counts"), "event_type")


@query
def stream_current_per_event(spark, folder):
    """Every click with the sum of its uri in the newest and the oldest hopping window it is in."""
    timed = clicks.timed_clicks(tables.click_records(_s(spark, folder, "events")), keep=["offset"])
    return _plain_time(run.keep_rows(clicks.current_hopping(timed), "current").select("offset", "uri", F.col("_time").alias("at"), "current", "oldest"), "at")


@query
def stream_tumbling_current_per_event(spark, folder):
    """Every click with the sum of its uri in its tumbling window so far."""
    timed = clicks.timed_clicks(tables.click_records(_s(spark, folder, "events")), keep=["offset"])
    return run.keep_rows(clicks.current_tumbling(timed), "current").select("offset", "uri", "current")


@query
def stream_message_outcomes(spark, folder):
    """What each message of the board's topics does to its station when it is applied."""
    records = tables.board_records(_s(spark, folder, "events"), TOPICS)
    outcomes = run.keep_rows(stateful.message_outcomes(transit.board_messages(records, TOPICS)), "outcomes")
    return outcomes.select("line", "station_id", "offset", "kind", "step", "outcome", "train_a", "status_a", "train_b", "status_b", "entries")


@query
def stream_bounded_deposit_join(spark, folder):
    """Large deposits with the items of the account published within 30 days, as streams with bounded state."""
    orders, items = _s(spark, folder, "orders"), _s(spark, folder, "lineitem")
    holders = tables.as_topic(items, "bank-customers", F.col("l_orderkey"), F.to_json(F.struct(
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("customerName"),
        F.col("l_orderkey").cast("string").alias("accountNumber"))), F.col("l_shipdate"))
    deposits = tables.as_topic(orders, "bank-deposits", F.col("o_orderkey"), F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("accountNumber"), F.col("o_totalprice").alias("amount"),
        F.lit("").alias("dateAndTime"))), F.col("o_orderdate"))
    joined = bank.bounded_deposits(deposits, holders, "1 day", "30 days", HALF_OF_ORDERS)
    kept = run.keep_rows(joined.select("accountNumber", "amount", "customerName", "depositTime", "customerTime"), "bounded-deposits")
    return _plain_time(_as_double(kept, "amount"), "depositTime", "customerTime")


@query
def replayed_topic(spark, folder):
    """A stream over a topic run twice: from its checkpoint nothing comes again, from a new one all does."""
    records = tables.deposit_records(_t(spark, folder, "orders"))
    broker = topics.Broker(folder=fresh_folder(spark, "replayed"))
    records.write.parquet(f"{broker.folder}/bank-deposits")
    path = fresh_folder(spark, "replays")
    first = fresh_folder(spark, "checkpoints/replayed")
    for i, checkpoint in enumerate((first, first, run.replay_checkpoint(spark, "replayed"))):
        def store(batch: DataFrame, batch_id: int, name: int = i) -> None:
            batch.select("key").withColumn("run", F.lit(name)).write.mode("overwrite").parquet(f"{path}/run{name}-{batch_id}")

        run.run_available(sinks.for_each_batch(topics.read_topic(spark, broker, "bank-deposits"), store, checkpoint))
    stored = spark.read.schema("key binary, run int").option("recursiveFileLookup", "true").parquet(path)
    return stored.select(F.col("key").cast("string").alias("key"), "run")


@query
def bounded_batches(spark, folder):
    """Sums per micro-batch of a topic of six files read two at a time."""
    records = tables.deposit_records(_t(spark, folder, "orders"))
    broker = topics.Broker(folder=fresh_folder(spark, "bounded"))
    for i in range(6):
        records.where(F.col("offset") % 6 == i).coalesce(1).write.parquet(f"{broker.folder}/bank-deposits/part{i}")
    path = fresh_folder(spark, "batches")

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.agg(F.count("*").alias("rows"), F.count_distinct(F.col("offset") % 6).alias("files")) \
            .write.mode("overwrite").parquet(f"{path}/{batch_id}")

    stream = topics.read_topic(spark, broker, "bank-deposits", max_files=2)
    run.run_available(sinks.for_each_batch(stream, store, fresh_folder(spark, "checkpoints/bounded")))
    stored = spark.read.schema("rows long, files long").option("recursiveFileLookup", "true").parquet(path)
    return stored.agg(F.count("*").alias("batches"), F.max("files").alias("most_files"), F.sum("rows").alias("rows"))


@query
def split_clicks(spark, folder):
    """Valid clicks and rejects, with the reason, published by one stream in one pass and read back."""
    stream = tables.mixed_click_records(_s(spark, folder, "events"))
    broker = topics.Broker(folder=fresh_folder(spark, "split"))
    run.run_available(sinks.split_writer(clicks.judged_clicks(stream), broker, "clicks.required", "clicks.rejected", "uri",
                                         fresh_folder(spark, "checkpoints/split")))
    return decode.as_text(topics.read_topic(spark, broker, ["clicks.required", "clicks.rejected"], streaming=False), keep=["topic"])


@query
def stream_newest_orders(spark, folder):
    """The newest row of every customer's orders, kept by a stream."""
    newest = latest.latest_table(_s(spark, folder, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return run.keep_table(newest, "newest-orders")


@query
def stream_text_lines(spark, folder):
    """Text files taken in as they appear, counted line by line."""
    path = fresh_folder(spark, "stream-lines")
    _t(spark, folder, "documents").select("text").write.text(path)
    return lines_of_text.letter_counts(run.keep_rows(files.appended_lines(spark, path), "lines"))


@query
def stream_growing_lines(spark, folder):
    """Text files followed as they grow, counted line by line."""
    path = fresh_folder(spark, "growing-lines")
    _t(spark, folder, "documents").select("text").write.text(path)
    return lines_of_text.letter_counts(run.keep_rows(growing.growing_lines(spark, path).select("value"), "growing"))


@query
def stream_topic_pattern(spark, folder):
    """All topics that fit a pattern, half of which come when the stream has already run."""
    records = tables.board_records(_t(spark, folder, "events"), TOPICS)
    broker, out = topics.Broker(folder=fresh_folder(spark, "later-topics")), fresh_folder(spark, "later-rows")
    for half in (0, 1):
        records.where(F.pmod(F.hash("topic"), F.lit(2)) == half).write.parquet(f"{broker.folder}/org.example.arrival.half{half}")
        stream = topics.read_topic(spark, broker, pattern=TOPICS.arrival_pattern)
        run.run_available(run.row_writer(stream.select("topic", "offset"), out, f"{out}-checkpoint"))
    return spark.read.schema("topic string, offset long").parquet(out)


@query
def stream_sums_and_late_rows(spark, folder):
    """Clicks of which some come after the watermark: every row is in a sum or among the late ones."""
    records = tables.click_records(_t(spark, folder, "events"))
    bounds = records.select(F.unix_micros("timestamp").alias("t")).approxQuantile("t", [0.25, 0.5, 0.75], 0.01)
    part = sum((F.unix_micros("timestamp") > F.lit(b)).cast("int") for b in bounds)
    part = F.when(F.col("offset") % 50 == 0, 3).otherwise(part)
    broker = topics.Broker(folder=fresh_folder(spark, "late"))
    checkpoint = fresh_folder(spark, "checkpoints/late")
    for i in range(4):
        records.where(part == i).write.parquet(f"{broker.folder}/clicks/slice{i}")
        timed = clicks.timed_clicks(topics.read_topic(spark, broker, "clicks"))
        run.run_available(sinks.late_writer(timed, "_time", "1 hour", clicks.TUMBLING, "uri", broker, "in-time", "late", checkpoint))
    read = {topic: decode.flatten_json(topics.read_topic(spark, broker, topic, streaming=False), record(uri=STRING, number=LONG)) for topic in ("in-time", "late")}
    sums = aggregates.running_sum(read["in-time"], "uri", "number").select("total", F.lit(False).alias("late"))
    both = sums.unionAll(read["late"].select("number", F.lit(True)))
    return both.agg(F.sum("total").alias("total"), F.bool_or("late").alias("some_late"))


def _published(spark: SparkSession, start: Callable[[topics.Broker, str], object], topic: str) -> DataFrame:
    """What a stream has published to a topic kept as files, as text."""
    broker = topics.Broker(folder=fresh_folder(spark, "topics"))
    run.run_available(start(broker, fresh_folder(spark, f"checkpoints/{topic}")))
    return decode.as_text(topics.read_topic(spark, broker, topic, streaming=False))


@query
def published_withdrawals(spark, folder):
    """The joined withdrawals published as JSON by a stream and read back."""
    bank_side = tables.bank_withdrawal_records(_s(spark, folder, "lineitem"))
    atm_side = tables.atm_withdrawal_records(_s(spark, folder, "orders"))
    joined = bank.withdrawal_locations(bank_side, atm_side)
    return _published(spark, lambda broker, checkpoint: sinks.publish_json(
        joined, "transactionId", broker, "withdrawals-location", checkpoint), "withdrawals-location")


@query
def published_gears(spark, folder):
    """Key and value passed through a stream unchanged and read back."""
    lineitem = _s(spark, folder, "lineitem")
    gears = vehicles.gear_position(tables.as_topic(lineitem, "gear-position", F.col("l_suppkey"), F.col("l_returnflag")))
    return _published(spark, lambda broker, checkpoint: sinks.publish_text(
        gears, "truckId", "gearPosition", broker, "gear-position-updates", checkpoint), "gear-position-updates")


@query
def published_summary(spark, folder):
    """Entry counts published with capital names by an update stream and read back."""
    records = tables.turnstile_records(_s(spark, folder, "events"), TOPICS.turnstile)
    summary = transit.turnstile_summary(transit.turnstile_rows(records))
    stored = _published(spark, lambda broker, checkpoint: sinks.publish_summary(
        summary, "station_id", broker, TOPICS.summary, checkpoint), TOPICS.summary)
    # A count only grows, so the newest record of a station is the one with the largest count.
    counted = decode.flatten_json(stored, ENTRY_SUMMARY, keep=["key"])
    return latest.latest_by_key(counted, ["key"], ["COUNT"])


@query
def handled_by_topic(spark, folder):
    """Two topics in one stream, each handed to its own handler and stored."""
    both = topics.merge_topics(tables.deposit_records(_s(spark, folder, "orders")),
                               tables.customer_records(_s(spark, folder, "customer")))
    path = fresh_folder(spark, "handled")

    def store(name: str):
        def handle(batch: DataFrame, batch_id: int) -> None:
            batch.select("key", "topic").withColumn("handler", F.lit(name)) \
                .write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        return handle

    handlers = {"bank-deposits": store("deposits"), "bank-customers": store("customers")}
    run.run_available(sinks.for_each_batch(both, sinks.by_topic(handlers), fresh_folder(spark, "checkpoints/handled")))
    stored = [spark.read.parquet(f"{path}/{name}") for name in ("deposits", "customers")]
    return topics.merge_topics(*stored).select(F.col("key").cast("string").alias("key"), "topic", "handler")


@query
def polled_ingest(spark, folder):
    """Orders published by two polls with a stored mark, read back from the topic."""
    orders = _t(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    broker = topics.Broker(folder=fresh_folder(spark, "topics"))
    marks = polling.Marks(fresh_folder(spark, "marks"))
    middle = orders.agg(F.floor(F.avg("o_orderkey")).alias("m")).first()["m"]
    for batch, visible in enumerate((orders.where(F.col("o_orderkey") <= middle), orders)):
        polling.poll_once(spark, "orders", lambda low, high, rows=visible: increments.next_increment(rows, "o_orderkey", low, high),
                          "o_orderkey", broker, increments.topic_for("orders", "connect-"), marks, batch)
    return decode.as_text(topics.read_topic(spark, broker, "connect-orders", streaming=False))


def catalog() -> dict[str, Query]:
    return dict(_CATALOG)
