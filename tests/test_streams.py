"""The same function on a table and on a stream of several micro-batches gives the same rows."""

import base64
import json

import pytest

from helpers import bag, folder_of, records, stream_of
from millrace import schemas as S
from millrace.operators import joins
from millrace.operators.aggregates import windowed_sum_table
from millrace.operators.latest import latest_table
from millrace.plans import bank, change_feed, clicks, risk, transit, vehicles
from millrace.sources.topics import Broker, as_topic, merge_topics, read_topic
from millrace.streaming import run, sinks
from millrace.streaming.tables import current, keeper
from pyspark.sql import functions as F

CLICKS = [{"email": f"u{i % 3}@t.com", "timestamp": str(i), "uri": f"/{'hot' if i % 3 else i % 4}", "number": i} for i in range(40)] + ["oops"]
DEPOSITS = [{"accountNumber": str(i % 4), "amount": 150.0 + 10 * i, "dateAndTime": "Mar 3, 2011, 9:15:00 PM"} for i in range(12)]
DEPOSITS += [{"amount": 900.0}, "oops", None]
CUSTOMERS = [{"customerName": f"C{i}", "email": f"u{i % 3}@t.com", "birthDay": f"196{i}-01-01", "accountNumber": str(i % 3), "location": f"L{i}"} for i in range(5)]
CUSTOMERS += [{"customerName": "no account"}]


def feed(entities):
    return [{"key": "k", "zSetEntries": [{"element": base64.b64encode(json.dumps(e).encode()).decode(), "score": 0.0}]} for e in entities]


FEED = feed(CUSTOMERS) + feed([{"accountNumber": str(i % 4), "location": f"P{i}"} for i in range(8)]) + [{"key": "empty", "zSetEntries": []}, "oops"]
STATUS = [{"truckNumber": str(i % 3), "destination": "D", "milesFromShop": i, "odometerReading": i} for i in range(6)]
CHECK_INS = [{"reservationId": str(i), "locationName": "N", "truckNumber": str(i % 4), "status": "In"} for i in range(6)]
SCORES = [{"customer": f"u{i % 4}@t.com", "score": i / 2, "riskDate": "2020"} for i in range(7)]
WITHDRAWALS = [{"accountNumber": "1", "amount": 31.5, "dateAndTime": "d", "transactionId": i % 5} for i in range(9)]
MACHINES = [{"transactionDate": "d", "transactionId": i % 6, "atmLocation": "Harbour"} for i in range(7)]

APPEND = {
    "deposits": (bank.large_deposits, DEPOSITS, CUSTOMERS),
    "check_in": (vehicles.vehicle_check_in, STATUS, CHECK_INS),
    "check_in_topic": (vehicles.vehicle_check_in_topic, STATUS, CHECK_INS),
    "withdrawals": (bank.withdrawal_location_topic, WITHDRAWALS, MACHINES),
    "risk": (risk.risk_topic, SCORES, FEED),
    "countries": (change_feed.country_now_and_home, FEED),
    "locations": (change_feed.customer_locations, FEED),
    "payments": (change_feed.payment_topic, FEED),
    "clicks": (clicks.click_events, CLICKS),
    "popular": (lambda r: clicks.popular_clicks(r, 20), CLICKS),
    "scored": (clicks.scored_clicks, CLICKS),
    "rejected": (lambda r: clicks.required_clicks(r)[1], CLICKS),
}


@pytest.mark.parametrize("name", APPEND)
def test_rows_match_the_table_run(spark, tmp_path, name):
    build, *inputs = APPEND[name]
    frames = [records(spark, values, f"in{i}") for i, values in enumerate(inputs)]
    streams = [stream_of(spark, f, tmp_path, f"in{i}") for i, f in enumerate(frames)]
    want = bag(build(*frames))
    assert want and bag(run.keep_rows(build(*streams), name)) == want


def test_both_entity_readings_of_the_feed(spark):
    frame = records(spark, FEED)
    everything = change_feed.country_now_and_home(frame)
    stated = change_feed.country_now_and_home(frame, split_entities=True)
    # Customers meet their own home only when they also count as locations.
    assert everything.count() == stated.count() + sum(
        1 for a in CUSTOMERS for b in CUSTOMERS if a.get("accountNumber") and a.get("accountNumber") == b.get("accountNumber"))
    assert {r["birthYear"] for r in stated.collect()} == {"1960", "1961", "1962", "1963", "1964"}


UPDATE = {
    "sums": (clicks.uri_sums_table, clicks.uri_sums),
    "tumbling": (clicks.tumbling_uri_sums_table, clicks.tumbling_uri_sums),
    "hopping": (clicks.hopping_uri_sums_table, clicks.hopping_uri_sums),
    "latest": (lambda r: latest_table(clicks.click_events(r, keep=["offset"]), ["uri"], ["offset"]), None),
}


@pytest.mark.parametrize("name", UPDATE)
def test_tables_match_the_table_run(spark, tmp_path, name):
    build, plain = UPDATE[name]
    frame = records(spark, CLICKS, "in")
    kept = run.keep_table(build(stream_of(spark, frame, tmp_path, "in")), name)
    assert bag(kept) == bag(plain(frame) if plain else build(frame).rows())


def test_every_change_of_a_sum_is_emitted(spark, tmp_path):
    frame = records(spark, [{"uri": "/a", "number": n} for n in (1, 2, 3)], "in")
    table, totals = clicks.uri_sums_table(stream_of(spark, frame, tmp_path, "in")), []
    keep = lambda batch, _: totals.extend(r["total"] for r in batch.collect())
    run.run_available(sinks.for_each_batch(table.rows(), keep, f"{tmp_path}/ckpt", "update"))
    assert len(totals) == 3 and totals[-1] == 6
    # The table is in the state, whatever the sink was.
    assert [r["total"] for r in current(table, f"{tmp_path}/ckpt").collect()] == [6]


def test_restart_continues_from_the_checkpoint(spark, tmp_path):
    frame = records(spark, CLICKS, "in")
    broker = folder_of(frame.where("offset < 20"), tmp_path, "in")
    table = clicks.uri_sums_table(read_topic(spark, broker, "in"))
    assert current(table, f"{tmp_path}/ckpt").count() == 0
    run.run_available(keeper(table, f"{tmp_path}/ckpt"))
    assert bag(current(table, f"{tmp_path}/ckpt")) == bag(clicks.uri_sums(frame.where("offset < 20")))
    frame.where("offset >= 20").write.parquet(f"{tmp_path}/in/late")
    run.run_available(keeper(clicks.uri_sums_table(read_topic(spark, broker, "in")), f"{tmp_path}/ckpt"))
    assert bag(current(table, f"{tmp_path}/ckpt")) == bag(clicks.uri_sums(frame))


def test_tables_need_no_success_files(spark, tmp_path):
    frame = records(spark, CLICKS, "in")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        stream = stream_of(spark, frame, tmp_path, "in")
        assert bag(run.keep_table(clicks.uri_sums_table(stream), "sums")) == bag(clicks.uri_sums(frame))
        assert bag(run.keep_rows(clicks.click_events(stream), "rows")) == bag(clicks.click_events(frame))
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_a_state_of_other_rows_is_refused(spark, tmp_path):
    frame = records(spark, CLICKS, "in")
    table = clicks.uri_sums_table(stream_of(spark, frame, tmp_path, "in"))
    run.run_available(keeper(table, f"{tmp_path}/ckpt"))
    with pytest.raises(TypeError):
        current(clicks.tumbling_uri_sums_table(frame), f"{tmp_path}/ckpt")


def test_hopping_sums_behind_a_watermark_keep_a_fifth_of_the_state(spark, tmp_path):
    rows = [{"uri": f"/{i % 40}", "number": i} for i in range(400)] + [{"uri": "/end", "number": 0}]
    frame = records(spark, rows, "in", times=[(i * 370) % 30_000 for i in range(400)] + [90_000])
    plain = run.run_available(sinks.for_each_batch(clicks.hopping_uri_sums(stream_of(spark, frame, tmp_path / "a", "in", 1)), lambda b, _: b.count(),
                                                   f"{tmp_path}/plain", "update"))
    panes = run.run_available(keeper(clicks.hopping_uri_sums_table(stream_of(spark, frame, tmp_path / "b", "in", 1)), f"{tmp_path}/panes"))
    assert 5 * run.state_rows(panes)[0] <= run.state_rows(plain)[0]
    chained = clicks.hopping_uri_sums(stream_of(spark, frame, tmp_path / "c", "in", 1), watermark="1 minute")
    closed = run.keep_rows(chained, "closed")
    want = clicks.hopping_uri_sums(frame)
    assert bag(closed) == bag(want.where("uri <> '/end'"))
    assert bag(current(clicks.hopping_uri_sums_table(frame), f"{tmp_path}/panes")) == bag(want)


def test_watermark_drops_only_what_is_late(spark, tmp_path):
    rows = [{"uri": "/a", "number": 1}] * 5
    # One file per micro-batch: 0 s, 600 s, then twice a row of the first window, then 700 s.
    frame = records(spark, rows, "in", times=[0, 600, 601, 5, 700])
    for i in range(5):
        frame.where(f"offset = {i}").coalesce(1).write.parquet(f"{tmp_path}/in/p{i}")
    broker = Broker(folder=str(tmp_path))
    source = lambda: read_topic(spark, broker, "in", max_files=1)
    bounded, windows = clicks.tumbling_uri_sums_table(source(), watermark="1 minute"), run.ClosingWindows(spark, "bounded")
    totals = lambda df: sorted(r["total"] for r in df.collect())
    assert totals(run.keep_table(clicks.tumbling_uri_sums_table(source()), "open")) == [1, 2, 2]
    windows.run(bounded)
    assert totals(windows.rows(bounded)) == [1, 1, 2]


@pytest.mark.parametrize("files", [1, 4, 16])
def test_bounded_sums_in_time_order_lose_nothing(spark, tmp_path, files):
    frame = records(spark, [{"uri": f"/{i % 3}", "number": i} for i in range(64)], "in", times=[40 * i for i in range(64)])
    windows, late = run.ClosingWindows(spark, "in-order"), 0
    for i in range(files):
        frame.where(f"offset DIV {64 // files} = {i}").coalesce(1).write.parquet(f"{tmp_path}/in/p{i}")
        table = clicks.tumbling_uri_sums_table(read_topic(spark, Broker(folder=str(tmp_path)), "in"), watermark="1 minute")
        late += run.late_rows(windows.run(table))
    assert bag(windows.rows(table)) == bag(clicks.tumbling_uri_sums(frame)) and late == 0


def test_late_rows_are_counted(spark, tmp_path):
    frame = records(spark, [{"uri": "/a", "number": 1}] * 3, "in", times=[0, 6000, 5])
    late = 0
    for i in range(3):
        frame.where(f"offset = {i}").coalesce(1).write.parquet(f"{tmp_path}/in/p{i}")
        table = clicks.tumbling_uri_sums_table(read_topic(spark, Broker(folder=str(tmp_path)), "in"), watermark="1 minute")
        late += run.late_rows(run.run_available(keeper(table, f"{tmp_path}/ckpt")))
    assert late == 1


def test_sums_and_late_rows_are_all_rows(spark, tmp_path):
    from millrace.functions.decode import flatten_json

    times = [0, 600, 601, 5, 700, 650, 595, 3]
    frame = records(spark, [{"uri": f"/{i}", "number": 2 ** i} for i in range(8)], "in", times=times)
    for i in range(8):
        frame.where(f"offset = {i}").coalesce(1).write.parquet(f"{tmp_path}/in/p{i}")
    broker = Broker(folder=str(tmp_path))
    rows = clicks.timed_clicks(read_topic(spark, broker, "in", max_files=1))
    for _ in range(2):  # a second run finds nothing new
        run.run_available(sinks.late_writer(rows, "_time", "1 minute", "10 seconds", "uri", broker, "in-time", "late", f"{tmp_path}/ckpt"))
    layout = S.record(uri=S.STRING, number=S.LONG, _time=S.STRING)
    read = lambda topic, **how: flatten_json(read_topic(spark, broker, topic, **how), layout)
    late = {r["number"] for r in read("late", streaming=False).collect()}
    assert late == {8, 64, 128} - ({64} if 595 // 10 * 10 + 10 > 700 - 60 else set())
    in_time = read("in-time", max_files=1).withColumn("_time", F.to_timestamp("_time"))
    table = windowed_sum_table(in_time, "_time", "uri", "number", "10 seconds", watermark="1 minute")
    windows = run.ClosingWindows(spark, "in-time")
    assert run.late_rows(windows.run(table)) == 0
    assert {r["total"] for r in windows.rows(table).collect()} | late == {2 ** i for i in range(8)}


def test_only_hot_keys_are_copied(spark, tmp_path):
    deposits = [{"accountNumber": "7" if i % 3 == 0 else str(100 + i), "amount": 900.0, "dateAndTime": "d"} for i in range(60)]
    customers = [{"customerName": f"C{a}", "accountNumber": str(a)} for a in (7, *range(100, 160))]
    left, right = records(spark, deposits, "l"), records(spark, customers, "r")
    split = run.kept_split(spark, f"{tmp_path}/ckpt", lambda: joins.measured_split(spark.createDataFrame(deposits), "accountNumber"))
    assert split == joins.Split(4, ("7",))
    assert run.kept_split(spark, f"{tmp_path}/ckpt", lambda: None) == split
    stored = {}
    for name, how in (("none", None), ("hot", split), ("all", 4)):
        joined = bank.large_deposits(stream_of(spark, left, tmp_path / name, "l"), stream_of(spark, right, tmp_path / name, "r"), split=how)
        query = run.run_available(run.row_writer(joined, f"{tmp_path}/{name}-out", f"{tmp_path}/{name}-ckpt"))
        assert bag(spark.read.parquet(f"{tmp_path}/{name}-out")) == bag(bank.large_deposits(left, right))
        stored[name] = run.state_rows(query)[0]
    # Both sides once; the right row of the hot key three times more; every right row three times more.
    assert stored == {"none": 121, "hot": 124, "all": 304}


def test_bounded_join_on_streams(spark, tmp_path):
    left = records(spark, [{"uri": "/a", "number": i} for i in range(3)], "l", times=[0, 100, 1000])
    right = records(spark, [{"uri": "/a", "number": i} for i in range(3)], "r", times=[50, 130, 5000])

    def build(a, b):
        from millrace.functions.decode import flatten_json
        layout = S.record(uri=S.STRING, number=S.LONG)
        lhs = flatten_json(a, layout, keep=["timestamp"]).toDF("lk", "ln", "lt")
        rhs = flatten_json(b, layout, keep=["timestamp"]).toDF("rk", "rn", "rt")
        return joins.bounded_join(lhs, rhs, "lk", "rk", "lt", "rt", "1 hour", "60 seconds").select("ln", "rn")

    want = bag(build(left, right))
    assert want == {(0, 0): 1, (1, 0): 1, (1, 1): 1}
    assert bag(run.keep_rows(build(stream_of(spark, left, tmp_path, "l"), stream_of(spark, right, tmp_path, "r")), "near")) == want


def test_batches_are_handed_out_by_topic(spark, tmp_path):
    frame = merge_topics(records(spark, ["a", "b"], "one"), records(spark, ["c"], "two"), records(spark, ["d"], "three"))
    seen = {"one": 0, "two": 0}
    for i, topic in enumerate(("one", "two", "three")):
        frame.where(F.col("topic") == topic).write.parquet(f"{tmp_path}/{topic}")
    stream = read_topic(spark, Broker(folder=str(tmp_path)), ["one", "two"])

    def count(topic):
        def handle(rows, _):
            seen[topic] += rows.count()
        return handle

    run.run_available(sinks.for_each_batch(stream, sinks.by_topic({t: count(t) for t in seen}), f"{tmp_path}/ckpt"))
    assert seen == {"one": 2, "two": 1}


def test_stream_against_known_state(spark, tmp_path):
    frame = records(spark, ["x"] * 4, "in", keys=["a", "b", "a", "c"])
    known = spark.createDataFrame([("a",), ("c",)], "key string")
    build = lambda df: joins.known_only(df.select(F.col("key").cast("string"), "offset"), known, ["key"])
    assert bag(run.keep_rows(build(stream_of(spark, frame, tmp_path, "in")), "known")) == bag(build(frame))


def test_published_summary_reads_back(spark, tmp_path):
    broker = Broker(folder=str(tmp_path))
    entries = records(spark, [{"station_id": i, "station_name": "x", "line": "blue"} for i in (1, 1, 2)], "in")
    summary = transit.turnstile_summary(transit.turnstile_rows(stream_of(spark, entries, tmp_path, "in", batches=1)))
    run.run_available(sinks.publish_summary(summary, "station_id", broker, "SUMMARY", f"{tmp_path}/ckpt"))
    stored = read_topic(spark, broker, "SUMMARY", streaming=False)
    assert sorted(bytes(r["value"]).decode() for r in stored.collect()) == ['{"STATION_ID":1,"COUNT":2}', '{"STATION_ID":2,"COUNT":1}']
    assert stored.select("topic").distinct().first()[0] == "SUMMARY"


def test_text_passes_through_unchanged(spark, tmp_path):
    broker = folder_of(records(spark, ["P", "R"], "gear-position", keys=["t1", "t2"]), tmp_path, "gear-position", 1)
    gears = vehicles.gear_position(read_topic(spark, broker, "gear-position"))
    run.run_available(sinks.publish_text(gears, "truckId", "gearPosition", broker, "updates", f"{tmp_path}/ckpt"))
    stored = read_topic(spark, broker, "updates", streaming=False)
    assert sorted((bytes(r["key"]), bytes(r["value"])) for r in stored.collect()) == [(b"t1", b"P"), (b"t2", b"R")]


def test_records_from_rows(spark):
    df = as_topic(spark.range(1), "t", F.col("id"), F.lit("v"), F.lit("2024-01-01").cast("timestamp"), F.col("id"))
    assert df.schema.names == S.ENVELOPE.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in S.ENVELOPE]
