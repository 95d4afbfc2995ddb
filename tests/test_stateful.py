"""Results for each message against a plain loop over all messages, however the input is cut."""

import random
from collections import Counter

import pytest

from helpers import START, records
from millrace.plans import clicks, transit
from millrace.sources.topics import Broker, read_topic
from millrace.streaming import progress, run, stateful
from test_positions import TOPICS, frame, message_log

SHOWN = ("line", "station_id", "offset", "kind", "step", "outcome", "train_a", "status_a", "train_b", "status_b", "entries")


def outcomes(log):
    """What each message does, one after the other."""
    lines, out = {"blue": {}, "green": {}, "red": {}}, []

    def change(line, station, offset, kind, step, apply):
        known = lines[line].get(station)
        outcome = "unknown" if known is None and kind != "station" else apply(known)
        s = lines[line].get(station)
        out.append((line, station, offset, kind, step, outcome,
                    *((*(s["a"] or (None, None)), *(s["b"] or (None, None)), s["n"]) if s else (None,) * 5)))

    for offset, (topic, m) in enumerate(log):
        if topic == TOPICS.summary:
            for line in lines:
                change(line, m["STATION_ID"], offset, "count", 0, lambda s: s.update(n=m["COUNT"]) or "counted")
        elif m["line"] not in lines:
            continue
        elif topic == TOPICS.station_table:
            stations = lines[m["line"]]
            fresh = lambda known: stations.update({m["station_id"]: {"a": None, "b": None, "n": 0}}) or ("reset" if known else "registered")
            change(m["line"], m["station_id"], offset, "station", 0, fresh)
        else:
            side = lambda d: "a" if d == "a" else "b"
            if m["prev_station_id"] is not None and m["prev_direction"] is not None:
                slot = side(m["prev_direction"])
                change(m["line"], m["prev_station_id"], offset, slot, 0, lambda s: s.update({slot: None}) or "cleared")
            if m["station_id"] is not None:
                slot, train = side(m["direction"]), (m["train_id"], m["train_status"].replace("_", " "))
                change(m["line"], m["station_id"], offset, slot, 1, lambda s: s.update({slot: train}) or "applied")
    return Counter(out)


def cut(all_records, path, slices):
    """The records as a topic that is read one slice a micro-batch."""
    for i, condition in enumerate(slices):
        all_records.where(condition).coalesce(1).write.parquet(f"{path}/in/p{i:02}")
    return read_topic(all_records.sparkSession, Broker(folder=str(path)), "in", max_files=1)


def in_time(n, total):
    return [f"offset DIV {-(-total // n)} = {i}" for i in range(n)]


@pytest.mark.parametrize("batches", [1, 4, 16])
def test_message_outcomes(spark, tmp_path, batches):
    log = message_log(11, 240)
    stream = cut(frame(spark, log), tmp_path, in_time(batches, 240))
    got = run.keep_rows(stateful.message_outcomes(transit.board_messages(stream, TOPICS)), "outcomes")
    got = Counter(tuple(r[c] for c in SHOWN) for r in got.collect())
    assert got == outcomes(log)
    assert {k[5] for k in got} == {"registered", "reset", "applied", "cleared", "counted", "unknown"}


def test_messages_that_come_out_of_order_wait(spark, tmp_path):
    log = message_log(12, 200)
    # A last message, far behind the others in time, lets all that wait go.
    log.append((TOPICS.summary, {"STATION_ID": 99, "COUNT": 0}))
    all_records = records(spark, [m for _, m in log], topic=[t for t, _ in log], times=[*range(200), 100_000])
    slices = [f"offset < 200 AND pmod(hash(offset), 5) = {i}" for i in range(5)] + ["offset = 200"]
    stream = cut(all_records, tmp_path, slices)
    got = run.keep_rows(stateful.message_outcomes(transit.board_messages(stream, TOPICS), wait="300 seconds"), "waiting")
    want = outcomes(log)
    assert Counter(tuple(r[c] for c in SHOWN) for r in got.collect() if r["offset"] < 200) == Counter({k: v for k, v in want.items() if k[2] < 200})


def click_log(n):
    pick = random.Random(5)
    values = [{"email": "e", "timestamp": "t", "uri": f"/{pick.choice('aab')}", "number": pick.choice((1, 2, 30, None))} for _ in range(n)]
    return values, [i * pick.choice((0, 3, 3, 8)) for i in range(n)]


def plain_values(values, times, hops, late):
    """Sums of the newest and the oldest window of each event, in order of time and offset."""
    panes, newest, out = {}, {}, Counter()
    for offset, (value, time) in sorted(enumerate(zip(values, times, strict=True)), key=lambda x: (x[1][1], x[0])):
        uri, pane = value["uri"], time // 10
        newest[uri] = max(newest.get(uri, pane), pane)
        sums = panes.setdefault(uri, {})
        if newest[uri] - pane >= hops + late:
            out[offset, uri, None, None] += 1
            continue
        sums[pane] = sums.get(pane, 0) + (value["number"] or 0)
        out[offset, uri, sum(sums.get(pane + i, 0) for i in range(hops)), sum(sums.get(pane - i, 0) for i in range(hops))] += 1
    return out


@pytest.mark.parametrize("batches", [1, 4, 16])
@pytest.mark.parametrize("build, hops", [(clicks.current_hopping, 6), (clicks.current_tumbling, 1)])
def test_current_values(spark, tmp_path, batches, build, hops):
    assert START.timestamp() % 60 == 0
    values, times = click_log(96)
    times = sorted(times)
    stream = cut(records(spark, values, "in", times=times), tmp_path, in_time(batches, 96))
    got = run.keep_rows(build(clicks.timed_clicks(stream, keep=["offset"])), "current")
    assert Counter((r["offset"], r["uri"], r["current"], r["oldest"]) for r in got.collect()) == plain_values(values, times, hops, hops)


def test_events_behind_the_ring_are_not_added(spark, tmp_path):
    times = [0, 300, 5, 250, 299]
    stream = cut(records(spark, [{"uri": "/a", "number": 1}] * 5, "in", times=times), tmp_path, [f"offset = {i}" for i in range(5)])
    got = run.keep_rows(clicks.current_hopping(clicks.timed_clicks(stream, keep=["offset"])), "current")
    shown = {r["offset"]: (r["current"], r["oldest"]) for r in got.collect()}
    # The fourth falls in windows with the second, which came before it though it is later.
    assert shown == {0: (1, 1), 1: (1, 1), 2: (None, None), 3: (2, 1), 4: (2, 2)}


@pytest.mark.parametrize("batches", [1, 4, 16])
def test_running_count_over_a_table(spark, tmp_path, batches):
    pick = random.Random(3)
    rows = [(pick.choice([None, *range(9)]), i, pick.choice(["x", "y", "z", None])) for i in range(160)]
    pick.shuffle(rows)
    table = spark.createDataFrame([(k, o, g, i) for i, (k, o, g) in enumerate(rows)], "k int, o long, g string, offset long")
    for i in range(batches):
        table.where(f"offset DIV {160 // batches} = {i}").coalesce(1).write.parquet(f"{tmp_path}/t/p{i:02}")
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/t/*")
    changes = run.keep_rows(stateful.running_table_count(stream, ["k"], ["o"], "g"), "counts")
    newest = {}
    for k, o, g in rows:
        newest[k] = max(newest.get(k, (-1, "")), (o, g), key=lambda x: x[0])
    want = Counter(g for _, g in newest.values() if g is not None)
    assert {r["g"]: r["count"] for r in stateful.latest_counts(changes, "g").collect()} == dict(want)
    # Each change of a group has its own number, so that the rows tell their order.
    numbers = [(r["g"], r["change"]) for r in changes.collect()]
    assert len(numbers) == len(set(numbers))


def test_every_micro_batch_is_remembered(spark, tmp_path):
    values = [{"email": "e", "timestamp": "t", "uri": "/a", "number": i} if i % 3 else "oops" for i in range(30)]
    stream = cut(records(spark, values, "in"), tmp_path, [f"offset = {i}" for i in range(30)])
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "10")
    try:
        query = run.run_available(clicks.click_events(stream).writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/ckpt"))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    counts = progress.observed_counts(query, "rejected_clicks")
    assert run.batch_sizes(query) == [1] * 30 and len(query.recentProgress) <= 10
    assert [c["rows"] for c in counts] == [1 if i % 3 == 0 else 0 for i in range(30)]
