"""The board state against a message-by-message simulation, and on a stream."""

import random

import pytest

from helpers import bag, folder_of, records, stream_of
from millrace.operators.positions import status_board, weather_line
from millrace.plans import programs, transit
from millrace.sources.topics import Broker
from millrace.streaming.run import keep_table, run_available
from millrace.streaming.sinks import console
from millrace.streaming.tables import current
from pyspark.sql import functions as F

TOPICS = transit.TransitTopics("org.example.")


def message_log(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        line = rng.choice(["blue", "green", "red", "brown", None])
        station = rng.randrange(6)
        kind = rng.choice(["reg", "arr", "arr", "arr", "count"])
        if kind == "reg":
            out.append((TOPICS.station_table, {"station_id": station, "station_name": f"S{station}", "order": rng.randrange(4), "line": line}))
        elif kind == "arr":
            out.append((f"org.example.arrival.s{station}.v3", {
                "station_id": rng.choice([station] * 5 + [None]), "train_id": f"T{rng.randrange(5)}", "direction": rng.choice(["a", "b", "c"]), "line": line,
                "train_status": rng.choice(["in_service", "broken_down"]),
                "prev_station_id": rng.choice([None, *range(6)]), "prev_direction": rng.choice([None, "a", "b", "x"])}))
        else:
            out.append((TOPICS.summary, {"STATION_ID": station, "COUNT": rng.randrange(50)}))
    return out


def simulate(log):
    lines = {"blue": {}, "green": {}, "red": {}}
    for topic, m in log:
        if topic == TOPICS.summary:
            for stations in lines.values():
                if m["STATION_ID"] in stations:
                    stations[m["STATION_ID"]]["entries"] = m["COUNT"]
            continue
        stations = lines.get(m["line"])
        if stations is None:
            continue
        if topic == TOPICS.station_table:
            stations[m["station_id"]] = {"name": m["station_name"], "order": m["order"], "a": None, "b": None, "entries": 0}
            continue
        side = lambda d: "a" if d == "a" else "b"
        if m["prev_station_id"] is not None and m["prev_direction"] is not None and m["prev_station_id"] in stations:
            stations[m["prev_station_id"]][side(m["prev_direction"])] = None
        if m["station_id"] in stations:
            stations[m["station_id"]][side(m["direction"])] = (m["train_id"], m["train_status"].replace("_", " "))
    return {(line, sid, s["name"], s["order"], *(s["a"] or (None, None)), *(s["b"] or (None, None)), s["entries"])
            for line, stations in lines.items() for sid, s in stations.items()}


def frame(spark, log):
    return records(spark, [m for _, m in log], topic=[t for t, _ in log])


def state_rows(state):
    return {tuple(r) for r in state.select("line", "station_id", "station_name", "order", "train_a", "status_a", "train_b",
                                           "status_b", "entries").collect()}


@pytest.mark.parametrize("seed", range(4))
def test_state_matches_the_simulation(spark, seed):
    log = message_log(seed, 400)
    got = frame(spark, log)
    # Shuffled, with a part of the messages delivered twice.
    again = got.unionByName(got.where("offset % 3 = 0")).repartition(5)
    assert state_rows(transit.board_state(again, TOPICS)) == simulate(log)


def test_state_on_a_stream(spark, tmp_path):
    log = message_log(9, 300)
    stream = stream_of(spark, frame(spark, log), tmp_path, "all", batches=4)
    kept = keep_table(transit.board_table(stream, TOPICS), "board")
    assert state_rows(kept) == simulate(log)


def test_board_shows_defaults_in_display_order(spark):
    log = [(TOPICS.station_table, {"station_id": i, "station_name": f"S{i}", "order": o, "line": line})
           for i, o, line in ((1, 2, "red"), (2, 1, "red"), (3, 9, "blue"), (4, 0, "green"), (5, 0, None))]
    log.append(("org.example.arrival.s.v3", {"station_id": 4, "train_id": "GL1", "direction": "b", "line": "green",
                                             "train_status": "in_service", "prev_station_id": None, "prev_direction": None}))
    log.append(("org.example.arrival.s.v2", {"station_id": 4, "train_id": "GL2", "direction": "b", "line": "green",
                                             "train_status": "in_service", "prev_station_id": None, "prev_direction": None}))
    board = [tuple(r) for r in status_board(transit.board_state(frame(spark, log), TOPICS)).collect()]
    assert board == [("blue", "#1E90FF", 3, 9, "S3", "---", "---", 0), ("green", "#32CD32", 4, 0, "S4", "---", "GL1", 0),
                     ("red", "#DC143C", 2, 1, "S2", "---", "---", 0), ("red", "#DC143C", 1, 2, "S1", "---", "---", 0)]


def test_a_bad_station_record_is_left_out(spark):
    log = [(TOPICS.station_table, "oops"), (TOPICS.station_table, {"station_id": 1, "line": "red"}),
           (TOPICS.station_table, {"station_id": 2, "station_name": "S2", "order": 1, "line": "red", "__ns": {"ns": "x"}})]
    assert {r[1] for r in state_rows(transit.board_state(frame(spark, log), TOPICS))} == {2}


def test_weather(spark):
    log = [(TOPICS.weather, {"temperature": 51.75, "status": "windy"}),
           (TOPICS.weather, {"temperature": 33.625, "status": "partly_cloudy"})]
    shown = lambda rows: tuple(weather_line(transit.weather_now(rows, TOPICS)).first())
    assert shown(frame(spark, log)) == (33, "Partly Cloudy")
    assert shown(frame(spark, log).where("false")) == (70, "Sunny")


def test_sample_stations_and_summary(spark):
    stops = [(501, "Mill Gate", 71, 4, "blue"), (502, "Mill Gate", 71, 4, "blue"), (503, "Quay/North", 72, 0, "green"),
             (504, "Orchard", 73, 2, "green"), (505, "Tannery", 74, 9, "blue"), (506, "Depot", 75, 3, None)]
    values = [{"stop_id": s, "direction_id": "E", "stop_name": n, "station_name": n, "station_descriptive_name": n, "station_id": i,
               "order": o, "red": False, "blue": c == "blue", "green": c == "green"} for s, n, i, o, c in stops]
    table = transit.station_table(transit.station_rows(records(spark, values, TOPICS.stations)))
    assert {tuple(r) for r in table.collect()} == {(i, n, o, c) for _, n, i, o, c in stops}
    entries = [{"station_id": i, "station_name": "x", "line": "blue"} for i in (81, 81, 82, 83, 83, 83)]
    summary = transit.turnstile_summary(transit.turnstile_rows(records(spark, entries + ["oops"])))
    assert bag(summary) == {(2, 81): 1, (1, 82): 1, (3, 83): 1}


def test_station_on_two_lines(spark):
    both = [{"stop_id": i, "direction_id": "E", "stop_name": "n", "station_name": "Weir/Bridge", "station_descriptive_name": "n",
             "station_id": 91, "order": 5, "red": False, "blue": i == 2, "green": i == 1} for i in (1, 2)]
    rows = transit.station_rows(records(spark, both))
    assert [r["line"] for r in transit.station_table(rows).collect()] == ["blue"]
    assert {r["line"] for r in transit.station_table(rows, by_line=True).collect()} == {"green", "blue"}


def test_board_follows_its_topics(spark, tmp_path):
    log = message_log(4, 200)
    everything = frame(spark, log)
    for topic in {t for t, _ in log}:
        folder_of(everything.where(F.col("topic") == topic), tmp_path, topic, 1)
    table = programs.board_stream(spark, Broker(folder=str(tmp_path)), TOPICS, avro=False)
    boards = []
    run_available(programs.board_writer(table, f"{tmp_path}-ckpt", lambda board: boards.append(bag(board))))
    assert state_rows(current(table, f"{tmp_path}-ckpt")) == simulate(log)
    assert boards[-1] == bag(status_board(transit.board_state(everything, TOPICS)))


def test_one_pass_equals_one_frame_a_kind(spark):
    everything = frame(spark, message_log(3, 300))
    assert state_rows(transit.board_state(everything, TOPICS)) == state_rows(
        transit.board_state_of(everything, everything, everything, TOPICS))
    plan = transit.board_state(everything.repartition(2), TOPICS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") <= 2  # once in each of the initial and current plan


def test_weather_is_on_the_live_board(spark, tmp_path):
    folder_of(frame(spark, [(TOPICS.weather, {"temperature": 12.5, "status": "sunny"})]), tmp_path, TOPICS.weather, 1)
    shown = []
    stream = programs.weather_stream(spark, Broker(folder=str(tmp_path)), TOPICS, avro=False)
    run_available(console(stream, "update", shown.append).option("checkpointLocation", f"{tmp_path}-w"))
    assert shown == ['{"degrees":12,"sky":"Sunny"}']
