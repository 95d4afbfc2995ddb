import random
from collections import defaultdict

import pytest

from helpers import bag, records
from millrace import schemas as S
from millrace.functions.decode import flatten_json
from millrace.operators import aggregates, filters, joins, latest, ridership, topology
from millrace.sources import tables
from pyspark.sql import Observation
from pyspark.sql import functions as F


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


# --- filters ---

def test_thresholds_at_the_bound(spark):
    deposits = flatten_json(records(spark, [{"accountNumber": "1", "amount": a} for a in (199.99, 200.00, 200.01, None)]),
                            S.BANK_DEPOSIT)
    assert [round(r["amount"], 2) for r in filters.above(deposits, "amount", 200.00).collect()] == [200.01]
    clicks = spark.createDataFrame([(99,), (100,), (None,)], "number long")
    assert rows(filters.at_least(clicks, "number", 100)) == [(100,)]


def test_text_filters(spark):
    df = spark.createDataFrame([("birthDay",), ("x",), (None,)], "t string")
    assert rows(filters.contains(df, "t", "birth")) == [("birthDay",)]
    assert rows(filters.lacks(df, "t", "birth")) == [("x",)]


def test_topic_names(spark):
    df = spark.createDataFrame([("a.arrival.x.v3",), ("a.arrival.x.v2",), ("b.a.arrival.x.v3",), ("a.arrival..v3",)], "topic string")
    assert rows(df.where(filters.topic_between(F.col("topic"), "a.arrival.", ".v3"))) == [("a.arrival..v3",), ("a.arrival.x.v3",)]


def test_flags_and_presence(spark):
    df = spark.createDataFrame([(True, "a", 1), (False, "b", 2), (None, "c", None)], "blue boolean, line string, n int")
    assert rows(filters.flagged(df, "blue")) == [(True, "a", 1)]
    assert rows(filters.equals(df, "line", "b")) == [(False, "b", 2)]
    assert rows(filters.present(df, "blue", "n")) == [(False, "b", 2), (True, "a", 1)]


def test_latest_with_a_map_column(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1}), ("a", 2, {"y": 2})], "k string, t int, m map<string,int>")
    assert [tuple(r) for r in latest.latest_by_key(df, ["k"], ["t"]).collect()] == [("a", 2, {"y": 2})]


def test_routing_is_a_partition(spark):
    df = spark.createDataFrame([("blue",), ("red",), ("pink",), (None,), ("blue",)], "line string")
    branches = filters.route(df, "line", S.LINES)
    assert {k: v.count() for k, v in branches.items()} == {"blue": 2, "green": 0, "red": 1, None: 2}
    assert rows(df.select(filters.route_label(F.col("line"), S.LINES, "other"))) == rows(
        spark.createDataFrame([("blue",), ("blue",), ("other",), ("other",), ("red",)], "x string"))
    assert filters.fan_out(df, "to", S.LINES).count() == 15


# --- joins ---

def pairs(left, right):
    return sorted((l, r) for l in left for r in right if l[0] is not None and l[0] == r[0])


@pytest.mark.parametrize("split", [1, 3])
def test_inner_join_pairs_with_a_hot_key(spark, split):
    rng = random.Random(5)
    left = [(rng.choice(["hot", "hot", "a", "b", None]), i) for i in range(60)]
    right = [(rng.choice(["hot", "a", "c", None]), i) for i in range(20)]
    got = joins.inner_join(spark.createDataFrame(left, "k string, l int").withColumn("n", F.col("l")),
                           spark.createDataFrame(right, "j string, r int"), "k", "j", split=split,
                           split_by=["n"] if split > 1 else [])
    assert sorted(((r["k"], r["l"]), (r["j"], r["r"])) for r in got.collect()) == pairs(left, right)


def test_a_hot_key_in_tables_is_split_at_run_time(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("string").alias("k"), F.col("id").alias("l"))
        right = spark.range(0, 60000, 1, 8).select(F.col("id").cast("string").alias("j"), F.col("id").alias("r"))
        joined = joins.inner_join(left, right, "k", "j")
        assert joined.count() == 60000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.mark.parametrize("maker, name", [
    (tables.deposit_records, "orders"), (tables.bank_withdrawal_records, "lineitem"), (tables.vehicle_status_records, "lineitem"),
    (tables.attributed_click_records, "events"), (tables.risk_records, "events"), (tables.click_records, "events")])
def test_all_groups_of_a_split_are_used(spark, maker, name):
    records = maker(spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet"))
    spread, groups, keep = joins.split_for(records, 4)
    sizes = [r["count"] for r in spread.groupBy(F.pmod(F.xxhash64(*keep), F.lit(groups.groups))).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)


def test_split_needs_distinguishing_columns(spark):
    df = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(ValueError):
        joins.inner_join(df, df.toDF("j"), "k", "j", split=2)


def test_lookups_and_defaults(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    dim = spark.createDataFrame([("a", 5), ("a", 4), ("c", 6)], "k string, d int")
    assert rows(joins.lookup_first(facts, dim, ["k"], ["d"])) == [("a", 1, 4)]
    assert rows(joins.known_only(facts, dim, ["k"])) == [("a", 1)]
    assert rows(joins.with_defaults(facts, latest.first_by_key(dim, ["k"], ["d"]), ["k"], {"d": 0})) == [
        ("a", 1, 4), ("b", 2, 0), (None, 3, 0)]


# --- aggregates and latest values ---

def test_counts(spark):
    df = spark.createDataFrame([("ads",), ("d",), ("x",), (None,)], "value string")
    assert rows(aggregates.count_containing(df, "value", {"d": "d", "s": "s"})) == [(2, 1)]
    keyed = spark.createDataFrame([(1, None), (1, 2), (None, 3)], "k int, v int")
    assert rows(aggregates.keyed_count(keyed, "k")) == [(1, 2), (None, 0)]
    assert rows(aggregates.keyed_count(keyed, "k", "v")) == [(1, 1), (None, 1)]
    assert rows(aggregates.running_sum(keyed, "k", "v")) == [(1, 2), (None, 3)]


def test_count_over_a_table_counts_each_record_key_once(spark):
    df = spark.createDataFrame([("m1", 1, "a"), ("m1", 2, "b"), ("m2", 1, "b")], "key string, at int, station string")
    assert rows(aggregates.count_latest_by_key(df, ["key"], ["at"], "station")) == [("b", 2)]


def test_windows_at_their_bounds(spark):
    times = [0.0, 9.999999, 10.0, 59.0, 60.0]
    df = spark.createDataFrame([(t, "u", 1) for t in times], "s double, uri string, n int").select(
        F.timestamp_micros((F.col("s") * 1000000).cast("long")).alias("ts"), "uri", "n")
    seconds = lambda f: sorted((r[0], r[1]) for r in f.select(F.unix_seconds("window_start"), "total").collect())
    assert seconds(aggregates.windowed_sum(df, "ts", "uri", "n", "10 seconds")) == [(0, 2), (10, 1), (50, 1), (60, 1)]
    want = defaultdict(int)
    for t in times:
        for start in range(-50, 70, 10):
            if start <= t < start + 60:
                want[start] += 1
    hopping = aggregates.windowed_sum(df, "ts", "uri", "n", "60 seconds", "10 seconds")
    assert seconds(hopping) == sorted(want.items())
    assert seconds(aggregates.current_window(hopping, "uri")) == [(60, 1)]


@pytest.mark.parametrize("size, slide", [(60, 10), (45, 15), (7, 7)])
def test_current_window_from_panes_alone(spark, size, slide):
    rng = random.Random(size)
    data = [(rng.uniform(-400, 400), rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, 1, 2, 3])) for _ in range(300)]
    data += [(None, "a", 5), (12.0, "c", None)]
    df = spark.createDataFrame(data, "s double, uri string, n long").select(
        F.timestamp_micros((F.col("s") * 1000000).cast("long")).alias("ts"), "uri", "n")
    every = aggregates.windowed_sum(df, "ts", "uri", "n", f"{size} seconds", f"{slide} seconds")
    current = aggregates.current_window_table(df, "ts", "uri", "n", f"{size} seconds", f"{slide} seconds").rows()
    assert current.schema.simpleString() == every.schema.simpleString()
    assert rows(current) == rows(aggregates.current_window(every, "uri"))
    # Panes are not spread over the windows they are in.
    assert "explode" not in current._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size, slide", [(60, 10), (45, 15), (7, 1), (3000, 10)])
def test_hopping_sums_over_blocks_and_before_the_epoch(spark, size, slide):
    rng = random.Random(size)
    data = [(rng.uniform(-4000, 4000), rng.choice(["hot", "hot", "a", None]), rng.choice([None, 1, 2, 3])) for _ in range(300)]
    df = spark.createDataFrame(data, "s double, uri string, n long").select(
        F.timestamp_micros((F.col("s") * 1000000).cast("long")).alias("ts"), "uri", "n")
    got = aggregates.windowed_sum(df, "ts", "uri", "n", f"{size} seconds", f"{slide} seconds")
    window = df.groupBy("uri", F.window("ts", f"{size} seconds", f"{slide} seconds").alias("w")).agg(F.sum("n").alias("total"))
    assert bag(got) == bag(window.select("uri", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "total"))
    # Amounts in decimals keep their type, and other windows go the general way.
    exact = df.withColumn("n", F.col("n").cast("decimal(10,2)"))
    assert dict(aggregates.windowed_sum(exact, "ts", "uri", "n", "60 seconds", "10 seconds").dtypes)["total"] == "decimal(20,2)"
    assert aggregates.windowed_sum(df, "ts", "uri", "n", "25 seconds", "10 seconds").count() > 0


def test_latest_and_first(spark):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, None), ("b", 0, 9, "z"), (None, 5, 5, "n")],
                               "k string, t int, o int, v string")
    assert rows(latest.latest_by_key(df, ["k"], ["t", "o"])) == [("a", 1, 2, None), ("b", 0, 9, "z"), (None, 5, 5, "n")]
    assert rows(latest.first_by_key(df, ["k"], ["t", "o"]))[0] == ("a", 1, 1, "x")
    assert rows(latest.latest_overall(df, ["t", "o"], v="none")) == [("n",)]
    assert rows(latest.latest_overall(df.where("false"), ["t", "o"], v="none")) == [("none",)]


def test_latest_reduces_before_the_shuffle(spark):
    plan = latest.latest_by_key(spark.createDataFrame([(1, 2, 3)], "k int, t int, v int"), ["k"], ["t"]) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_max")


def test_progress(spark):
    seen = Observation("n")
    aggregates.with_progress(spark.range(250), seen).write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 250


def test_distinct_in_order(spark):
    df = spark.createDataFrame([("l", "b", 3), ("l", "a", 2), ("l", "b", 1)], "line string, name string, order int")
    assert rows(aggregates.distinct_in_order(df, "name", "order", ["line"])) == [("l", "a", 2), ("l", "b", 1)]


# --- topology and ridership ---

@pytest.mark.parametrize("chunks", [1, 4, 13])
def test_neighbours_match_a_sorted_list(spark, chunks):
    rng = random.Random(1)
    data = [("hot" if i % 3 else rng.choice(["x", "y"]), rng.choice([None, *range(20)]), i, None if i % 11 == 0 else i * 2)
            for i in range(90)]
    df = spark.createDataFrame(data, "line string, order int, id long, value long").repartition(3, "id")
    got = {r["id"]: (r["prev_value"], r["next_value"])
           for r in topology.neighbours(df, "line", ["order", "id"], "value", chunks).collect()}
    want = {}
    for line in {d[0] for d in data}:
        members = sorted((d for d in data if d[0] == line), key=lambda d: (d[1] is not None, d[1], d[2]))
        for i, d in enumerate(members):
            want[d[2]] = (members[i - 1][3] if i else None, members[i + 1][3] if i + 1 < len(members) else None)
    assert got == want


def test_line_topology(spark):
    stops = [  # two stops per station, one station on two lines, one name under two ids
        (1, "E", "", "Lake", "", 10, 0, False, True, False), (2, "W", "", "Lake", "", 10, 0, False, True, False),
        (3, "E", "", "Clark", "", 11, 1, False, True, True), (4, "E", "", "Harlem", "", 12, 2, False, True, False),
        (5, "E", "", "Harlem", "", 13, 5, False, True, False), (6, "E", "", "Nowhere", "", 14, 3, False, False, False),
        (7, "E", "", "Oak", "", 15, 4, None, None, True)]
    topo = topology.line_topology(spark.createDataFrame(stops, S.STATION))
    assert rows(topo.select("line", "station_id", "prev_station_id", "next_station_id", "shared_name")) == rows(
        spark.createDataFrame([("blue", 10, None, 11, False), ("blue", 11, 10, 12, False), ("blue", 12, 11, None, True),
                               ("green", 11, None, 15, False), ("green", 15, 11, None, False)],
                              "a string, b int, c int, d int, e boolean"))
    assert rows(topology.line_hops(topo)) == [("blue", 2), ("green", 1)]


def test_expected_entries(spark):
    seed = spark.createDataFrame([(1, "a", "", 3000.5, 2001.5, 0.0, 1)], S.RIDERSHIP_SEED)
    curve = spark.createDataFrame([(h, 0.5 if h == 7 else 0.01) for h in range(25)], S.RIDERSHIP_CURVE)
    got = {(r["day"], r["hour"]): r["entries"] for r in ridership.expected_entries(seed, curve).collect()}
    assert len(got) == 72
    assert got["weekday", 7] == 3000 * 0.5 // 300 and got["saturday", 7] == int(2002 * 0.5 / 300) and got["sunday", 7] == 0
    moments = spark.createDataFrame([(1, "2024-01-05 07:10:00"), (1, "2024-01-06 07:10:00"), (1, "2024-01-07 07:10:00")],
                                    "station_id int, t string").select("station_id", F.to_timestamp("t").alias("ts"))
    unknown = moments.limit(1).withColumn("station_id", F.lit(2))
    got = ridership.entries_at(moments.unionByName(unknown), seed, curve).orderBy("station_id", "ts")
    assert [r["entries"] for r in got.collect()] == [5, 3, 0, None]
