import time

import pytest

from helpers import bag, folder_of, records
from millrace import schemas as S
from millrace.plans import programs
from millrace.plans.ingest import ingest_increment, ingest_writer
from millrace.plans.lines_of_text import letter_counts
from millrace.session import shared_folder
from millrace.sources import avro_files, files, increments, tables, topics
from millrace.sources.growing import growing_lines
from millrace.streaming import polling, run, sinks
from pyspark.sql import functions as F


def test_kafka_options():
    broker = topics.Broker("host:9092")
    assert topics.kafka_options(broker, "fuel-level") == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "fuel-level", "startingOffsets": "earliest"}
    assert topics.kafka_options(broker, ["a", "b"], start="latest", max_records=5) == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "a,b", "startingOffsets": "latest", "maxOffsetsPerTrigger": "5"}
    assert topics.subscription(pattern="^org.x.arrival.*.v3") == {"subscribePattern": "org.x.arrival.*.v3.*"}
    assert sinks.kafka_sink_options(broker, "out") == {"kafka.bootstrap.servers": "host:9092", "topic": "out"}


def test_a_real_broker_needs_the_kafka_package(spark):
    try:
        topics.read_topic(spark, topics.Broker("nowhere:1"), "t")
    except Exception as error:
        if "Failed to find data source: kafka" in str(error):
            pytest.skip("the Kafka source is an external package, which is not installed here")
        raise


def test_topics_by_pattern_and_by_list(spark, tmp_path):
    names = ["org.x.arrival.a.v3", "org.x.arrival.b.v3", "org.x.weather.v3"]
    for name in names:
        folder_of(records(spark, [name], name), tmp_path, name, 1)
    broker = topics.Broker(folder=str(tmp_path))
    read = lambda *a, **k: sorted(r["topic"] for r in topics.read_topic(spark, broker, *a, streaming=False, **k).collect())
    assert read(pattern="^org.x.arrival.*.v3") == names[:2]
    assert read([names[0], names[2]]) == [names[0], names[2]]
    assert read(names[1]) == [names[1]]


def test_lines_of_text(spark, tmp_path):
    (tmp_path / "a.txt").write_text("add\nsees\n\nno\n")
    lines = files.text_lines(spark, str(tmp_path), reuse=True)
    assert tuple(letter_counts(lines).first()) == (1, 1)
    assert lines.count() == 4 and lines.is_cached
    lines.unpersist()


def test_appended_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("a\nb\n")
    (tmp_path / "in" / "2.txt").write_text("c\n")
    kept = run.keep_rows(files.appended_lines(spark, f"{tmp_path}/in", max_files=1), "lines")
    assert bag(kept) == {("a",): 1, ("b",): 1, ("c",): 1}


def test_csv_with_quotes_and_carriage_returns(spark, tmp_path):
    path = tmp_path / "stations.csv"
    path.write_bytes(b"stop_id,direction_id,stop_name,station_name,station_descriptive_name,station_id,order,red,blue,green\r\n"
                     b'61,E,Weir (Upper),Weir,"Weir (Old, New, Both)",9,12,FALSE,FALSE,TRUE\r\n'
                     b"62,W,Weir,Weir,x,9,,TRUE,FALSE,FALSE\r\n")
    got = [tuple(r) for r in files.csv_table(spark, str(path), S.STATION).collect()]
    assert got == [(61, "E", "Weir (Upper)", "Weir", "Weir (Old, New, Both)", 9, 12, False, False, True),
                   (62, "W", "Weir", "Weir", "x", 9, None, True, False, False)]


def test_increments_cover_each_row_once(spark):
    rows = spark.createDataFrame([(i, f"r{i}") for i in (1, 2, 5, 9)], "id long, v string")
    first, mark = ingest_increment(rows.where("id <= 2"), "id")
    assert mark == 2 and first.count() == 2
    second, mark = ingest_increment(rows, "id", mark)
    assert mark == 9 and sorted(r["key"] for r in second.collect()) == ["5", "9"]
    none, mark = ingest_increment(rows, "id", mark)
    assert mark == 9 and none.count() == 0
    empty, mark = increments.next_increment(rows.where("false"), "id")
    assert mark is None and empty.count() == 0


def test_increment_bounds_reach_the_scan(spark, tmp_path):
    spark.range(100).write.parquet(f"{tmp_path}/t")
    rows, _ = increments.next_increment(spark.read.parquet(f"{tmp_path}/t"), "id", 40)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(id,99)" in plan and "GreaterThan(id,40)" in plan


def test_database_statements():
    assert increments.jdbc_bounds_query("stations", "stop_id", None) == "SELECT MIN(stop_id) AS low, MAX(stop_id) AS high FROM stations"
    assert increments.jdbc_rows_query("stations", "stop_id", 7, 20) == (
        "(SELECT * FROM stations WHERE stop_id > 7 AND stop_id <= 20) increment")
    assert increments.topic_for("stations", "connect-") == "connect-stations"


def test_only_allowed_tables_are_read(spark):
    for table, column, allowed in (("secrets", "id", ["stations"]), ("secrets", "id", []), ("a; b", "id", ["a; b"]), ("a", "id--", ["a"])):
        with pytest.raises(ValueError):
            increments.jdbc_increment(spark, "jdbc:x", table, column, allowed=allowed)


def test_declared_tables(spark):
    frame = records(spark, [{"station_id": i, "station_name": n, "line": "blue"} for i, n in ((1, "a"), (2, "b"), (1, "c"))])
    topics.declare_table(frame, "turnstile_stream", S.TURNSTILE)
    topics.declare_table(frame, "turnstile_table", S.TURNSTILE, key="station_id")
    count = "SELECT station_id, COUNT(station_id) AS n FROM {} GROUP BY station_id"
    assert bag(topics.topic_sql(spark, count.format("turnstile_stream"))) == {(2, 1): 1, (1, 2): 1}
    assert bag(topics.topic_sql(spark, count.format("turnstile_table"))) == {(1, 1): 1, (1, 2): 1}


def test_avro_files_with_a_map(spark, tmp_path):
    rows = [("e", "t", "u", 5, {"a": ("x", "y"), "b": ("z", "")}), ("f", "t", "u", 0, {})]
    df = spark.createDataFrame(rows, S.ATTRIBUTED_CLICK)
    avro_files.write_avro(df, f"{tmp_path}/a", S.ATTRIBUTED_CLICK_AVRO)
    assert bag(avro_files.read_avro(spark, f"{tmp_path}/a", S.ATTRIBUTED_CLICK_AVRO)) == bag(df)
    empty = avro_files.read_avro(spark, f"{tmp_path}/a", S.CLICK_AVRO)
    assert empty.columns == ["email", "timestamp", "uri", "number"] and empty.count() == 2


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_table_streams_read_one_file_or_a_folder(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    assert run.keep_rows(tables.table_stream(spark, str(tmp_path), "events"), "folder").count() == 5


@pytest.mark.parametrize("name", sorted(programs.PROGRAMS))
def test_programs_run_on_file_topics(spark, tmp_path, name):
    program = programs.PROGRAMS[name]
    options = {"turnstile-summary": {"avro": False}, "large-deposits-within": {"delay": "1 hour", "within": "1 day"},
               "uri-sums-tumbling": {"watermark": "1 hour"}, "large-deposits": {"split": 2}}.get(name)
    click = {"email": "e", "timestamp": "t", "uri": "u", "number": 100, "attributes": {"a": {"element": "x", "content": "y"}},
             "truckNumber": "1", "accountNumber": "1", "transactionId": "1", "customer": "c", "amount": 300}
    for topic in program.topics:
        topic = topic.format(space="org.x.")
        folder_of(records(spark, [click, "oops"], topic), tmp_path, topic, 1)
    broker = topics.Broker(folder=str(tmp_path))
    result = programs.build_program(spark, name, broker, space="org.x.", options=options)
    assert result.isStreaming
    run.run_available(programs.program_writer(result, name, broker, f"{tmp_path}/ckpt", out="out"))
    stored = topics.read_topic(spark, broker, "out", streaming=False)
    assert stored.columns == S.ENVELOPE.names
    if program.rejects:
        rejected = topics.read_topic(spark, broker, program.rejects, streaming=False)
        assert [(bytes(r["key"]), bytes(r["value"])) for r in rejected.where("value = cast('oops' as binary)").collect()] == [(b"malformed", b"oops")]
    with pytest.raises(ValueError):
        programs.build_program(spark, name, broker, space="org.x.", options={"nonsense": 1})


def test_the_console_shows_every_row_whole(spark, tmp_path):
    shown = []
    stream = topics.read_topic(spark, folder_of(records(spark, ["x" * 50] * 45, "in"), tmp_path, "in", 1), "in")
    run.run_available(sinks.console(stream.select(F.col("value").cast("string"), F.lit(None).cast("int").alias("n")), show=shown.append)
                      .option("checkpointLocation", f"{tmp_path}/c"))
    assert shown == ['{"value":"' + "x" * 50 + '","n":null}'] * 45


def test_a_table_is_ingested_by_name(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/in/things.parquet")
    broker = topics.Broker(folder=f"{tmp_path}/topics")
    writer = ingest_writer(spark, "things", "id", broker, "connect-", f"{tmp_path}/ckpt", path=f"{tmp_path}/in", seconds=1)
    query = writer.start()
    stored = lambda: topics.read_topic(spark, broker, "connect-things", streaming=False)
    for _ in range(150):
        if list((tmp_path / "topics").glob("*/*/_SUCCESS")):
            break
        time.sleep(0.2)
    query.stop()
    assert stored().count() == 5
    assert polling.Marks(f"{tmp_path}/ckpt-marks").last(spark, "things") == 4


def test_bytes_are_published_as_they_are(spark, tmp_path):
    frame = spark.createDataFrame([(bytearray(b"\x00\xff"), bytearray(b"\xfe\x01"))], "key binary, value binary")
    frame.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in")
    broker = topics.Broker(folder=f"{tmp_path}/topics")
    run.run_available(sinks.publish_bytes(stream, broker, "raw", f"{tmp_path}/ckpt"))
    row = topics.read_topic(spark, broker, "raw", streaming=False).first()
    assert (bytes(row["key"]), bytes(row["value"])) == (b"\x00\xff", b"\xfe\x01")


def test_program_topics_can_be_replaced(spark, tmp_path):
    broker = folder_of(records(spark, ["x"], "my-fuel"), tmp_path, "my-fuel", 1)
    assert programs.build_program(spark, "fuel-level", broker, ["my-fuel"], streaming=False).count() == 1
    with pytest.raises(ValueError):
        programs.build_program(spark, "large-deposits", broker, ["one"])


def test_polling_publishes_each_row_once(spark, tmp_path):
    broker, marks = topics.Broker(folder=str(tmp_path)), polling.Marks(f"{tmp_path}/marks")
    rows = spark.createDataFrame([(i, f"r{i}") for i in range(9)], "id long, v string")
    keys = lambda: sorted(bytes(r["key"]).decode() for r in topics.read_topic(spark, broker, "connect-purchases", streaming=False).collect())

    def poll(visible, batch, fail=False):
        def read(low, high):
            if fail and high is not None:
                raise OSError("the table is gone")
            return increments.next_increment(rows.where(F.col("id") < visible), "id", low, high)
        return polling.poll_once(spark, "purchases", read, "id", broker, increments.topic_for("purchases", "connect-"), marks, batch)

    assert [poll(3, 0), poll(3, 1), poll(6, 2)] == [2, 2, 5]
    # A failure between the range and its rows: the same micro-batch has the same range when it runs again.
    with pytest.raises(OSError):
        poll(7, 3, fail=True)
    assert keys() == list("012345") and marks.last(spark, "purchases") == 6
    assert [poll(9, 3), poll(9, 4)] == [6, 8]
    assert keys() == list("012345678")
    # A failure after the rows: the micro-batch replaces what it wrote.
    assert [poll(9, 4), poll(9, 2)] == [8, 5]
    assert keys() == list("012345678")
    assert marks.last(spark, "other") is None


def test_polling_runs_on_a_clock(spark, tmp_path):
    calls = []
    query = polling.polling_writer(spark, calls.append, f"{tmp_path}/ckpt", seconds=1).start()
    for _ in range(100):
        if len(calls) >= 2:
            break
        time.sleep(0.2)
    query.stop()
    assert calls[:2] == [0, 1]


@pytest.mark.parametrize("pattern, folders", [
    ("^org.x.arrival.*.v3", "org?x?arrival*"), ("org\\.x", "org?x*"), ("^ab*c", "a*"), ("a|b", "*"), ("x(y|z)", "*"), ("x[yz]", "x*"), (".*", "*")])
def test_folders_of_a_topic_pattern(pattern, folders):
    assert topics.folder_pattern(pattern) == folders


def test_topics_that_come_later_are_read(spark, tmp_path):
    broker = topics.Broker(folder=f"{tmp_path}/topics")
    write = lambda name: records(spark, [name], f"org.x.{name}").write.parquet(f"{broker.folder}/org.x.{name}")
    write("other")

    def seen():
        stream = topics.read_topic(spark, broker, pattern="^org.x.arrival.*")
        run.run_available(run.row_writer(stream, f"{tmp_path}/out", f"{tmp_path}/ckpt"))
        return sorted(r["topic"] for r in spark.read.schema(S.ENVELOPE).parquet(f"{tmp_path}/out").collect())

    assert seen() == []
    write("arrival.a")
    assert seen() == ["org.x.arrival.a"]
    write("arrival.b")
    write("third")
    assert seen() == ["org.x.arrival.a", "org.x.arrival.b"]


def test_batch_sizes_and_replay(spark, tmp_path):
    broker = folder_of(records(spark, list("abcdef"), "in"), tmp_path, "in", 3)

    def sizes(checkpoint):
        stream = topics.read_topic(spark, broker, "in", max_files=1)
        query = run.run_available(sinks.for_each_batch(stream, lambda rows, _: rows.count() and None, checkpoint), "sizes")
        return [n for n in run.batch_sizes(query) if n]

    first = run.checkpoint_for(spark, "sizes")
    assert sizes(first) == [2, 2, 2]
    assert sizes(first) == []
    assert sizes(run.replay_checkpoint(spark, "sizes")) == [2, 2, 2]


@pytest.mark.parametrize("task_bytes", [7, 1 << 20])
def test_a_growing_file_gives_each_line_once(spark, tmp_path, task_bytes):
    folder, out = tmp_path / "logs", f"{tmp_path}/out"
    folder.mkdir()

    def grow(name, text):
        with open(folder / name, "a", newline="") as file:
            file.write(text)

    def read():
        lines = growing_lines(spark, str(folder), task_bytes)
        run.run_available(run.row_writer(lines, out, f"{tmp_path}/ckpt"))
        return sorted((r["file"].split("/")[-1], r["offset"], r["value"]) for r in spark.read.parquet(out).collect())

    grow("a.log", "first\nsecond é\r\n\nunfin")
    grow("_hidden", "no\n")
    assert read() == [("a.log", 0, "first"), ("a.log", 6, "second é"), ("a.log", 17, "")]
    grow("a.log", "ished\n")
    grow("b.log", "".join(f"line {i}\n" for i in range(40)))
    got = read()
    assert ("a.log", 18, "unfinished") in got and len(got) == 44
    long = "x" * (200_000 if task_bytes > 7 else 300)
    grow("a.log", long + "\nlast\n")
    got = read()
    assert len(got) == 46 and got == read()
    assert [v for f, _, v in got if f == "a.log"] == ["first", "second é", "", "unfinished", long, "last"]
    assert len(set(got)) == len(got)
