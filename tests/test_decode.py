import base64
import json

import pytest

from helpers import bag, records
from millrace import schemas as S
from millrace.functions import decode, scalars
from pyspark.sql import functions as F


def values(frame):
    return [tuple(r) for r in frame.collect()]


def test_key_and_value_as_text(spark):
    got = decode.as_text(records(spark, ["x", None], keys=["a", "b"]), "truckId", "gear")
    assert got.columns == ["truckId", "gear"]
    assert values(got) == [("a", "x"), ("b", None)]


def test_flatten_keeps_every_row(spark):
    texts = ['{"truckNumber":"77","destination":"Harbour","milesFromShop":18,"odometerReading":4200}',
             '{"truckNumber":"1","odomoterReading":5}', "{}", "not json", None,
             '{"truckNumber":null,"milesFromShop":"7","other":1}', '{"truckNumber":12}']
    got = values(decode.flatten_json(records(spark, texts), S.VEHICLE_STATUS))
    assert got == [("77", "Harbour", 18, 4200), ("1", None, None, None), (None,) * 4, (None,) * 4, (None,) * 4,
                   (None,) * 4, ("12", None, None, None)]


def test_numbers_keep_their_digits_in_text_fields(spark):
    text = '{"accountNumber":"12","amount":31.7,"dateAndTime":"x","transactionId":98765432101}'
    got = values(decode.flatten_json(records(spark, [text]), S.BANK_WITHDRAWAL))
    assert got == [("12", "31.7", "x", "98765432101")]


def test_required_keys(spark):
    rows = [{"email": "a", "timestamp": "t", "uri": "u"}, {"user_email": "a", "timestamp": "t", "uri": "u"},
            {"email": None, "timestamp": "t", "uri": "u", "more": [1]}, {"email": "a"}, "oops", None, {}]
    valid, rejected = decode.required_split(records(spark, rows), S.CLICK_PLAIN, ("email", "uri", "timestamp"), keep=["offset"])
    assert {r["offset"] for r in valid.collect()} == {0, 2}
    assert {r["offset"]: r["reason"] for r in rejected.collect()} == {
        1: "email", 3: "uri", 4: "malformed", 5: "malformed", 6: "email"}


def test_typed_records(spark):
    good = {"email": "a", "timestamp": "t", "uri": "u", "number": 3}
    rows = [good, {**good, "number": "x"}, {**good, "number": None}, {k: good[k] for k in ("email", "uri")},
            {**good, "number": 2**40}, "oops"]
    valid, rejected = decode.typed_split(records(spark, rows), S.CLICK, keep=["offset"])
    assert {r["offset"]: r["number"] for r in valid.collect()} == {0: 3, 2: None, 4: 2**40}
    assert {r["offset"]: r["reason"] for r in rejected.collect()} == {
        1: "type of number", 3: "missing timestamp", 5: "malformed"}


def test_strict_mode_fails_on_bad_text(spark):
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        decode.strict_json(records(spark, ["oops"]), S.CLICK).collect()


def feed(element, **more):
    return {"key": "a2luZA==", "existType": "NONE", "Ch": False, "Incr": False,
            "zSetEntries": [{"element": element, "Score": 0.0}], **more}


def encoded(entity):
    return base64.b64encode(json.dumps(entity).encode()).decode()


def test_change_feed(spark):
    customer = {"customerName": "Ada Vale", "email": "ada@vale.example", "phone": "555000", "birthDay": "1988-11-30"}
    rows = [feed(encoded(customer)), feed("eyJub3Qg"), feed("a"), feed("!!!"), feed(encoded([1, 2])),
            {**feed(""), "zSetEntries": []}, {"key": "x"}, "oops", None,
            {**feed(encoded(customer)), "zSetEntries": [{"element": encoded({"email": "first"})}, {"element": encoded(customer)}]}]
    got = decode.decode_change_feed(records(spark, rows), S.FITNESS_CUSTOMER, keep=["offset"]).orderBy("offset").collect()
    assert len(got) == len(rows)
    assert tuple(got[0])[:4] == ("Ada Vale", "ada@vale.example", "555000", "1988-11-30")
    assert got[9]["email"] == "first" and got[9]["birthDay"] is None
    assert all(r["email"] is None for r in got[1:9])


def test_base64_with_stray_characters(spark):
    texts = ["aGVsbG8=", "aGVsbG8", "aGVs\nbG8=\n", "aGVs-bG8=", "!!!", "a", "aGVsbG8=xx", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(decode.base64_text(F.col("t")))
    assert [r[0] for r in got.collect()] == ["hello"] * 4 + ["", None, None, None]


def test_feed_fields_are_case_sensitive(spark):
    got = decode.flatten_json(records(spark, [feed("aaaa")]), S.CHANGE_FEED).first()
    assert got["existType"] == "NONE" and got["ch"] is None and got["incr"] is None
    assert got["zSetEntries"][0]["score"] is None


def test_json_output_drops_or_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None, 1)], "k string, b string, c int")
    assert values(decode.json_value(df, "k")) == [("a", '{"k":"a","c":1}')]
    assert values(decode.json_value(df, "k", nulls=True)) == [("a", '{"k":"a","b":null,"c":1}')]
    assert json.loads(decode.pretty_json(df).first()[0]) == {"k": "a", "c": 1}
    assert "\n" in decode.pretty_json(df).first()[0]


def test_framing(spark):
    df = spark.createDataFrame([(bytearray(b"payload"),), (bytearray(b""),)], "p binary")
    framed = df.select(decode.frame(F.col("p"), 258).alias("v"))
    assert bytes(framed.first()[0]) == b"\x00\x00\x00\x01\x02payload"
    got = framed.select(decode.framed_schema_id(F.col("v")), decode.framed_payload(F.col("v"))).collect()
    assert [(r[0], bytes(r[1])) for r in got] == [(258, b"payload"), (258, b"")]
    bad = spark.createDataFrame([(bytearray(b"\x01\x00\x00\x01\x02x"),), (bytearray(b"\x00"),), (None,)], "v binary")
    assert values(bad.select(decode.framed_schema_id(F.col("v")), decode.framed_payload(F.col("v")))) == [(None, None)] * 3


def test_messages_of_unknown_schemas_are_told(spark):
    df = spark.createDataFrame([(1,), (2,)], "n int").select(decode.frame(F.lit("p").cast("binary"), 7).alias("value")).unionByName(
        spark.range(1).select(decode.frame(F.lit("p").cast("binary"), 8).alias("value"))).unionByName(
        spark.range(1).select(F.lit("oops").cast("binary").alias("value")))
    assert sorted(r["reason"] for r in decode.unknown_schema(df, [7]).collect()) == ["no frame", "schema 8"]
    assert decode.unknown_schema(df, [7, 8]).count() == 1


def test_registry_avro_round_trip(spark):
    if not decode.avro_available(spark):
        pytest.skip("from_avro and to_avro need the external spark-avro package, which is not installed here")
    df = spark.createDataFrame([(1, "BL001", "a", "blue", "in_service", None, None)], S.ARRIVAL)
    sent = decode.encode_avro(df, F.lit(5).cast("long"), S.key_avro("arrival.key"), 1, S.ARRIVAL.names, S.ARRIVAL_AVRO, 2)
    assert bag(decode.decode_avro(sent, S.ARRIVAL_AVRO)) == bag(df)


def test_avro_schema_mapping():
    back = S.spark_schema(S.ARRIVAL_AVRO)
    assert [(f.name, f.dataType) for f in back] == [(f.name, f.dataType) for f in S.ARRIVAL]
    assert [f.name for f in back if f.nullable] == ["prev_station_id", "prev_direction"]
    assert [f.dataType.simpleString() for f in S.spark_schema(S.ATTRIBUTED_CLICK_AVRO)] == [
        f.dataType.simpleString() for f in S.ATTRIBUTED_CLICK]


def test_scalar_rules(spark):
    df = spark.createDataFrame([("Miller's/Low-East End",), (None,)], "n string")
    assert values(df.select(scalars.slug(F.col("n")))) == [("millers_and_low_east_end",), (None,)]
    assert df.select(scalars.topic_name(F.col("n"), "arrival.", ".v3")).first()[0] == "arrival.millers_and_low_east_end.v3"
    flags = spark.createDataFrame([(r, g, b) for r in (True, False, None) for g in (True, False) for b in (True, False)],
                                  "red boolean, green boolean, blue boolean")
    for row in flags.select("*", scalars.line_color().alias("line")).collect():
        assert row["line"] == ("red" if row["red"] else "green" if row["green"] else "blue" if row["blue"] else None)
    one = spark.range(1)
    assert one.select(*[scalars.color_code(F.lit(c)) for c in ("blue", "red", "green", "pink")]).first()[:] == (
        "#1E90FF", "#DC143C", "#32CD32", "0xFFFFFF")
    assert one.select(scalars.title_text(F.lit("partly_cloudy"))).first()[0] == "Partly Cloudy"
    assert one.select(scalars.whole_number(F.lit(-3.9)), scalars.whole_number(F.lit(51.75))).first()[:] == (-3, 51)
    assert one.select(scalars.or_default(F.lit(None).cast("string"), "---")).first()[0] == "---"
    assert one.select(scalars.epoch_millis(scalars.from_epoch_millis(F.lit(987654321098)))).first()[0] == 987654321098
    times = one.select(*[F.date_format(scalars.parse_time(F.lit(t)), "yyyy-MM-dd HH:mm:ss") for t in (
        "Mar 3, 2011, 9:15:00 PM", "Nov 21, 2019 12:05:59 AM", "yesterday")]).first()[:]
    assert times == ("2011-03-03 21:15:00", "2019-11-21 00:05:59", None)


def test_scores_are_in_bounds_and_repeatable(spark):
    df = spark.range(2000)
    scores = df.select(scalars.random_score(F.col("id"), seed=3).alias("s"))
    assert scores.agg(F.min("s"), F.max("s")).first()[:] == (1, 100)
    assert values(scores) == values(df.select(scalars.random_score(F.col("id"), seed=3)))
    assert df.select(scalars.random_score(seed=3).alias("s")).where("s < 1 or s > 100").count() == 0
