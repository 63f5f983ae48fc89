"""Responses are applied in order of landing, and only usable ones count as answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattlake.functions.parsing import is_object, parse_instant
from wattlake.operators.normalize import latest_response, usable
from wattlake.operators.metadata import normalize_listing


@pytest.mark.parametrize(
    "text, ok",
    [
        ("{}", True),
        ('{"result": []}', True),
        ('{"result": ""}', True),
        ('{"result": {}}', True),
        ('{"result": [{}]}', True),
        ("[]", False),
        ('"busy"', False),
        ("null", False),
        ('{"result": null}', False),
        ('{"result": [5]}', False),
        ('{"result": {"a": 1}}', False),
        ("not json", False),
        (None, False),
    ],
)
def test_usable(spark, text, ok):
    df = spark.createDataFrame([(text,)], "value string")
    assert df.select(usable(F.col("value"))).first()[0] is ok


def test_later_response_replaces_earlier_and_keeps_its_own_duplicates(spark):
    t = dt.datetime(2031, 3, 4, 5)
    rows = [("m", t, 1.0, 1), ("m", t, 2.0, 2), ("m", t, 3.0, 2), ("m", t + dt.timedelta(hours=1), 9.0, 1)]
    df = spark.createDataFrame(rows, "metering_point_id string, timestamp timestamp, v double, seq int")
    assert sorted(r.v for r in latest_response(df, "seq").collect()) == [2.0, 3.0, 9.0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2031-03-04T05:06:07Z", "2031-03-04 05:06:07"),
        ("20310304T050607Z", "2031-03-04 05:06:07"),
        ("2031-03-04T05Z", "2031-03-04 05:00:00"),
        ("2031-03-04 05:06", "2031-03-04 05:06:00"),
        ("2031-03-04T05:06:07+02:00", "2031-03-04 03:06:07"),
        ("2031-03-04", "2031-03-04 00:00:00"),
        ("2031", None),
        ("2031-03", None),
        ("2031-3-4", None),
        (" 2031-03-04T05:06:07Z", None),
        ("2031-03-04 05:06:07 Europe/Copenhagen", None),
        ("2031-13-04T05:06:07Z", None),
        (None, None),
    ],
)
def test_start_forms(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").select(parse_instant(F.col("t")).alias("t"))
    shown = df.select(F.unix_micros("t")).first()[0]
    want = None if expected is None else int(dt.datetime.fromisoformat(expected + "+00:00").timestamp()) * 1_000_000
    assert shown == want


def test_ids_lose_all_white_space_at_their_ends(spark):
    rows = [("\t\n", {}, 0), ("\t m1\n", {}, 1), (" m 2 ", {}, 2)]
    df = spark.createDataFrame(rows, "metering_point_id string, attributes map<string,string>, position long")
    assert sorted(r[0] for r in normalize_listing(df).select("metering_point_id").collect()) == ["m 2", "m1"]


def test_order_is_looked_up_where_responses_meet(spark):
    t, later = dt.datetime(2031, 3, 4, 5), dt.datetime(2031, 3, 4, 6)
    rows = [("m", t, 1.0, 70), ("m", t, 2.0, 5), ("m", t, 3.0, 5), ("m", later, 9.0, 70), (None, t, 4.0, 70)]
    df = spark.createDataFrame(rows, "metering_point_id string, timestamp timestamp, v double, response long")
    # numbers tell responses apart, but 5 landed after 70
    places = spark.createDataFrame([(70, 1), (5, 2), (6, 3)], "response long, response_order int")
    out = latest_response(df.where("metering_point_id IS NOT NULL"), "response", places)
    assert out.columns == ["metering_point_id", "timestamp", "v"]
    assert sorted(r.v for r in out.collect()) == [2.0, 3.0, 9.0]


def test_is_object_does_not_depend_on_what_is_inside(spark):
    texts = {"{}": True, '{"a": [1, {"b": null}]}': True, "[{}]": False, "null": False, '"x"': False, "5": False, "true": False, "no json": False}
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("v", F.try_parse_json("t"))
    assert {r.t: r.o for r in df.select("t", is_object(F.col("v")).alias("o")).collect()} == texts
