"""Flattening of nested API responses (the source system's cases and derived ones)."""

from __future__ import annotations

import datetime as dt
import json

from wattlake.operators.normalize import normalize_responses, unparsable_documents

UTC = dt.timezone.utc
MP = "meter-north-7"
AS_OF = dt.datetime(2025, 11, 20, 12, tzinfo=UTC)


def _response(points, start="2025-11-15T23:00:00Z", success=True, unit="KWH", mp=MP):
    series = {"MarketEvaluationPoint": {"mRID": {"name": mp}}, "Period": [{"timeInterval": {"start": start}, "Point": points}]}
    if unit is not None:
        series["measurement_Unit"] = {"name": unit}
    return {"result": [{"success": success, "errorText": "", "MyEnergyData_MarketDocument": {"TimeSeries": [series]}}]}


def _run(spark, docs, tracked=(MP,)):
    df = spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string")
    ids = spark.createDataFrame([(t,) for t in tracked], "metering_point_id string") if tracked else None
    readings, rejects = normalize_responses(df, tracked=ids, as_of=AS_OF)
    return readings.orderBy("timestamp").collect(), rejects.collect()


def _pt(pos, qty=None, quality=None):
    p = {}
    if pos is not None:
        p["position"] = pos
    if qty is not None:
        p["out_Quantity.quantity"] = qty
    if quality is not None:
        p["out_Quantity.quality"] = quality
    return p


def test_empty_result(spark):
    assert _run(spark, [{"result": []}])[0] == []


def test_unsuccessful_result_skipped(spark):
    assert _run(spark, [_response([_pt("1", "0.5")], success=False)])[0] == []


def test_single_point(spark):
    rows, _ = _run(spark, [_response([_pt("1", "0.5", "A04")])])
    assert len(rows) == 1
    r = rows[0]
    assert (r.metering_point_id, r.consumption_value, r.quality, r.unit) == (MP, 0.5, "A04", "KWH")
    assert r.timestamp.astimezone(UTC).replace(tzinfo=None) == dt.datetime(2025, 11, 15, 23)
    assert r.ingestion_date == dt.date(2025, 11, 20)


def test_three_points(spark):
    rows, _ = _run(spark, [_response([_pt("1", "0.5"), _pt("2", "0.6"), _pt("3", "0.7")])])
    assert [r.consumption_value for r in rows] == [0.5, 0.6, 0.7]


def test_positions_cross_midnight(spark):
    rows, _ = _run(spark, [_response([_pt("1", "1"), _pt("2", "2")])])
    assert [r.timestamp.astimezone(UTC).replace(tzinfo=None) for r in rows] == [
        dt.datetime(2025, 11, 15, 23),
        dt.datetime(2025, 11, 16, 0),
    ]


def test_untracked_meter_dropped(spark):
    assert _run(spark, [_response([_pt("1", "1")], mp="999")])[0] == []


def test_missing_quantity_is_zero_and_missing_quality_empty(spark):
    rows, _ = _run(spark, [_response([_pt("1")])])
    assert (rows[0].consumption_value, rows[0].quality) == (0.0, "")


def test_string_to_float_and_z_suffix(spark):
    rows, _ = _run(spark, [_response([_pt("1", "1.234")]), _response([_pt("1", "1.5")], start="2025-11-16T00:00:00Z")])
    assert sorted(r.consumption_value for r in rows) == [1.234, 1.5]


def test_nested_quantity_object_gives_defaults(spark):
    point = {"position": "1", "out_Quantity": {"quantity": "9", "quality": "A04"}}
    rows, _ = _run(spark, [_response([point])])
    assert (rows[0].consumption_value, rows[0].quality) == (0.0, "")


def test_bad_points_dropped_siblings_kept(spark):
    pts = [
        _pt("1", "1.0"),
        {"position": None, "out_Quantity.quantity": "2"},
        {"position": "3", "out_Quantity.quantity": None},
        _pt("4", "abc"),
        _pt("1.5", "5"),
        _pt("6", "1_000"),
        _pt(" 7 ", 7.5),
    ]
    rows, rejects = _run(spark, [_response(pts)])
    assert sorted(r.consumption_value for r in rows) == [1.0, 7.5]
    assert sorted(r.reject_reason for r in rejects) == [
        "bad_position",
        "bad_position",
        "bad_quantity",
        "bad_quantity",
        "bad_quantity",
    ]


def test_missing_position_is_one_hour_before_start(spark):
    rows, _ = _run(spark, [_response([_pt(None, "1")])])
    assert rows[0].timestamp.astimezone(UTC).replace(tzinfo=None) == dt.datetime(2025, 11, 15, 22)


def test_bad_or_missing_start_drops_period(spark):
    doc = _response([_pt("1", "1")], start="not a date")
    doc["result"][0]["MyEnergyData_MarketDocument"]["TimeSeries"][0]["Period"].append(
        {"timeInterval": {}, "Point": [_pt("1", "2")]}
    )
    doc["result"][0]["MyEnergyData_MarketDocument"]["TimeSeries"][0]["Period"].append(
        {"timeInterval": {"start": "2025-11-15T23:00:00+02:00"}, "Point": [_pt("1", "3")]}
    )
    rows, rejects = _run(spark, [doc])
    assert [(r.consumption_value, r.timestamp.astimezone(UTC).replace(tzinfo=None)) for r in rows] == [
        (3.0, dt.datetime(2025, 11, 15, 21))
    ]
    assert {r.reject_reason for r in rejects} == {"bad_period_start"}


def test_unit_default_only_when_absent(spark):
    rows, _ = _run(spark, [_response([_pt("1", "1")], unit=None)])
    assert rows[0].unit == "kWh"


def test_start_without_offset_read_as_utc(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows, _ = _run(spark, [_response([_pt("1", "1")], start="2025-11-15T23:00:00")])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert rows[0].timestamp.astimezone(UTC).replace(tzinfo=None) == dt.datetime(2025, 11, 15, 23)


def test_no_tracked_filter_keeps_all_meters(spark):
    rows, _ = _run(spark, [_response([_pt("1", "1")], mp="a"), _response([_pt("1", "2")], mp="b")], tracked=None)
    assert sorted(r.metering_point_id for r in rows) == ["a", "b"]


def test_unparsable_documents(spark):
    df = spark.createDataFrame([("not json",), ('{"result": []}',)], "value string")
    assert unparsable_documents(df).count() == 1
    readings, _ = normalize_responses(df, as_of=AS_OF)
    assert readings.count() == 0


def test_success_follows_python_truthiness(spark):
    docs = []
    for flag in [True, False, "false", "", 1, 0, [], [1], {}, {"a": 1}, None]:
        d = _response([_pt("1", "1")])
        d["result"][0]["success"] = flag
        docs.append(d)
    missing = _response([_pt("1", "1")])
    del missing["result"][0]["success"]
    docs.append(missing)
    rows, _ = _run(spark, docs)
    # True, "false", 1, [1], {"a": 1} are truthy.
    assert len(rows) == 5


def test_numeric_meter_id_is_not_tracked(spark):
    doc = _response([_pt("1", "1")])
    doc["result"][0]["MyEnergyData_MarketDocument"]["TimeSeries"][0]["MarketEvaluationPoint"]["mRID"]["name"] = 42
    assert _run(spark, [doc], tracked=("42",))[0] == []


def test_boolean_quantity_is_one(spark):
    rows, _ = _run(spark, [_response([_pt("1", True)])])
    assert rows[0].consumption_value == 1.0


def test_non_object_point_is_rejected_not_defaulted(spark):
    rows, rejects = _run(spark, [_response([_pt("1", "1"), 5, None, ["x"]])])
    assert [r.consumption_value for r in rows] == [1.0]
    assert sorted(r.reject_reason for r in rejects) == ["bad_point"] * 3


def test_out_of_range_position_rejected(spark):
    rows, rejects = _run(spark, [_response([_pt("1", "1"), _pt("2000000000", "2")])])
    assert [r.consumption_value for r in rows] == [1.0]
    assert [r.reject_reason for r in rejects] == ["bad_position"]
