"""Meter metadata (the source system's cases)."""

from __future__ import annotations

import json

import pytest

from wattlake.operators import metadata as M
from wattlake.session import session_conf
from wattlake.schema import METADATA, METADATA_SOURCE


def _listing(spark, rows):
    return spark.createDataFrame(rows, METADATA_SOURCE)


def test_extra_attributes_become_json(spark):
    meta = M.build_metadata(M.normalize_listing(_listing(spark, [("123", {"name": "Main", "custom": "value"}, 0)])))
    row = meta.first()
    assert row.extra_metadata == '{"custom": "value"}'  # as json.dumps writes it
    assert json.loads(row.extra_metadata) == {"custom": "value"}
    assert row.name == "Main"


def test_core_only_has_null_extra(spark):
    attrs = {"name": "Main", "type": "consumption", "location": "Home", "description": "d"}
    row = M.build_metadata(M.normalize_listing(_listing(spark, [("123", attrs, 0)]))).first()
    assert (row.type, row.location, row.description, row.extra_metadata) == ("consumption", "Home", "d", None)
    assert M.build_metadata(M.normalize_listing(_listing(spark, [("1", attrs, 0)]))).schema == METADATA


def test_empty_or_blank_name_falls_back_to_id(spark):
    rows = [("1", None, 0), ("2", {"name": ""}, 1), ("3", {"type": "x"}, 2)]
    got = {r.metering_point_id: r.name for r in M.build_metadata(M.normalize_listing(_listing(spark, rows))).collect()}
    assert got == {"1": "1", "2": "2", "3": "3"}


def test_blank_ids_dropped_and_trimmed(spark):
    rows = [("  ", {"name": "x"}, 0), (" 42 ", {"name": "y"}, 1)]
    got = [(r.metering_point_id, r.name) for r in M.normalize_listing(_listing(spark, rows)).collect()]
    assert got == [("42", "y")]


def test_no_meters_is_an_error(spark):
    with pytest.raises(ValueError):
        M.require_meters(M.normalize_listing(_listing(spark, [(" ", None, 0)])))


def test_tracked_set_last_listed_wins(spark):
    rows = [("a", {"name": "Same"}, 0), ("b", {"name": "Same"}, 1), ("c", {"name": "Other"}, 2)]
    got = {r.name: r.metering_point_id for r in M.tracked_meters(M.normalize_listing(_listing(spark, rows))).collect()}
    assert got == {"Same": "b", "Other": "c"}


def test_save_metadata_table(spark):
    meta = M.build_metadata(M.normalize_listing(_listing(spark, [("1", {"name": "n"}, 0)])))
    M.save_metadata_table(spark, meta, "wl_reporting.meter_metadata")
    assert spark.table("wl_reporting.meter_metadata").first().name == "n"


def test_read_listing_keeps_order_and_validates(spark, tmp_path):
    from wattlake.sources.listing import read_listing

    good = tmp_path / "meters.json"
    good.write_text(
        '{"metering_points": {"north-7": {"name": "Home", "floor": 2, "tags": {"a": 1}},'
        ' "0012": null, "b": {"name": "Home"}}}'
    )
    rows = read_listing(spark, str(good)).orderBy("position").collect()
    assert [r.metering_point_id for r in rows] == ["north-7", "0012", "b"]
    meta = {r.metering_point_id: r for r in M.build_metadata(M.normalize_listing(read_listing(spark, str(good)))).collect()}
    assert meta["north-7"].extra_metadata == '{"floor": 2, "tags": {"a": 1}}'
    assert meta["0012"].name == "0012" and meta["0012"].extra_metadata is None
    tracked = M.tracked_meters(M.normalize_listing(read_listing(spark, str(good)))).collect()
    assert {(r.name, r.metering_point_id) for r in tracked} == {("Home", "b"), ("0012", "0012")}
    for text in ('{"other": {}}', '{"metering_points": ["a"]}', '{"metering_points": {"a": "oops"}}'):
        bad = tmp_path / "bad.json"
        bad.write_text(text)
        with pytest.raises(ValueError):
            read_listing(spark, str(bad))


def test_extra_metadata_text_matches_json_dumps(spark):
    entries = [("b", "x"), ("a", 'say "hi"'), ("c", "tab\there"), ("d", None), ("sted", "Kælder ø å"), ("e", "😀")]
    df = spark.createDataFrame([("1", entries)], "metering_point_id string, e array<struct<k:string,v:string>>")
    from pyspark.sql import functions as F

    listing = df.select("metering_point_id", F.map_from_entries("e").alias("attributes"), F.lit(0).cast("long").alias("position"))
    got = M.build_metadata(M.normalize_listing(listing)).first().extra_metadata
    assert got == json.dumps(dict(entries))


def test_typed_listing_matches_json_dumps(spark, tmp_path):
    from wattlake.sources.listing import read_listing

    attrs = {
        "name": 0, "type": "pv", "floor": 2, "ok": True, "ratio": 2.5, "note": None, "sted": "Kælder",
        "nested": {"a": [1, 2, {"c": "x, y: z \"q\""}], "b": {}}, "list": [],
    }
    path = tmp_path / "typed.json"
    path.write_text(json.dumps({"metering_points": {"m1": attrs}}))
    row = M.build_metadata(M.normalize_listing(read_listing(spark, str(path)))).first()
    extras = {k: v for k, v in attrs.items() if k not in ("name", "type")}
    assert row.extra_metadata == json.dumps(extras)
    assert (row.name, row.type) == ("m1", "pv")  # a falsy name falls back to the id


def test_listing_by_lines_is_split_and_keeps_its_order(spark, tmp_path):
    from wattlake.sources.listing import read_listing

    lines = ['{" m%d\\t": {"name": "n%d", "floor": %d}}' % (i, i % 50, i) for i in range(400)]
    lines += ['{"m7": {"name": "later"}}', "", '{"  ": {"name": "blank"}}', '{"m400": null}']
    (tmp_path / "a.json").write_text("\n".join(lines[:200]) + "\n")
    (tmp_path / "b.json").write_text("\n".join(lines[200:]) + "\n")
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "2000"}):
        listing = read_listing(spark, str(tmp_path), lines=True)
        assert listing.rdd.getNumPartitions() > 4
        rows = M.normalize_listing(listing).orderBy("position").collect()
        tracked = {r.name: r.metering_point_id for r in M.tracked_meters(M.normalize_listing(listing)).collect()}
    assert [r.metering_point_id for r in rows] == [f"m{i}" for i in range(401)]
    assert rows[7].name == "later" and rows[400].name == "m400"
    assert tracked["n49"] == "m399" and tracked["later"] == "m7" and tracked["n7"] == "m357"


@pytest.mark.parametrize("line", ["[1]", "no json", '{"m": 5}', "null"])
def test_lines_that_are_no_mapping_raise(spark, tmp_path, line):
    from wattlake.sources.listing import read_listing

    (tmp_path / "a.json").write_text('{"m": {}}\n' + line + "\n")
    with pytest.raises(ValueError, match="mapping"):
        read_listing(spark, str(tmp_path), lines=True)
