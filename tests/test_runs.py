"""Runs over responses that overlap, and runs that meet another one."""

import datetime as dt
import json
import os

import pytest

from wattlake.operators.state import NO_VERSION, StateConflict, init_state, read_state, state_version, write_state
from wattlake.plans.ingest import run_ingest
from wattlake.schema import STATE
from wattlake.sources.lake import read_readings
from wattlake.streaming.ingest import start_stream_ingest

AS_OF = dt.date(2031, 6, 10)


def response(meter, value, day="2031-06-09"):
    point = {"position": "5", "out_Quantity.quantity": str(value), "out_Quantity.quality": "A"}
    series = {"MarketEvaluationPoint": {"mRID": {"name": meter}}, "Period": [{"timeInterval": {"start": f"{day}T00:00:00Z"}, "Point": [point]}]}
    return json.dumps({"result": [{"success": True, "MyEnergyData_MarketDocument": {"TimeSeries": [series]}}]})


@pytest.mark.parametrize("bound", ["-1", "10485760"])
def test_the_last_line_of_a_meter_wins(spark, tmp_path, bound):
    """Whatever join filters the responses: their order is the one in which they landed."""
    meters = [f"m{i}" for i in range(60)]
    chunks = [("2031-06-01", "2031-06-05"), ("2031-06-06", "2031-06-10"), ("2031-06-06", "2031-06-10")]
    lines = [f"{m}\t{a}\t{b}\t{response(m, i)}" for i, (a, b) in enumerate(chunks) for m in meters]
    os.makedirs(tmp_path / "raw")
    (tmp_path / "raw" / "part-0.txt").write_text("\n".join(lines) + "\n")
    tracked = spark.createDataFrame([(m,) for m in meters], "id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", bound)
    try:
        run_ingest(spark, str(tmp_path / "raw"), str(tmp_path / "lake"), str(tmp_path / "state"), tracked, AS_OF, backfill_days=9, chunk_days=5, landing="lines")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    got = {r.metering_point_id: r.consumption_value for r in read_readings(spark, str(tmp_path / "lake")).collect()}
    assert got == {m: 2.0 for m in meters}


def states(spark, day):
    return spark.createDataFrame([("m", day)], STATE)


def test_of_two_runs_on_one_state_one_wins(spark, tmp_path):
    root = str(tmp_path / "state")
    assert state_version(spark, root) == NO_VERSION and read_state(spark, root) is None
    init_state(spark, root)
    init_state(spark, root)
    seen = state_version(spark, root)
    assert (seen, read_state(spark, root).count()) == (0, 0)
    assert write_state(spark, states(spark, AS_OF), root, expected=seen) == 1
    with pytest.raises(StateConflict):
        write_state(spark, states(spark, dt.date(2030, 1, 1)), root, expected=seen)
    assert read_state(spark, root).first().last_ingestion_date == AS_OF


def test_older_tables_are_read_and_continued(spark, tmp_path):
    root = str(tmp_path / "state")
    states(spark, dt.date(2031, 1, 1)).write.parquet(f"{root}/version=3")
    assert read_state(spark, root).first().last_ingestion_date == dt.date(2031, 1, 1)
    assert write_state(spark, states(spark, AS_OF), root) == 4
    assert read_state(spark, root).first().last_ingestion_date == AS_OF


def test_a_version_without_its_marker_raises(spark, tmp_path):
    root = str(tmp_path / "state")
    states(spark, AS_OF).write.parquet(f"{root}/version=0")
    os.makedirs(f"{root}/version=1")
    with pytest.raises(ValueError, match="_SUCCESS"):
        read_state(spark, root)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """Batches correct each other; the last one runs twice and is applied once."""
    raw, lake, checkpoint, rejects = (str(tmp_path / x) for x in ("raw", "lake", "checkpoint", "rejects"))
    os.makedirs(raw)
    for i in range(3):
        lines = [f"m{k}\t2031-06-01\t2031-06-10\t{response(f'm{k}', i)}" for k in range(i, 3)] + ["m0\t2031-06-01\t2031-06-10\tbusy"]
        with open(f"{raw}/{i}.txt", "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(f"{raw}/{i}.txt", (1_900_000_000 + i, 1_900_000_000 + i))

    def run():
        start_stream_ingest(spark, raw, lake, checkpoint, as_of=dt.datetime(2031, 6, 10), max_files_per_trigger=1, landing="lines", rejects_root=rejects).awaitTermination()
        files = sorted(os.path.join(d, f) for root in (lake, rejects) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet"))
        return {r.metering_point_id: r.consumption_value for r in read_readings(spark, lake).collect()}, spark.read.parquet(rejects).count(), files

    def forget(name):
        """As after a crash before the file was written; Hadoop's checksum goes with it."""
        folder, file = os.path.split(f"{checkpoint}/{name}")
        for path in (f"{folder}/{file}", f"{folder}/.{file}.crc"):
            if os.path.exists(path):
                os.remove(path)

    first = run()
    assert first[:2] == ({"m0": 0.0, "m1": 1.0, "m2": 2.0}, 3)
    forget("commits/2")
    assert run() == first  # not even a file was written again
    forget("commits/2")
    forget("applied/2.json")
    assert run()[:2] == first[:2]  # broken off before its end: applied again
