"""The meter/day layout written by tasks equals what Spark's partitioned write leaves."""

import datetime as dt
import glob
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tests.conftest import UTC, reading
from wattlake.operators import upsert
from wattlake.operators.upsert import migrate_lake, upsert_readings, to_lake_rows, write_partitions
from wattlake.schema import READING_COLUMNS
from wattlake.sources import folders
from wattlake.sources.lake import read_lake
from wattlake.sources.manifest import NANOS_CONF

T0 = dt.datetime(2025, 1, 1, 10, tzinfo=UTC)
ODD = ["a", "", "a b", "x/y", "50%", "k=v", "q?*:#[]{}^'\"\\", "tab\there", "\x7f", "."]
HOUR = dt.timedelta(hours=1)


def listed(root):
    return sorted(os.path.relpath(d, root) for d in glob.glob(f"{root}/metering_point=*/date=*"))


def test_folders_and_rows_equal_those_of_sparks_writer(spark, make_readings, tmp_path):
    rows = make_readings([reading(m, T0 + n * 9 * HOUR, float(n)) for m in ODD for n in range(4)])
    ours, theirs = str(tmp_path / "ours"), str(tmp_path / "theirs")
    lake = to_lake_rows(rows)
    write_partitions(lake, ours, "meter_day")
    keys = ["metering_point", "date"]
    lake.select(*READING_COLUMNS, *keys).write.partitionBy(*keys).parquet(theirs)
    assert listed(ours) == listed(theirs) and len(listed(ours)) == 2 * len(ODD)
    a, b = (read_lake(spark, root, layout="meter_day", nanos=False) for root in (ours, theirs))
    assert a.count() == 4 * len(ODD) and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    files = glob.glob(f"{ours}/*/*/*.parquet")
    assert len(files) == len(listed(ours))  # one a folder
    schema = pq.ParquetFile(files[0]).schema
    assert schema.column(schema.names.index("timestamp")).converted_type == "TIMESTAMP_MICROS"


def test_tasks_write_without_a_process_for_each_file(spark, make_readings, tmp_path):
    root = str(tmp_path / "lake")
    upsert_readings(spark, make_readings([reading("a", T0, 1.0), reading("b", T0, 2.0)]), root, layout="meter_day")
    # Hadoop's local file system leaves a checksum file beside each file that it makes (and forks chmod for both)
    assert not glob.glob(f"{root}/*/*/.*.crc")
    assert not [n for n in os.listdir(root) if n.startswith(".staging")]


def test_only_folders_with_rows_are_replaced(spark, make_readings, tmp_path):
    root = str(tmp_path / "lake")
    write_partitions(to_lake_rows(make_readings([reading(m, T0, 1.0) for m in "abc"])), root, "meter_day")
    kept = glob.glob(f"{root}/metering_point=c/*/*")
    open(f"{root}/metering_point=a/date=2025-01-01/.old.crc", "w").close()
    write_partitions(to_lake_rows(make_readings([reading(m, T0, 2.0) for m in "ab"])), root, "meter_day")
    assert glob.glob(f"{root}/metering_point=c/*/*") == kept
    got = {(r.metering_point_id, r.consumption_value) for r in read_lake(spark, root, layout="meter_day", nanos=False).collect()}
    assert got == {("a", 2.0), ("b", 2.0), ("c", 1.0)}
    assert os.listdir(f"{root}/metering_point=a/date=2025-01-01") == [os.path.basename(f) for f in glob.glob(f"{root}/metering_point=a/*/*.parquet")]


def test_a_folder_of_several_batches_is_one_file(spark, make_readings, tmp_path):
    root = str(tmp_path / "lake")
    rows = [reading("a", T0 + n * dt.timedelta(seconds=1), float(n)) for n in range(50)] + [reading("b", T0, 0.0)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        write_partitions(to_lake_rows(make_readings(rows)), root, "meter_day")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    (file,) = glob.glob(f"{root}/metering_point=a/*/*.parquet")
    assert pq.read_table(file).column("consumption_value").to_pylist() == [float(n) for n in range(50)]


def test_a_swap_that_is_run_again_finds_what_it_moved(tmp_path):
    home, staged = tmp_path / "lake", tmp_path / "staged.parquet"
    staged.write_text("rows")
    batch = pa.RecordBatch.from_pydict({"folder": ["metering_point=a/date=2025-01-01"], "files": [[str(staged)]]})
    for _ in range(2):
        assert [b.column("n").to_pylist() for b in folders._folder_swap(str(home))(iter([batch]))] == [[1]]
    assert (home / "metering_point=a" / "date=2025-01-01" / "staged.parquet").read_text() == "rows"


def foreign(root, folder, name="data.parquet", **changed):
    """Two rows as another writer may leave them; a column that is changed to None is left out."""
    at = pa.array([T0, T0 + HOUR], pa.timestamp("us", "UTC"))
    columns = {
        "metering_point_id": pa.array(["f", "f"]),
        "timestamp": at,
        "consumption_value": pa.array([1.5, None]),
        "quality": pa.array(["A", None]),
        "unit": pa.array(["kWh", "kWh"]),
        "ingestion_timestamp": at,
        "ingestion_date": pa.array([T0.date(), None]),
    }
    columns = {k: v for k, v in (columns | changed).items() if v is not None}
    os.makedirs(f"{root}/{folder}", exist_ok=True)
    pq.write_table(pa.table(columns), f"{root}/{folder}/{name}")


def whole(spark, root, nanos=False):
    return read_lake(spark, root, layout="meter_day", nanos=nanos, whole=True)


def same_as_sparks_scan(spark, root, nanos=False):
    ours, theirs = whole(spark, root, nanos), read_lake(spark, root, layout="meter_day", nanos=nanos)
    assert ours.schema == theirs.schema and ours.inputFiles() == []
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
    return ours.count()


def test_migration_keeps_no_folder_in_the_driver(spark, make_readings, tmp_path, monkeypatch):
    old, new, written = str(tmp_path / "old"), str(tmp_path / "new"), []
    upsert_readings(spark, make_readings([reading(m, T0 + n * 9 * HOUR, float(n)) for m in ODD for n in range(4)]), old, layout="meter_day")
    monkeypatch.setattr(upsert, "write_partitions", lambda rows, *a: (written.append(rows), write_partitions(rows, *a)))
    migrate_lake(spark, old, new)
    # Spark's scan has the name of each folder and file in the driver
    assert [rows.inputFiles() for rows in written] == [[]]
    a, b = read_lake(spark, old), read_lake(spark, new)
    columns = [*READING_COLUMNS, "date"]
    assert b.count() == 4 * len(ODD)
    assert a.select(columns).exceptAll(b.select(columns)).isEmpty() and b.select(columns).exceptAll(a.select(columns)).isEmpty()


def test_tasks_read_what_sparks_scan_reads(spark, make_readings, tmp_path):
    root, none = str(tmp_path / "lake"), "__HIVE_DEFAULT_PARTITION__"
    write_partitions(to_lake_rows(make_readings([reading(m, T0 + n * 9 * HOUR, float(n)) for m in ODD for n in range(4)])), root, "meter_day")
    at, day = pa.array([T0, None]), "date=2025-01-01"
    foreign(root, f"metering_point=f/{day}")
    foreign(root, f"metering_point=f/{day}", "part-2", extra=pa.array([1, 2]), unit=None)
    foreign(root, f"metering_point=0012/date={none}")
    foreign(root, f"metering_point={none}/{day}", timestamp=at.cast(pa.timestamp("ms", "UTC")), ingestion_timestamp=at.cast(pa.timestamp("us")))
    foreign(root, f"metering_point=g/{day}", quality=None, Quality=pa.array(["B", "C"]).dictionary_encode(), unit=pa.array(["kWh", "Wh"], pa.large_string()))
    foreign(root, f"metering_point=h/{day}", consumption_value=pa.array([0.1, None], pa.float32()), quality=pa.nulls(2, pa.string()))
    foreign(root, f"metering_point=h/{day}", "int", consumption_value=pa.array([3, None], pa.int32()), unit=pa.array([b"x", None]))
    foreign(root, f"metering_point=h/{day}/below", metering_point_id=pa.array(["other", None]))
    for hidden in ("_SUCCESS", "_temporary/0/x", ".staging/metering_point=z/x", f"metering_point=f/{day}/.x.crc", f"metering_point=f/{day}/_x", f"metering_point=.z/{day}/empty", "stray"):
        os.makedirs(os.path.dirname(f"{root}/{hidden}"), exist_ok=True)
        open(f"{root}/{hidden}", "w").write("" if hidden.endswith("empty") else "no Parquet file")
    assert same_as_sparks_scan(spark, root) == 4 * len(ODD) + 2 * 8


def test_files_with_many_rows_and_folders_with_many_files(spark, tmp_path):
    root, n = str(tmp_path / "lake"), 25_001
    many = [T0 + k * dt.timedelta(seconds=1) for k in range(n)]
    rows = {"metering_point_id": pa.array(["f"] * n), "timestamp": pa.array(many, pa.timestamp("us", "UTC")), "consumption_value": pa.array(range(n)).cast(pa.float64())}
    foreign(root, "metering_point=f/date=2025-01-01", **rows, quality=None, unit=None, ingestion_timestamp=None, ingestion_date=None)
    for k in range(250):
        foreign(root, "metering_point=g/date=2025-01-01", f"part-{k}")
    assert same_as_sparks_scan(spark, root) == n + 500


def test_nanoseconds_are_read_as_sparks_scan_reads_them(spark, tmp_path):
    root, before = str(tmp_path / "lake"), spark.conf.get(NANOS_CONF)
    at = pa.array([1_700_000_000_123_456_789, -1_001], pa.timestamp("ns", "UTC"))
    foreign(root, "metering_point=n/date=2023-11-14", timestamp=at, ingestion_timestamp=pa.array([None, 5_000], pa.timestamp("ns")))
    try:
        whole(spark, root, nanos=True).collect()
        assert spark.conf.get(NANOS_CONF) == before  # tasks need no setting
        assert same_as_sparks_scan(spark, root, nanos=True) == 2
    finally:
        spark.conf.set(NANOS_CONF, before)


def test_whole_reads_refuse_what_sparks_scan_refuses(spark, tmp_path):
    for name, changed, folder in [("long", {"consumption_value": pa.array([1, 2])}, "a"), ("date", {"ingestion_date": pa.array(["2025-01-01", None])}, "a"), ("folder", {}, "a/b=1")]:
        root = str(tmp_path / name)
        foreign(root, "metering_point=m/date=2025-01-01")
        foreign(root, f"metering_point={folder}/date=2025-01-01", **changed)
        with pytest.raises(Exception, match="is not in a folder|is not read as"):
            whole(spark, root).collect()
        with pytest.raises(Exception):
            read_lake(spark, root, layout="meter_day", nanos=False).select(READING_COLUMNS).collect()
    os.makedirs(tmp_path / "none" / "metering_point=a")
    for missing in ("none", "nowhere"):
        with pytest.raises(FileNotFoundError):
            whole(spark, str(tmp_path / missing))
    (tmp_path / "none" / "metering_point=a" / "date=2025-01-01").mkdir()
    (tmp_path / "none" / "metering_point=a" / "date=2025-01-01" / "empty").write_text("")
    assert same_as_sparks_scan(spark, str(tmp_path / "none")) == 0
