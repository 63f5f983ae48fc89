"""Property tests: Spark operators against brute-force Python on small inputs."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import UTC, reading
from wattlake.operators.joins import fits_broadcast
from wattlake.operators.planning import chunk_windows
from wattlake.operators.upsert import upsert_readings
from wattlake.sources.lake import read_lake

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(
    windows=st.lists(
        st.tuples(st.integers(0, 400), st.integers(-5, 400)), min_size=1, max_size=6
    ),
    days=st.integers(1, 120),
)
def test_chunks_cover_their_window(spark, windows, days):
    """Chunks lie end to end from the window's first to its last day; all but the last have full length."""
    origin = dt.date(2031, 1, 1).toordinal()
    rows = [(f"m{i}", dt.date.fromordinal(origin + a), dt.date.fromordinal(origin + a + b)) for i, (a, b) in enumerate(windows)]
    df = spark.createDataFrame(rows, "metering_point_id string, date_from date, date_to date")
    got = chunk_windows(df, days).collect()
    for meter, first, last in rows:
        spans = sorted((r.chunk_from.toordinal(), r.chunk_to.toordinal()) for r in got if r.metering_point_id == meter)
        covered = [day for lo, hi in spans for day in range(lo, hi + 1)]
        assert covered == list(range(first.toordinal(), last.toordinal() + 1))
        assert all(hi - lo + 1 == days for lo, hi in spans[:-1])
        assert all(1 <= hi - lo + 1 <= days for lo, hi in spans)


hours = st.integers(0, 71)
batch = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), hours, st.integers(0, 9)), max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches=st.lists(batch, min_size=1, max_size=3), layout=st.sampled_from(["day", "meter_day"]))
def test_upsert_matches_brute_force(spark, make_readings, tmp_path_factory, batches, layout):
    root = str(tmp_path_factory.mktemp("lake"))
    base = dt.datetime(2025, 1, 1, tzinfo=UTC)
    lake: list[tuple[str, int, int]] = []
    for rows in batches:
        new_keys = {(m, h) for m, h, _ in rows}
        lake = [r for r in lake if (r[0], r[1]) not in new_keys] + list(rows)
        df = make_readings([reading(m, base + dt.timedelta(hours=h), float(v)) for m, h, v in rows])
        upsert_readings(spark, df, root, layout=layout if not read_lake_exists(root) else None)
    if not lake:
        return
    base_micros = int(base.timestamp()) * 1_000_000
    got = sorted(
        (r[0], int(r[1]), int(r[2]))
        for r in read_lake(spark, root)
        .selectExpr(
            "metering_point_id",
            f"(unix_micros(timestamp) - {base_micros}) div 3600000000",
            "consumption_value",
        )
        .collect()
    )
    assert got == sorted(lake)


def read_lake_exists(root):
    import os

    return any(name.startswith(("date=", "metering_point=")) for name in os.listdir(root))


def test_broadcast_bound_is_checked(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert fits_broadcast(df, max_rows=10)
    assert not fits_broadcast(df, max_rows=9)
    assert not fits_broadcast(df, max_rows=100, max_bytes=20)
