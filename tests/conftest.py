from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wattlake.schema import READING  # noqa: E402
from wattlake.session import build_session  # noqa: E402

UTC = dt.timezone.utc


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="wattlake-warehouse-")
    session = build_session(
        app="wattlake-tests",
        master="local[4]",
        shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": warehouse},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def reading(mp, ts, value, quality="A", unit="kWh", ingested=None):
    ingested = ingested or dt.datetime(2025, 1, 2, tzinfo=UTC)
    return (mp, ts, value, quality, unit, ingested, ingested.date())


@pytest.fixture
def make_readings(spark):
    def _make(rows):
        return spark.createDataFrame(rows, READING)

    return _make


@pytest.fixture
def one_day(make_readings):
    """meter_001 on 2025-01-01: hour h has value h + 1 (24 readings)."""
    base = dt.datetime(2025, 1, 1, tzinfo=UTC)
    return make_readings(
        [reading("meter_001", base + dt.timedelta(hours=h), float(h + 1), ingested=base) for h in range(24)]
    )
