"""Property test: the reporting views against plain-Python versions."""

from __future__ import annotations

import datetime as dt
import math
import os
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import UTC, reading
from wattlake.operators import views as V

BASE = dt.datetime(2025, 1, 1, tzinfo=UTC)
value = st.sampled_from([None, -1.5, 0.0, 0.0, 0.25, 1.0, 2.5, 7.0])
row = st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 24 * 100), value)
SETTINGS = settings(
    max_examples=int(os.environ.get("MODEL_EXAMPLES", "10")), deadline=None, suppress_health_check=list(HealthCheck)
)


def _r(x, places=9):
    return None if x is None else round(x, places)


def model(rows):
    per_day, stage_count = defaultdict(list), defaultdict(int)
    for mp, hours, v in rows:
        day = (BASE + dt.timedelta(hours=hours)).date()
        stage_count[(mp, day)] += 1
        if v is not None and v >= 0:
            per_day[(mp, day)].append(v)
    daily = {k: (sum(vs), sum(vs) / len(vs), min(vs), max(vs), len(vs)) for k, vs in per_day.items()}
    variability = {
        k: (math.sqrt(sum((x - sum(vs) / len(vs)) ** 2 for x in vs) / len(vs)), max(vs)) for k, vs in per_day.items()
    }
    missing = {k: (n, 24, 24 - n) for k, n in stage_count.items()}
    monthly_tot = defaultdict(float)
    for (mp, day), vs in per_day.items():
        monthly_tot[(mp, day.replace(day=1))] += sum(vs)
    monthly, flags = {}, {}
    for mp in {k[0] for k in monthly_tot}:
        months = sorted(m for (p, m) in monthly_tot if p == mp)
        prev = None
        for m in months:
            t = monthly_tot[(mp, m)]
            ratio = None if prev is None or prev == 0 else (t - prev) / prev
            monthly[(mp, m)] = (t, prev, None if prev is None else t - prev, ratio)
            prev = t
    for mp in {k[0] for k in daily}:
        days = sorted(d for (p, d) in daily if p == mp)
        totals = [daily[(mp, d)][0] for d in days]
        for i, d in enumerate(days):
            p = totals[i - 1] if i > 0 else None
            n = totals[i + 1] if i + 1 < len(totals) else None
            flags[(mp, d)] = totals[i] == 0 and (p or 0) > 0 and (n or 0) > 0
    return daily, variability, missing, monthly, flags


def _keyed(df, key_cols, places=9):
    out = {}
    for r in df.collect():
        d = r.asDict()
        key = tuple(d.pop(k) for k in key_cols)
        out[key] = tuple(_r(v, places) if isinstance(v, float) else v for v in d.values())
    return out


def _rounded(m, places=9):
    return {k: tuple(_r(v, places) if isinstance(v, float) else v for v in vals) for k, vals in m.items()}


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=40))
def test_views_match_model(spark, make_readings, rows):
    df = make_readings([reading(mp, BASE + dt.timedelta(hours=h), v) for mp, h, v in rows])
    staged = V.stage(df)
    cleaned = V.clean(staged)
    daily_df = V.daily_consumption(cleaned)
    daily, variability, missing, monthly, flags = model(rows)
    key = ["metering_point_id", "reading_date"]
    assert _keyed(daily_df, key) == _rounded(daily)
    assert _keyed(V.load_variability(cleaned), key) == _rounded(variability)
    assert _keyed(V.missing_data_summary(staged), key) == _rounded(missing)
    assert _keyed(V.monthly_consumption(cleaned), ["metering_point_id", "month_start"]) == _rounded(monthly)
    got_flags = {k: v[1] for k, v in _keyed(V.daily_quality_flags(daily_df), key).items()}
    assert got_flags == flags
