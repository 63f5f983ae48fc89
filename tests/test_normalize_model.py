"""Property test: documents are built together with the readings they must give.

Every value that can go into a document is listed with what it stands for, so
no rule is evaluated here: a reading is expected where all parts stand for
something.
"""

from __future__ import annotations

import datetime as dt
import json
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wattlake.operators.normalize import normalize_responses

UTC = dt.timezone.utc
AS_OF = dt.datetime(2031, 6, 1, tzinfo=UTC)
LEFT_OUT = "left out"
NOTHING = "nothing"  # what stands in the document makes no reading

# (in the document, what it stands for)
POSITIONS = [(LEFT_OUT, 0), ("1", 1), (" 2 ", 2), (4, 4), (2.7, 2), (True, 1), (None, NOTHING), ("1.5", NOTHING), ("x", NOTHING)]
AMOUNTS = [(LEFT_OUT, 0.0), ("0.5", 0.5), ("1e3", 1000.0), (" 2.25 ", 2.25), (3, 3.0), (1.5, 1.5), (True, 1.0)]
AMOUNTS += [(x, NOTHING) for x in (None, "abc", "", [1], {"a": 1})]
QUALITIES = [(LEFT_OUT, ""), ("A04", "A04"), ("", ""), ("E01", "E01")]
STARTS = [("2031-01-01T00:00:00Z", 0), ("2031-01-01T02:00:00+02:00", 0), ("20310102T030000Z", 27), ("2031-01-01T05Z", 5)]
STARTS += [(x, NOTHING) for x in (LEFT_OUT, None, "", "bad", "2031", "2031-01", "2031-1-5")]
SUCCESSES = [(x, True) for x in (True, "false", 1, [1])] + [(x, NOTHING) for x in (False, "", 0, [], {}, None, LEFT_OUT)]
METERS = [("m1", "m1"), ("m2", "m2"), ("other", NOTHING), (7, NOTHING), (None, NOTHING)]
UNITS = [(LEFT_OUT, "kWh"), ({"name": "MWh"}, "MWh"), ({"name": "kWh"}, "kWh"), ({}, "kWh")]

few = lambda choices, most: st.lists(choices, max_size=most)
one = st.sampled_from
points = st.tuples(one(POSITIONS), one(AMOUNTS), one(QUALITIES))
periods = st.tuples(one(STARTS), few(points, 4))
series = st.tuples(one(METERS), one(UNITS), few(periods, 3))
results = st.tuples(one(SUCCESSES), few(series, 2))


def present(**pairs):
    return {k.replace("__", "."): v for k, v in pairs.items() if v is not LEFT_OUT}


def written(chosen) -> str:
    """The document with the chosen values."""

    def of_point(p):
        return present(position=p[0][0], out_Quantity__quantity=p[1][0], out_Quantity__quality=p[2][0])

    def of_period(p):
        return {"timeInterval": present(start=p[0][0]), "Point": [of_point(x) for x in p[1]]}

    def of_series(s):
        meter = {"MarketEvaluationPoint": {"mRID": {"name": s[0][0]}}, "Period": [of_period(x) for x in s[2]]}
        return meter | present(measurement_Unit=s[1][0])

    def of_result(r):
        return {"MyEnergyData_MarketDocument": {"TimeSeries": [of_series(x) for x in r[1]]}} | present(success=r[0][0])

    return json.dumps({"result": [of_result(r) for r in chosen]})


def expected(chosen) -> list[tuple]:
    """(meter, hours after the first of January 2031, amount, quality, unit) of all that stands for something."""
    whole = [
        (ok[1], meter[1], start[1], position[1], amount[1], quality[1], unit[1])
        for ok, all_series in chosen
        for meter, unit, all_periods in all_series
        for start, all_points in all_periods
        for position, amount, quality in all_points
    ]
    return [(m, s + p - 1, a, q, u) for ok, m, s, p, a, q, u in whole if NOTHING not in (ok, m, s, p, a)]


@settings(max_examples=int(os.environ.get("MODEL_EXAMPLES", "12")), deadline=None, suppress_health_check=list(HealthCheck))
@given(docs=st.lists(few(results, 3), min_size=1, max_size=4))
def test_readings_are_what_the_documents_stand_for(spark, docs):
    frame = spark.createDataFrame([(written(d),) for d in docs], "value string")
    tracked = spark.createDataFrame([("m1",), ("m2",)], "metering_point_id string")
    readings, _ = normalize_responses(frame, tracked=tracked, as_of=AS_OF)
    origin = dt.datetime(2031, 1, 1, tzinfo=UTC)
    got = [
        (r.metering_point_id, (r.timestamp.astimezone(UTC) - origin) / dt.timedelta(hours=1), r.consumption_value, r.quality, r.unit)
        for r in readings.collect()
    ]
    assert sorted(got) == sorted(row for d in docs for row in expected(d))
