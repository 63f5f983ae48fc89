"""The driver-table stand-ins plant what the oracle queries claim to test."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from wattlake.sources import standins as S

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_packed_documents_parse_and_carry_planted_cases(spark):
    docs = S.event_responses(spark, SF)
    parsed = docs.select(F.try_parse_json("value").alias("v"))
    assert parsed.where(F.col("v").isNull()).count() == 0
    results = parsed.select(F.explode(F.try_variant_get("v", "$.result", "array<variant>")).alias("r"))
    failed = results.where(~F.try_variant_get("r", "$.success", "boolean")).count()
    ev = S.table(spark, SF, "events")
    error_days = ev.where(F.col("event_type") == "error").select("user_id", F.to_date("ts")).distinct().count()
    assert failed == error_days > 0
    points = docs.select(F.size(F.from_json("value", "struct<result: array<struct<MyEnergyData_MarketDocument: struct<TimeSeries: array<struct<Period: array<struct<Point: array<string>>>>>>>>>")["result"][0]["MyEnergyData_MarketDocument"]["TimeSeries"][0]["Period"][0]["Point"]).alias("n"))
    assert points.agg(F.sum("n")).first()[0] == ev.count()
    assert points.agg(F.max("n")).first()[0] <= S.POINTS_PER_DOCUMENT * 2


def test_listing_leaves_out_negative_balances_and_shares_names(spark):
    listing = S.customer_listing(spark, SF)
    cust = S.table(spark, SF, "customer")
    assert listing.count() == cust.count()
    names = listing.select(F.col("attributes")["name"].alias("n"))
    assert names.where(F.col("n").startswith("Shared ")).count() > names.where(F.col("n").startswith("Shared ")).distinct().count()
