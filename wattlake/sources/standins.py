"""The driver's test tables read as meter data.

The driver ships TPC-H-like tables, not meter readings.  These functions map
them onto the reading record and the metadata listing, always over whole
tables, so every query's work grows with the data:

- ``events``: meter = user_id, timestamp = ts (UTC wall clock), value = value,
  quality = event_type; it lands the next day.  Variants: ``dirty`` (NULL for
  error events, negated view events) and ``sparse`` (0 except purchases).
- ``lineitem``: meter = l_suppkey, timestamp = l_shipdate, value = l_quantity;
  it spans years, so month-over-month changes are not all NULL.
- ``customer`` with ``nation`` and ``region``: the metadata listing.
- ``events`` packed into nested API responses, to drive the normaliser and the
  ingest; one document per meter, chunk, day and salt bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.schema import (
    API_DOCUMENT,
    API_ERROR_TEXT,
    API_INTERVAL,
    API_METER,
    API_METER_ID,
    API_NAME,
    API_PERIOD,
    API_POINT,
    API_POSITION,
    API_QUALITY,
    API_QUANTITY,
    API_RESULT,
    API_START,
    API_SUCCESS,
    API_TIME_SERIES,
    API_UNIT,
)

MP = "metering_point_id"

# Documents hold about this many points at most: a (meter, day) with more
# rows is split over several documents by a hash bucket of the event id.
POINTS_PER_DOCUMENT = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_value(variant: str) -> Column:
    value, kind = F.col("value"), F.col("event_type")
    if variant == "base":
        return value
    if variant == "dirty":
        return F.when(kind == "error", F.lit(None).cast("double")).when(kind == "view", -value).otherwise(value)
    if variant == "sparse":
        return F.when(kind == "purchase", value).otherwise(F.lit(0.0))
    raise ValueError(f"unknown variant {variant}")


def event_readings(spark: SparkSession, sf_dir: str, variant: str = "base") -> DataFrame:
    ev = table(spark, sf_dir, "events")
    landed = F.date_add(F.to_date("ts"), 1)
    return ev.select(
        F.col("user_id").cast("string").alias(MP),
        F.col("ts").alias("timestamp"),
        event_value(variant).alias("consumption_value"),
        F.col("event_type").alias("quality"),
        F.lit("kWh").alias("unit"),
        landed.cast("timestamp_ntz").alias("ingestion_timestamp"),
        landed.alias("ingestion_date"),
    )


def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    landed = F.date_add(F.to_date("l_shipdate"), 1)
    return li.select(
        F.col("l_suppkey").cast("string").alias(MP),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("consumption_value"),
        F.col("l_returnflag").alias("quality"),
        F.lit("kWh").alias("unit"),
        landed.cast("timestamp_ntz").alias("ingestion_timestamp"),
        landed.alias("ingestion_date"),
    )


def customer_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata listing (id, attributes, position) from customers.

    Household names are empty (fall back to the id); machinery
    customers share one name per nation (the tracked set keeps the last);
    automobile customers have no extra attributes.
    """
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    rows = (
        cust.join(nation, cust.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
    )
    seg = F.col("c_mktsegment")
    entries = F.array(
        F.struct(
            F.lit("name").alias("key"),
            F.when(seg == "HOUSEHOLD", F.lit(""))
            .when(seg == "MACHINERY", F.concat(F.lit("Shared "), F.col("n_name")))
            .otherwise(F.col("c_name"))
            .alias("value"),
        ),
        F.struct(F.lit("type").alias("key"), F.lower(seg).alias("value")),
        F.struct(F.lit("location").alias("key"), F.col("n_name").alias("value")),
        F.struct(
            F.lit("description").alias("key"),
            F.when(seg == "BUILDING", F.lit("building account")).alias("value"),
        ),
        F.struct(
            F.lit("region").alias("key"), F.when(seg != "AUTOMOBILE", F.col("r_name")).alias("value")
        ),
        F.struct(
            F.lit("nation_key").alias("key"),
            F.when(seg != "AUTOMOBILE", F.col("c_nationkey").cast("string")).alias("value"),
        ),
    )
    present = F.filter(entries, lambda e: e["value"].isNotNull())
    return rows.select(
        F.col("c_custkey").cast("string").alias(MP),
        F.map_from_entries(present).alias("attributes"),
        F.col("c_custkey").cast("long").alias("position"),
    )


def land_customer_listing(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Land ``customer_listing`` as a JSON listing, one meter a line.

    Planted: white space around every 5th id, a line with a blank id after every
    11th, no attributes for every 13th, and a second entry, after all others,
    for every 7th.
    """
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("position"), "c_name")
    rows = customer_listing(spark, sf_dir).join(cust, "position")
    key, attrs = F.col("position"), F.col("attributes")
    padded = F.when(key % 5 == 0, F.concat(F.lit("  "), MP, F.lit("\t"))).otherwise(F.col(MP))
    again = F.create_map(F.lit("name"), F.concat("c_name", F.lit(" again")), F.lit("type"), F.lit("second"))
    entry = lambda place, id_, value: F.struct(place.alias("place"), id_.alias("id"), value.alias("value"))
    entries = F.array(
        entry(key * 2, padded, F.when(key % 13 > 0, attrs)),
        entry(F.when(key % 11 == 0, key * 2 + 1), F.lit(" \t "), attrs),
        entry(F.when(key % 7 == 0, key + F.lit(1 << 40)), F.col(MP), again),
    )
    lines = rows.select(F.explode(F.filter(entries, lambda e: e["place"].isNotNull())).alias("e"))
    body = F.coalesce(F.to_json("e.value"), F.lit("null"))
    name = F.to_json(F.array("e.id"))
    line = F.concat(F.lit("{"), F.substring(name, F.lit(2), F.length(name) - 2), F.lit(": "), body, F.lit("}"))
    lines.orderBy("e.place").select(line.alias("value")).write.text(path)


def event_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State rows: last purchase day per user."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return ev.groupBy(F.col("user_id").cast("string").alias(MP)).agg(
        F.max(F.to_date("ts")).alias("last_ingestion_date")
    )


def _point(kind: Column, value: Column, hour: Column) -> Column:
    """One API point; planted faults are keyed on the event type."""
    quantity = (
        F.when(kind == "error", F.lit(None).cast("string"))  # key absent -> 0.0
        .when((kind == "signup") & (value < 1), F.lit("abc"))  # malformed -> dropped
        .otherwise(value.cast("string"))
    )
    quality = F.when(kind == "purchase", F.lit(None).cast("string")).otherwise(kind)  # absent -> ""
    return F.struct(
        (hour + 1).cast("string").alias(API_POSITION),
        quantity.alias(API_QUANTITY),
        quality.alias(API_QUALITY),
    )


def pack_responses(points: DataFrame, chunk_cols: list[str]) -> DataFrame:
    """Nest point rows into API response documents.

    ``points``: metering_point_id, day (date), point (struct), failed (bool),
    event_id, plus ``chunk_cols``.  One document per (meter, chunk, day,
    bucket); a (meter, day) with many rows is salted over buckets so that no
    document, and no collect, grows past about POINTS_PER_DOCUMENT points.
    A day whose events include an error also carries a failed result with
    the same series, which the normaliser must skip.
    """
    keys = [MP, *chunk_cols, "day"]
    sizes = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    buckets = F.ceil(F.col("n") / F.lit(POINTS_PER_DOCUMENT)).cast("long")
    salted = points.join(sizes, keys).withColumn(
        "bucket", F.pmod(F.xxhash64("event_id"), buckets)
    )
    docs = salted.groupBy(*keys, "bucket").agg(
        F.collect_list("point").alias("pts"), F.max(F.col("failed").cast("int")).alias("failed")
    )
    odd_day = F.dayofmonth("day") % 2 == 1
    start = F.when(odd_day, F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T00:00:00Z"))).otherwise(
        F.concat(F.date_format(F.date_sub("day", 1), "yyyy-MM-dd"), F.lit("T23:00:00-01:00"))
    )
    series = F.struct(
        F.struct(F.struct(F.col(MP).alias(API_NAME)).alias(API_METER_ID)).alias(API_METER),
        F.when(odd_day, F.struct(F.lit("kWh").alias(API_NAME))).alias(API_UNIT),
        F.array(
            F.struct(F.struct(start.alias(API_START)).alias(API_INTERVAL), F.col("pts").alias(API_POINT))
        ).alias(API_PERIOD),
    )
    document = F.struct(F.array(series).alias(API_TIME_SERIES))
    ok = F.struct(F.lit(True).alias(API_SUCCESS), document.alias(API_DOCUMENT))
    bad = F.struct(
        F.lit(False).alias(API_SUCCESS),
        F.lit("no data").alias(API_ERROR_TEXT),
        document.alias(API_DOCUMENT),
    )
    results = F.when(F.col("failed") == 1, F.array(F.to_json(ok), F.to_json(bad))).otherwise(
        F.array(F.to_json(ok))
    )
    body = F.concat(F.lit(f'{{"{API_RESULT}": ['), F.array_join(results, ", "), F.lit("]}"))
    return docs.select(F.col(MP).alias("metering_point"), *chunk_cols, "day", "bucket", body.alias("value"))


def event_points(spark: SparkSession, sf_dir: str, variant: str = "base") -> DataFrame:
    ev = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    return ev.select(
        F.col("user_id").cast("string").alias(MP),
        "event_id",
        F.to_date("ts").alias("day"),
        _point(kind, event_value(variant), F.hour("ts")).alias("point"),
        (kind == "error").alias("failed"),
    )


def event_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of all events, one-day chunks."""
    pts = event_points(spark, sf_dir).withColumn("chunk_from", F.col("day")).withColumn("chunk_to", F.col("day"))
    return pack_responses(pts, ["chunk_from", "chunk_to"])



def land_event_responses(
    spark: SparkSession,
    sf_dir: str,
    plan: DataFrame,
    raw_root: str,
    as_of,
    value_shift: float = 0.0,
    chunk_days: int = 90,
    landing: str = "lines",
    sends: int = 1,
    faults: bool = False,
) -> None:
    """Play the fetcher: land the events of every planned chunk as responses.

    Days after ``as_of`` are not available yet.  ``value_shift`` is added to
    every value (a later run delivering corrected readings).  ``landing`` is
    ``lines`` (keyed JSON Lines), ``sends`` (the same in a folder for each
    send) or ``folders`` (JSON Lines under the chunk's folder keys).  With ``sends`` 2 or 3 a chunk comes again, later in
    the same file, each time with 1 more in every value: first without its
    ``view`` events, then with its ``purchase`` events only.  ``faults`` plants
    what has to be rejected: a period start that is no time on every 13th of a
    month, a position that is no number for every 97th event, and an answer that
    is no JSON on every 17th for meters whose id ends in 1 or 6.
    """
    from wattlake.operators.joins import join_small
    from wattlake.operators.planning import chunk_of

    # One row per meter; the chunk of a day follows by arithmetic, so there
    # is no range join and no fan-out over a meter's chunks.
    windows = plan.select(MP, "date_from", "date_to").distinct()
    ev = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    send = F.col("send")
    ev = ev.withColumn("send", F.explode(F.sequence(F.lit(0), F.lit(sends - 1))))
    ev = ev.where((send == 0) | ((send == 1) & (kind != "view")) | ((send == 2) & (kind == "purchase")))
    point = _point(kind, F.col("value") + F.lit(value_shift) + send.cast("double"), F.hour("ts"))
    if faults:
        point = point.withField(API_POSITION, F.when(F.col("event_id") % 97 == 0, F.lit("first")).otherwise(point[API_POSITION]))
    pts = ev.select(
        F.col("user_id").cast("string").alias(MP),
        "event_id",
        "send",
        F.to_date("ts").alias("day"),
        point.alias("point"),
        (kind == "error").alias("failed"),
    ).where(F.col("day") <= F.lit(as_of).cast("date"))
    placed = join_small(pts, windows, MP, "inner").where(
        F.col("day").between(F.col("date_from"), F.col("date_to"))
    )
    start = F.date_add("date_from", chunk_of(F.col("day"), F.col("date_from"), chunk_days) * chunk_days)
    placed = placed.withColumn("chunk_from", start).withColumn(
        "chunk_to", F.least(F.date_add(start, chunk_days - 1), F.col("date_to"))
    )
    docs = pack_responses(placed.drop("date_from", "date_to"), ["chunk_from", "chunk_to", "send"])
    if faults:
        value = F.when(F.dayofmonth("day") == 13, F.regexp_replace("value", rf'"{API_START}":"[^"]*"', f'"{API_START}":"some day"')).otherwise(F.col("value"))
        busy = (F.dayofmonth("day") == 17) & (F.col("metering_point").cast("long") % 5 == 1)
        docs = docs.withColumn("value", F.when(busy, F.lit("busy, try again")).otherwise(value))
    if sends > 1:  # all that a meter gets stands in one file, in the order of sending
        docs = docs.repartition("metering_point").sortWithinPartitions("metering_point", "chunk_from", "send", "day")
    if landing == "lines":
        line = F.concat_ws("\t", "metering_point", "chunk_from", "chunk_to", "value")
        docs.select(line.alias("value")).write.mode("overwrite").text(raw_root)
        return
    if landing == "sends":
        line = F.concat_ws("\t", "metering_point", "chunk_from", "chunk_to", "value")
        docs.select("send", line.alias("value")).write.mode("overwrite").partitionBy("send").text(raw_root)
        return
    (
        docs.select("metering_point", "chunk_from", "chunk_to", "value")
        .write.mode("overwrite")
        .partitionBy("metering_point", "chunk_from", "chunk_to")
        .text(raw_root)
    )
