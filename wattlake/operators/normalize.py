"""Flatten nested API responses into reading rows, on VARIANT.

Shape of one document (dots inside the point keys are part of the names):

    result[] -> {success, errorText, MyEnergyData_MarketDocument: {TimeSeries[] ->
        {MarketEvaluationPoint.mRID.name, measurement_Unit.name, Period[] ->
            {timeInterval.start, Point[] -> {position, "out_Quantity.quantity",
                                              "out_Quantity.quality"}}}}}

Rules kept from the source system:
- a result whose ``success`` is not truthy (Python rules) is skipped;
- only tracked meters are kept (a meter id must be a JSON string);
- a period without a usable start is skipped;
- a point whose position or quantity is present but null or malformed is
  skipped, its siblings are kept; a missing position is 0 (timestamp is one
  hour before the start), a missing quantity is 0.0, a missing quality "",
  a missing unit "kWh";
- timestamp = period start + (position - 1) hours.

Each level is one ``explode`` of an ``array<variant>``, so one malformed
element never nulls its siblings, and JSON null is told apart from a missing
key.  Skipped points come back in a second frame with a reason.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.calendar import utc_date
from wattlake.functions.parsing import (
    add_hours,
    float_or_default,
    int_or_default,
    is_object,
    json_type,
    key_missing,
    parse_instant,
    text_only,
    text_or_default,
    truthy,
)
from wattlake.schema import (
    API_DOCUMENT,
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
    DEFAULT_UNIT,
    READING_COLUMNS,
)

MP = "metering_point_id"

# VARIANT paths into the document (bracket form for names with dots).
RESULTS = f"$.{API_RESULT}"
SUCCESS = f"$.{API_SUCCESS}"
SERIES = f"$.{API_DOCUMENT}.{API_TIME_SERIES}"
METER_ID = f"$.{API_METER}.{API_METER_ID}.{API_NAME}"
UNIT = f"$.{API_UNIT}.{API_NAME}"
PERIODS = f"$.{API_PERIOD}"
START = f"$.{API_INTERVAL}.{API_START}"
POINTS = f"$.{API_POINT}"
POSITION = f"$.{API_POSITION}"
QUANTITY = f'$["{API_QUANTITY}"]'
QUALITY = f'$["{API_QUALITY}"]'


def _as_of_column(as_of: dt.datetime | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=dt.timezone.utc)
    return F.lit(as_of)


def parsed_document(docs: DataFrame) -> Column:
    """The response as VARIANT: the column ``doc`` where ``docs`` has been parsed, else ``value`` parsed."""
    return F.col("doc") if "doc" in docs.columns else F.try_parse_json("value")


def _points(docs: DataFrame, keep: list[str], tracked: DataFrame | None) -> DataFrame:
    """One row per point of every successful result of a tracked meter."""
    parsed = docs.select(*keep, parsed_document(docs).alias("doc"))
    results = parsed.select(
        *keep, F.explode(F.try_variant_get("doc", RESULTS, "array<variant>")).alias("r")
    )
    ok = results.where(truthy(F.col("r"), SUCCESS))
    series = ok.select(
        *keep,
        F.explode(F.try_variant_get("r", SERIES, "array<variant>")).alias("t"),
    ).select(
        *keep,
        text_only(F.col("t"), METER_ID).alias(MP),
        text_or_default(F.col("t"), UNIT, DEFAULT_UNIT).alias("unit"),
        F.try_variant_get("t", PERIODS, "array<variant>").alias("periods"),
    )
    series = series.where(F.col(MP).isNotNull())
    if tracked is not None:
        ids = tracked.select(F.col(tracked.columns[0]).alias(MP)).distinct()
        series = series.join(ids, MP, "left_semi")
    periods = series.select(*keep, MP, "unit", F.explode("periods").alias("p")).select(
        *keep,
        MP,
        "unit",
        F.try_variant_get("p", START, "string").alias("start_text"),
        F.try_variant_get("p", POINTS, "array<variant>").alias("pts"),
    )
    periods = periods.withColumn(
        "period_start",
        F.when(F.col("start_text") != "", parse_instant(F.col("start_text"))),
    )
    points = periods.select(*keep, MP, "unit", "start_text", "period_start", F.explode("pts").alias("pt"))
    pt = F.col("pt")
    position = int_or_default(pt, POSITION, 0)
    return points.select(
        *keep,
        MP,
        "unit",
        "start_text",
        "period_start",
        position.alias("position"),
        float_or_default(pt, QUANTITY, 0.0).alias("consumption_value"),
        text_or_default(pt, QUALITY, "").alias("quality"),
        # Defaults apply to keys missing from an object; a point that is not
        # an object at all (a bare number, a list) is malformed.
        is_object(pt).alias("is_object"),
        F.to_json(pt).alias("point_json"),
    )


def normalize_responses(
    docs: DataFrame,
    tracked: DataFrame | None = None,
    as_of: dt.datetime | None = None,
    keep: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(readings, rejects) from a frame with one JSON document per row in ``value`` (or, parsed, in ``doc``).

    ``tracked`` is a one-column frame of meter ids to keep (None keeps all).
    ``as_of`` stamps ``ingestion_timestamp``/``ingestion_date``; it defaults to
    the query's current time, one value for the whole query.
    ``keep`` names document columns to carry onto both outputs.
    """
    keep = list(keep or [])
    points = _points(docs, keep, tracked)
    reason = (
        F.when(F.col("period_start").isNull(), F.lit("bad_period_start"))
        .when(~F.col("is_object"), F.lit("bad_point"))
        .when(F.col("position").isNull(), F.lit("bad_position"))
        .when(F.col("consumption_value").isNull(), F.lit("bad_quantity"))
    )
    points = points.withColumn("timestamp", add_hours(F.col("period_start"), F.col("position") - 1))
    reason = reason.when(F.col("timestamp").isNull(), F.lit("bad_position"))
    points = points.withColumn("reject_reason", reason)
    stamp = _as_of_column(as_of)
    good = points.where(F.col("reject_reason").isNull()).select(
        *keep,
        MP,
        "timestamp",
        "consumption_value",
        "quality",
        "unit",
        stamp.alias("ingestion_timestamp"),
    )
    good = good.withColumn("ingestion_date", utc_date(good, "ingestion_timestamp"))
    readings = good.select(*keep, *READING_COLUMNS)
    rejects = points.where(F.col("reject_reason").isNotNull()).select(
        *keep, MP, "start_text", "point_json", "reject_reason"
    )
    return readings, rejects


def usable(value: Column) -> Column:
    """Whether a response counts as an answer: an object whose result, if any, is a list of objects.

    An empty object or text in place of the list is no result, as an empty
    list is; anything else (other JSON, a null result, a result that is not
    an object) means that the request failed.
    """
    return usable_document(F.try_parse_json(value))


def usable_document(doc: Column) -> Column:
    """``usable`` of a parsed response (null: no JSON)."""
    kind = json_type(doc, RESULTS)  # of what is no list only: it goes through all that a value holds
    results = F.try_variant_get(doc, RESULTS, "array<variant>")
    result_ok = (
        F.when(key_missing(doc, RESULTS), F.lit(True))
        .when(results.isNotNull(), F.forall(results, is_object))
        .when(kind == "STRING", F.try_variant_get(doc, RESULTS, "string") == "")
        .otherwise(kind == "OBJECT<>")
    )
    return F.coalesce(is_object(doc) & result_ok, F.lit(False))


def latest_response(readings: DataFrame, order: str, places: DataFrame | None = None) -> DataFrame:
    """Per (meter, timestamp), all rows of the response that comes last by ``order``; drops ``order``.

    ``places``: (``order``, ``response_order``) of all responses, where ``order`` is only a number that
    tells them apart.  Rows then carry that number, and the order is looked up for the hours that
    several responses bring.

    Responses are applied one after the other: a later one replaces what an
    earlier one brought for the same hour, while duplicates inside one
    response stay.
    """
    hours = readings.groupBy(MP, "timestamp").agg(F.max(order).alias("last_order"), F.min(order).alias("first_order"))
    contested = hours.where(F.col("first_order") < F.col("last_order")).select(MP, "timestamp", "last_order")
    if places is not None:
        rivals = readings.join(contested, [MP, "timestamp"], "left_semi").select(MP, "timestamp", order).distinct()
        ranked = rivals.join(places.select(order, "response_order"), order)
        contested = ranked.groupBy(MP, "timestamp").agg(F.max_by(order, "response_order").alias("last_order"))
    # mostly few or none: Spark broadcasts them once it has measured them
    both = readings.join(contested, [MP, "timestamp"], "left")
    kept = both.where(F.col("last_order").isNull() | (F.col(order) == F.col("last_order")))
    return kept.select(*[c for c in readings.columns if c != order])


def unparsable_documents(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Documents that are no usable answer."""
    keep = list(keep or [])
    return docs.where(~usable(F.col("value"))).select(*keep, F.lit("unparsable").alias("reject_reason"))
