"""Meter metadata: normalise the listing, build the dimension, tracked set.

Input rows are (metering_point_id, attributes, position), ``position`` being
the order of the meter in its source listing (a number, or a struct that sorts).  ``attributes`` is a
map<string,string> (rows) or a map<string,variant> (a JSON listing, which
keeps value types, so ``floor: 2`` stays a number in ``extra_metadata``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions.parsing import truthy
from wattlake.schema import CORE_METADATA_FIELDS, METADATA

MP = "metering_point_id"


def _typed(df: DataFrame) -> bool:
    """Whether the attribute values are VARIANT (typed) rather than text."""
    return isinstance(df.schema["attributes"].dataType.valueType, T.VariantType)


# White space of any script at either end.
BLANK_ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _text(value: Column, typed: bool) -> Column:
    """An attribute value as text (a number 2 becomes "2")."""
    return F.try_variant_get(value, "$", "string") if typed else value


def normalize_listing(listing: DataFrame) -> DataFrame:
    """Trim ids, drop blank ones, NULL attributes -> empty, name falls back to id.

    A name that is absent or falsy (NULL, empty, 0, false) becomes the id.
    An id listed twice keeps its first position and its last attributes.
    """
    typed = _typed(listing)
    map_type = listing.schema["attributes"].dataType.simpleString()
    attrs = F.coalesce(F.col("attributes"), F.create_map().cast(map_type))
    rows = listing.select(
        F.regexp_replace(F.col(MP).cast("string"), BLANK_ENDS, "").alias(MP),
        attrs.alias("attributes"),
        "position",
    ).where(F.col(MP).isNotNull() & (F.col(MP) != ""))
    rows = rows.groupBy(MP).agg(
        F.max_by("attributes", "position").alias("attributes"), F.min("position").alias("position")
    )
    given = F.col("attributes")["name"]
    if typed:
        name = F.when(truthy(given, "$"), _text(given, True)).otherwise(F.col(MP))
    else:
        name = F.coalesce(F.nullif(given, F.lit("")), F.col(MP))
    return rows.select(MP, "attributes", "position", name.alias("name"))


def require_meters(normalized: DataFrame) -> DataFrame:
    if normalized.isEmpty():
        raise ValueError("At least one metering point ID must be configured")
    return normalized


def extras_json(extras: Column, typed: bool = False) -> Column:
    """JSON object text of a map, laid out as Python's json.dumps does:
    ``{"key": "value", "other": 2}`` (listing order, ", " and ": "), with
    non-ASCII characters written as \\uXXXX escapes (UTF-16 units).
    Typed (VARIANT) values keep their JSON type, nested objects and arrays
    included (keys inside a nested object come out sorted: VARIANT stores
    object keys in order of name).
    """
    value = (
        (lambda v: _ensure_ascii(_python_spacing(F.coalesce(F.to_json(v), F.lit("null")))))
        if typed
        else _quoted
    )
    entries = F.transform(
        F.map_entries(extras),
        lambda e: F.concat(_quoted(e["key"]), F.lit(": "), value(e["value"])),
    )
    return F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))


# A JSON string literal, or a run of text between string literals.
_JSON_TOKENS = r'"(?:[^"\\]|\\.)*"|[^"]+'


def _python_spacing(compact: Column) -> Column:
    """Compact JSON text with json.dumps' separators: ", " and ": ".

    Only the text between string literals is touched, so commas and colons
    inside strings stay as they are.
    """
    tokens = F.regexp_extract_all(compact, F.lit(_JSON_TOKENS), 0)
    spaced = F.transform(
        tokens,
        lambda t: F.when(t.startswith('"'), t).otherwise(
            F.regexp_replace(F.regexp_replace(t, ",", ", "), ":", ": ")
        ),
    )
    return F.array_join(spaced, "")


def _ensure_ascii(text: Column) -> Column:
    """Escape every non-ASCII character as \\uXXXX (lower-case hex of its
    UTF-16 code units, so characters beyond the BMP become surrogate pairs)."""
    return F.array_join(
        F.transform(
            F.split(text, ""),
            lambda c: F.when(F.ascii(c) < 128, c).otherwise(
                F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1")
            ),
        ),
        "",
    )


def _quoted(value: Column) -> Column:
    wrapped = F.to_json(F.array(value))  # ["..."] with JSON escaping
    return F.when(value.isNull(), F.lit("null")).otherwise(
        _ensure_ascii(wrapped.substr(F.lit(2), F.length(wrapped) - F.lit(2)))
    )


def build_metadata(normalized: DataFrame) -> DataFrame:
    """The metadata dimension: core fields plus leftover attributes as JSON.

    extra_metadata is the JSON object of the non-core attributes in listing
    order, NULL when there are none.
    """
    typed = _typed(normalized)
    core = F.array(*[F.lit(k) for k in CORE_METADATA_FIELDS])
    extras = F.map_filter("attributes", lambda k, v: ~F.array_contains(core, k))
    attrs = F.col("attributes")
    out = normalized.select(
        F.col(MP),
        F.coalesce(F.col("name"), _text(attrs["name"], typed), F.col(MP)).alias("name"),
        _text(attrs["type"], typed).alias("type"),
        _text(attrs["location"], typed).alias("location"),
        _text(attrs["description"], typed).alias("description"),
        F.when(F.size(extras) > 0, extras_json(extras, typed)).alias("extra_metadata"),
    )
    return out


def empty_metadata(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], METADATA)


def tracked_meters(normalized: DataFrame) -> DataFrame:
    """name -> id; when names repeat, the meter listed last wins."""
    return normalized.groupBy("name").agg(F.max_by(MP, "position").alias(MP))


def save_metadata_table(
    spark: SparkSession, metadata: DataFrame, table: str = "reporting.meter_metadata"
) -> None:
    """Create or replace the metadata table in the catalog, rows ordered by id.

    The order is applied only here, where it lands in the files; joins and
    views take the dimension unsorted (a sort would be a global shuffle).
    """
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.', 1)[0]}")
    metadata.orderBy(MP).write.mode("overwrite").format("parquet").saveAsTable(table)
