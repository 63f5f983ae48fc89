"""Null-safe parsing of values inside landed API responses (VARIANT)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattlake.functions.calendar import ntz_to_instant

# Text that Python's float() accepts, minus digit underscores ("1_000"), which
# are treated as malformed.  Spark alone would also take "1d" or "1f".
NUMERIC_TEXT = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"

# ISO 8601 starts, extended or basic: date, then optionally hour, minute,
# second and fraction, then optionally Z or an offset.
ISO_START = (
    r"^(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2}))"
    r"(?:[Tt ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
    r"(?:([Zz])|([+-])(\d{2})(?::?(\d{2})(?::?(\d{2}))?)?)?)?$"
)


# The form that responses mostly have: seconds, then Z or an offset of hours and minutes.
USUAL_START = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:Z|[+-][0-9]{2}:[0-9]{2})$"


def key_missing(v: Column, path: str) -> Column:
    """TRUE when ``path`` is absent (a JSON null is present, not missing)."""
    return F.try_variant_get(v, path, "variant").isNull()


def key_is_json_null(v: Column, path: str) -> Column:
    return F.coalesce(F.is_variant_null(F.try_variant_get(v, path, "variant")), F.lit(False))


def json_type(v: Column, path: str) -> Column:
    """Type name of the value at ``path`` (STRING, BIGINT, ARRAY<..>, VOID, ...)."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def is_object(v: Column) -> Column:
    """Whether ``v`` is a JSON object; unlike ``json_type`` this does not go through all that it holds."""
    return F.coalesce(F.try_variant_get(v, "$", "struct<>").isNotNull(), F.lit(False))


def truthy(v: Column, path: str) -> Column:
    """Python truthiness of the value at ``path``; FALSE when it is absent.

    false/0/""/[]/{}/null are false, every other value is true.
    """
    kind = json_type(v, path)
    return (
        F.when(kind.isNull() | (kind == "VOID"), F.lit(False))
        .when(kind == "STRING", F.length(F.try_variant_get(v, path, "string")) > 0)
        .when(kind.startswith("ARRAY"), F.size(F.try_variant_get(v, path, "array<variant>")) > 0)
        .when(kind.startswith("OBJECT"), kind != "OBJECT<>")
        .otherwise(F.coalesce(F.try_variant_get(v, path, "double") != 0, F.lit(False)))
    )


def text_only(v: Column, path: str) -> Column:
    """The value at ``path`` if it is a JSON string, else NULL."""
    return F.when(json_type(v, path) == "STRING", F.try_variant_get(v, path, "string"))


def text_or_default(v: Column, path: str, default: str) -> Column:
    """String at ``path``; ``default`` only when the key is absent."""
    return F.when(key_missing(v, path), F.lit(default)).otherwise(F.try_variant_get(v, path, "string"))


def int_or_default(v: Column, path: str, default: int) -> Column:
    """int(value) with the Python rules: "1.5" fails, " 1 " is 1, 1.7 is 1.

    Returns NULL for a value that does not convert (the caller rejects it).
    """
    return F.when(key_missing(v, path), F.lit(default)).otherwise(F.try_variant_get(v, path, "int"))


def float_or_default(v: Column, path: str, default: float) -> Column:
    """float(value); ``default`` when absent, NULL when null or malformed.

    Numbers and booleans convert (true is 1.0), text must look like a number,
    anything else (null, arrays, objects) is malformed.
    """
    text = F.try_variant_get(v, path, "string")
    parsed = F.when(
        (json_type(v, path) == "BOOLEAN") | text.rlike(NUMERIC_TEXT),
        F.try_variant_get(v, path, "double"),
    )
    return F.when(key_missing(v, path), F.lit(default)).otherwise(parsed)


def parse_instant(text: Column) -> Column:
    """ISO 8601 text to an instant; NULL for any other form.

    A value without offset is read as UTC.  Years alone, year and month,
    padded text and zone names are not accepted; fractions beyond micros are
    cut off.  The usual form is cut at its fixed places; only other forms cost
    a match of the whole pattern for each part.
    """
    wall = F.concat(F.substring(text, 1, 10), F.lit(" "), F.substring(text, 12, 8)).try_cast("timestamp_ntz")
    # Z leaves both numbers empty
    hours, minutes = (F.coalesce(F.substring(text, at, 2).try_cast("long"), F.lit(0)) for at in (21, 24))
    ahead = F.when(F.substring(text, 20, 1) == "-", -1).otherwise(1) * (hours * 3600 + minutes * 60)
    usual = F.timestamp_micros(F.unix_micros(ntz_to_instant(wall)) - ahead * F.lit(1_000_000))
    return F.when(text.rlike(USUAL_START), usual).otherwise(_any_iso_instant(text))


def _any_iso_instant(text: Column) -> Column:

    def part(group: int, default: str = "00") -> Column:
        found = F.regexp_extract(text, ISO_START, group)
        return F.when(found == "", F.lit(default)).otherwise(found)

    month = F.concat(part(2, ""), part(4, ""))
    day = F.concat(part(3, ""), part(5, ""))
    fraction = F.rpad(F.substring(part(9, "0"), 1, 6), 6, "0")
    wall = F.concat(
        part(1), F.lit("-"), month, F.lit("-"), day, F.lit(" "), part(6), F.lit(":"), part(7), F.lit(":"), part(8), F.lit("."), fraction
    ).try_cast("timestamp_ntz")
    ahead = part(12).cast("long") * 3600 + part(13).cast("long") * 60 + part(14).cast("long")
    ahead = F.when(part(11) == "-", -ahead).otherwise(ahead)
    instant = F.timestamp_micros(F.unix_micros(ntz_to_instant(wall)) - ahead * F.lit(1_000_000))
    return F.when(text.rlike(ISO_START), instant)


# First and last microsecond of the years 1 to 9999.
FIRST_MICRO, LAST_MICRO = -62_135_596_800_000_000, 253_402_300_799_999_999


def add_hours(instant: Column, hours: Column) -> Column:
    """instant + hours, by micro arithmetic (no session time zone); NULL outside the years 1 to 9999."""
    micros = F.unix_micros(instant) + hours.cast("long") * F.lit(3_600_000_000)
    return F.when(micros.between(FIRST_MICRO, LAST_MICRO), F.timestamp_micros(micros))
