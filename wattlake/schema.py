"""Fixed schemas of the reading record, the lake, the state table and metadata."""

from __future__ import annotations

from pyspark.sql import types as T

# One interval reading as it is stored in the lake files.
READING = T.StructType(
    [
        T.StructField("metering_point_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("consumption_value", T.DoubleType()),
        T.StructField("quality", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("ingestion_date", T.DateType()),
    ]
)

READING_COLUMNS = [f.name for f in READING.fields]

# Directory keys of the lake.  All layouts carry the columns
# ``metering_point`` and ``date`` once read; they differ in which are folders.
#   bucket:    date=<YYYY-MM-DD>/bucket=<k>/  the meters of a day by a hash of
#              their id; a batch of few meters rewrites few buckets of its days;
#   day:       date=<YYYY-MM-DD>/  rows sorted by meter and time in each file,
#              meter filters prune through Parquet statistics;
#   meter_day: metering_point=<id>/date=<YYYY-MM-DD>/  one folder per meter and
#              day, the source system's layout (many small files at scale).
LAYOUTS = {"bucket": ["date", "bucket"], "day": ["date"], "meter_day": ["metering_point", "date"]}
DEFAULT_LAYOUT = "bucket"
# Meters of a day fall into so many buckets in a new lake; choose it so that a
# bucket of a day is about one Parquet file of the wanted size.
DEFAULT_BUCKETS = 8
PARTITION_COLUMNS = ["metering_point", "date"]

_PARTITION_FIELDS = {
    "metering_point": T.StructField("metering_point", T.StringType()),
    "date": T.StructField("date", T.DateType()),
    "bucket": T.StructField("bucket", T.IntegerType()),
}


def lake_schema(layout: str) -> T.StructType:
    """Read schema of a lake: file columns plus the layout's folder keys.

    Naming the key types here keeps ids such as "0012" as strings.
    """
    return T.StructType(READING.fields + [_PARTITION_FIELDS[c] for c in LAYOUTS[layout]])


LAKE_SCHEMA = lake_schema("meter_day")

# Ingestion state: one row per meter.
STATE = T.StructType(
    [
        T.StructField("metering_point_id", T.StringType()),
        T.StructField("last_ingestion_date", T.DateType()),
    ]
)

# Meter metadata dimension.
METADATA = T.StructType(
    [
        T.StructField("metering_point_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("extra_metadata", T.StringType()),
    ]
)

# Raw metadata rows: id, attribute map, position in the source listing.
METADATA_SOURCE = T.StructType(
    [
        T.StructField("metering_point_id", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("position", T.LongType()),
    ]
)

# Columns of the stage view, in order.
STAGE_COLUMNS = [
    "metering_point_id",
    "reading_ts_utc",
    "reading_date",
    "reading_hour",
    "reading_weekday",
    "reading_weekday_label",
    "reading_month",
    "reading_year",
    "consumption_value",
    "quality",
    "unit",
    "ingestion_timestamp",
    "ingestion_date",
]

# Fixed values of the reporting layer.
EXPECTED_READINGS_PER_DAY = 24
DEFAULT_UNIT = "kWh"
DEFAULT_BACKFILL_DAYS = 1095
DEFAULT_CHUNK_DAYS = 90
OVERLAP_DAYS = 7
CORE_METADATA_FIELDS = ("id", "name", "type", "location", "description")

# Field names of the metering API's response document, from the
# outside in.  The two point keys contain a dot as part of the name.
API_RESULT = "result"
API_SUCCESS = "success"
API_ERROR_TEXT = "errorText"
API_DOCUMENT = "MyEnergyData_MarketDocument"
API_TIME_SERIES = "TimeSeries"
API_METER = "MarketEvaluationPoint"
API_METER_ID = "mRID"
API_NAME = "name"
API_UNIT = "measurement_Unit"
API_PERIOD = "Period"
API_INTERVAL = "timeInterval"
API_START = "start"
API_POINT = "Point"
API_POSITION = "position"
API_QUANTITY = "out_Quantity.quantity"
API_QUALITY = "out_Quantity.quality"
