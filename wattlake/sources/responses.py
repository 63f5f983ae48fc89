"""Landed API responses.

Two landing formats are read:

- ``folders``: one file per request under
  ``<root>/metering_point=<id>/chunk_from=<day>/chunk_to=<day>/<any>.json``;
  the folder keys tell which request the file answers, the file is read whole
  (``wholetext``) so one row holds one document.
- ``lines``: batched landing, any number of files under ``<root>``, one
  request per line: ``<meter>\t<chunk_from>\t<chunk_to>\t<response JSON>``.
  File count then follows data volume instead of the number of requests,
  and a response that is not JSON still names its request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESPONSE_SCHEMA = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("metering_point", T.StringType()),
        T.StructField("chunk_from", T.DateType()),
        T.StructField("chunk_to", T.DateType()),
    ]
)


def landed_at() -> Column:
    """When a response landed, for ordering: time of its file, then the file's name and the place in it."""
    meta = F.col("_metadata")
    return F.struct(meta["file_modification_time"], meta["file_path"], meta["file_block_start"]).alias("landed_at")


def response_order() -> Column:
    """Orders the documents of one read: ``landed_at``, then the line.

    To be taken straight from the scan, before rows are moved: there, the ids
    of a file's block rise with its lines.  ``line`` alone tells the documents
    of one read apart, but says nothing of their order.
    """
    return F.struct("landed_at", F.monotonically_increasing_id().alias("line"))


def _keyed_lines(df: DataFrame) -> DataFrame:
    parts = F.split(F.col("value"), "\t", 4)
    # try_element_at: a line with fewer fields yields NULLs (an unparsable
    # response) instead of failing the job under ANSI mode.
    return df.select(
        F.try_element_at(parts, F.lit(4)).alias("value"),
        F.try_element_at(parts, F.lit(1)).alias("metering_point"),
        F.try_element_at(parts, F.lit(2)).try_cast("date").alias("chunk_from"),
        F.try_element_at(parts, F.lit(3)).try_cast("date").alias("chunk_to"),
        F.col("_metadata.file_path").alias("source_file"),
        landed_at(),
    )


def read_responses(
    spark: SparkSession,
    root: str,
    partitioned: bool = True,
    whole_files: bool = True,
    landing: str = "folders",
) -> DataFrame:
    """Documents (``value``) with their source file, request keys and ``response_order``.

    ``landing="folders"``: keys from the folders (if ``partitioned``);
    ``whole_files`` reads one document per file, else one per line.
    ``landing="lines"``: keyed lines, see the module doc.
    A missing root means the fetcher landed nothing: no documents.
    """
    from wattlake.session import path_exists

    if not path_exists(spark, root):
        empty = spark.createDataFrame([], RESPONSE_SCHEMA)
        empty = empty.withColumn("source_file", F.lit(None).cast("string")).withColumn(
            "landed_at", F.struct(F.lit(None).cast("timestamp").alias("file_modification_time"))
        )
        return empty.withColumn("response_order", response_order())
    if landing == "lines":
        return _keyed_lines(spark.read.text(root)).withColumn("response_order", response_order())
    reader = spark.read
    if partitioned:
        reader = reader.schema(RESPONSE_SCHEMA)
    # text() sets wholetext itself (default False), so it is passed here.
    df = reader.text(root, wholetext=whole_files)
    df = df.withColumn("source_file", F.col("_metadata.file_path")).withColumn("landed_at", landed_at())
    return df.withColumn("response_order", response_order())


def stream_responses(
    spark: SparkSession,
    root: str,
    max_files_per_trigger: int | None = None,
    whole_files: bool = True,
    landing: str = "folders",
):
    """The same documents as a file stream (new files only, tracked by checkpoint)."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if landing == "lines":
        return _keyed_lines(reader.schema("value string").format("text").load(root))
    reader = reader.schema(RESPONSE_SCHEMA).option("wholetext", whole_files)
    df = reader.format("text").load(root)
    return df.withColumn("source_file", F.col("_metadata.file_path")).withColumn("landed_at", landed_at())
