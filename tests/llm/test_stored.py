"""Intermediate tables: what is written is read, without checksum files beside it, and damage is noticed."""

import glob
import os

import pytest

from tests.llm import cases
from wattlake.llm import common


def test_rows_and_types_come_back(spark):
    df = cases.table(spark).selectExpr("*", "split(text, ' ') AS words", "named_struct('a', doc_id, 'b', cast(n_chars AS decimal(38,0))) AS pair")
    back = common.stored(df, "test-rows")
    assert back.dtypes == df.dtypes
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    assert common.stored(df.where("false"), "test-empty").collect() == []


def test_no_processes_are_started_for_checksum_files(spark):
    (file, *_) = common.stored(spark.range(100), "test-files").inputFiles()
    folder = os.path.dirname(file.removeprefix("file://"))
    assert glob.glob(f"{folder}/*.parquet")
    # Hadoop's checked local file system starts a chmod for each file, and two more for the checksum file beside it
    assert not glob.glob(f"{folder}/.*.crc")


def test_damaged_pages_are_not_read(spark):
    df = common.stored(spark.range(1000).selectExpr("hash(id) AS x", "'a long enough text ' || id AS t").coalesce(1), "test-damage")
    assert df.count() == 1000
    (file,) = df.inputFiles()
    with open(file.removeprefix("file://"), "r+b") as f:
        f.seek(2000)  # inside the first column's page
        (byte,) = f.read(1)
        f.seek(2000)
        f.write(bytes([byte ^ 1]))
    with pytest.raises(Exception, match="(?i)crc"):
        df.selectExpr("sum(x)", "max(t)").collect()
