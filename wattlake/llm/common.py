"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.session import scratch_path

#: A word is a run of anything but the six ASCII white-space characters.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
#: For intermediate files on a local or mounted disk (other file systems do not look at this).  Without native
#: libraries, Hadoop's local file systems start a ``chmod`` for each file and folder, the checked one two more for
#: the checksum file, and until a new process runs its own program all memory of the executor counts for it as well.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
#: In place of checksum files: those that Parquet keeps in every page.
CHECKED_PAGES = {"parquet.page.write-checksum.enabled": "true", "parquet.page.verify-checksum.enabled": "true"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back.

    This cuts the lineage: later jobs read files that every executor sees, so
    a lost executor costs a task rerun, never the whole computation again.
    Files have no checksum files beside them; damaged pages end the reading job.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**PLAIN_FILES, **CHECKED_PAGES).parquet(path)
    return df.sparkSession.read.schema(df.schema).options(**CHECKED_PAGES).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words of ``text`` as a long; null text has none."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long"), F.lit(0).cast("long"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def remembered(key: tuple, make: Callable):
    """``make()`` for the first task of this Python worker with ``key``; whatever was remembered before it goes first."""
    memory = sys.modules.setdefault("wattlake_worker_memory", types.ModuleType("wattlake_worker_memory")).__dict__
    if memory.get("key") != key:
        forget()
        memory["value"], memory["key"] = make(), key
    return memory["value"]


def forget() -> None:
    """Let go of what ``remembered`` holds: Spark gives the worker of one operator's tasks to the next operator's."""
    memory = sys.modules.get("wattlake_worker_memory")
    if memory and "key" in memory.__dict__:
        memory.__dict__.pop("value", None)
        memory.__dict__.pop("key", None)
        gc.collect()  # encoders and their caches refer to each other
    trim()


def trim() -> None:
    """Give freed memory back to the system: Arrow and the C library keep it for this worker, also while it waits."""
    pa.default_memory_pool().release_unused()
    if release := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        release(0)
