"""Dynamic overwrite and whole read of many small folders on a disk that all executors mount.

Without native libraries, Hadoop's local file system forks a ``chmod`` for each
file, checksum file and folder that it creates: most of the time of a layout with
a folder for every meter and day.  Here tasks write the Parquet files themselves
(Arrow), and nothing else is different from Spark's partitioned write: rows come
dealt and sorted by Spark, files are staged, and folders are swapped only when all
of them are written.  Other file systems do not fork; Spark's writer serves them.

Spark's scan keeps every folder and file in the driver: the more meters and days,
the more memory.  Where all rows are wanted and no folder is pruned, tasks list
the folders here and read the files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.session import hadoop_fs


def is_local(spark: SparkSession, root: str) -> bool:
    return hadoop_fs(spark, root)[0].getScheme() == "file"


def _local_path(spark: SparkSession, root: str) -> str:
    fs, path = hadoop_fs(spark, root)
    return fs.makeQualified(path).toUri().getPath().rstrip("/")


def overwrite_folders(rows: DataFrame, root: str, keys: list[str]) -> None:
    """Replace the folders ``<key>=<value>/...`` of the local ``root`` that ``rows`` have rows for.

    ``rows`` are sorted by ``keys`` within their partitions.  A task that is run
    again stages files of its own, of which only those of the attempt that
    counted are moved; a swap that is run again finds what the first one moved.
    """
    spark = rows.sparkSession
    fs, path = hadoop_fs(spark, root)
    home = _local_path(spark, root)
    staging = f"{home}/.staging-{uuid.uuid4().hex}"
    columns = [c for c in rows.columns if c not in keys]
    fs.mkdirs(path)
    try:
        staged = rows.select(*columns, *[F.col(k).cast("string").alias(k) for k in keys])
        staged = staged.mapInArrow(_file_writer(staging, columns, keys), "folder string, file string")
        staged.write.parquet(f"file:{staging}/files")
        files = spark.read.schema("folder string, file string").parquet(f"file:{staging}/files")
        files = files.groupBy("folder").agg(F.collect_list("file").alias("files"))
        files.mapInArrow(_folder_swap(home), "n long").agg(F.sum("n")).collect()
    finally:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file:{staging}"), True)


def has_data_file(spark: SparkSession, root: str) -> bool:
    """Whether a file lies under the local ``root``; the walk stops at the first one."""
    return next(_walker()(_local_path(spark, root)), None) is not None


def read_folders(spark: SparkSession, root: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The rows that ``spark.read.schema(schema).parquet(root)`` gives, of a local ``root`` with folders ``<key>=<value>/...``.

    One task names the top folders, others list what is below them, and the files
    are dealt anew before they are read: a meter with many rows is no straggler,
    and the driver gets no names at all.
    """
    home = _local_path(spark, root)
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    body = [f for f in schema.fields if f.name not in keys]
    names = [T.StructField(k, T.StringType()) for k in keys]
    top = spark.range(0, 1, 1, 1).mapInArrow(_top_folders(home), "folder string").repartition(tasks)
    files = top.mapInArrow(_file_lister(home), "files array<string>").repartition(tasks)
    rows = files.mapInArrow(_file_reader(home, {f.name: f.dataType.typeName() for f in body}, keys), T.StructType([*body, *names]))
    return rows.select(*[F.col(f.name).cast(f.dataType) if f.name in keys else f.name for f in schema.fields])


# The functions below travel to the executors, which need no copy of wattlake: they use nothing of this module.
def _file_writer(staging: str, columns: list[str], keys: list[str]):
    def folder_name(key: tuple) -> str:
        # as Spark names partition folders
        unsafe = {chr(c) for c in range(1, 32)} | set("\"#%'*/:=?\\\x7f{[]^")
        parts = ("".join(f"%{ord(c):02X}" if c in unsafe else c for c in value or "") or "__HIVE_DEFAULT_PARTITION__" for value in key)
        return "/".join(f"{name}={part}" for name, part in zip(keys, parts))

    def write(batches: Iterator) -> Iterator:
        import os
        import uuid
        from itertools import groupby

        import pyarrow as pa
        import pyarrow.parquet as pq

        own, key, file, out, n = f"{staging}/{uuid.uuid4().hex}", None, "", None, 0
        os.makedirs(own, exist_ok=True)
        for batch in batches:
            made, at = [], 0
            body = batch.select(columns)
            for this, group in groupby(zip(*[batch.column(k).to_pylist() for k in keys])):
                if out is None or this != key:
                    if out is not None:
                        out.close()
                    key, n = this, n + 1
                    file = f"{own}/part-{n:05d}-{os.path.basename(own)}.snappy.parquet"
                    out = pq.ParquetWriter(file, body.schema, compression="snappy", store_schema=False)
                    made.append((folder_name(key), file))
                size = sum(1 for _ in group)
                out.write_batch(body.slice(at, size))  # a folder of several batches: a row group for each
                at += size
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in zip(*made)], names=["folder", "file"])
        if out is not None:
            out.close()

    return write


def _folder_swap(home: str):
    def swap(batches: Iterator) -> Iterator:
        import os
        import shutil
        from contextlib import suppress

        import pyarrow as pa

        for batch in batches:
            for folder, files in zip(batch.column("folder").to_pylist(), batch.column("files").to_pylist()):
                target = f"{home}/{folder}"
                os.makedirs(target, exist_ok=True)
                new = {os.path.basename(f): f for f in files}
                for old in list(os.scandir(target)):
                    if old.name not in new:
                        if old.is_dir(follow_symlinks=False):
                            shutil.rmtree(old.path)
                        else:
                            with suppress(FileNotFoundError):
                                os.remove(old.path)
                for name, file in new.items():
                    try:
                        os.rename(file, f"{target}/{name}")
                    except FileNotFoundError:
                        if not os.path.exists(f"{target}/{name}"):
                            raise
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return swap


def _walker():
    def walk(folder: str) -> Iterator[tuple[str, int]]:
        """Files, and their bytes, that are not hidden or in a hidden folder by the rules of Spark's scan."""
        import os

        with os.scandir(folder) as entries:
            for entry in entries:
                name = entry.name
                if name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"):
                    continue
                if entry.is_dir():
                    yield from walk(entry.path)
                else:
                    yield entry.path, entry.stat().st_size

    return walk


def _top_folders(home: str):
    def top(batches: Iterator) -> Iterator:
        import os
        from itertools import islice

        import pyarrow as pa

        for _ in batches:
            with os.scandir(home) as entries:
                found = (e.name for e in entries if "=" in e.name and e.name[0] != "." and e.is_dir())
                while names := list(islice(found, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["folder"])

    return top


def _file_lister(home: str):
    walk, most_files, most_bytes = _walker(), 100, 8_000_000  # that stay together: neighbours are found faster

    def groups(folders: Iterator[str]) -> Iterator[list[str]]:
        for folder in folders:
            files, size = [], 0
            for file, n in walk(f"{home}/{folder}"):
                if not n:  # Spark's scan leaves empty files out
                    continue
                if files and (len(files) == most_files or size + n > most_bytes):
                    yield files
                    files, size = [], 0
                files.append(file)
                size += n
            if files:
                yield files

    def listed(batches: Iterator) -> Iterator:
        from itertools import islice

        import pyarrow as pa

        for batch in batches:
            found = groups(batch.column("folder").to_pylist())
            while rows := list(islice(found, 200)):
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], names=["files"])

    return listed


def _file_reader(home: str, types: dict[str, str], keys: list[str]):
    most_rows, most_files = 10_000, 2_000  # joined into a batch

    def key_of(file: str) -> list[str | None]:
        # as Spark reads the names of partition folders
        import re

        parts = file[len(home) + 1 :].split("/")[:-1]
        while "=" not in parts[-1]:
            parts.pop()
        if [p.split("=")[0] for p in parts] != keys:
            raise ValueError(f"{file} is not in a folder {'/'.join(f'{k}=<{k}>' for k in keys)}")
        values = [p.split("=", 1)[1] for p in parts]
        return [None if v == "__HIVE_DEFAULT_PARTITION__" else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), v) for v in values]

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        arrow = {"string": pa.string(), "timestamp": pa.timestamp("us", "UTC"), "double": pa.float64(), "date": pa.date32(), "long": pa.int64()}
        names, wanted = list(types), [arrow[kind] for kind in types.values()]

        def fitted(column: pa.ChunkedArray, to: pa.DataType) -> pa.ChunkedArray:
            """A column of another writer, read as Spark's scan reads it."""
            if column.type == to:
                return column
            kind = column.type.value_type if pa.types.is_dictionary(column.type) else column.type
            if kind == to or pa.types.is_null(kind):
                return column.cast(to)
            if pa.types.is_timestamp(kind) and (kind.unit, to) in (("us", arrow["timestamp"]), ("ns", arrow["long"])):
                return column.cast(pa.int64()).cast(to)
            if pa.types.is_timestamp(kind) and (kind.unit, to) == ("ms", arrow["timestamp"]):
                return pc.multiply_checked(column.cast(pa.int64()), 1000).cast(to)
            if to == arrow["string"] and (pa.types.is_large_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_binary(kind)):
                return column.cast(to)
            if to == arrow["double"] and kind in (pa.float32(), pa.int8(), pa.int16(), pa.int32()):
                return column.cast(to)
            raise TypeError(f"{kind} is not read as {to}")

        def tables(file: str) -> Iterator[pa.Table]:
            with pa.OSFile(file) as opened, pq.ParquetFile(opened, pre_buffer=False, coerce_int96_timestamp_unit="us") as source:
                own = {name.lower(): name for name in source.schema_arrow.names}
                columns = [own[name] for name in names if name in own]
                if source.metadata.num_rows <= most_rows:
                    found = [source.read(columns, use_threads=False)]
                else:
                    found = (pa.Table.from_batches([b]) for b in source.iter_batches(most_rows, columns=columns, use_threads=False))
                for table in found:
                    if table.column_names != names or table.schema.types != wanted:
                        try:
                            made = [fitted(table.column(own[n]), to) if n in own else pa.chunked_array([pa.nulls(table.num_rows, to)]) for n, to in zip(names, wanted)]
                        except (TypeError, pa.ArrowInvalid) as e:
                            raise ValueError(f"{file}: {e}") from e
                        table = pa.table(made, names)
                    yield table

        def joined(held: list[tuple]) -> pa.RecordBatch:
            alike = []  # neighbours of one schema: writers differ in which columns may be null
            for _, t in held:
                if alike and t.schema.equals(alike[-1][0].schema):
                    alike[-1].append(t)
                else:
                    alike.append([t])
            whole = [pa.concat_tables(ts).combine_chunks() for ts in alike]
            made = [pa.concat_arrays([c for t in whole for c in t.column(i).chunks]) for i in range(len(names))]
            made += [pa.array([key[i] for key, t in held for _ in range(t.num_rows)], pa.string()) for i in range(len(keys))]
            return pa.RecordBatch.from_arrays(made, names=[*names, *keys])

        held, n = [], 0
        for batch in batches:
            for file in batch.column("files").flatten().to_pylist():
                key = key_of(file)
                for table in tables(file):
                    if table.num_rows:
                        held.append((key, table))
                        n += table.num_rows
                    if n >= most_rows or len(held) >= most_files:
                        yield joined(held)
                        held, n = [], 0
        if held:
            yield joined(held)

    return rows
