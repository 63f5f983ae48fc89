"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every wattlake job relies on.  None of the operators depend on the
# session time zone; UTC is set so that printed LTZ timestamps read as UTC.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app: str = "wattlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with wattlake's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and every executor sees it;
    if it is unset there, this raises rather than use a machine-local folder.
    Only in local mode (tests) is a folder of our own created when unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        existing = spark.sparkContext.getCheckpointDir()
        if existing:
            return existing.rsplit("/", 1)[0]
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is not set: point it at a folder every executor shares"
            )
        root = tempfile.mkdtemp(prefix="wattlake-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def checkpointed(df):
    """Cut ``df``'s lineage: reliable checkpoint into the shared checkpoint folder.

    Used for small frames that several later jobs reuse (the load plan), so
    they are computed once and a lost executor re-reads them instead of
    recomputing the whole lineage.  Never a local checkpoint.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/wattlake/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_fs(spark: SparkSession, path: str):
    """Hadoop FileSystem and Path objects for ``path`` (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = hadoop_fs(spark, path)
    return bool(fs.exists(hpath))


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Session settings for the time of a block; what was set before comes back."""
    previous = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in previous.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def read_small_file(spark: SparkSession, path: str) -> str:
    """A small text file as a whole, from any Hadoop file system."""
    fs, hpath = hadoop_fs(spark, path)
    stream = fs.open(hpath)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def claim_file(spark: SparkSession, path: str, content: str) -> bool:
    """Create ``path`` with ``content`` if there is no such file; whether this call made it.

    The content is written beside it first and given the name in one step, so
    nobody sees half a file: a hard link on a local disk, else a rename, which
    HDFS refuses where the name is taken.  (Object stores whose rename is a
    copy give no such promise; put these small files on a file system that does.)
    """
    fs, target = hadoop_fs(spark, path)
    jvm = spark.sparkContext._jvm
    fs.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(content.encode("utf-8")))
    out.close()
    try:
        if fs.exists(target):
            return False
        if fs.getScheme() == "file":
            files = jvm.java.nio.file.Files
            local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, draft)]
            try:
                files.createLink(*local)
            except Exception as e:
                if "FileAlreadyExists" in str(e):
                    return False
                raise
            return True
        return bool(fs.rename(draft, target))
    finally:
        fs.delete(draft, False)
