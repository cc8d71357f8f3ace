"""Session helpers: settings the operators rely on and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# UTC keeps date boundaries equal on every executor; ANSI makes bad casts fail
# instead of turning into NULL silently.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    A temporary folder stands in only in local mode, where driver and executors
    are one process. On a cluster an unset folder is an error.
    """
    name = "spark.checkpoint.dir"
    configured = spark.conf.get(name, None) or spark.sparkContext.getConf().get(name)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    path = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(name, path)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """The frame written to the shared folder and read back.

    Used where a result is needed more than once: its plan runs once, and a lost executor
    costs a re-read.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Options of the writers of what is read soon and removed again: zstd at its default level, which takes half the time of ``COMPACT``.
PASSING = {"compression": "zstd"}
#: Options of the writers of tables: their files outlive the job that writes them, so they are packed tighter than by default.
COMPACT = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6"}


@contextmanager
def scratch(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The frame written to the shared folder and read back, as ``stored`` has it, but removed at the end of the block."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    try:
        df.write.options(**PASSING).parquet(path)
        yield spark.read.parquet(path)
    finally:
        fs, folder = hadoop_fs(spark, path)
        fs.delete(folder, True)


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs in the block go as each job ends, not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # from Spark 4.1 on; earlier versions ignore it
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def hadoop_fs(spark: SparkSession, path: str):
    """Hadoop ``FileSystem`` and ``Path`` for a location on any store."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path
