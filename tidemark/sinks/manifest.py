"""A manifest of landed files: path and size as written, compared later with what is there.

The manifest is a table under ``_manifest`` in the landing folder, which readers of the folder skip. Spark lists the
files, in parallel over many folders; their content is not read, and no list of files reaches Python. Spark's readers leave
files without a byte out, so an emptied file looks like an absent one; ``quality.landed_files`` tells them apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import hadoop_fs

_SCHEMA = "path string, size long"


def present(spark: SparkSession, path: str) -> DataFrame:
    """(path, size) of every file below a folder that has any content."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select("path", F.col("length").alias("size"))


def recorded(spark: SparkSession, path: str) -> DataFrame:
    """(path, size) of every file in the manifest; no row without a manifest."""
    fs, folder = hadoop_fs(spark, f"{path}/_manifest")
    if not fs.exists(folder):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).parquet(f"{path}/_manifest")


def record(spark: SparkSession, path: str) -> None:
    """Add the files that are not in the manifest yet. To be called by the writer after its write has ended."""
    present(spark, path).join(recorded(spark, path), "path", "left_anti").write.mode("append").parquet(f"{path}/_manifest")


def issues(spark: SparkSession, path: str) -> DataFrame:
    """(path, issue, size, found): recorded files that are ``lost`` (absent or empty) or ``changed``, others that are ``unknown``.

    A file recorded twice counts once, by its largest size.
    """
    known = recorded(spark, path).groupBy("path").agg(F.max("size").alias("size"))
    there = present(spark, path).withColumnRenamed("size", "found")
    issue = (
        F.when(F.col("found").isNull(), "lost")
        .when(F.col("size").isNull(), "unknown")
        .when(F.col("size") != F.col("found"), "changed")
    )
    met = known.join(there, "path", "full").select("path", issue.alias("issue"), "size", "found")
    return met.where(F.col("issue").isNotNull())
