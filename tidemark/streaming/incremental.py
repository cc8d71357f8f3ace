"""Incremental loads: each landed file is taken once, as a file stream with a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.flatten import flatten_snapshots
from tidemark.plans import model
from tidemark.plans.model import SUMMARY_TIES
from tidemark.session import COMPACT
from tidemark.sinks.tables import prune_images, upsert_table
from tidemark.sources.snapshots import (
    CORRUPT,
    JSON_FILES,
    SNAPSHOT_SCHEMA,
    is_unreadable,
    moments_as_text,
    with_corrupt_text,
    with_moments,
)


def document_stream(
    spark: SparkSession, path: str, one_per_file: bool = True, pattern: str = JSON_FILES, max_files: int | None = None
) -> DataFrame:
    """Snapshot documents as a stream over landed files, read like ``read_documents`` reads them."""
    schema, moments = moments_as_text(SNAPSHOT_SCHEMA)
    reader = (
        spark.readStream.schema(with_corrupt_text(schema))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", one_per_file)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_moments(reader.json(path).withColumn("source_file", F.col("_metadata.file_path")), moments, tolerant=True)


def _append(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .option("path", target)
        .options(**COMPACT)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .start()
    )


def append_raw(documents: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append flattened snapshots to a Parquet table, every file exactly once. Ends when caught up."""
    return _append(flatten_snapshots(documents.filter(~is_unreadable(documents))), target, checkpoint)


def append_quarantine(documents: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append unreadable documents with their text and file. Ends when caught up."""
    unreadable = documents.filter(is_unreadable(documents))
    return _append(unreadable.select("source_file", CORRUPT), target, checkpoint)


def summary_upserter(base: str) -> Callable[[DataFrame, int], None]:
    """Batch function that merges the newest snapshot per market into a published table.

    A snapshot ranked behind the stored one changes nothing, so late files and repeated batches
    leave the table right, and equally new snapshots end as in one batch. ``plans.upkeep`` keeps all tables so.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        summary = model.market_summary(flatten_snapshots(batch.filter(~is_unreadable(batch))))
        upsert_table(
            spark,
            base,
            summary.select(*model.SUMMARY_INSERTS),
            ["market_id"],
            model.SUMMARY_UPDATES,
            insert_columns=model.SUMMARY_INSERTS,
            newer_by="last_updated",
            tie_breakers=SUMMARY_TIES,
            check_unique=False,
        )
        prune_images(spark, base)

    return upsert


def upsert_summary(documents: DataFrame, base: str, checkpoint: str) -> StreamingQuery:
    """Keep the market summary current from the stream. Ends when caught up."""
    return (
        documents.writeStream.foreachBatch(summary_upserter(base))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
