"""File sinks: envelope, JSON, CSV, date-partitioned landing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import ColumnLike, as_column, date_parts
from tidemark.operators.flatten import flatten_struct

PARTS = ("year", "month", "day")


def envelope(df: DataFrame, source: str | Column, extracted_at: datetime | Column | None = None) -> DataFrame:
    """Each row as ``data`` inside an envelope with source and UTC extraction time (ISO text)."""
    at = F.lit(extracted_at) if isinstance(extracted_at, datetime) else extracted_at
    if at is None:
        at = F.current_timestamp()
    name = source if isinstance(source, Column) else F.lit(source)
    return df.select(
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("extracted_at"),
        name.alias("source"),
        F.struct(*df.columns).alias("data"),
    )


def as_json_text(df: DataFrame, alias: str = "value") -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias(alias))


def _jsonable(df: DataFrame) -> DataFrame:
    """Columns JSON has no form for become text."""
    fields = df.schema.fields
    texts = (T.BinaryType, T.DayTimeIntervalType, T.YearMonthIntervalType, T.CalendarIntervalType)
    return df.select(
        [
            F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, texts) else F.col(f"`{f.name}`")
            for f in fields
        ]
    )


#: Rows in a compressed file. Such files cannot be split, so their size is bounded; a reader gathers small ones into one task.
ROWS_PER_FILE = 50_000


def text_options(compression: str | None) -> dict[str, str | int]:
    """Options of a writer of text files."""
    return {"compression": compression, "maxRecordsPerFile": ROWS_PER_FILE} if compression else {}


def save_json(df: DataFrame, path: str, compression: str | None = None, mode: str = "overwrite") -> str:
    _jsonable(df).write.mode(mode).options(**text_options(compression)).json(path)
    return path


def csv_rows(df: DataFrame, records: str = "markets") -> DataFrame:
    """Rows for CSV: each element of a ``markets`` array becomes a row, nested structs dotted columns."""
    if records in df.columns and isinstance(df.schema[records].dataType, T.ArrayType):
        df = df.select(F.explode(records).alias("_r")).select("_r.*")
    return flatten_struct(df)


def save_csv(df: DataFrame, path: str, records: str = "markets", compression: str | None = None) -> str:
    writer = csv_rows(df, records).write.mode("overwrite").option("header", True).option("escape", '"')
    writer.options(**text_options(compression)).csv(path)
    return path


def save(df: DataFrame, path: str, file_format: str = "json") -> str:
    """Documents in JSON with their envelope, or only their data part as CSV."""
    kind = file_format.lower()
    if kind == "json":
        return save_json(df, path)
    if kind == "csv":
        return save_csv(df.select("data.*") if "data" in df.columns else df, path)
    raise ValueError(f"Unsupported format: {file_format}")


def with_upload_metadata(df: DataFrame, source_file: ColumnLike, uploaded_at: Column | None = None) -> DataFrame:
    """Audit columns of a landed row."""
    name = F.regexp_extract(as_column(source_file), r"([^/]*)$", 1)
    return df.withColumn("upload_timestamp", F.current_timestamp() if uploaded_at is None else uploaded_at).withColumn(
        "source_file", name
    )


def with_date_parts(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns(date_parts(ts))


def save_by_date(df: DataFrame, path: str, ts: str, file_format: str = "json", mode: str = "append") -> str:
    """Write under ``year=YYYY/month=MM/day=DD``.

    The rebalance hint gathers each day for few files, and AQE splits days that are too large,
    so a day holding most rows is still written by many tasks.
    """
    dated = with_date_parts(df, ts).hint("rebalance", *PARTS)
    dated.write.mode(mode).partitionBy(*PARTS).format(file_format).save(path)
    return path
