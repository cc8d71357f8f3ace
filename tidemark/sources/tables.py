"""Tables made from a description, and batch inserts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: audit columns of a loaded table
AUDIT_COLUMNS = {"loaded_at": "TIMESTAMP_NTZ", "source_file": "VARCHAR(500)"}
AUDIT_DEFAULTS = {"loaded_at": "localtimestamp()"}


def schema_from_dict(columns: Mapping[str, str], audit: bool = True) -> T.StructType:
    """Schema from column names and SQL types, with audit columns when asked."""
    described = {**columns, **(AUDIT_COLUMNS if audit else {})}
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in described.items()))


def create_table(
    spark: SparkSession,
    name: str,
    columns: Mapping[str, str],
    location: str | None = None,
    audit: bool = True,
    defaults: Mapping[str, str] | None = None,
    partition_by: Iterable[str] = (),
) -> None:
    """``CREATE TABLE IF NOT EXISTS`` over Parquet with column defaults.

    Keys are not enforced by file tables; ``tidemark.operators.quality`` reports violations.
    """
    described = {**columns, **(AUDIT_COLUMNS if audit else {})}
    filled = {**(AUDIT_DEFAULTS if audit else {}), **(defaults or {})}
    body = ", ".join(
        f"`{c}` {kind}" + (f" DEFAULT {filled[c]}" if c in filled else "") for c, kind in described.items()
    )
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING parquet{parts}{place}")


def insert_rows(df: DataFrame, path: str) -> int:
    """Append rows and return how many, counted while writing."""
    seen = Observation("insert")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return seen.get["rows"]


def insert_tuples(spark: SparkSession, rows: list[tuple], schema: T.StructType | str, path: str) -> int:
    """Append parameter tuples handed in by the caller."""
    return insert_rows(spark.createDataFrame(rows, schema), path)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))
