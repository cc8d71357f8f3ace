"""Other feeds in the same envelope: objects keyed by id, and single records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.flatten import flatten_struct

# fixed values: attributes of a keyed price object
KEYED_PRICES_DDL = (
    "extracted_at STRING, source STRING, data MAP<STRING, STRUCT<usd: DOUBLE, usd_24h_change: DOUBLE>>"
)


def keyed_records(documents: DataFrame, key_alias: str = "id") -> DataFrame:
    """One row per key of ``data``, a map from id to a struct."""
    rows = documents.select("extracted_at", "source", F.explode("data").alias(key_alias, "_record"))
    return rows.select(F.col("extracted_at").cast("timestamp_ntz").alias("extracted_at"), "source", key_alias, "_record.*")


def keyed_records_from_text(text: DataFrame, ddl: str = KEYED_PRICES_DDL, key_alias: str = "id") -> DataFrame:
    parsed = text.select(F.from_json("value", ddl).alias("d")).select("d.*")
    return keyed_records(parsed, key_alias)


def single_records(documents: DataFrame, sep: str = "_") -> DataFrame:
    """The record inside ``data`` as flat columns, one row per document."""
    taken_at = F.col("extracted_at").cast("timestamp_ntz").alias("extracted_at")
    return flatten_struct(documents.select(taken_at, "source", "data.*"), sep)
