"""Spreading rows that share a key but need not meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOTS = 1024


def spread_number(df: DataFrame) -> Column:
    """A number from 1 to ``SLOTS`` from the content of the row: the same in every attempt of a task."""
    nested = (T.MapType, T.VariantType, T.StructType, T.ArrayType)
    names = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, nested)]
    return F.pmod(F.xxhash64(*names), F.lit(SLOTS)) + 1


def slot_when(df: DataFrame, condition: Column) -> Column:
    """A spread number for rows meeting ``condition``, 0 for the others.

    Added to the keys of a shuffle it deals those rows over many tasks.
    """
    return F.when(condition, spread_number(df)).otherwise(F.lit(0).cast("bigint"))
