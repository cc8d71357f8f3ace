"""Approximate distinct counts by mergeable HyperLogLog sketches, as an opt-in beside exact counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ColumnLike, as_column

#: 2^14 registers: a standard error of 0.65 %, 16 KB a sketch at most; small sets are exact.
PRECISION = 14


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: ColumnLike, precision: int = PRECISION) -> DataFrame:
    """One sketch of the different values of each key. Partial sketches are merged, so values are not shuffled.

    NULL values are not counted; a key with NULLs alone has a sketch that estimates 0.
    """
    # a sketch takes 32-bit or longer numbers, text or bytes; others count by their text
    column = as_column(value)
    kind = df.select(column).schema[0].dataType.simpleString()
    typed = column if kind in ("int", "bigint", "string", "binary") else column.cast("string")
    return df.groupBy(*keys).agg(F.hll_sketch_agg(typed, F.lit(precision)).alias("sketch"))


def united(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser keys from those of finer ones; the rows behind them are not read again."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimate(sketch: ColumnLike = "sketch") -> Column:
    """Approximate number of different values of a sketch; 0 for NULL."""
    return F.coalesce(F.hll_sketch_estimate(as_column(sketch)), F.lit(0).cast("bigint"))
