"""Column helpers and tables shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, as a Java class. Words are the runs of anything else.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row.

    A lambda variable is never inlined, so a costly value can be used inside other lambdas.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words of a text in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def text_key(text: Column) -> Column:
    """Two 64-bit hashes that stand for a text when rows meet again."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"))


def packed(rows: DataFrame, **more: Column) -> DataFrame:
    """Whole rows in one column ``row`` beside others, so that no column of the rows can clash with a name used here."""
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), *[c.alias(name) for name, c in more.items()])


def unpacked(rows: DataFrame, columns: Sequence[str], **more: Column) -> DataFrame:
    """The rows of ``packed`` again."""
    return rows.select(*[F.col("row").getField(c).alias(c) for c in columns], *[c.alias(name) for name, c in more.items()])


def free_name(columns: Sequence[str], name: str) -> str:
    """``name``, or with the first number behind it that no column has."""
    taken = {c.lower() for c in columns}
    return next(n for n in (name, *(f"{name}_{i}" for i in range(1, len(taken) + 2))) if n.lower() not in taken)
