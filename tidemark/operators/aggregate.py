"""Grouping operators: shares, histograms, row counts, mergeable moments, top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ColumnLike, as_column, bucket_label, keyword_label, rounded
from tidemark.session import stored


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows; planned as TakeOrderedAndProject, each task keeps ``k`` rows."""
    return df.orderBy(*order).limit(k)


def top_k_joined(child: DataFrame, parent: DataFrame, key: str, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of ``child`` joined to ``parent``, ordered by columns of the child.

    Joins the first ``k`` child rows only: ``k`` rows are broadcast whatever the size of the
    tables, and neither is shuffled. When some of them have no parent and fewer than ``k`` rows
    come out, later child rows count too, and the tables are joined in full.
    """
    candidates = F.broadcast(top_k(child, order, k))
    found = stored(parent.join(candidates, key), "top")
    if found.count() < k:
        return top_k(child.join(parent, key), order, k)
    return top_k(found, order, k)


def share_of_total(
    df: DataFrame,
    keys: Sequence[str],
    count_alias: str,
    share_alias: str,
    extra: Sequence[Column] = (),
    few_groups: bool = False,
) -> DataFrame:
    """Rows per group and their share of all rows in percent, rounded to 2 digits.

    The total is a scalar subquery over the grouped rows, so many groups never meet in one task.
    ``few_groups`` (a status, a fixed set of buckets) totals with a window instead.
    """
    grouped = df.groupBy(*keys).agg(F.count("*").alias(count_alias), *extra)
    if few_groups:
        total = F.sum(count_alias).over(Window.partitionBy())
    else:
        total = grouped.agg(F.sum(count_alias).alias("total")).scalar()
    share = F.col(count_alias).cast("decimal(20,0)") * 100 / total
    return grouped.withColumn(share_alias, rounded(share, 2))


def histogram(
    df: DataFrame,
    column: str,
    edges: Sequence[str],
    labels: Sequence[str],
    bucket_alias: str = "bucket",
    count_alias: str = "rows",
    share_alias: str = "percentage",
) -> DataFrame:
    """Counts and shares per half-open bucket over the non-NULL values."""
    labelled = df.filter(F.col(column).isNotNull()).select(bucket_label(column, edges, labels).alias(bucket_alias))
    return share_of_total(labelled, [bucket_alias], count_alias, share_alias, few_groups=True)


def keyword_category(
    df: DataFrame, text: str, rules: Mapping[str, Sequence[str]], aggregates: Sequence[Column], alias: str = "category"
) -> DataFrame:
    """Aggregates per keyword category of a text column."""
    return df.withColumn(alias, keyword_label(text, rules)).groupBy(alias).agg(*aggregates)


def table_counts(tables: Mapping[str, DataFrame], name_alias: str = "table_name", count_alias: str = "row_count"):
    """One row per table with its number of rows."""
    frames = [
        df.agg(F.count("*").alias(count_alias)).select(F.lit(name).alias(name_alias), count_alias)
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, frames)


# --- mergeable moments of a DECIMAL column -------------------------------------------------
# Sums of decimals are exact, so moments taken per fine key combine to coarse keys without
# loss and in any order. This lets a report aggregate before it joins. Squares are kept in whole units of the last
# digit, where a decimal has room for 10^18 values of a million.

SCALE = 4
_WHOLE = "decimal(38,0)"


def units(value: ColumnLike) -> Column:
    """A DECIMAL with up to ``SCALE`` digits behind the point as a whole number of its last digit."""
    return (as_column(value) * F.lit(10**SCALE).cast("decimal(5,0)")).cast(_WHOLE)


def moments(value: ColumnLike, prefix: str = "p") -> list[Column]:
    value = as_column(value)
    whole = units(value).cast("decimal(18,0)")
    return [
        F.count(value).alias(f"{prefix}_n"),
        F.sum(value).alias(f"{prefix}_sum"),
        F.sum((whole * whole).cast(_WHOLE)).alias(f"{prefix}_squares"),
        F.min(value).alias(f"{prefix}_min"),
        F.max(value).alias(f"{prefix}_max"),
    ]


def combined(prefix: str = "p", weight: Column | None = None) -> dict[str, Column]:
    """Aggregate expressions over rows of partial moments."""
    n, total, squares = (F.col(f"{prefix}_{s}") for s in ("n", "sum", "squares"))
    if weight is not None:
        n, total, squares = n * weight, total * weight, squares * weight.cast(_WHOLE)
    n, total, squares = F.sum(n), F.sum(total), F.sum(squares)
    return {
        "count": F.coalesce(n, F.lit(0)).cast("bigint"),
        "sum": total,
        "avg": mean_of(n, total),
        "min": F.min(f"{prefix}_min"),
        "max": F.max(f"{prefix}_max"),
        "stddev": deviation_of(n, total, squares),
    }


def mean_of(n: Column, total: Column) -> Column:
    return F.when(n > 0, total.cast("decimal(38,8)") / n.cast("decimal(20,0)"))


def deviation_of(n: Column, total: Column, squares: Column) -> Column:
    """Sample deviation from count, sum and sum of squared ``units``; NULL below two values.

    One way for every size. With the sum of units as ``n * q + r``, 0 <= r < n, the squared distances from q add up to
    ``squares - q * (sum + r)``, a whole number taken exactly, and their sum about the mean is that less r^2 / n. It is
    computed as ``(that - r) + r * (n - r) / n``: both parts are at least 0, so nothing cancels, and equal values give exactly 0.
    """
    count = F.when(n > 0, n).cast(_WHOLE)
    whole, squares = units(total.cast("decimal(33,4)")), squares.cast(_WHOLE)
    rest = F.pmod(whole, count)
    quotient = F.call_function("div", whole - rest, count).cast("decimal(19,0)")
    about = squares - (quotient * (whole + rest).cast(_WHOLE)).cast(_WHOLE) - rest
    spread = about.cast("double") + rest.cast("double") * (count - rest).cast("double") / count.cast("double")
    return F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n.cast("double") - 1)) / 10.0**SCALE)
