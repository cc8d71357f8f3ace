"""Joins whose many-side may hold a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def with_children(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """Left outer join of a parent to many children, safe for a parent owning most of them.

    AQE can split only the left side of a left outer join, and here the right side is the large
    one. An inner join splits either side; parents without children are added from an anti join
    against the distinct child keys.
    """
    matched = parent.join(child, key)
    childless = parent.join(child.select(key).distinct(), key, "left_anti")
    return matched.unionByName(childless, allowMissingColumns=True)


def without_match(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is absent from ``other``; its keys are made distinct before the shuffle."""
    return df.join(other.select(*keys).distinct(), keys, "left_anti")


def with_match(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs in ``other``."""
    return df.join(other.select(*keys).distinct(), keys, "left_semi")
