"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node it is connected with.

    Alternates two star steps until nothing changes: every node's larger neighbours move to its smallest
    neighbour, then its smaller neighbours do. The rounds grow with the logarithm of the longest path. Each round is
    written to the shared folder, which cuts the lineage. A hub's neighbours are reduced to a minimum
    before they meet, and the join back to that minimum has one row per hub, so it can be split.
    """
    current = stored(_forward(edges), "edges")
    while True:
        large = _towards_minimum(current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        following = stored(_forward(_towards_minimum(_forward(large), larger=False)), "edges")
        if _same(current, following):
            break
        current = following
    # a star now: the smaller end is the component
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def _forward(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node, without loops."""
    return (
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )


def _towards_minimum(edges: DataFrame, larger: bool) -> DataFrame:
    """Per node a of ``edges``: link its neighbours b (larger than a, or all) to the smallest of a and its neighbours."""
    # stored, so that the join does not take over the exchange of the grouping and a hub's edges can be split
    least = stored(edges.groupBy(F.col("a").alias("hub")).agg(F.least(F.min("b"), F.first("a")).alias("least")), "least")
    met = edges.join(least, F.col("a") == F.col("hub"))
    if larger:
        return met.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return met.select(F.col("b").alias("a"), F.col("least").alias("b")).unionAll(
        least.select(F.col("hub").alias("a"), F.col("least").alias("b"))
    )


def _same(one: DataFrame, other: DataFrame) -> bool:
    """Equal edge sets, by count and sums of two hashes."""

    def digest(edges: DataFrame):
        h = F.xxhash64("a", "b").cast("decimal(38,0)")
        g = F.xxhash64("b", "a").cast("decimal(38,0)")
        return tuple(edges.agg(F.count("*"), F.sum(h), F.sum(g)).first())

    return digest(one) == digest(other)
