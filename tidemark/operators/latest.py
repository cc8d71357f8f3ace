"""Newest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ColumnLike, as_column, descending
from tidemark.operators.skew import slot_when
from tidemark.session import freed

#: Most rows of a key that one task ranks; beyond it the rows are joined to their newest pair, which a join may split.
HOT_KEY = 1_000_000


def latest_per_key(
    df: DataFrame,
    keys: Sequence[ColumnLike],
    newest: Sequence[ColumnLike],
    tie_breakers: Sequence[ColumnLike] = (),
) -> DataFrame:
    """One row per key: the newest, ties settled by ``tie_breakers`` (ascending).

    The rank filter lets Spark plan a WindowGroupLimit below the exchange, so every map
    task sends one row per key at most. A key holding a third of all rows costs its final
    task one row per map task.
    """
    order = descending(*newest) + [as_column(t).asc_nulls_last() for t in tie_breakers]
    window = Window.partitionBy(*[as_column(k) for k in keys]).orderBy(*order)
    return df.withColumn("_version", F.row_number().over(window)).filter("_version = 1").drop("_version")


def keep_latest_rows(df: DataFrame, key: str, ts: str, has_null_keys: bool | None = None) -> DataFrame:
    """Rows left after deleting those whose (key, ts) is not a newest pair of its key.

    Ties all stay. The delete follows three-valued NOT IN: a row whose test is unknown
    stays. Without NULL keys that means rows with a NULL ts plus rows at their key's newest ts.
    ``has_null_keys=None`` counts the rows per key first (two pruned columns). If no key is NULL or held by more than ``HOT_KEY``
    rows the rows are ranked, so that a map task sends none but its newest ones.
    """
    k, t = F.col(key), F.col(ts)
    if has_null_keys is None:
        facts = _key_facts(df, key, ts)
        has_null_keys = facts["null_keys"] > 0
        if not has_null_keys and facts["most"] <= HOT_KEY:
            return _ranked_newest(df, key, ts, facts["undated"] > 0)
    if not has_null_keys:
        # joined on (key, ts), not ranked in a window: copies of one newest pair may be a third
        # of all rows, and a join splits them over tasks while a window would not
        newest = df.groupBy(k.alias("_k")).agg(F.max(ts).alias("_t")).withColumn("_newest", F.lit(True))
        slotted = df.withColumn("_slot", slot_when(df, t.isNull()))
        on = (k == F.col("_k")) & (t == F.col("_t")) & (F.col("_slot") == F.col("_zero"))
        joined = slotted.join(newest.withColumn("_zero", F.lit(0).cast("bigint")), on, "left")
        return joined.filter(t.isNull() | F.col("_newest")).select(*df.columns)

    maxima = df.groupBy(key).agg(F.max(ts).alias("_max"))
    null_max = df.filter(k.isNull()).agg(F.max(ts).alias("_max")).scalar()
    undated_groups = maxima.filter(F.col("_max").isNull()).agg(F.count("*").alias("n")).scalar()

    undated = df.filter(t.isNull())
    keyed = df.filter(k.isNotNull() & t.isNotNull())
    keyed = (
        keyed.join(maxima.filter(k.isNotNull()), key)
        .filter((t == F.col("_max")) | null_max.isNull() | (t == null_max))
        .drop("_max")
    )
    unkeyed = df.filter(k.isNull() & t.isNotNull())
    any_maximum = maxima.select(F.col("_max").alias(ts)).filter(t.isNotNull()).distinct()
    at_maximum = unkeyed.filter(undated_groups == 0).join(any_maximum, ts, "left_semi")
    return (
        keyed.unionByName(undated)
        .unionByName(at_maximum.select(*df.columns))
        .unionByName(unkeyed.filter(undated_groups > 0))
    )


def _key_facts(df: DataFrame, key: str, ts: str):
    """Rows with a NULL key, rows without a time, and the most rows that one key holds."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.col(ts).isNull()).alias("undated"))
    null = F.col(key).isNull()
    facts = counts.agg(
        F.coalesce(F.sum(F.when(null, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum("undated"), F.lit(0)).alias("undated"),
        F.coalesce(F.max(F.when(~null, F.col("n"))), F.lit(0)).alias("most"),
    )
    with freed(df.sparkSession):
        return facts.first()


def _ranked_newest(df: DataFrame, key: str, ts: str, has_undated: bool) -> DataFrame:
    """Rows at the newest time of their key, ties included, and those without a time."""
    dated = df.filter(F.col(ts).isNotNull()) if has_undated else df
    window = Window.partitionBy(key).orderBy(F.col(ts).desc())
    newest = dated.withColumn("_rank", F.rank().over(window)).filter("_rank = 1").drop("_rank")
    return newest.unionByName(df.filter(F.col(ts).isNull())) if has_undated else newest
