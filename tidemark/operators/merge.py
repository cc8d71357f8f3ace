"""Table maintenance as DataFrame rewrites: upsert, insert-if-absent, expiry of stale rows.

Each function returns the new image of the table; ``tidemark.sinks.tables`` publishes it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import days_before, moment
from tidemark.operators.joins import without_match
from tidemark.operators.skew import slot_when

BROADCAST_LIMIT = 32 * 1024 * 1024
_FIXED_WIDTH = 16


class DuplicateSourceKeys(ValueError):
    """The merge source holds a key more than once."""


def null_slot(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 for complete keys; a spread number for rows with a NULL key.

    NULL keys match nothing, yet a shuffled join would send all of them to one task.
    Joining on the slot too leaves the matches as they are and spreads those rows.
    """
    return slot_when(df, ~reduce(and_, [F.col(k).isNotNull() for k in keys]))


def row_bytes(df: DataFrame) -> Column:
    """Bytes of one row: text and nested columns by length, others by a fixed width."""
    width = F.lit(_FIXED_WIDTH * max(len(df.columns), 1)).cast("bigint")
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            value = F.to_json(F.struct(value))
        elif not isinstance(field.dataType, T.StringType):
            continue
        width = width + F.coalesce(F.octet_length(value), F.lit(0))
    return width


def measured_bytes(df: DataFrame) -> int:
    """Size of the frame in bytes, from one aggregate over its rows."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).cast("bigint")).first()[0]


def require_unique(df: DataFrame, keys: Sequence[str]) -> int:
    """Raise when a complete key occurs twice; returns the size of the frame in bytes.

    One pass: rows are counted per key before the shuffle, so a hot key is one row per task.
    """
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.sum(row_bytes(df)).alias("_bytes"))
    facts = per_key.agg(
        F.max(F.when(complete, F.struct("_n", F.struct(*keys).alias("key")))).alias("most"),
        F.coalesce(F.sum("_bytes"), F.lit(0)).cast("bigint").alias("bytes"),
    ).first()
    if facts["most"] and facts["most"]["_n"] > 1:
        raise DuplicateSourceKeys(f"source holds {facts['most']['key'].asDict()} {facts['most']['_n']} times")
    return facts["bytes"]


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    insert_columns: Sequence[str] | None = None,
    newer_by: str | None = None,
    action_column: str | None = None,
    check_unique: bool = True,
    broadcast_limit: int = BROADCAST_LIMIT,
    tie_breakers: Sequence[str] | None = None,
    before_column: str | None = None,
    source_bytes: int | None = None,
) -> DataFrame:
    """New image of ``target`` after an upsert of ``source``.

    Matched rows take ``update_columns`` from the source and keep the rest. Unmatched source
    rows are inserted with ``insert_columns`` (default: keys and update columns), other
    columns NULL. Rows with a NULL key never match. With ``newer_by`` a matched row changes
    only when the source is not older; a stored row without a time always does. With ``tie_breakers`` the order is that of
    ``latest_per_key`` instead: a row without a time is the newest, and the tie breakers settle equally new ones, so versions
    merged one after the other, in any order, end as if ranked at once.
    ``action_column`` adds updated, inserted or kept, ``before_column`` the row an updated one was before.

    A source measured within ``broadcast_limit`` bytes is broadcast and the target is not
    shuffled; a larger one goes through a full outer join on the keys. Checking and measuring
    run the source once more, so pass a stored table rather than a long plan, or ``source_bytes`` if it is measured already.
    """
    keys = list(keys)
    insert_columns = list(insert_columns or [*keys, *update_columns])
    ordered_by = [newer_by] if newer_by else []
    used = list(dict.fromkeys([*keys, *update_columns, *insert_columns, *ordered_by, *(tie_breakers or ())]))
    source = source.select(*used)
    size = require_unique(source, keys) if check_unique else source_bytes
    small = broadcast_limit and (measured_bytes(source) if size is None else size) <= broadcast_limit
    merged = _merge_small if small else _merge_large
    guard = not_older(newer_by, tie_breakers) if newer_by else F.lit(True)
    return merged(target, source, keys, update_columns, insert_columns, guard, action_column, before_column)


def not_older(newer_by: str, tie_breakers: Sequence[str] | None) -> Column:
    """Whether the source columns ``_s_name`` of a matched row replace those of the target.

    With ``tie_breakers`` they do if they rank first or equal: the newest first with NULL as the newest, equal ones by the
    smallest tie breakers with NULL as the largest.
    """
    if tie_breakers is None:
        return F.col(newer_by).isNull() | (F.col(f"_s_{newer_by}") >= F.col(newer_by))
    ranks_before = F.lit(True)  # equal in everything
    for name in reversed(tie_breakers):
        theirs, ours = F.col(f"_s_{name}"), F.col(name)
        smaller = F.coalesce(theirs < ours, theirs.isNotNull())
        ranks_before = F.when(theirs.eqNullSafe(ours), ranks_before).otherwise(smaller)
    theirs, ours = F.col(f"_s_{newer_by}"), F.col(newer_by)
    newer = F.coalesce(theirs > ours, theirs.isNull())
    return F.when(theirs.eqNullSafe(ours), ranks_before).otherwise(newer)


def _image(target, update_columns, insert_columns, guard, in_target, in_source, action_column, before_column):
    """Output columns over target columns ``name`` and source columns ``_s_name``."""
    types = {f.name: f.dataType for f in target.schema.fields}
    applies = in_target & in_source & guard
    inserted = in_source & ~in_target
    out = []
    for name in target.columns:
        theirs = F.col(f"_s_{name}").cast(types[name])
        value = F.col(name)
        if name in update_columns:
            value = F.when(applies, theirs).otherwise(value)
        if name in insert_columns:
            value = F.when(inserted, theirs).otherwise(value)
        out.append(value.alias(name))
    if action_column:
        out.append(F.when(inserted, "inserted").when(applies, "updated").otherwise("kept").alias(action_column))
    if before_column:
        out.append(F.when(applies, F.struct(*target.columns)).alias(before_column))
    return out


def _renamed(source: DataFrame) -> DataFrame:
    return source.select([F.col(c).alias(f"_s_{c}") for c in source.columns])


def _merge_large(target, source, keys, update_columns, insert_columns, guard, action_column, before_column):
    left = target.withColumn("_slot", null_slot(target, keys)).withColumn("_in_target", F.lit(True))
    right = _renamed(source.withColumn("slot", null_slot(source, keys))).withColumn("_in_source", F.lit(True))
    on = reduce(and_, [F.col(k) == F.col(f"_s_{k}") for k in keys], F.col("_slot") == F.col("_s_slot"))
    joined = left.join(right, on, "full")
    in_target = F.coalesce(F.col("_in_target"), F.lit(False))
    in_source = F.coalesce(F.col("_in_source"), F.lit(False))
    return joined.select(
        *_image(target, update_columns, insert_columns, guard, in_target, in_source, action_column, before_column)
    )


def _merge_small(target, source, keys, update_columns, insert_columns, guard, action_column, before_column):
    types = {f.name: f.dataType for f in target.schema.fields}
    right = F.broadcast(_renamed(source).withColumn("_in_source", F.lit(True)))
    on = reduce(and_, [F.col(k) == F.col(f"_s_{k}") for k in keys])
    in_source = F.coalesce(F.col("_in_source"), F.lit(False))
    kept = target.join(right, on, "left").select(
        *_image(target, update_columns, insert_columns, guard, F.lit(True), in_source, action_column, before_column)
    )

    source_keys = F.broadcast(source.select(*keys))
    matched = target.select(*keys).join(source_keys, keys, "left_semi")
    new_rows = without_match(source, matched, keys).select(
        [(F.col(c) if c in insert_columns else F.lit(None)).cast(types[c]).alias(c) for c in target.columns]
        + ([F.lit("inserted").alias(action_column)] if action_column else [])
        + ([F.lit(None).cast(target.select(F.struct("*")).schema[0].dataType).alias(before_column)] if before_column else [])
    )
    return kept.unionByName(new_rows)


def merge_counts(image: DataFrame, action_column: str) -> DataFrame:
    """Rows inserted, updated and kept by a merge."""
    action = F.col(action_column)
    return image.agg(
        F.count_if(action == "inserted").alias("inserted"),
        F.count_if(action == "updated").alias("updated"),
        F.count_if(action == "kept").alias("kept"),
    )


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str], check_unique: bool = False) -> DataFrame:
    """Target plus the source rows whose key it lacks, one per key.

    Of source rows with one key the first in order of all their columns is inserted; rows with a NULL key never
    conflict and are all inserted. The result has the columns of the target; those the source
    lacks are NULL. ``check_unique`` raises on repeated keys instead.
    """
    if check_unique:
        require_unique(source, keys)
    types = {f.name: f.dataType for f in target.schema.fields}
    columns = [
        (F.col(f"`{c}`") if c in source.columns else F.lit(None)).cast(types[c]).alias(c) for c in target.columns
    ]
    new_rows = without_match(source, target, list(keys)).select(*columns)
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    sortable = [c for c in target.columns if not isinstance(types[c], (T.MapType, T.VariantType))]
    first = Window.partitionBy(*keys, slot_when(new_rows, ~complete)).orderBy(*sortable)
    ranked = new_rows.withColumn("_place", F.row_number().over(first)).where(~complete | (F.col("_place") == 1))
    return target.unionByName(ranked.drop("_place"))


def mark_stale(
    df: DataFrame,
    seen: DataFrame,
    key: str,
    status: str,
    seen_at: str,
    days: int = 7,
    as_of: datetime | Column | None = None,
    closed: str = "Closed",
) -> DataFrame:
    """Set ``status`` to ``closed`` for keys not seen in the last ``days`` days.

    Follows NOT IN: no recent sighting at all closes every row, a NULL among the recent
    keys closes none, and rows with a NULL key change only in the first case.
    """
    recent = seen.filter(F.col(seen_at) >= days_before(moment(as_of), days)).select(F.col(key).alias("_s_key"))
    # one row with both facts, evaluated once as a scalar subquery
    facts = recent.agg(
        F.struct(F.count("*").alias("rows"), F.count_if(F.col("_s_key").isNull()).alias("nulls")).alias("facts")
    ).scalar()
    keys_seen = recent.dropna().distinct().withColumn("_s_slot", F.lit(0).cast("bigint")).withColumn("_seen", F.lit(True))
    joined = df.withColumn("_slot", null_slot(df, [key])).join(
        keys_seen, (F.col(key) == F.col("_s_key")) & (F.col("_slot") == F.col("_s_slot")), "left"
    )
    closes = (facts["rows"] == 0) | (
        (facts["nulls"] == 0) & F.col(key).isNotNull() & F.col("_seen").isNull()
    )
    changed = F.when(closes, F.lit(closed)).otherwise(F.col(status))
    return joined.select([changed.alias(c) if c == status else F.col(c) for c in df.columns])
