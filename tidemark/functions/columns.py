"""Column expressions shared by the operators. All stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = str | Column


def as_column(value: ColumnLike) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def descending(*names: ColumnLike) -> list[Column]:
    """Warehouse order for DESC: NULL counts as the largest value."""
    return [as_column(n).desc_nulls_first() for n in names]


def ascending(*names: ColumnLike) -> list[Column]:
    """Warehouse order for ASC: NULL comes last."""
    return [as_column(n).asc_nulls_last() for n in names]


def rounded(value: ColumnLike, digits: int) -> Column:
    """Round half away from zero through DECIMAL, so ties never depend on binary floats."""
    return F.round(as_column(value).cast("decimal(28,8)"), digits).cast("double")


def difference(left: ColumnLike, right: ColumnLike, digits: int = 4) -> Column:
    return rounded(as_column(left) - as_column(right), digits)


def percent_over(left: ColumnLike, right: ColumnLike, digits: int = 2) -> Column:
    """How far ``left`` lies above ``right`` in percent of ``right``; NULL when ``right`` is 0."""
    base = as_column(right).cast("decimal(18,8)")
    return rounded((as_column(left).cast("decimal(18,8)") - base) / F.nullif(base, F.lit(0)) * 100, digits)


def price_change(last: ColumnLike, close: ColumnLike) -> Column:
    return as_column(last) - as_column(close)


def price_change_pct(last: ColumnLike, close: ColumnLike) -> Column:
    """Change against the close in percent; 0 when the close is missing or not positive."""
    close = as_column(close)
    return F.when(close > 0, price_change(last, close) / close * 100).otherwise(F.lit(0))


def status_or_unknown(status: ColumnLike) -> Column:
    return F.coalesce(as_column(status), F.lit("Unknown"))


def hours_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Number of hour boundaries crossed from ``start`` to ``end`` (00:59 to 01:01 is 1)."""
    def hour_number(value: ColumnLike) -> Column:
        return F.unix_timestamp(F.date_trunc("hour", as_column(value)).cast("timestamp"))

    return ((hour_number(end) - hour_number(start)) / 3600).cast("bigint")


def days_before(moment: ColumnLike, days: int) -> Column:
    return as_column(moment) - F.make_dt_interval(F.lit(days))


def moment(value: ColumnLike | datetime | None) -> Column:
    """A point in time: a literal, a column, or the clock when nothing is given."""
    if value is None:
        return F.localtimestamp()
    return F.lit(value).cast("timestamp_ntz") if isinstance(value, datetime) else as_column(value)


def day(value: ColumnLike | date | None) -> Column:
    if value is None:
        return F.current_date()
    return F.lit(value).cast("date") if isinstance(value, date) else as_column(value).cast("date")


def date_parts(ts: ColumnLike) -> dict[str, Column]:
    """Zero-padded year, month and day, as used in lake paths."""
    ts = as_column(ts)
    # fixed values: path layout year=YYYY/month=MM/day=DD
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    }


def bucket_label(value: ColumnLike, edges: Sequence[str], labels: Sequence[str]) -> Column:
    """Label of the first half-open bucket ``value < edge``; the last label takes the rest.

    Edges are decimal text: a binary 0.1 would push exact edge prices into the wrong bucket.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    value = as_column(value)
    expr = None
    for edge, label in zip(edges, labels):
        hit = value < F.lit(edge).cast("decimal(10,4)")
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return F.lit(labels[-1]) if expr is None else expr.otherwise(labels[-1])


def keyword_label(text: ColumnLike, rules: Mapping[str, Sequence[str]], default: str = "Other") -> Column:
    """First rule with a keyword inside the lower-cased text wins."""
    lowered = F.lower(as_column(text))
    expr = None
    for label, words in rules.items():
        hit = None
        for word in words:
            found = lowered.contains(word.lower())
            hit = found if hit is None else hit | found
        if hit is not None:
            expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return F.lit(default) if expr is None else expr.otherwise(default)


def joined_text(*parts: ColumnLike) -> Column:
    """Concatenation with numbers turned to text; any NULL part gives NULL."""
    return F.concat(*[as_column(p).cast("string") for p in parts])


def variant_path(value: ColumnLike, path: str, type_name: str, strict: bool = True) -> Column:
    """Typed read at a path of a VARIANT; ``strict=False`` turns bad values into NULL."""
    read = F.variant_get if strict else F.try_variant_get
    return read(as_column(value), path, type_name)


def variant_rows(value: ColumnLike, path: str, attributes: Mapping[str, str], strict: bool = False) -> Column:
    """The array at a path of a VARIANT as structs of some attributes, read in one pass.

    An element that is no object has NULL attributes, an attribute that is missing is NULL, and one of a wrong type fails the read,
    as ``variant_path`` does. What is no array is NULL, or fails with ``strict``. Elements are copied as VARIANT only if
    some are no objects: a copy walks the whole element, and each path read from it looks its attribute up again.
    """
    value = as_column(value)
    names = ", ".join(f"`{name}`: {type_name}" for name, type_name in attributes.items())
    shapes = F.try_variant_get(value, path, "array<struct<_: boolean>>")
    one_by_one = F.transform(
        variant_path(value, path, "array<variant>", strict),
        lambda e: F.struct(*[variant_path(e, f"$.{name}", type_name).alias(name) for name, type_name in attributes.items()]),
    )
    all_objects = F.forall(shapes, lambda e: e.isNotNull())
    return F.when(all_objects, F.variant_get(value, path, f"array<struct<{names}>>")).otherwise(one_by_one)
