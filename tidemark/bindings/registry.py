"""Named queries with their SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Runner = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Runner] = {}
ORACLE: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: bigint, double, text and boolean."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            value = value.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            value = value.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def register(name: str, run: Runner, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = lambda spark, sf_dir: plain(run(spark, sf_dir))
    if sql is not None:
        ORACLE[name] = sql


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    def keep(run: Runner) -> Runner:
        register(name, run, sql)
        return run

    return keep


# --- pieces of SQL text -----------------------------------------------------------------------


def rnd(expr: str, digits: int) -> str:
    """Round half away from zero through DECIMAL, as ``functions.columns.rounded`` does."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def date_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"
