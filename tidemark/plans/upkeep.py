"""Incremental upkeep of all tables: a batch of snapshots changes what it touches, and nothing else is read or written.

A batch runs through the tables in turn, and each passes its changes on:

1. raw rows are appended under their day (or month), unreadable documents to the quarantine;
2. the newest snapshot per market is merged into the summary, the newest per contract into the details. A merge
   applies where the new row ranks before the stored one, in the order of the full refresh, so batches may come in any order;
3. the changed contracts, with the row before, become differences of counts and sums per market, which are added to the
   totals. Sums are whole numbers or decimals, so adding and taking away leave no error;
4. the markets of changed summaries and totals get new daily metrics. On the first batch of a day all markets do.

Each table keeps the number of the last batch it has taken from a source in the same commit as its rows, and its changes with
them. A batch repeated after a failure goes on where it stopped; one repeated after success changes nothing.

Contracts without an id cannot be told from one another between batches: they stay in the raw table and are in no other.
"""

from __future__ import annotations

from contextlib import nullcontext
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import day
from tidemark.operators.aggregate import deviation_of, units
from tidemark.operators.flatten import flatten_contracts, flatten_snapshots
from tidemark.plans import model
from tidemark.session import scratch
from tidemark.sinks.managed import ACTIONS, BEFORE, ManagedTable, Merged, by_hash, by_value
from tidemark.sources.snapshots import CORRUPT, is_unreadable

BUCKETS = 64
_WHOLE = "decimal(38,0)"
_SUMS = {"contracts": "bigint", "priced": "bigint", "price_sum": "decimal(38,4)", "price_squares": _WHOLE}


@dataclass(frozen=True)
class Warehouse:
    """The tables kept up to date under one folder."""

    raw: ManagedTable
    quarantine: ManagedTable
    market_summary: ManagedTable
    contract_details: ManagedTable
    market_totals: ManagedTable
    daily_metrics: ManagedTable
    period: str = "day"

    @classmethod
    def at(cls, spark: SparkSession, base: str, buckets: int = BUCKETS, period: str = "day") -> Warehouse:
        """``buckets`` counts when a table is made; choose it so that a bucket fits in a few tasks. Raw rows lie
        under the first day of their ``period`` (day, month or year)."""
        return cls(
            ManagedTable(spark, f"{base}/raw", by_value("taken_on")),
            ManagedTable(spark, f"{base}/quarantine", by_hash(["source_file"], 1)),
            ManagedTable(spark, f"{base}/market_summary", by_hash(["market_id"], buckets)),
            ManagedTable(spark, f"{base}/contract_details", by_hash(["contract_id"], buckets)),
            ManagedTable(spark, f"{base}/market_totals", by_hash(["market_id"], buckets)),
            ManagedTable(spark, f"{base}/daily_metrics", by_value("metric_date")),
            period,
        )

    def tables(self) -> tuple[ManagedTable, ...]:
        return self.raw, self.quarantine, self.market_summary, self.contract_details, self.market_totals, self.daily_metrics

    def prune(self, keep: int = 3, least_age: float = 86_400.0) -> None:
        for table in self.tables():
            table.prune(keep, least_age)


@dataclass(frozen=True)
class Applied:
    """Rows written by a batch, by table and action; all zero for a batch taken before."""

    market_summary: dict[str, int]
    contract_details: dict[str, int]
    market_totals: dict[str, int]
    daily_metrics: dict[str, int]
    parts: dict[str, tuple[str, ...]]


def apply_batch(
    documents: DataFrame, warehouse: Warehouse, number: int, source: str = "landing", metric_date: date | None = None
) -> Applied:
    """Take a batch of documents (typed or VARIANT) into all tables.

    Batches of a ``source`` are numbered upwards; a number not above the last one taken is a repetition.
    """
    batch = (source, number)
    kept = [t for t in warehouse.tables() if t is not warehouse.quarantine or CORRUPT in documents.columns]
    if all(t.has_taken(batch, t.entry()) for t in kept):
        none = dict.fromkeys(ACTIONS, 0)  # a repetition: the documents need not be read
        return Applied(none, none, none, none, dict.fromkeys(("market_summary", "contract_details", "market_totals", "daily_metrics"), ()))
    bad = is_unreadable(documents)
    seen = Observation("batch")
    flat = _flat(documents.observe(seen, F.count_if(bad).alias("unreadable")).where(~bad), warehouse)
    taken = warehouse.raw.appended(flat, batch)
    if CORRUPT in documents.columns:
        # the documents are read once more only if the first reading has met an unreadable one, or was not this call's
        some = taken is None or seen.get["unreadable"]
        lost = documents.where(bad).select("source_file", CORRUPT)
        warehouse.quarantine.append(lost if some else lost.limit(0), batch)
    # raw rows are read from where they were appended; after a failure behind that they are made again
    with scratch(_flat(documents.where(~bad), warehouse), "batch") if taken is None else nullcontext(taken) as held:
        summary, details = _merged_newest(held, warehouse, batch)
    totals = warehouse.market_totals.merge(
        differences(details.changes), ["market_id"], list(_SUMS), batch, combine=_added, check_unique=False
    )
    daily = _daily(warehouse, summary, totals, metric_date, batch)
    return Applied(
        summary.counts,
        details.counts,
        totals.counts,
        daily.counts,
        {"market_summary": summary.parts, "contract_details": details.parts, "market_totals": totals.parts, "daily_metrics": daily.parts},
    )


def _flat(documents: DataFrame, warehouse: Warehouse) -> DataFrame:
    return flatten_snapshots(documents).withColumn("taken_on", F.date_trunc(warehouse.period, "extraction_timestamp").cast("date"))


def _merged_newest(flat: DataFrame, warehouse: Warehouse, batch: tuple[str, int]) -> tuple[Merged, Merged]:
    """The newest rows of a batch merged into the summary and the details."""
    summary = warehouse.market_summary.merge(
        model.market_summary(flat).select(*model.SUMMARY_INSERTS),
        ["market_id"],
        [*model.SUMMARY_UPDATES, "total_volume"],
        batch,
        newer_by="last_updated",
        tie_breakers=model.SUMMARY_TIES,
        check_unique=False,
    )
    versions = model.contract_details(flat).where("contract_id is not null")
    details = warehouse.contract_details.merge(
        versions,
        ["contract_id"],
        ["market_id", *model.DETAIL_UPDATES],
        batch,
        newer_by="last_updated",
        tie_breakers=model.DETAIL_TIES,
        check_unique=False,
    )
    return summary, details


def differences(changes: DataFrame) -> DataFrame:
    """What changed contracts add to the sums of their markets: the new row counts up, the one before down."""

    def side(prefix: str, sign: int) -> DataFrame:
        price = F.col(f"{prefix}last_trade_price")
        whole = units(price).cast("decimal(18,0)")
        return changes.select(
            F.col(f"{prefix}market_id").alias("market_id"),
            F.lit(sign).alias("contracts"),
            F.when(price.isNotNull(), sign).otherwise(0).alias("priced"),
            (F.coalesce(price, F.lit(0)) * sign).alias("price_sum"),
            (F.coalesce((whole * whole).cast(_WHOLE), F.lit(0)) * sign).cast(_WHOLE).alias("price_squares"),
        )

    both = side("", 1).unionByName(side(f"{BEFORE}.", -1)).where("market_id is not null")
    return both.groupBy("market_id").agg(*[F.sum(c).cast(t).alias(c) for c, t in _SUMS.items()])


def _added(differences: DataFrame, totals: DataFrame) -> DataFrame:
    """Totals of the markets in ``differences`` after adding them."""
    before = totals.select(F.col("market_id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in _SUMS])
    joined = differences.join(before, F.col("market_id") == F.col("_id"), "left")
    zero = F.lit(0)
    return joined.select("market_id", *[(F.col(c) + F.coalesce(F.col(f"_{c}"), zero)).cast(t).alias(c) for c, t in _SUMS.items()])


def metrics_of(markets: DataFrame, totals: DataFrame, metric_date: date | Column | None) -> DataFrame:
    """Daily metrics of markets from their totals; equal to ``model.daily_metrics`` over the contracts."""
    joined = markets.select("market_id").join(totals.withColumnRenamed("market_id", "_id"), F.col("market_id") == F.col("_id"), "left")
    count, total = F.col("priced"), F.col("price_sum")
    mean = F.when(count > 0, (total / F.when(count > 0, count)).cast("decimal(14,8)"))
    return joined.select(
        "market_id",
        day(metric_date).alias("metric_date"),
        F.coalesce("contracts", F.lit(0)).cast("bigint").alias("total_contracts"),
        F.coalesce(total, F.lit(0)).cast("decimal(20,4)").alias("total_volume"),
        F.coalesce(mean, F.lit(0)).cast("decimal(14,8)").alias("avg_trade_price"),
        F.coalesce(deviation_of(count, total, F.col("price_squares")), F.lit(0.0)).alias("price_volatility"),
    )


def _daily(warehouse: Warehouse, summary: Merged, totals: Merged, metric_date: date | None, batch: tuple[str, int]) -> Merged:
    spark, table = warehouse.raw.spark, warehouse.daily_metrics
    touched = summary.changes.select("market_id").unionByName(totals.changes.select("market_id")).distinct()
    markets, sums = warehouse.market_summary, warehouse.market_totals
    today = spark.range(1).select(day(metric_date).alias("metric_date"))
    entry = table.entry()
    if entry is None or table.parts_of(today, entry)[0] not in entry.content["parts"]:
        chosen, totalled = markets.read(), sums.read()  # the first batch of a day: every market gets its row
    else:
        # only parts with a touched market are read
        known = markets.read(parts=markets.parts_of(touched)).select("market_id")
        chosen, totalled = known.join(touched, "market_id", "left_semi"), sums.read(parts=sums.parts_of(touched))
    rows = metrics_of(chosen, totalled, metric_date)
    return table.merge(rows, model.DAILY_KEYS, model.DAILY_UPDATES, batch, check_unique=False)


def follow(
    documents: DataFrame, warehouse: Warehouse, checkpoint: str, source: str = "landing", metric_date: date | None = None
) -> StreamingQuery:
    """Keep all tables current from a stream of documents. Ends when caught up."""

    def take(batch: DataFrame, number: int) -> None:
        apply_batch(batch, warehouse, number, source, metric_date)

    return (
        documents.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
