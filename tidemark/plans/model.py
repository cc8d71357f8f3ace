"""Analytics tables derived from raw snapshots: summary, details, daily metrics, trends."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ColumnLike, day
from tidemark.operators.flatten import array_length, flatten_contracts
from tidemark.operators.latest import latest_per_key

# fixed values: columns a merge may change; the summary keeps its volume, details keep their market
SUMMARY_UPDATES = ("market_name", "short_name", "market_url", "market_status", "total_contracts", "last_updated")
SUMMARY_INSERTS = ("market_id", *SUMMARY_UPDATES, "total_volume")
DETAIL_UPDATES = (
    "contract_name",
    "contract_status",
    "last_trade_price",
    "best_buy_yes_cost",
    "best_sell_yes_cost",
    "best_buy_no_cost",
    "best_sell_no_cost",
    "last_close_price",
    "display_order",
    "last_updated",
)
DETAIL_INSERTS = ("contract_id", "market_id", *DETAIL_UPDATES)
# what settles which of two equally new versions counts
SUMMARY_TIES = ("market_name", "short_name", "market_url", "market_status", "total_contracts")
DETAIL_TIES = ("market_id", "contract_name", "contract_status", "display_order", *DETAIL_UPDATES[2:8])
DAILY_KEYS = ("metric_date", "market_id")
DAILY_UPDATES = ("total_contracts", "total_volume", "avg_trade_price", "price_volatility")


def market_summary(raw: DataFrame, null_is_zero: bool = True, tie_breakers: tuple[ColumnLike, ...] = ()) -> DataFrame:
    """Newest snapshot per market with its number of contracts.

    ``total_volume`` is the constant 0: the feed has no traded volume.
    """
    # count the contracts first, so the arrays are not sorted and shuffled with the rows
    slim = raw.filter(F.col("market_id").isNotNull()).select(
        "market_id",
        "market_name",
        "short_name",
        "market_url",
        "market_status",
        array_length(raw, "contract_data", null_is_zero).alias("total_contracts"),
        F.lit("0.00").cast("decimal(18,2)").alias("total_volume"),
        F.col("extraction_timestamp").alias("last_updated"),
    )
    ties = tie_breakers or SUMMARY_TIES
    return latest_per_key(slim, ["market_id"], ["last_updated"], ties)


def contract_details(raw: DataFrame, tie_breakers: tuple[ColumnLike, ...] = ()) -> DataFrame:
    """Newest snapshot per contract."""
    ties = tie_breakers or DETAIL_TIES
    return latest_per_key(flatten_contracts(raw), ["contract_id"], ["last_updated"], ties)


def _contract_totals(contracts: DataFrame, unique: bool, *aggregates: Column) -> DataFrame:
    """Aggregates per market, taken before any join so map tasks combine first.

    With contract_id known to be unique (details come from ``latest_per_key``) the distinct
    count is a plain count and needs no second shuffle.
    """
    ids = F.count("contract_id") if unique else F.count_distinct("contract_id")
    return (
        contracts.filter(F.col("market_id").isNotNull())
        .groupBy("market_id")
        .agg(ids.cast("bigint").alias("_contracts"), *aggregates)
    )


def daily_metrics(
    markets: DataFrame,
    contracts: DataFrame,
    metric_date: date | ColumnLike | None = None,
    status: str | None = None,
    contracts_unique: bool = False,
) -> DataFrame:
    """Per market and day: distinct contracts, and sum, mean and deviation of prices, 0 when absent.

    ``metric_date`` is a date, an expression over the market columns, or today.
    Markets must be unique by market_id, as ``market_summary`` makes them.
    """
    price = F.col("last_trade_price")
    totals = _contract_totals(
        contracts,
        contracts_unique,
        F.sum(price).alias("_sum"),
        F.avg(price).alias("_avg"),
        F.stddev_samp(price).alias("_dev"),
    )
    chosen = markets if status is None else markets.filter(F.col("market_status") == status)
    dated = chosen.select("market_id", day(metric_date).alias("metric_date"))
    return dated.join(totals, "market_id", "left").select(
        "market_id",
        "metric_date",
        F.coalesce("_contracts", F.lit(0)).cast("bigint").alias("total_contracts"),
        F.coalesce("_sum", F.lit(0)).alias("total_volume"),
        F.coalesce("_avg", F.lit(0)).alias("avg_trade_price"),
        F.coalesce("_dev", F.lit(0.0)).alias("price_volatility"),
    )


def daily_metrics_declared(
    markets: DataFrame,
    contracts: DataFrame,
    metric_date: date | ColumnLike | None = None,
    status: str | None = "Open",
    contracts_unique: bool = False,
    dedupe: bool = False,
) -> DataFrame:
    """Per market and day: volume, mean price and number of contracts, NULL when absent.

    The volume of a market counts once per contract row, as a join of both tables gives;
    ``dedupe=True`` counts it once.
    """
    totals = _contract_totals(
        contracts, contracts_unique, F.count("*").alias("_rows"), F.avg("last_trade_price").alias("_avg")
    )
    chosen = markets if status is None else markets.filter(F.col("market_status") == status)
    dated = chosen.select("market_id", "total_volume", day(metric_date).alias("metric_date"))
    copies = F.lit(1) if dedupe else F.coalesce("_rows", F.lit(1))
    return dated.join(totals, "market_id", "left").select(
        "metric_date",
        "market_id",
        (F.col("total_volume") * copies).cast("decimal(18,2)").alias("total_volume"),
        F.col("_avg").cast("decimal(10,4)").alias("avg_last_trade_price"),
        F.coalesce("_contracts", F.lit(0)).cast("int").alias("num_active_contracts"),
    )


def market_trends(markets: DataFrame, contracts: DataFrame, contracts_unique: bool = False) -> DataFrame:
    """Per market: distinct contracts with mean, range and deviation of prices, NULL when absent."""
    price = F.col("last_trade_price")
    totals = _contract_totals(
        contracts,
        contracts_unique,
        F.avg(price).alias("avg_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.stddev_samp(price).alias("price_volatility"),
    )
    return (
        markets.select("market_id", "market_name", "market_status", "last_updated")
        .join(totals, "market_id", "left")
        .select(
            "market_id",
            "market_name",
            "market_status",
            F.coalesce("_contracts", F.lit(0)).cast("bigint").alias("total_contracts"),
            "avg_price",
            "min_price",
            "max_price",
            "price_volatility",
            "last_updated",
        )
    )
