"""Views and report queries over the analytics tables.

Every report takes DataFrames and returns one. Reports that group after joining contracts to
markets aggregate contracts per market first, so only one row per market is joined. Order by
name is made complete with an id, so equal values always give the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    ascending,
    descending,
    difference,
    hours_between,
    joined_text,
    moment,
    percent_over,
    price_change,
    price_change_pct,
    rounded,
)
from tidemark.operators.aggregate import (
    combined,
    histogram,
    keyword_category,
    moments,
    share_of_total,
    table_counts,
    top_k,
    top_k_joined,
)
from tidemark.operators.flatten import array_length

# fixed values: price buckets (upper edges and labels)
PRICE_EDGES = ("0.10", "0.20", "0.30", "0.40", "0.50", "0.60", "0.70", "0.80", "0.90")
PRICE_LABELS = (
    "$0.00 - $0.10",
    "$0.10 - $0.20",
    "$0.20 - $0.30",
    "$0.30 - $0.40",
    "$0.40 - $0.50",
    "$0.50 - $0.60",
    "$0.60 - $0.70",
    "$0.70 - $0.80",
    "$0.80 - $0.90",
    "$0.90 - $1.00",
)

# fixed values: category keywords, first match wins
CATEGORY_RULES = {
    "Elections": ("election", "vote"),
    "Trump-related": ("trump",),
    "Presidential": ("president",),
    "Congress": ("congress", "senate", "house"),
    "Supreme Court": ("supreme court", "scotus"),
    "Economics": ("economic", "market", "stock"),
    "International": ("world", "international"),
}

PRICE = "last_trade_price"


def _with_market(contracts: DataFrame, markets: DataFrame) -> DataFrame:
    """Contracts with the name of their market. AQE picks broadcast or a skew-split sort-merge join."""
    return contracts.join(markets.select("market_id", "market_name"), "market_id")


def _top_with_market(contracts: DataFrame, markets: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return top_k_joined(contracts, markets.select("market_id", "market_name"), "market_id", order, k)


def _priced(contracts: DataFrame) -> DataFrame:
    return contracts.filter(F.col(PRICE).isNotNull())


def _price_moments(contracts: DataFrame) -> DataFrame:
    """Price moments and contract counts per market."""
    return contracts.groupBy("market_id").agg(
        F.count("contract_id").alias("_ids"), F.count("*").alias("_rows"), *moments(PRICE)
    )


# --- views -----------------------------------------------------------------------------------


def active_markets(markets: DataFrame) -> DataFrame:
    kept = [c for c in markets.columns if c != "market_url"]
    return markets.filter(F.col("market_status") == "Open").select(*kept)


def top_volume_markets(markets: DataFrame, k: int = 20) -> DataFrame:
    ranked = top_k(markets, [*descending("total_volume"), *ascending("market_id")], k)
    return ranked.select("market_id", "market_name", "total_volume", "total_contracts", "last_updated")


def contract_price_movements(markets: DataFrame, contracts: DataFrame) -> DataFrame:
    open_contracts = contracts.filter(F.col("contract_status") == "Open")
    return _with_market(open_contracts, markets).select(
        "contract_id",
        "contract_name",
        "market_name",
        PRICE,
        "last_close_price",
        price_change(PRICE, "last_close_price").alias("price_change"),
        price_change_pct(PRICE, "last_close_price").alias("price_change_pct"),
        "last_updated",
    )


# --- rankings over one table -----------------------------------------------------------------


def top_markets_by_contracts(markets: DataFrame, k: int = 10, columns: tuple[str, ...] = ()) -> DataFrame:
    ranked = top_k(markets, [*descending("total_contracts"), *ascending("market_id")], k)
    return ranked.select("market_name", "total_contracts", "market_status", *columns)


def most_expensive_contracts(contracts: DataFrame, k: int = 10) -> DataFrame:
    ranked = top_k(_priced(contracts), [*descending(PRICE), *ascending("contract_id")], k)
    return ranked.select("contract_name", PRICE, "contract_status")


def cheapest_contracts(contracts: DataFrame, k: int = 10) -> DataFrame:
    ranked = top_k(contracts.filter(F.col(PRICE) > 0), ascending(PRICE, "contract_id"), k)
    return ranked.select("contract_name", PRICE, "contract_status")


def quote_imbalance(contracts: DataFrame, k: int = 10) -> DataFrame:
    both = F.col("best_buy_yes_cost") + F.col("best_buy_no_cost")
    quoted = contracts.filter(
        (F.col("contract_status") == "Open")
        & F.col("best_buy_yes_cost").isNotNull()
        & F.col("best_buy_no_cost").isNotNull()
    )
    return top_k(quoted, [*descending(both), *ascending("contract_id")], k).select(
        "contract_name",
        F.col("best_buy_yes_cost").alias("buy_yes"),
        F.col("best_buy_no_cost").alias("buy_no"),
        F.col("best_sell_yes_cost").alias("sell_yes"),
        F.col("best_sell_no_cost").alias("sell_no"),
        rounded(both, 4).alias("total_buy"),
        rounded(F.col("best_sell_yes_cost") + F.col("best_sell_no_cost"), 4).alias("total_sell"),
    )


# --- rankings of contracts with their market --------------------------------------------------


def spread_opportunities(
    markets: DataFrame, contracts: DataFrame, k: int = 10, positive_only: bool = False
) -> DataFrame:
    """Open contracts with the widest distance between sell and buy quotes."""
    buy, sell = F.col("best_buy_yes_cost"), F.col("best_sell_yes_cost")
    quoted = contracts.filter((F.col("contract_status") == "Open") & (buy > 0) & sell.isNotNull())
    if positive_only:
        quoted = quoted.filter(sell > buy)
    spread = quoted.withColumn("spread", difference(sell, buy))
    ranked = _top_with_market(spread, markets, [*descending("spread"), *ascending("contract_id")], k)
    return ranked.select(
        "contract_name",
        "market_name",
        PRICE,
        "best_buy_yes_cost",
        "best_sell_yes_cost",
        "spread",
        percent_over(sell, buy).alias("spread_pct"),
        *(["contract_status"] if positive_only else []),
    )


def expensive_contracts_with_market(markets: DataFrame, contracts: DataFrame, k: int = 10) -> DataFrame:
    order = [*descending(PRICE), *ascending("contract_id")]
    return _top_with_market(_priced(contracts), markets, order, k).select(
        "contract_name", "market_name", PRICE, "contract_status", "best_buy_yes_cost", "best_sell_yes_cost"
    )


def cheapest_contracts_with_market(markets: DataFrame, contracts: DataFrame, k: int = 10) -> DataFrame:
    order = ascending(PRICE, "contract_id")
    return _top_with_market(contracts.filter(F.col(PRICE) > 0), markets, order, k).select(
        "contract_name", "market_name", PRICE, "contract_status"
    )


# --- rankings of markets ----------------------------------------------------------------------


def volatile_markets(
    markets: DataFrame, metrics: DataFrame, k: int = 10, positive_only: bool = False, with_date: bool = False
) -> DataFrame:
    moved = metrics.filter(F.col("price_volatility").isNotNull())
    if positive_only:
        moved = moved.filter(F.col("price_volatility") > 0)
    order = [*descending("price_volatility"), *ascending("market_id", "metric_date")]
    return _top_with_market(moved, markets, order, k).select(
        "market_name",
        "price_volatility",
        "avg_trade_price",
        "total_contracts",
        *(["metric_date"] if with_date else []),
    )


def _by_market_name(markets: DataFrame, contracts: DataFrame, **outputs: str) -> DataFrame:
    """Price statistics per (market name, contract total); markets of one name and total merge."""
    per_market = _price_moments(_priced(contracts))
    named = per_market.join(markets.select("market_id", "market_name", "total_contracts"), "market_id")
    stats = combined()
    columns = [stats[kind].alias(alias) for alias, kind in outputs.items()]
    return named.groupBy("market_name", "total_contracts").agg(F.sum("_ids").alias("_ids"), *columns)


def markets_by_average_price(
    markets: DataFrame, contracts: DataFrame, k: int = 10, min_contracts: int = 3, with_spread: bool = False
) -> DataFrame:
    stats = _by_market_name(
        markets, contracts, _avg="avg", _min="min", _max="max", **({"_dev": "stddev"} if with_spread else {})
    )
    enough = stats.filter(F.col("_ids") >= min_contracts).withColumn("avg_contract_price", rounded("_avg", 4))
    ranked = top_k(
        enough, [*descending("avg_contract_price"), *ascending("market_name", "total_contracts")], k
    )
    return ranked.select(
        "market_name",
        "total_contracts",
        *([F.col("_ids").alias("num_contracts")] if with_spread else []),
        "avg_contract_price",
        rounded("_min", 4).alias("min_price"),
        rounded("_max", 4).alias("max_price"),
        *([rounded("_dev", 4).alias("price_stddev")] if with_spread else []),
    )


def most_active_markets(markets: DataFrame, contracts: DataFrame, k: int = 15) -> DataFrame:
    stats = _by_market_name(markets, contracts, _avg="avg", _sum="sum")
    ranked = top_k(stats, [*descending("_ids"), *ascending("market_name", "total_contracts")], k)
    return ranked.select(
        "market_name",
        "total_contracts",
        F.col("_ids").alias("active_contracts"),
        rounded("_avg", 4).alias("avg_price"),
        rounded("_sum", 4).alias("total_volume"),
    )


# --- distributions ----------------------------------------------------------------------------


def contract_status_breakdown(contracts: DataFrame, with_share: bool = False) -> DataFrame:
    stats = (
        rounded(F.avg(PRICE), 4).alias("avg_price"),
        rounded(F.min(PRICE), 4).alias("min_price"),
        rounded(F.max(PRICE), 4).alias("max_price"),
    )
    order = [*descending("num_contracts"), *ascending("contract_status")]
    shares = share_of_total(contracts, ["contract_status"], "num_contracts", "percentage", stats, few_groups=True)
    return (shares if with_share else shares.drop("percentage")).orderBy(*order)


def price_distribution(contracts: DataFrame) -> DataFrame:
    return histogram(contracts, PRICE, PRICE_EDGES, PRICE_LABELS, "price_range", "num_contracts").orderBy(
        "price_range"
    )


def contracts_per_market(markets: DataFrame, k: int = 20) -> DataFrame:
    shares = share_of_total(
        markets.withColumnRenamed("total_contracts", "contracts_per_market"),
        ["contracts_per_market"],
        "num_markets",
        "percentage_of_markets",
    )
    return top_k(shares, descending("contracts_per_market"), k)


def market_status_distribution(markets: DataFrame) -> DataFrame:
    slots = F.sum("total_contracts").cast("bigint").alias("total_contracts")
    return share_of_total(markets, ["market_status"], "num_markets", "percentage", (slots,), few_groups=True).orderBy(
        *descending("num_markets"), *ascending("market_status")
    )


def market_categories(
    markets: DataFrame, text: str = "market_name", rules: Mapping[str, tuple[str, ...]] = CATEGORY_RULES
) -> DataFrame:
    aggregates = (
        F.count("*").alias("num_markets"),
        F.sum("total_contracts").cast("bigint").alias("total_contracts"),
        rounded(F.avg("total_contracts"), 2).alias("avg_contracts_per_market"),
    )
    return keyword_category(markets, text, rules, aggregates).orderBy(
        *descending("num_markets"), *ascending("category")
    )


# --- overall ----------------------------------------------------------------------------------


def overall_statistics(
    markets: DataFrame, contracts: DataFrame, label: str | None = None, dedupe: bool = False
) -> DataFrame:
    """One row over all markets and their contracts.

    Contract slots count once per contract row of a market, as a left join of both tables
    gives; ``dedupe=True`` counts them once per market.
    """
    per_market = _price_moments(contracts.filter(F.col("market_id").isNotNull()))
    joined = markets.select("market_id", "total_contracts").join(per_market, "market_id", "left")
    stats = combined()
    copies = F.lit(1) if dedupe else F.coalesce("_rows", F.lit(1))
    return joined.agg(
        F.count_distinct("market_id").alias("total_markets"),
        F.sum(F.col("total_contracts") * copies).cast("bigint").alias("total_contract_slots"),
        F.coalesce(F.sum("_ids"), F.lit(0)).cast("bigint").alias("actual_contracts"),
        rounded(stats["avg"], 4).alias("overall_avg_price"),
        rounded(stats["min"], 4).alias("lowest_price"),
        rounded(stats["max"], 4).alias("highest_price"),
        rounded(stats["stddev"], 4).alias("price_stddev"),
    ).select(*([F.lit(label).alias("metric_type")] if label else []), "*")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return table_counts(tables)


def data_freshness(table: DataFrame, ts: str = "last_updated", as_of: datetime | Column | None = None) -> DataFrame:
    """Newest timestamp and the hour boundaries passed since."""
    latest = table.agg(F.max(ts).alias("latest_data_timestamp"))
    return latest.select(
        F.lit("Data Freshness").alias("check_type"),
        "latest_data_timestamp",
        hours_between("latest_data_timestamp", moment(as_of)).alias("hours_since_update"),
    )


def daily_trend(metrics: DataFrame) -> DataFrame:
    """Time series over metric dates: size, mean of market means, mean volatility."""
    return (
        metrics.groupBy("metric_date")
        .agg(
            F.count("*").alias("num_markets"),
            F.sum("total_contracts").cast("bigint").alias("total_contracts"),
            F.sum("total_volume").alias("total_volume"),
            rounded(F.avg("avg_trade_price"), 4).alias("avg_trade_price"),
            rounded(F.avg(F.col("price_volatility").cast("decimal(18,8)")), 4).alias("avg_volatility"),
        )
        .orderBy("metric_date")
    )


def summary_line(contracts: DataFrame) -> DataFrame:
    """One sentence with the number of markets, contracts and the mean price."""
    numbers = contracts.agg(
        F.count_distinct("market_id").alias("markets"),
        F.count("*").alias("contracts"),
        F.round(F.avg(PRICE).cast("decimal(18,8)"), 2).cast("decimal(18,2)").alias("price"),
    )
    return numbers.select(
        joined_text(
            F.lit("Total Markets Analyzed: "),
            "markets",
            F.lit(" | Total Contracts: "),
            "contracts",
            F.lit(" | Avg Price: $"),
            "price",
        ).alias("summary")
    )


def sample_rows(table: DataFrame, key: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by key, so a sample is the same in every run."""
    return top_k(table, ascending(*key), n)


def raw_sample(raw: DataFrame, n: int = 10) -> DataFrame:
    """A few raw rows with the length of their contract array."""
    first = top_k(raw, ascending("market_id", "extraction_timestamp"), n)
    return first.select(
        "market_id",
        "market_name",
        "short_name",
        "market_status",
        array_length(first, "contract_data").alias("num_contracts"),
        "extraction_timestamp",
    )
