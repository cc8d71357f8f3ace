"""Views V1-V3 and reports Q1-Q30 over the lens, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.bindings import lens
from tidemark.bindings.lens import ALL_TABLES_SQL, DOCUMENTS_SQL, TABLES_SQL
from tidemark.bindings.registry import big, date_text, dbl, query, rnd, ts
from tidemark.plans import reports
from tidemark.sources.tables import row_count

M = lens.markets
C = lens.contracts
D = lens.metrics


def _both(report, **options):
    return lambda spark, sf: report(M(spark, sf), C(spark, sf), **options)


@query(
    "v1_active_markets",
    TABLES_SQL
    + f"""SELECT market_id, market_name, short_name, market_status, total_contracts,
       {dbl('total_volume')} AS total_volume, {ts('last_updated')} AS last_updated
FROM markets WHERE market_status = 'Open'""",
)
def _(spark, sf):
    return reports.active_markets(M(spark, sf))


@query(
    "v2_top_volume_markets",
    TABLES_SQL
    + f"""SELECT market_id, market_name, {dbl('total_volume')} AS total_volume, total_contracts,
       {ts('last_updated')} AS last_updated
FROM markets ORDER BY markets.total_volume DESC NULLS FIRST, market_id LIMIT 20""",
)
def _(spark, sf):
    return reports.top_volume_markets(M(spark, sf))


@query(
    "v3_contract_price_movements",
    TABLES_SQL
    + f"""SELECT contract_id, contract_name, market_name, {dbl('last_trade_price')} AS last_trade_price,
       {dbl('last_close_price')} AS last_close_price,
       {dbl('last_trade_price - last_close_price')} AS price_change,
       CASE WHEN last_close_price > 0
            THEN {rnd('CAST(last_trade_price - last_close_price AS DOUBLE) / CAST(last_close_price AS DOUBLE) * 100', 4)}
            ELSE 0 END AS price_change_pct,
       {ts('c.last_updated')} AS last_updated
FROM contracts c JOIN markets m USING (market_id) WHERE contract_status = 'Open'""",
)
def _(spark, sf):
    moves = reports.contract_price_movements(M(spark, sf), C(spark, sf))
    return moves.withColumn("price_change_pct", reports.rounded("price_change_pct", 4))


@query(
    "q01_top_markets_by_contracts",
    TABLES_SQL
    + """SELECT market_name, total_contracts, market_status FROM markets
ORDER BY total_contracts DESC NULLS FIRST, market_id LIMIT 10""",
)
def _(spark, sf):
    return reports.top_markets_by_contracts(M(spark, sf))


@query(
    "q02_most_expensive_contracts",
    TABLES_SQL
    + f"""SELECT contract_name, {dbl('last_trade_price')} AS last_trade_price, contract_status FROM contracts
WHERE contracts.last_trade_price IS NOT NULL ORDER BY contracts.last_trade_price DESC, contract_id LIMIT 10""",
)
def _(spark, sf):
    return reports.most_expensive_contracts(C(spark, sf))


@query(
    "q03_cheapest_contracts",
    TABLES_SQL
    + f"""SELECT contract_name, {dbl('last_trade_price')} AS last_trade_price, contract_status FROM contracts
WHERE contracts.last_trade_price > 0 ORDER BY contracts.last_trade_price, contract_id LIMIT 10""",
)
def _(spark, sf):
    return reports.cheapest_contracts(C(spark, sf))


_SPREAD = f"""SELECT contract_name, market_name, {dbl('last_trade_price')} AS last_trade_price,
       {dbl('best_buy_yes_cost')} AS best_buy_yes_cost, {dbl('best_sell_yes_cost')} AS best_sell_yes_cost,
       {rnd('best_sell_yes_cost - best_buy_yes_cost', 4)} AS spread,
       {rnd('CAST(best_sell_yes_cost - best_buy_yes_cost AS DOUBLE) / CAST(NULLIF(best_buy_yes_cost, 0) AS DOUBLE) * 100', 2)} AS spread_pct"""


@query(
    "q04_best_spreads",
    TABLES_SQL
    + _SPREAD
    + """
FROM contracts c JOIN markets m USING (market_id)
WHERE contract_status = 'Open' AND c.best_buy_yes_cost > 0 AND c.best_sell_yes_cost IS NOT NULL
ORDER BY spread DESC NULLS FIRST, contract_id LIMIT 10""",
)
def _(spark, sf):
    return reports.spread_opportunities(M(spark, sf), C(spark, sf))


@query(
    "q05_volatile_markets",
    ALL_TABLES_SQL
    + f"""SELECT market_name, {rnd('price_volatility', 6)} AS price_volatility,
       {rnd('avg_trade_price', 6)} AS avg_trade_price, x.total_contracts
FROM metrics x JOIN markets m USING (market_id) WHERE x.price_volatility IS NOT NULL
ORDER BY {rnd('x.price_volatility', 6)} DESC, market_id, metric_date LIMIT 10""",
)
def _(spark, sf):
    return reports.volatile_markets(M(spark, sf), _rounded_metrics(spark, sf))


def _rounded_metrics(spark, sf):
    """Metrics to 6 digits, where the deviation of every engine agrees."""
    return (
        D(spark, sf)
        .withColumn("price_volatility", reports.rounded("price_volatility", 6))
        .withColumn("avg_trade_price", reports.rounded("avg_trade_price", 6))
    )


_STATUS = f"""SELECT contract_status, COUNT(*) AS num_contracts,
       {rnd('AVG(last_trade_price)', 4)} AS avg_price, {rnd('MIN(last_trade_price)', 4)} AS min_price,
       {rnd('MAX(last_trade_price)', 4)} AS max_price"""


@query("q06_contract_status_breakdown", TABLES_SQL + _STATUS + " FROM contracts GROUP BY contract_status")
def _(spark, sf):
    return reports.contract_status_breakdown(C(spark, sf))


# bucket by arithmetic rather than by a list of cases: an independent way to the same labels
def prices_sql(column: str) -> str:
    return (
        TABLES_SQL
        + f""", b AS (SELECT LEAST(GREATEST(CAST(FLOOR({column} * 10) AS INTEGER), 0), 9) AS i
  FROM contracts WHERE {column} IS NOT NULL)
SELECT printf('$%.2f - $%.2f', i / 10.0, (i + 1) / 10.0) AS price_range, COUNT(*) AS num_contracts,
       {rnd('COUNT(*) * 100.0 / (SELECT COUNT(*) FROM b)', 2)} AS percentage
FROM b GROUP BY i"""
    )


@query("q07_price_distribution", prices_sql("last_trade_price"))
def _(spark, sf):
    return reports.price_distribution(C(spark, sf))


_BY_AVG = f"""FROM contracts c JOIN markets m USING (market_id) WHERE last_trade_price IS NOT NULL
GROUP BY market_name, m.total_contracts HAVING COUNT(*) >= 3
ORDER BY avg_contract_price DESC, market_name, m.total_contracts"""


@query(
    "q08_markets_by_average_price",
    TABLES_SQL
    + f"""SELECT market_name, m.total_contracts, {rnd('AVG(last_trade_price)', 4)} AS avg_contract_price,
       {rnd('MIN(last_trade_price)', 4)} AS min_price, {rnd('MAX(last_trade_price)', 4)} AS max_price
{_BY_AVG} LIMIT 10""",
)
def _(spark, sf):
    return reports.markets_by_average_price(M(spark, sf), C(spark, sf))


_OVERALL = f"""COUNT(DISTINCT m.market_id) AS total_markets, {big('SUM(m.total_contracts)')} AS total_contract_slots,
       COUNT(c.contract_id) AS actual_contracts, {rnd('AVG(c.last_trade_price)', 4)} AS overall_avg_price,
       {rnd('MIN(c.last_trade_price)', 4)} AS lowest_price, {rnd('MAX(c.last_trade_price)', 4)} AS highest_price,
       {rnd('STDDEV_SAMP(CAST(c.last_trade_price AS DOUBLE))', 4)} AS price_stddev
FROM markets m LEFT JOIN contracts c USING (market_id)"""


@query("q09_overall_statistics", TABLES_SQL + "SELECT " + _OVERALL)
def _(spark, sf):
    return reports.overall_statistics(M(spark, sf), C(spark, sf))


@query(
    "q09b_overall_statistics_deduped",
    TABLES_SQL
    + f"""SELECT (SELECT COUNT(*) FROM markets) AS total_markets,
       {big('(SELECT SUM(total_contracts) FROM markets)')} AS total_contract_slots,
       COUNT(*) AS actual_contracts, {rnd('AVG(last_trade_price)', 4)} AS overall_avg_price,
       {rnd('MIN(last_trade_price)', 4)} AS lowest_price, {rnd('MAX(last_trade_price)', 4)} AS highest_price,
       {rnd('STDDEV_SAMP(CAST(last_trade_price AS DOUBLE))', 4)} AS price_stddev
FROM contracts WHERE market_id IN (SELECT market_id FROM markets)""",
)
def _(spark, sf):
    return reports.overall_statistics(M(spark, sf), C(spark, sf), dedupe=True)


@query("q10_overall_statistics_labelled", TABLES_SQL + "SELECT 'Overall Statistics' AS metric_type, " + _OVERALL)
def _(spark, sf):
    return reports.overall_statistics(M(spark, sf), C(spark, sf), label="Overall Statistics")


@query(
    "q11_table_row_counts",
    """SELECT 'market_summary' AS table_name, (SELECT COUNT(*) FROM orders) AS row_count
UNION ALL SELECT 'contract_details', (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
UNION ALL SELECT 'daily_market_metrics', (SELECT COUNT(*) FROM orders)
UNION ALL SELECT 'raw', (SELECT 2 * COUNT(*) FROM lineitem)""",
)
def _(spark, sf):
    return reports.row_counts(
        {
            "market_summary": M(spark, sf),
            "contract_details": C(spark, sf),
            "daily_market_metrics": D(spark, sf),
            "raw": lens.raw(spark, sf),
        }
    )


@query(
    "q12_data_freshness",
    TABLES_SQL
    + f"""SELECT 'Data Freshness' AS check_type, {ts('MAX(last_updated)')} AS latest_data_timestamp,
       date_diff('hour', MAX(last_updated), (SELECT MAX(ts) FROM events)) AS hours_since_update FROM markets""",
)
def _(spark, sf):
    now = lens.table(spark, sf, "events").agg(F.max("ts")).scalar()
    return reports.data_freshness(M(spark, sf), as_of=now)


@query(
    "q13_top_markets_with_short_name",
    TABLES_SQL
    + """SELECT market_name, total_contracts, market_status, short_name FROM markets
ORDER BY total_contracts DESC NULLS FIRST, market_id LIMIT 15""",
)
def _(spark, sf):
    return reports.top_markets_by_contracts(M(spark, sf), 15, ("short_name",))


@query(
    "q14_most_active_markets",
    TABLES_SQL
    + f"""SELECT market_name, m.total_contracts, COUNT(contract_id) AS active_contracts,
       {rnd('AVG(last_trade_price)', 4)} AS avg_price, {rnd('SUM(last_trade_price)', 4)} AS total_volume
FROM contracts c JOIN markets m USING (market_id) WHERE last_trade_price IS NOT NULL
GROUP BY market_name, m.total_contracts
ORDER BY active_contracts DESC, market_name, m.total_contracts LIMIT 15""",
)
def _(spark, sf):
    return reports.most_active_markets(M(spark, sf), C(spark, sf))


@query(
    "q15_expensive_contracts_with_market",
    TABLES_SQL
    + f"""SELECT contract_name, market_name, {dbl('last_trade_price')} AS last_trade_price, contract_status,
       {dbl('best_buy_yes_cost')} AS best_buy_yes_cost, {dbl('best_sell_yes_cost')} AS best_sell_yes_cost
FROM contracts c JOIN markets m USING (market_id) WHERE c.last_trade_price IS NOT NULL
ORDER BY c.last_trade_price DESC, contract_id LIMIT 10""",
)
def _(spark, sf):
    return reports.expensive_contracts_with_market(M(spark, sf), C(spark, sf))


@query(
    "q16_cheapest_contracts_with_market",
    TABLES_SQL
    + f"""SELECT contract_name, market_name, {dbl('last_trade_price')} AS last_trade_price, contract_status
FROM contracts c JOIN markets m USING (market_id) WHERE c.last_trade_price > 0
ORDER BY c.last_trade_price, contract_id LIMIT 10""",
)
def _(spark, sf):
    return reports.cheapest_contracts_with_market(M(spark, sf), C(spark, sf))


@query(
    "q17_contract_status_shares",
    TABLES_SQL
    + _STATUS
    + f""", {rnd('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()', 2)} AS percentage
FROM contracts GROUP BY contract_status""",
)
def _(spark, sf):
    return reports.contract_status_breakdown(C(spark, sf), with_share=True)


@query("q18_price_ranges", prices_sql("last_trade_price"))
def _(spark, sf):
    return reports.price_distribution(C(spark, sf))


@query(
    "q19_positive_spreads",
    TABLES_SQL
    + _SPREAD
    + """, contract_status
FROM contracts c JOIN markets m USING (market_id)
WHERE contract_status = 'Open' AND c.best_buy_yes_cost > 0 AND c.best_sell_yes_cost > c.best_buy_yes_cost
ORDER BY spread DESC NULLS FIRST, contract_id LIMIT 15""",
)
def _(spark, sf):
    return reports.spread_opportunities(M(spark, sf), C(spark, sf), 15, positive_only=True)


@query(
    "q20_quote_imbalance",
    TABLES_SQL
    + f"""SELECT contract_name, {dbl('best_buy_yes_cost')} AS buy_yes, {dbl('best_buy_no_cost')} AS buy_no,
       {dbl('best_sell_yes_cost')} AS sell_yes, {dbl('best_sell_no_cost')} AS sell_no,
       {rnd('best_buy_yes_cost + best_buy_no_cost', 4)} AS total_buy,
       {rnd('best_sell_yes_cost + best_sell_no_cost', 4)} AS total_sell
FROM contracts WHERE contract_status = 'Open' AND best_buy_yes_cost IS NOT NULL AND best_buy_no_cost IS NOT NULL
ORDER BY best_buy_yes_cost + best_buy_no_cost DESC, contract_id LIMIT 10""",
)
def _(spark, sf):
    return reports.quote_imbalance(C(spark, sf))


@query(
    "q21_volatile_markets_dated",
    ALL_TABLES_SQL
    + f"""SELECT market_name, {rnd('price_volatility', 6)} AS price_volatility,
       {rnd('avg_trade_price', 6)} AS avg_trade_price, x.total_contracts, {date_text('metric_date')} AS metric_date
FROM metrics x JOIN markets m USING (market_id) WHERE x.price_volatility > 0
ORDER BY {rnd('x.price_volatility', 6)} DESC, market_id, x.metric_date LIMIT 15""",
)
def _(spark, sf):
    return reports.volatile_markets(M(spark, sf), _rounded_metrics(spark, sf), 15, positive_only=True, with_date=True)


@query(
    "q22_average_price_with_spread",
    TABLES_SQL
    + f"""SELECT market_name, m.total_contracts, COUNT(contract_id) AS num_contracts,
       {rnd('AVG(last_trade_price)', 4)} AS avg_contract_price,
       {rnd('MIN(last_trade_price)', 4)} AS min_price, {rnd('MAX(last_trade_price)', 4)} AS max_price,
       {rnd('STDDEV_SAMP(CAST(last_trade_price AS DOUBLE))', 4)} AS price_stddev
{_BY_AVG} LIMIT 15""",
)
def _(spark, sf):
    return reports.markets_by_average_price(M(spark, sf), C(spark, sf), 15, with_spread=True)


@query(
    "q23_contracts_per_market",
    TABLES_SQL
    + f"""SELECT total_contracts AS contracts_per_market, COUNT(*) AS num_markets,
       {rnd('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()', 2)} AS percentage_of_markets
FROM markets GROUP BY total_contracts ORDER BY total_contracts DESC NULLS FIRST LIMIT 20""",
)
def _(spark, sf):
    return reports.contracts_per_market(M(spark, sf))


@query(
    "q24_market_status_distribution",
    TABLES_SQL
    + f"""SELECT market_status, COUNT(*) AS num_markets,
       {rnd('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()', 2)} AS percentage,
       {big('SUM(total_contracts)')} AS total_contracts
FROM markets GROUP BY market_status""",
)
def _(spark, sf):
    return reports.market_status_distribution(M(spark, sf))


@query(
    "q25_daily_trend",
    ALL_TABLES_SQL
    + f"""SELECT {date_text('metric_date')} AS metric_date, COUNT(*) AS num_markets,
       {big('SUM(total_contracts)')} AS total_contracts, {dbl('SUM(total_volume)')} AS total_volume,
       {rnd('AVG(CAST(avg_trade_price AS DECIMAL(18,8)))', 4)} AS avg_trade_price,
       {rnd('AVG(CAST(price_volatility AS DECIMAL(18,8)))', 4)} AS avg_volatility
FROM metrics GROUP BY metrics.metric_date""",
)
def _(spark, sf):
    return reports.daily_trend(D(spark, sf))


def category_sql(text: str) -> str:
    """Written by hand, so that a wrong rule of the library shows. Labels and words, in order."""
    return f"""CASE WHEN lower({text}) LIKE '%election%' OR lower({text}) LIKE '%vote%' THEN 'Elections'
  WHEN lower({text}) LIKE '%trump%' THEN 'Trump-related'
  WHEN lower({text}) LIKE '%president%' THEN 'Presidential'
  WHEN lower({text}) LIKE '%congress%' OR lower({text}) LIKE '%senate%' OR lower({text}) LIKE '%house%' THEN 'Congress'
  WHEN lower({text}) LIKE '%supreme court%' OR lower({text}) LIKE '%scotus%' THEN 'Supreme Court'
  WHEN lower({text}) LIKE '%economic%' OR lower({text}) LIKE '%market%' OR lower({text}) LIKE '%stock%' THEN 'Economics'
  WHEN lower({text}) LIKE '%world%' OR lower({text}) LIKE '%international%' THEN 'International'
  ELSE 'Other' END"""


@query(
    "q26_market_categories",
    TABLES_SQL
    + f"""SELECT {category_sql('market_name')} AS category, COUNT(*) AS num_markets,
       {big('SUM(total_contracts)')} AS total_contracts,
       {rnd('AVG(total_contracts)', 2)} AS avg_contracts_per_market
FROM markets GROUP BY 1""",
)
def _(spark, sf):
    return reports.market_categories(M(spark, sf))


@query(
    "q27_summary_line",
    TABLES_SQL
    + """SELECT 'Total Markets Analyzed: ' || COUNT(DISTINCT market_id) || ' | Total Contracts: ' || COUNT(*)
       || ' | Avg Price: $' || CAST(ROUND(CAST(AVG(last_trade_price) AS DECIMAL(18,8)), 2) AS DECIMAL(18,2)) AS summary
FROM contracts""",
)
def _(spark, sf):
    return reports.summary_line(C(spark, sf))


@query("q28_daily_metrics_count", "SELECT COUNT(*) AS row_count FROM orders")
def _(spark, sf):
    return row_count(D(spark, sf))


@query(
    "q28b_daily_metrics_sample",
    ALL_TABLES_SQL
    + f"""SELECT market_id, {date_text('metric_date')} AS metric_date, total_contracts,
       {dbl('total_volume')} AS total_volume, {rnd('avg_trade_price', 6)} AS avg_trade_price,
       {rnd('price_volatility', 6)} AS price_volatility
FROM metrics ORDER BY market_id LIMIT 10""",
)
def _(spark, sf):
    return reports.sample_rows(_rounded_metrics(spark, sf), ["market_id", "metric_date"], 10)


@query(
    "q29_raw_sample",
    DOCUMENTS_SQL
    + f"""SELECT market_id, market_name, short_name, market_status, {big('COALESCE(n_contracts, 0)')} AS num_contracts,
       {ts('extraction_timestamp')} AS extraction_timestamp
FROM raw ORDER BY market_id NULLS LAST, raw.extraction_timestamp NULLS LAST LIMIT 10""",
)
def _(spark, sf):
    return reports.raw_sample(lens.raw(spark, sf))


@query("q30_loaded_rows", "SELECT COUNT(*) AS files_loaded, 2 * COUNT(*) AS loaded_rows FROM lineitem")
def _(spark, sf):
    documents = lens.documents(spark, sf)
    return documents.agg(
        F.count("*").alias("files_loaded"), F.sum(F.size("data.markets")).cast("bigint").alias("loaded_rows")
    )
