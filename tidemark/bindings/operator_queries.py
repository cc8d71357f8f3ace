"""Aggregate jobs, window operators, merges and composite operators over the lens."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.bindings import lens
from tidemark.bindings.lens import (
    ALL_TABLES_SQL,
    CONTRACTS_SQL,
    DOCUMENTS_SQL,
    MARKETS_SQL,
    RAW_CONTRACTS_SQL,
    RAW_SQL,
    SUMMARY_SQL,
    TABLES_SQL,
)
from tidemark.bindings.registry import big, date_text, dbl, query, rnd, ts
from tidemark.functions.columns import keyword_label, percent_over, rounded
from tidemark.operators import aggregate, flatten, latest, merge
from tidemark.plans import model, reports

SUMMARY_OUT = f"""market_id, market_name, short_name, market_url, market_status, total_contracts,
       {dbl('total_volume')} AS total_volume, {ts('last_updated')} AS last_updated"""
PRICES_OUT = ", ".join(
    f"{dbl(c)} AS {c}"
    for c in (
        "last_trade_price",
        "best_buy_yes_cost",
        "best_sell_yes_cost",
        "best_buy_no_cost",
        "best_sell_no_cost",
        "last_close_price",
    )
)
DETAILS_OUT = f"""contract_id, market_id, contract_name, contract_status, {PRICES_OUT},
       {big('display_order')} AS display_order, {ts('last_updated')} AS last_updated"""


def events(spark, sf):
    return lens.table(spark, sf, "events")


# --- aggregate jobs ---------------------------------------------------------------------------


@query("a1_market_summary", f"WITH {RAW_SQL}, {SUMMARY_SQL} SELECT {SUMMARY_OUT} FROM summary")
def _(spark, sf):
    return model.market_summary(lens.raw(spark, sf))


@query(
    "a1b_market_summary_null_sizes",
    f"""WITH {RAW_SQL}, s AS (
  SELECT *, row_number() OVER (PARTITION BY market_id ORDER BY extraction_timestamp DESC NULLS FIRST,
    market_name, short_name, market_url, market_status, n_contracts NULLS LAST) AS rn FROM raw)
SELECT market_id, market_status, {big('n_contracts')} AS total_contracts FROM s WHERE rn = 1""",
)
def _(spark, sf):
    summary = model.market_summary(lens.raw(spark, sf), null_is_zero=False)
    return summary.select("market_id", "market_status", "total_contracts")


_METRICS_OUT = f"""{dbl('total_volume')} AS total_volume, {rnd('avg_trade_price', 6)} AS avg_trade_price,
       {rnd('price_volatility', 6)} AS price_volatility"""


def _six_digits(df, *names):
    for name in names:
        df = df.withColumn(name, rounded(name, 6))
    return df


@query(
    "a2_daily_metrics",
    ALL_TABLES_SQL
    + f"""SELECT market_id, '2001-12-31' AS metric_date, total_contracts, {_METRICS_OUT}
FROM metrics WHERE market_id IN (SELECT market_id FROM markets WHERE market_status = 'Unknown')""",
)
def _(spark, sf):
    metrics = model.daily_metrics(
        lens.markets(spark, sf), lens.contracts(spark, sf), date(2001, 12, 31), status="Unknown", contracts_unique=True
    )
    return _six_digits(metrics, "avg_trade_price", "price_volatility")


@query(
    "a2b_daily_metrics_from_versions",
    f"""WITH {MARKETS_SQL}, versions AS (SELECT l_orderkey AS market_id, l_orderkey * 10 + l_linenumber AS contract_id,
  CASE WHEN NOT (l_returnflag = 'R' AND l_quantity < 5)
       THEN CAST(CAST(l_discount AS DECIMAL(10,4)) * 10 AS DECIMAL(10,4)) END AS price FROM lineitem)
SELECT m.market_id, {date_text('MAX(m.last_updated)')} AS metric_date, COUNT(DISTINCT contract_id) AS total_contracts,
       {dbl('COALESCE(SUM(price), 0)')} AS total_volume, {rnd('COALESCE(AVG(price), 0)', 6)} AS avg_trade_price,
       {rnd('COALESCE(STDDEV_SAMP(CAST(price AS DOUBLE)), 0)', 6)} AS price_volatility
FROM markets m LEFT JOIN versions v USING (market_id) GROUP BY m.market_id""",
)
def _(spark, sf):
    """Contracts with several versions each: the distinct count matters."""
    versions = lens.contract_versions(lens.table(spark, sf, "lineitem"))
    metrics = model.daily_metrics(lens.markets(spark, sf), versions, F.col("last_updated"))
    return _six_digits(metrics, "avg_trade_price", "price_volatility")


def _declared_sql(volume: str) -> str:
    return (
        TABLES_SQL
        + f"""SELECT '2001-12-31' AS metric_date, m.market_id, {dbl(f'{volume}(m.total_volume)')} AS total_volume,
       {rnd('AVG(c.last_trade_price)', 4)} AS avg_last_trade_price,
       COUNT(DISTINCT c.contract_id) AS num_active_contracts
FROM markets m LEFT JOIN contracts c USING (market_id) WHERE market_status = 'Open' GROUP BY m.market_id"""
    )


@query("a3_daily_metrics_declared", _declared_sql("SUM"))
def _(spark, sf):
    return model.daily_metrics_declared(
        lens.markets(spark, sf), lens.contracts(spark, sf), date(2001, 12, 31), contracts_unique=True
    )


@query("a3b_daily_metrics_declared_deduped", _declared_sql("MAX"))
def _(spark, sf):
    return model.daily_metrics_declared(
        lens.markets(spark, sf), lens.contracts(spark, sf), date(2001, 12, 31), contracts_unique=True, dedupe=True
    )


_TRENDS_SQL = (
    TABLES_SQL
    + f"""SELECT m.market_id, market_name, market_status, COUNT(DISTINCT c.contract_id) AS total_contracts,
       {rnd('AVG(c.last_trade_price)', 6)} AS avg_price, {dbl('MIN(c.last_trade_price)')} AS min_price,
       {dbl('MAX(c.last_trade_price)')} AS max_price,
       {rnd('STDDEV_SAMP(CAST(c.last_trade_price AS DOUBLE))', 6)} AS price_volatility,
       {ts('m.last_updated')} AS last_updated
FROM markets m LEFT JOIN contracts c USING (market_id)
GROUP BY m.market_id, market_name, market_status, m.last_updated"""
)


def trends(spark, sf):
    frame = model.market_trends(lens.markets(spark, sf), lens.contracts(spark, sf), contracts_unique=True)
    return _six_digits(frame, "avg_price", "price_volatility")


@query("a4_market_trends", _TRENDS_SQL)
def _(spark, sf):
    return trends(spark, sf)


# fixed values: value buckets of events
_EVENT_EDGES = ("1", "2.5", "5", "10", "20")
_EVENT_LABELS = ("under 1", "1 to 2.5", "2.5 to 5", "5 to 10", "10 to 20", "20 and more")


@query(
    "a5_histogram",
    f"""WITH e AS (SELECT CAST(value AS DECIMAL(10,4)) AS v FROM events WHERE value IS NOT NULL),
b AS (SELECT CASE WHEN v >= 20 THEN '20 and more' WHEN v >= 10 THEN '10 to 20' WHEN v >= 5 THEN '5 to 10'
  WHEN v >= 2.5 THEN '2.5 to 5' WHEN v >= 1 THEN '1 to 2.5' ELSE 'under 1' END AS bucket FROM e)
SELECT bucket, COUNT(*) AS rows, {rnd('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()', 2)} AS percentage
FROM b GROUP BY bucket""",
)
def _(spark, sf):
    values = events(spark, sf).select(F.col("value").cast("decimal(10,4)").alias("value"))
    return aggregate.histogram(values, "value", _EVENT_EDGES, _EVENT_LABELS)


# fixed values: keyword rules for whole document texts
_TEXT_RULES = {"Contact": ("@", "phone"), "Licence": ("license", "copyright"), "French": (" le ", " la "), "Web": ("http",)}


@query(
    "a6_keyword_categories",
    f"""SELECT CASE WHEN contains(lower(text), '@') OR contains(lower(text), 'phone') THEN 'Contact'
  WHEN regexp_matches(lower(text), 'license|copyright') THEN 'Licence'
  WHEN regexp_matches(lower(text), ' le | la ') THEN 'French'
  WHEN contains(lower(text), 'http') THEN 'Web' ELSE 'Other' END AS category,
  COUNT(*) AS num_documents, {big('SUM(n_chars)')} AS chars
FROM documents GROUP BY 1""",
)
def _(spark, sf):
    aggregates = (F.count("*").alias("num_documents"), F.sum("n_chars").alias("chars"))
    return aggregate.keyword_category(lens.table(spark, sf, "documents"), "text", _TEXT_RULES, aggregates)


# --- windows ----------------------------------------------------------------------------------


@query(
    "w1_latest_market",
    f"""WITH {RAW_SQL}
SELECT market_id, arg_max(market_status, (extraction_timestamp, -rk)) AS market_status,
       {ts('MAX(extraction_timestamp)')} AS last_updated
FROM (SELECT *, dense_rank() OVER (ORDER BY market_name, short_name, market_url, market_status) AS rk FROM raw)
GROUP BY market_id""",
)
def _(spark, sf):
    newest = latest.latest_per_key(
        lens.raw(spark, sf),
        ["market_id"],
        ["extraction_timestamp"],
        ["market_name", "short_name", "market_url", "market_status"],
    )
    return newest.select("market_id", "market_status", F.col("extraction_timestamp").alias("last_updated"))


@query("w2_latest_contract", DOCUMENTS_SQL + f"SELECT {DETAILS_OUT} FROM details")
def _(spark, sf):
    return model.contract_details(lens.raw(spark, sf))


@query("w2b_latest_contract_from_variant", DOCUMENTS_SQL + f"SELECT {DETAILS_OUT} FROM details")
def _(spark, sf):
    return model.contract_details(lens.raw_variant(spark, sf))


@query(
    "w3_share_of_total",
    f"""SELECT user_id, COUNT(*) AS events, {rnd('COUNT(*) * 100.0 / (SELECT COUNT(*) FROM events)', 2)} AS share
FROM events GROUP BY user_id""",
)
def _(spark, sf):
    return aggregate.share_of_total(events(spark, sf), ["user_id"], "events", "share", few_groups=False)


# --- merges -----------------------------------------------------------------------------------

_OLD, _NEW = datetime(1999, 7, 1), datetime(1998, 1, 1)
_BEFORE, _FROM = "TIMESTAMP '1999-07-01'", "TIMESTAMP '1998-01-01'"


def _renewed(markets):
    """Newer versions of markets: every attribute differs."""
    return markets.filter(F.col("last_updated") >= F.lit(_NEW)).select(
        "market_id",
        F.concat("market_name", F.lit(" v2")).alias("market_name"),
        F.upper("short_name").alias("short_name"),
        F.concat("market_url", F.lit("?v=2")).alias("market_url"),
        F.lit("Renewed").alias("market_status"),
        (F.col("total_contracts") + 1).alias("total_contracts"),
        (F.col("total_volume") * 2).cast("decimal(18,2)").alias("total_volume"),
        F.date_add("last_updated", 1).cast("timestamp_ntz").alias("last_updated"),
    )


MERGED_SUMMARY_SQL = f"""WITH {MARKETS_SQL},
t AS (SELECT * FROM markets WHERE last_updated < {_BEFORE}),
s AS (SELECT market_id, market_name || ' v2' AS market_name, upper(short_name) AS short_name,
  market_url || '?v=2' AS market_url, 'Renewed' AS market_status, total_contracts + 1 AS total_contracts,
  total_volume * 2 AS total_volume, last_updated + INTERVAL 1 DAY AS last_updated
  FROM markets WHERE last_updated >= {_FROM}),
merged AS (
  SELECT market_id, s.market_name, s.short_name, s.market_url, s.market_status, s.total_contracts,
         COALESCE(t.total_volume, s.total_volume) AS total_volume, s.last_updated
  FROM s LEFT JOIN t USING (market_id)
  UNION ALL
  SELECT * FROM t WHERE market_id NOT IN (SELECT market_id FROM s))"""


def merge_sides(spark, sf):
    """Target and source of the summary merges."""
    markets = lens.markets(spark, sf)
    return markets.filter(F.col("last_updated") < F.lit(_OLD)), _renewed(markets)


def _merge_summary(spark, sf, **options):
    target, source = merge_sides(spark, sf)
    return merge.merge_upsert(target, source, ["market_id"], model.SUMMARY_UPDATES, model.SUMMARY_INSERTS, **options)


@query("k08_merge_market_summary", MERGED_SUMMARY_SQL + f" SELECT {SUMMARY_OUT} FROM merged")
def _(spark, sf):
    return _merge_summary(spark, sf, broadcast_limit=0)


@query("k08b_merge_market_summary_small_source", MERGED_SUMMARY_SQL + f" SELECT {SUMMARY_OUT} FROM merged")
def _(spark, sf):
    return _merge_summary(spark, sf)


_CUT = datetime(1998, 6, 1)
_CONTRACT_KEYS = ["l_orderkey", "l_linenumber"]


def _contract_versions(spark, sf, older):
    lines = lens.table(spark, sf, "lineitem")
    side = F.col("l_shipdate") < F.lit(_CUT)
    newest = latest.latest_per_key(lines.filter(side if older else ~side), _CONTRACT_KEYS, ["l_shipdate"], lens.VERSION_TIES)
    return lens.contract_versions(newest)


def _side_sql(name: str, condition: str) -> str:
    body = CONTRACTS_SQL.replace("contracts AS", f"{name} AS", 1)
    return body.replace("FROM lineitem", f"FROM lineitem WHERE l_shipdate {condition} TIMESTAMP '1998-06-01'")


@query(
    "k09_merge_contract_details",
    f"""WITH {_side_sql('t', '<')}, {_side_sql('s', '>=')},
merged AS (
  SELECT s.* REPLACE (COALESCE(t.market_id, -s.market_id) AS market_id) FROM s LEFT JOIN t USING (contract_id)
  UNION ALL SELECT * FROM t WHERE contract_id NOT IN (SELECT contract_id FROM s))
SELECT {DETAILS_OUT} FROM merged""",
)
def _(spark, sf):
    """A matched contract keeps its market; the source says otherwise to show it."""
    source = _contract_versions(spark, sf, older=False).withColumn("market_id", -F.col("market_id"))
    return merge.merge_upsert(
        _contract_versions(spark, sf, older=True),
        source,
        ["contract_id"],
        model.DETAIL_UPDATES,
        model.DETAIL_INSERTS,
        check_unique=False,
        broadcast_limit=0,
    )


@query(
    "k10_merge_daily_metrics",
    ALL_TABLES_SQL
    + f""", s AS (SELECT * REPLACE (total_contracts + 1 AS total_contracts) FROM metrics WHERE metric_date >= DATE '1998-01-01'),
t AS (SELECT * FROM metrics WHERE metric_date < DATE '1999-07-01'),
merged AS (SELECT * FROM s UNION ALL SELECT t.* FROM t ANTI JOIN s USING (metric_date, market_id))
SELECT market_id, {date_text('metric_date')} AS metric_date, total_contracts, {_METRICS_OUT} FROM merged""",
)
def _(spark, sf):
    metrics = lens.metrics(spark, sf)
    source = metrics.filter(F.col("metric_date") >= F.lit(date(1998, 1, 1))).withColumn(
        "total_contracts", F.col("total_contracts") + 1
    )
    target = metrics.filter(F.col("metric_date") < F.lit(date(1999, 7, 1)))
    merged = merge.merge_upsert(
        target, source, model.DAILY_KEYS, model.DAILY_UPDATES, check_unique=False, broadcast_limit=0
    )
    return _six_digits(merged, "avg_trade_price", "price_volatility")


def _user_state(frame):
    """Newest event per user."""
    newest = latest.latest_per_key(frame, ["user_id"], ["ts"], ["event_id"])
    return newest.select("user_id", "ts", "event_id", "event_type", "value")


_MID = "TIMESTAMP '2024-01-16'"
_STATE = """SELECT user_id, ts, event_id, event_type, value FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id) AS rn FROM events WHERE {where}) WHERE rn = 1"""


@query(
    "k11_generic_merge",
    f"""WITH t AS ({_STATE.format(where=f'ts < {_MID}')}), s AS ({_STATE.format(where=f"ts >= {_MID} AND event_type <> 'view'")})
SELECT COALESCE(s.user_id, t.user_id) AS user_id, {ts('COALESCE(s.ts, t.ts)')} AS ts,
       CASE WHEN t.user_id IS NULL THEN NULL ELSE t.event_id END AS event_id,
       CASE WHEN t.user_id IS NULL THEN NULL ELSE t.event_type END AS event_type,
       COALESCE(s.value, t.value) AS value,
       CASE WHEN t.user_id IS NULL THEN 'inserted' WHEN s.user_id IS NULL THEN 'kept' ELSE 'updated' END AS action
FROM t FULL JOIN s ON t.user_id = s.user_id""",
)
def _(spark, sf):
    """Only keys and update columns are written for new rows."""
    mid = F.lit(datetime(2024, 1, 16))
    rows = events(spark, sf)
    target = _user_state(rows.filter(F.col("ts") < mid))
    source = _user_state(rows.filter((F.col("ts") >= mid) & (F.col("event_type") != "view")))
    return merge.merge_upsert(target, source, ["user_id"], ["ts", "value"], action_column="action")


@query(
    "k11b_merge_late_guard",
    f"""WITH t AS ({_STATE.format(where="event_type <> 'view'")}), s AS ({_STATE.format(where="event_type = 'view'")})
SELECT COALESCE(t.user_id, s.user_id) AS user_id,
       {ts('CASE WHEN t.user_id IS NULL OR s.ts >= t.ts THEN s.ts ELSE t.ts END')} AS ts,
       CASE WHEN t.user_id IS NULL OR s.ts >= t.ts THEN s.value ELSE t.value END AS value,
       CASE WHEN t.user_id IS NULL THEN 'inserted' WHEN s.ts >= t.ts THEN 'updated' ELSE 'kept' END AS action
FROM t FULL JOIN s ON t.user_id = s.user_id""",
)
def _(spark, sf):
    """A source row older than the stored one changes nothing."""
    rows = events(spark, sf)
    target = _user_state(rows.filter(F.col("event_type") != "view")).select("user_id", "ts", "value")
    source = _user_state(rows.filter(F.col("event_type") == "view")).select("user_id", "ts", "value")
    return merge.merge_upsert(
        target, source, ["user_id"], ["ts", "value"], newer_by="ts", action_column="action", broadcast_limit=0
    )


@query(
    "k11c_merge_counts",
    MERGED_SUMMARY_SQL
    + """ SELECT CAST(COUNT_IF(i) AS BIGINT) AS inserted, CAST(COUNT_IF(NOT i) AS BIGINT) AS updated, (SELECT COUNT(*) FROM t ANTI JOIN s USING (market_id)) AS kept
FROM (SELECT market_id NOT IN (SELECT market_id FROM t) AS i FROM s)""",
)
def _(spark, sf):
    return merge.merge_counts(_merge_summary(spark, sf, action_column="action", broadcast_limit=0), "action")


@query(
    "k12_insert_if_absent",
    ALL_TABLES_SQL
    + f"""SELECT market_id, {date_text('metric_date')} AS metric_date,
       total_contracts + CASE WHEN metric_date >= DATE '1999-07-01' THEN 1 ELSE 0 END AS total_contracts FROM metrics""",
)
def _(spark, sf):
    metrics = lens.metrics(spark, sf).select("metric_date", "market_id", "total_contracts")
    target = metrics.filter(F.col("metric_date") < F.lit(date(1999, 7, 1)))
    source = metrics.filter(F.col("metric_date") >= F.lit(date(1998, 1, 1))).withColumn(
        "total_contracts", F.col("total_contracts") + 1
    )
    return merge.insert_if_absent(target, source, model.DAILY_KEYS, check_unique=False)


@query(
    "k13_keep_latest_rows",
    f"""WITH {RAW_SQL} SELECT market_id, market_name, short_name, market_url, market_status, n_contracts::BIGINT AS n_contracts,
  {ts('extraction_timestamp')} AS extraction_timestamp
FROM raw r WHERE extraction_timestamp = (SELECT MAX(extraction_timestamp) FROM raw x WHERE x.market_id = r.market_id)""",
)
def _(spark, sf):
    kept = latest.keep_latest_rows(lens.raw(spark, sf), "market_id", "extraction_timestamp")
    number = F.array_size("contract_data").cast("bigint").alias("n_contracts")
    return kept.select("market_id", "market_name", "short_name", "market_url", "market_status", number, "extraction_timestamp")


_STALE_SQL = f"""WITH {MARKETS_SQL}, seen AS (SELECT DISTINCT l_orderkey AS market_id FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '2000-06-01' - INTERVAL 365 DAY)
SELECT market_id, CASE WHEN market_id NOT IN (SELECT market_id FROM seen) THEN 'Closed' ELSE market_status END AS market_status
FROM markets"""


@query("k14_mark_stale", _STALE_SQL)
def _(spark, sf):
    seen = lens.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("market_id"), "l_shipdate")
    marked = merge.mark_stale(
        lens.markets(spark, sf), seen, "market_id", "market_status", "l_shipdate", 365, datetime(2000, 6, 1)
    )
    return marked.select("market_id", "market_status")


# --- composite operators on other tables -------------------------------------------------------


@query(
    "x1_latest_event_per_user",
    f"SELECT user_id, {ts('ts')} AS ts, event_id, event_type, value FROM ({_STATE.format(where='TRUE')})",
)
def _(spark, sf):
    return _user_state(events(spark, sf))


_NULLABLE = """WITH e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS k,
  CASE WHEN value < 1 THEN NULL ELSE date_trunc('day', ts) END AS t FROM events) """


def _nullable_events(spark, sf):
    """Events with NULL keys and NULL days."""
    return events(spark, sf).select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("k"),
        F.when(F.col("value") >= 1, F.date_trunc("day", "ts").cast("timestamp_ntz")).alias("t"),
    )


# NOT IN over pairs written out in three-valued logic, so the meaning does not hang on how an
# engine compares row values
_NOT_IN_PAIRS = """, g AS (SELECT k, MAX(t) AS m FROM e GROUP BY k)
SELECT event_id FROM e WHERE NOT (
  NOT EXISTS (SELECT 1 FROM g WHERE g.k = e.k AND g.m = e.t)
  AND NOT EXISTS (SELECT 1 FROM g WHERE (g.k IS NULL OR e.k IS NULL) AND (g.m = e.t OR g.m IS NULL OR e.t IS NULL))
  AND NOT EXISTS (SELECT 1 FROM g WHERE g.k = e.k AND (g.m IS NULL OR e.t IS NULL)))"""


@query("x4_keep_latest_with_null_keys", _NULLABLE + _NOT_IN_PAIRS)
def _(spark, sf):
    return latest.keep_latest_rows(_nullable_events(spark, sf), "k", "t").select("event_id")


@query("x4b_keep_latest_with_null_times", _NULLABLE.replace("CASE WHEN event_type = 'error' THEN NULL ELSE user_id END", "user_id") + _NOT_IN_PAIRS)
def _(spark, sf):
    rows = _nullable_events(spark, sf).drop("k").join(events(spark, sf).select("event_id", F.col("user_id").alias("k")), "event_id")
    return latest.keep_latest_rows(rows, "k", "t").select("event_id")


def _stale_users_sql(since: str, key: str) -> str:
    return f"""WITH seen AS (SELECT DISTINCT {key} AS user_id FROM events WHERE ts >= {since})
SELECT event_id, CASE WHEN user_id NOT IN (SELECT user_id FROM seen) THEN 'stale' ELSE event_type END AS event_type FROM events"""


def _stale_users(spark, sf, as_of, days, key):
    seen = events(spark, sf).select(key.alias("user_id"), "ts")
    marked = merge.mark_stale(events(spark, sf), seen, "user_id", "event_type", "ts", days, as_of, "stale")
    return marked.select("event_id", "event_type")


@query("x5_mark_stale_users", _stale_users_sql("TIMESTAMP '2024-01-30 12:00:00'", "user_id"))
def _(spark, sf):
    return _stale_users(spark, sf, datetime(2024, 1, 31, 12), 1, F.col("user_id"))


@query(
    "x5b_mark_stale_null_seen",
    _stale_users_sql("TIMESTAMP '2024-01-30'", "CASE WHEN event_type = 'error' THEN NULL ELSE user_id END"),
)
def _(spark, sf):
    """A NULL among the recent keys: nothing is marked."""
    return _stale_users(
        spark, sf, datetime(2024, 1, 31), 1, F.when(F.col("event_type") != "error", F.col("user_id"))
    )


@query("x5c_mark_stale_none_seen", _stale_users_sql("TIMESTAMP '2024-06-01'", "user_id"))
def _(spark, sf):
    """Nothing seen lately: every row is marked."""
    return _stale_users(spark, sf, datetime(2024, 6, 2), 1, F.col("user_id"))


_RAW_OUT = f"""market_id, market_name, short_name, market_url, market_status,
       {big('COALESCE(n_contracts, 0)')} AS num_contracts, {ts('extraction_timestamp')} AS extraction_timestamp"""


def _raw_out(raw):
    return raw.select(
        "market_id",
        "market_name",
        "short_name",
        "market_url",
        "market_status",
        flatten.array_length(raw, "contract_data").alias("num_contracts"),
        "extraction_timestamp",
    )


@query("x6_flatten_snapshots", f"WITH {RAW_SQL} SELECT {_RAW_OUT} FROM raw")
def _(spark, sf):
    return _raw_out(lens.raw(spark, sf))


@query("x6b_flatten_snapshots_variant", f"WITH {RAW_SQL} SELECT {_RAW_OUT} FROM raw")
def _(spark, sf):
    return _raw_out(lens.raw_variant(spark, sf))


@query("x6c_flatten_contracts", f"WITH {RAW_SQL}, {RAW_CONTRACTS_SQL} SELECT {DETAILS_OUT} FROM raw_contracts")
def _(spark, sf):
    return flatten.flatten_contracts(lens.raw(spark, sf))


@query(
    "x10_part_categories",
    """SELECT p_partkey, CASE WHEN p_name LIKE '%bolt%' OR p_name LIKE '%gear%' THEN 'Hardware'
  WHEN p_name LIKE '%red%' OR p_name LIKE '%blue%' THEN 'Colour' ELSE 'Other' END AS category FROM part""",
)
def _(spark, sf):
    rules = {"Hardware": ("bolt", "gear"), "Colour": ("red", "blue")}
    return lens.table(spark, sf, "part").select("p_partkey", keyword_label("p_name", rules).alias("category"))


@query(
    "x11_model_from_documents",
    DOCUMENTS_SQL
    + f"""SELECT s.market_id, s.market_name, s.total_contracts AS slots, COUNT(d.contract_id) AS contracts,
       {rnd('AVG(d.last_trade_price)', 4)} AS avg_price
FROM summary s LEFT JOIN details d USING (market_id) GROUP BY ALL""",
)
def _(spark, sf):
    """Documents to summary and details, then both joined."""
    raw = lens.raw(spark, sf)
    per_market = model.market_trends(model.market_summary(raw), model.contract_details(raw), contracts_unique=True)
    slots = model.market_summary(raw).select("market_id", F.col("total_contracts").alias("slots"))
    return per_market.join(slots, "market_id").select(
        "market_id",
        "market_name",
        "slots",
        F.col("total_contracts").alias("contracts"),
        rounded("avg_price", 4).alias("avg_price"),
    )


@query(
    "x12_flatten_struct",
    """SELECT c_custkey AS id, c_name AS "who.name", CAST(c_nationkey AS BIGINT) AS "who.place.nation",
       '["' || c_mktsegment || '"]' AS "who.tags" FROM customer""",
)
def _(spark, sf):
    nested = lens.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.struct(
            F.col("c_name").alias("name"),
            F.struct(F.col("c_nationkey").alias("nation")).alias("place"),
            F.array("c_mktsegment").alias("tags"),
        ).alias("who"),
    )
    return flatten.flatten_struct(nested)


@query(
    "x3_insert_absent_customers",
    """SELECT c_custkey, COALESCE(n, 0) AS orders FROM customer LEFT JOIN (
  SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def _(spark, sf):
    """Order counts per customer, completed by customers without orders."""
    counted = lens.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"))
    everyone = lens.table(spark, sf, "customer").select("c_custkey", F.lit(0).cast("bigint").alias("orders"))
    return merge.insert_if_absent(counted, everyone, ["c_custkey"])


@query(
    "x8_share_by_two_keys",
    f"""SELECT l_returnflag, l_linestatus, COUNT(*) AS lines,
       {rnd('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()', 2)} AS share FROM lineitem GROUP BY 1, 2""",
)
def _(spark, sf):
    return aggregate.share_of_total(
        lens.table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "lines", "share"
    )


@query(
    "x9_histogram_of_orders",
    f"""WITH b AS (SELECT CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'middle' ELSE 'high' END AS bucket FROM orders)
SELECT bucket, COUNT(*) AS rows, {rnd('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()', 2)} AS percentage FROM b GROUP BY bucket""",
)
def _(spark, sf):
    return aggregate.histogram(
        lens.table(spark, sf, "orders"), "o_totalprice", ("100000", "300000"), ("low", "middle", "high")
    )


@query(
    "p6_spread_columns",
    TABLES_SQL
    + f"""SELECT contract_id, {rnd('best_sell_yes_cost - best_buy_yes_cost', 4)} AS spread,
       {rnd('CAST(best_sell_yes_cost - best_buy_yes_cost AS DOUBLE) / CAST(NULLIF(best_buy_yes_cost, 0) AS DOUBLE) * 100', 2)} AS spread_pct
FROM contracts""",
)
def _(spark, sf):
    return lens.contracts(spark, sf).select(
        "contract_id",
        reports.difference("best_sell_yes_cost", "best_buy_yes_cost").alias("spread"),
        percent_over("best_sell_yes_cost", "best_buy_yes_cost").alias("spread_pct"),
    )
