"""Projections, predicates, joins, set operations, sorts, aggregate and scalar functions, each over whole tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.bindings import lens
from tidemark.bindings.lens import ALL_TABLES_SQL, DOCUMENTS_SQL, MARKETS_SQL, RAW_CONTRACTS_SQL, RAW_SQL, TABLES_SQL
from tidemark.bindings.registry import big, date_text, dbl, query, rnd, ts
from tidemark.functions import columns as c
from tidemark.operators import aggregate, sketches
from tidemark.operators.flatten import array_length, flatten_contracts
from tidemark.operators.joins import with_children, with_match, without_match
from tidemark.operators.latest import keep_latest_rows, latest_per_key
from tidemark.operators.merge import mark_stale
from tidemark.operators.quality import issue_counts
from tidemark.plans import reports
from tidemark.session import stored

M = lens.markets
C = lens.contracts
D = lens.metrics
T = lens.table

WITH_MARKETS = f"WITH {MARKETS_SQL} "
WITH_RAW = f"WITH {RAW_SQL} "

# --- projections ------------------------------------------------------------------------------


@query(
    "p1_variant_path_cast",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CAST(json_extract(props, '$.k') AS VARCHAR) AS k_text, CAST(json_extract(props, '$.missing') AS BIGINT) AS missing
FROM events""",
)
def _(spark, sf):
    parsed = T(spark, sf, "events").withColumn("v", F.try_parse_json("props"))
    return parsed.select(
        "event_id",
        c.variant_path("v", "$.k", "bigint").alias("k"),
        c.variant_path("v", "$.k", "string").alias("k_text"),
        c.variant_path("v", "$.missing", "bigint").alias("missing"),
    )


@query("p2_flatten_markets", WITH_RAW + f"SELECT market_id, {ts('extraction_timestamp')} AS extraction_timestamp FROM raw")
def _(spark, sf):
    return lens.raw(spark, sf).select("market_id", "extraction_timestamp")


@query(
    "p3_flatten_contracts",
    f"WITH {RAW_SQL}, {RAW_CONTRACTS_SQL} SELECT market_id, contract_id, contract_name FROM raw_contracts",
)
def _(spark, sf):
    return flatten_contracts(lens.raw(spark, sf)).select("market_id", "contract_id", "contract_name")


@query("p4_project_rename", "SELECT o_orderkey AS id, o_orderpriority AS label FROM orders")
def _(spark, sf):
    return T(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("label"))


@query(
    "p5_price_change",
    TABLES_SQL
    + f"""SELECT contract_id, {dbl('last_trade_price - last_close_price')} AS price_change,
       {rnd('CASE WHEN last_close_price > 0 THEN CAST(last_trade_price - last_close_price AS DOUBLE) / CAST(last_close_price AS DOUBLE) * 100 ELSE 0 END', 4)} AS price_change_pct
FROM contracts""",
)
def _(spark, sf):
    return C(spark, sf).select(
        "contract_id",
        c.price_change("last_trade_price", "last_close_price").alias("price_change"),
        c.rounded(c.price_change_pct("last_trade_price", "last_close_price"), 4).alias("price_change_pct"),
    )


@query(
    "p7_both_sides",
    TABLES_SQL
    + f"""SELECT contract_id, {rnd('best_buy_yes_cost + best_buy_no_cost', 4)} AS total_buy,
       {rnd('best_sell_yes_cost + best_sell_no_cost', 4)} AS total_sell FROM contracts""",
)
def _(spark, sf):
    return C(spark, sf).select(
        "contract_id",
        c.rounded(F.col("best_buy_yes_cost") + F.col("best_buy_no_cost"), 4).alias("total_buy"),
        c.rounded(F.col("best_sell_yes_cost") + F.col("best_sell_no_cost"), 4).alias("total_sell"),
    )


@query("p8_label_column", "SELECT 'orders populated' AS status, COUNT(*) AS row_count FROM orders")
def _(spark, sf):
    return T(spark, sf, "orders").agg(F.count("*").alias("row_count")).select(
        F.lit("orders populated").alias("status"), "row_count"
    )


# --- predicates -------------------------------------------------------------------------------


@query("f1_equality", WITH_MARKETS + "SELECT market_id FROM markets WHERE market_status = 'Open'")
def _(spark, sf):
    return M(spark, sf).filter(F.col("market_status") == "Open").select("market_id")


@query(
    "f2_null_tests",
    TABLES_SQL
    + """SELECT contract_id, 'missing' AS quote FROM contracts WHERE last_trade_price IS NULL OR best_sell_yes_cost IS NULL
UNION ALL SELECT contract_id, 'present' FROM contracts WHERE last_trade_price IS NOT NULL AND best_sell_yes_cost IS NOT NULL""",
)
def _(spark, sf):
    rows = C(spark, sf)
    missing = F.col("last_trade_price").isNull() | F.col("best_sell_yes_cost").isNull()
    return rows.select("contract_id", F.when(missing, "missing").otherwise("present").alias("quote"))


@query(
    "f3_range",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity FROM lineitem WHERE l_discount > 0 AND l_shipdate >= TIMESTAMP '1999-01-01'",
)
def _(spark, sf):
    since = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    return (
        T(spark, sf, "lineitem")
        .filter((F.col("l_discount") > 0) & (F.col("l_shipdate") >= since))
        .select("l_orderkey", "l_linenumber", "l_quantity")
    )


@query(
    "f4_column_to_column",
    TABLES_SQL + "SELECT contract_id FROM contracts WHERE best_sell_yes_cost > best_buy_yes_cost",
)
def _(spark, sf):
    return C(spark, sf).filter(F.col("best_sell_yes_cost") > F.col("best_buy_yes_cost")).select("contract_id")


@query(
    "f5_like_any",
    WITH_MARKETS
    + """SELECT market_id FROM markets WHERE lower(market_name) LIKE '%vote%' OR lower(market_name) LIKE '%court%'""",
)
def _(spark, sf):
    name = F.lower("market_name")
    return M(spark, sf).filter(name.contains("vote") | name.contains("court")).select("market_id")


@query("f6_having", "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey HAVING COUNT(o_orderkey) >= 10")
def _(spark, sf):
    return T(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n >= 10")


@query(
    "f7_qualify",
    """SELECT user_id, event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS FIRST, event_id) = 1""",
)
def _(spark, sf):
    newest = latest_per_key(T(spark, sf, "events"), ["user_id", "event_type"], ["ts"], ["event_id"])
    return newest.select("user_id", "event_type", "event_id")


# --- joins ------------------------------------------------------------------------------------


@query("j1_contracts_with_market", TABLES_SQL + "SELECT contract_id, market_name FROM contracts JOIN markets USING (market_id)")
def _(spark, sf):
    return C(spark, sf).join(M(spark, sf).select("market_id", "market_name"), "market_id").select("contract_id", "market_name")


@query(
    "j2_metrics_with_market",
    ALL_TABLES_SQL
    + f"SELECT market_name, market_id, x.total_contracts, {date_text('metric_date')} AS metric_date FROM metrics x JOIN markets m USING (market_id)",
)
def _(spark, sf):
    joined = D(spark, sf).join(M(spark, sf).select("market_id", "market_name"), "market_id")
    return joined.select("market_name", "market_id", "total_contracts", "metric_date")


@query(
    "j3_markets_left_contracts",
    TABLES_SQL + "SELECT market_id, contract_id, contract_name FROM markets LEFT JOIN contracts USING (market_id)",
)
def _(spark, sf):
    details = C(spark, sf).select("market_id", "contract_id", "contract_name")
    return with_children(M(spark, sf).select("market_id"), details, "market_id")


@query(
    "j4_full_join_two_keys",
    """WITH a AS (SELECT user_id, event_type, COUNT(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY ALL),
b AS (SELECT user_id, event_type, COUNT(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY ALL)
SELECT user_id, event_type, COALESCE(a.n, 0) AS before, COALESCE(b.n, 0) AS after FROM a FULL JOIN b USING (user_id, event_type)""",
)
def _(spark, sf):
    mid = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    keys = ["user_id", "event_type"]
    rows = T(spark, sf, "events")
    before = rows.filter(F.col("ts") < mid).groupBy(*keys).agg(F.count("*").alias("before"))
    after = rows.filter(F.col("ts") >= mid).groupBy(*keys).agg(F.count("*").alias("after"))
    return before.join(after, keys, "full").na.fill(0, ["before", "after"])


@query("j5_anti_join", "SELECT o_orderkey FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey")
def _(spark, sf):
    lines = T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return without_match(T(spark, sf, "orders").select("o_orderkey"), lines, ["o_orderkey"])


@query(
    "j6_pairs_not_newest",
    """SELECT event_id FROM events e WHERE ts = (SELECT MAX(ts) FROM events x WHERE x.user_id = e.user_id)""",
)
def _(spark, sf):
    return keep_latest_rows(T(spark, sf, "events"), "user_id", "ts").select("event_id")


@query(
    "j7_not_in_recent",
    """SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01')""",
)
def _(spark, sf):
    orders = T(spark, sf, "orders")
    marked = mark_stale(orders, orders, "o_custkey", "o_orderstatus", "o_orderdate", 7, datetime(2001, 7, 8), "gone")
    return marked.filter(F.col("o_orderstatus") == "gone").select("o_orderkey")


@query(
    "j8_lateral_flatten",
    WITH_RAW + "SELECT market_id, COUNT(*) AS snapshots FROM raw GROUP BY market_id",
)
def _(spark, sf):
    """Markets taken out of the documents with a lateral join, then counted."""
    lens.documents(spark, sf).createOrReplaceTempView("tidemark_documents")
    return spark.sql(
        """SELECT m.id AS market_id, count(*) AS snapshots
        FROM tidemark_documents d, LATERAL explode(d.data.markets) AS e(m) GROUP BY m.id"""
    )


# --- set operations and sorts -------------------------------------------------------------------


@query(
    "u1_union_of_counts",
    """SELECT 'orders' AS table_name, COUNT(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
UNION ALL SELECT 'events', COUNT(*) FROM events""",
)
def _(spark, sf):
    return aggregate.table_counts({t: T(spark, sf, t) for t in ("orders", "lineitem", "events")})


@query(
    "u2_union_of_issues",
    TABLES_SQL
    + """SELECT 'no price' AS check_name, COUNT(*) AS issue_count FROM contracts WHERE last_trade_price IS NULL
UNION ALL SELECT 'no sell quote', COUNT(*) FROM contracts WHERE best_sell_yes_cost IS NULL""",
)
def _(spark, sf):
    missing = {"no price": F.col("last_trade_price").isNull(), "no sell quote": F.col("best_sell_yes_cost").isNull()}
    return issue_counts(C(spark, sf), missing)


@query("u3_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(spark, sf):
    return T(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query("o1_sorted", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey")
def _(spark, sf):
    ranked = T(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ranked.orderBy(*c.descending("o_totalprice"), *c.ascending("o_orderkey"))


@query(
    "o2_sorted_by_alias",
    "SELECT l_orderkey, COUNT(*) AS lines FROM lineitem GROUP BY 1 ORDER BY lines DESC, l_orderkey LIMIT 100",
)
def _(spark, sf):
    counts = T(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    return aggregate.top_k(counts, [*c.descending("lines"), *c.ascending("l_orderkey")], 100)


@query(
    "o3_sorted_by_expression",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice FROM lineitem
ORDER BY CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - l_discount AS DECIMAL(4,2)) DESC, l_orderkey, l_linenumber, l_extendedprice LIMIT 50""",
)
def _(spark, sf):
    revenue = F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount")).cast("decimal(4,2)")
    order = [*c.descending(revenue), *c.ascending("l_orderkey", "l_linenumber", "l_extendedprice")]
    return aggregate.top_k(T(spark, sf, "lineitem"), order, 50).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "o4_top_k_nulls_first",
    TABLES_SQL
    + f"""SELECT contract_id, {dbl('best_sell_yes_cost')} AS best_sell_yes_cost FROM contracts
ORDER BY contracts.best_sell_yes_cost DESC NULLS FIRST, contract_id LIMIT 20""",
)
def _(spark, sf):
    order = [*c.descending("best_sell_yes_cost"), *c.ascending("contract_id")]
    return aggregate.top_k(C(spark, sf), order, 20).select("contract_id", "best_sell_yes_cost")


@query("o5_sample_by_key", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 5")
def _(spark, sf):
    return reports.sample_rows(T(spark, sf, "events"), ["event_id"], 5).select("event_id", "event_type", "value")


# --- aggregate functions ----------------------------------------------------------------------

_GROUP_SQL = TABLES_SQL + "SELECT market_status, {sql} FROM markets LEFT JOIN contracts USING (market_id) GROUP BY market_status"


def _per_status(expression):
    """Aggregates of contracts per market status, combined from exact per-market moments."""

    def run(spark, sf):
        per_market = C(spark, sf).groupBy("market_id").agg(
            F.count("*").alias("rows"),
            F.count_if(F.col("contract_status") == "Open").alias("open"),
            *aggregate.moments("last_trade_price"),
        )
        joined = M(spark, sf).select("market_id", "market_status").join(per_market, "market_id", "left")
        return joined.groupBy("market_status").agg(*expression())

    return run


def _register(name, sql, expression):
    query(name, _GROUP_SQL.format(sql=sql))(_per_status(expression))


_register("g1_count_rows", "COUNT(*) AS n", lambda: [F.sum(F.coalesce("rows", F.lit(1))).alias("n")])
_register("g2_count_values", "COUNT(last_trade_price) AS n", lambda: [aggregate.combined()["count"].alias("n")])
_register("g4_sum", f"{dbl('SUM(last_trade_price)')} AS total", lambda: [aggregate.combined()["sum"].alias("total")])
_register("g5_avg", f"{rnd('AVG(last_trade_price)', 6)} AS mean", lambda: [c.rounded(aggregate.combined()["avg"], 6).alias("mean")])
_register(
    "g6_min_max",
    f"{dbl('MIN(last_trade_price)')} AS low, {dbl('MAX(last_trade_price)')} AS high",
    lambda: [aggregate.combined()["min"].alias("low"), aggregate.combined()["max"].alias("high")],
)
_register(
    "g7_stddev",
    f"{rnd('STDDEV_SAMP(CAST(last_trade_price AS DOUBLE))', 6)} AS deviation",
    lambda: [c.rounded(aggregate.combined()["stddev"], 6).alias("deviation")],
)
_register(
    "g8_conditional_count",
    f"{big('SUM(CASE WHEN contract_status = $$Open$$ THEN 1 ELSE 0 END)')} AS n",
    lambda: [F.sum(F.coalesce("open", F.lit(0))).alias("n")],
)


@query(
    "g3b_approximate_distinct",
    "SELECT l_returnflag, l_linestatus, COUNT(DISTINCT l_partkey) AS parts, true AS within FROM lineitem GROUP BY ROLLUP (1, 2)",
)
def _(spark, sf):
    """Sketches stored per flag, status and day, united for coarser keys without the lines; within 2 % of the exact count."""
    lines = T(spark, sf, "lineitem")
    keys = ["l_returnflag", "l_linestatus"]
    days = stored(sketches.distinct_sketches(lines, [*keys, "l_shipdate"], "l_partkey"), "sketches")
    exact = lines.rollup(*keys).agg(F.count_distinct("l_partkey").alias("parts"), F.grouping_id().alias("level"))
    coarse = [sketches.united(days, keys[:n]).withColumns({k: F.lit(None).cast("string") for k in keys[n:]} | {"level": F.lit(2 ** (2 - n) - 1)}) for n in (0, 1, 2)]
    about = reduce(DataFrame.unionByName, coarse).select(*[F.col(k).alias(f"_{k}") for k in (*keys, "level")], sketches.estimate().alias("about"))
    same = (F.col("level") == F.col("_level")) & F.expr(" AND ".join(f"{k} <=> _{k}" for k in keys))
    return exact.join(about, same).select(*keys, "parts", (F.abs(F.col("about") - F.col("parts")) <= 0.02 * F.col("parts")).alias("within"))


@query("g3_count_distinct", "SELECT l_returnflag, COUNT(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def _(spark, sf):
    return T(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"))


@query(
    "g9_coalesced_sum",
    TABLES_SQL
    + f"""SELECT market_id, {dbl('COALESCE(SUM(last_trade_price), 0)')} AS total FROM markets LEFT JOIN contracts USING (market_id) GROUP BY 1""",
)
def _(spark, sf):
    sums = C(spark, sf).groupBy("market_id").agg(F.sum("last_trade_price").alias("total"))
    joined = M(spark, sf).select("market_id").join(sums, "market_id", "left")
    return joined.select("market_id", F.coalesce("total", F.lit(0)).alias("total"))


@query(
    "g10_rounded_average",
    f"SELECT l_suppkey, {rnd('AVG(CAST(l_quantity AS DECIMAL(10,2)))', 2)} AS quantity FROM lineitem GROUP BY 1",
)
def _(spark, sf):
    mean = c.rounded(F.avg(F.col("l_quantity").cast("decimal(10,2)")), 2)
    return T(spark, sf, "lineitem").groupBy("l_suppkey").agg(mean.alias("quantity"))


@query(
    "g11_group_by_keys",
    f"""SELECT l_returnflag, l_linestatus, l_linenumber % 2 = 0 AS even, COUNT(*) AS n, {dbl('SUM(CAST(l_quantity AS DECIMAL(10,2)))')} AS quantity
FROM lineitem GROUP BY ALL""",
)
def _(spark, sf):
    keyed = T(spark, sf, "lineitem").withColumn("even", F.col("l_linenumber") % 2 == 0)
    return keyed.groupBy("l_returnflag", "l_linestatus", "even").agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("decimal(10,2)")).alias("quantity")
    )


@query(
    "g12_group_by_expression",
    """SELECT CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 250000 THEN 'medium' ELSE 'large' END AS size, COUNT(*) AS n
FROM orders GROUP BY 1""",
)
def _(spark, sf):
    price = F.col("o_totalprice")
    size = F.when(price < 50000, "small").when(price < 250000, "medium").otherwise("large")
    return T(spark, sf, "orders").groupBy(size.alias("size")).agg(F.count("*").alias("n"))


@query("g13_group_by_alias", "SELECT upper(o_orderpriority) AS priority, COUNT(*) AS n FROM orders GROUP BY priority")
def _(spark, sf):
    T(spark, sf, "orders").createOrReplaceTempView("tidemark_orders")
    return spark.sql("SELECT upper(o_orderpriority) AS priority, count(*) AS n FROM tidemark_orders GROUP BY priority")


@query(
    "g14_global_aggregate",
    f"""SELECT COUNT(*) AS n, COUNT(DISTINCT o_custkey) AS customers, {dbl('SUM(CAST(o_totalprice AS DECIMAL(18,2)))')} AS total FROM orders""",
)
def _(spark, sf):
    return T(spark, sf, "orders").agg(
        F.count("*").alias("n"),
        F.count_distinct("o_custkey").alias("customers"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
    )


# --- scalar functions ---------------------------------------------------------------------------


@query(
    "c1_casts",
    f"""SELECT event_id, CAST(CAST(event_id AS VARCHAR) AS BIGINT) AS id, {dbl('CAST(value AS DECIMAL(10,4))')} AS price,
       CAST(user_id AS VARCHAR) AS user_text, {ts("CAST(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS TIMESTAMP)")} AS at FROM events""",
)
def _(spark, sf):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return T(spark, sf, "events").select(
        "event_id",
        F.col("event_id").cast("string").cast("bigint").alias("id"),
        F.col("value").cast("decimal(10,4)").alias("price"),
        F.col("user_id").cast("string").alias("user_text"),
        iso.cast("timestamp_ntz").alias("at"),
    )


@query("c2_coalesce", WITH_RAW + "SELECT market_status, COUNT(*) AS n FROM raw GROUP BY 1")
def _(spark, sf):
    market = lens.documents(spark, sf).select(F.explode("data.markets").alias("m"))
    return market.groupBy(c.status_or_unknown("m.status").alias("market_status")).agg(F.count("*").alias("n"))


@query(
    "c3_nullif_division",
    f"SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, {rnd('l_quantity / NULLIF(CAST(l_discount AS DECIMAL(10,4)) * 100, 0)', 4)} AS ratio FROM lineitem",
)
def _(spark, sf):
    percent = F.col("l_discount").cast("decimal(10,4)") * 100
    ratio = F.col("l_quantity") / F.nullif(percent, F.lit(0)).cast("double")
    return T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", c.rounded(ratio, 4).alias("ratio"))


@query(
    "c4_case_when",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'open' WHEN o_orderstatus = 'F' THEN 'filled' ELSE 'other' END AS state FROM orders""",
)
def _(spark, sf):
    status = F.col("o_orderstatus")
    state = F.when(status == "O", "open").when(status == "F", "filled").otherwise("other")
    return T(spark, sf, "orders").select("o_orderkey", state.alias("state"))


@query("c5_array_size", WITH_RAW + f"SELECT {big('n_contracts')} AS size, COUNT(*) AS n FROM raw GROUP BY n_contracts")
def _(spark, sf):
    raw = lens.raw(spark, sf)
    size = array_length(raw, "contract_data", null_is_zero=False)
    return raw.groupBy(size.alias("size")).agg(F.count("*").alias("n"))


@query(
    "c6_round_half_up",
    f"SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, {rnd('CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.125 AS DECIMAL(4,3))', 2)} AS eighth FROM lineitem",
)
def _(spark, sf):
    eighth = F.col("l_extendedprice").cast("decimal(18,2)") * F.lit("0.125").cast("decimal(4,3)")
    return T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", c.rounded(eighth, 2).alias("eighth"))


@query(
    "c7_arithmetic",
    f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
       {dbl('CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(20,4))')} AS net FROM lineitem""",
)
def _(spark, sf):
    net = F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", net.alias("net"))


@query("c8_lower_like", "SELECT doc_id FROM documents WHERE lower(text) LIKE '%license%'")
def _(spark, sf):
    return T(spark, sf, "documents").filter(F.lower("text").contains("license")).select("doc_id")


@query(
    "c9_concat_numbers",
    TABLES_SQL
    + "SELECT contract_id, 'contract ' || contract_id || ' in ' || market_id || ': ' || CAST(last_trade_price AS VARCHAR) AS line FROM contracts",
)
def _(spark, sf):
    line = c.joined_text(F.lit("contract "), "contract_id", F.lit(" in "), "market_id", F.lit(": "), "last_trade_price")
    return C(spark, sf).select("contract_id", line.alias("line"))


@query(
    "c10_as_of_day",
    f"SELECT o_orderkey, (SELECT {date_text('MAX(o_orderdate)')} FROM orders) AS metric_date FROM orders",
)
def _(spark, sf):
    orders = T(spark, sf, "orders")
    newest = orders.agg(F.max("o_orderdate")).scalar()
    return orders.select("o_orderkey", c.day(newest).alias("metric_date"))


@query(
    "c11_hour_boundaries",
    "SELECT event_id, date_diff('hour', ts, TIMESTAMP '2024-02-01 00:30:00') AS hours FROM events",
)
def _(spark, sf):
    end = F.lit("2024-02-01 00:30:00").cast("timestamp_ntz")
    return T(spark, sf, "events").select("event_id", c.hours_between("ts", end).alias("hours"))


@query("c12_days_before", f"SELECT o_orderkey, {ts('o_orderdate - INTERVAL 7 DAY')} AS week_before FROM orders")
def _(spark, sf):
    return T(spark, sf, "orders").select("o_orderkey", c.days_before("o_orderdate", 7).alias("week_before"))


@query(
    "c13_date_parts",
    "SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day FROM events",
)
def _(spark, sf):
    return T(spark, sf, "events").withColumns(c.date_parts("ts")).select("event_id", "year", "month", "day")


@query(
    "c14_in_subquery",
    """SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
AND (o_orderstatus = 'O' OR o_totalprice >= 200000)""",
)
def _(spark, sf):
    builders = T(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    wanted = (F.col("o_orderstatus") == "O") | (F.col("o_totalprice") >= 200000)
    return T(spark, sf, "orders").filter(wanted).transform(with_match, builders, ["o_custkey"]).select("o_orderkey")


@query("c15_nested_path", DOCUMENTS_SQL + "SELECT market_name, COUNT(*) AS n FROM raw GROUP BY market_name")
def _(spark, sf):
    """Two levels into JSON text, over whole documents."""
    parsed = lens.document_text(spark, sf).select(F.try_parse_json("value").alias("raw"))
    markets = c.variant_rows("raw", "$.data.markets", {"name": "string"}, strict=True)
    names = parsed.select(F.explode(markets).alias("market")).select(F.col("market.name").alias("market_name"))
    return names.groupBy("market_name").agg(F.count("*").alias("n"))
