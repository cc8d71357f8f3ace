"""The test tables seen as markets, contracts and snapshot documents.

Two views of the same tables:

* table view: ``orders`` are markets, the newest version of each ``lineitem`` is a contract;
* document view: each ``lineitem`` row is a snapshot document with two markets and their
  contracts. Built row by row, so no document grows with the data.

``*_SQL`` holds the same views as SQL text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.flatten import flatten_snapshots
from tidemark.operators.latest import latest_per_key
from tidemark.plans import model

# fixed values: topics that give market names their keywords
TOPICS = (
    "Senate vote",
    "Presidential race",
    "Stock index",
    "World cup",
    "Supreme Court seat",
    "House majority",
    "Rainfall",
    "International treaty",
)
PART_MARKETS = 1_000_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _topic(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in TOPICS]), (F.pmod(key, F.lit(len(TOPICS))) + 1).cast("int"))


def _topic_sql(key: str) -> str:
    listed = ", ".join(f"'{t}'" for t in TOPICS)
    return f"([{listed}])[CAST({key} % {len(TOPICS)} + 1 AS INTEGER)]"


def _price(expr: Column) -> Column:
    return expr.cast("decimal(10,4)")


# --- table view -------------------------------------------------------------------------------


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("market_id"),
        F.concat(_topic(F.col("o_custkey")), F.lit(" "), F.col("o_custkey").cast("string")).alias("market_name"),
        F.col("o_orderpriority").alias("short_name"),
        F.concat(F.lit("/markets/"), F.col("o_orderkey").cast("string")).alias("market_url"),
        F.when(status == "O", "Open").when(status == "F", "Closed").otherwise("Unknown").alias("market_status"),
        F.floor(F.col("o_totalprice") / 20000).cast("int").alias("total_contracts"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_volume"),
        F.col("o_orderdate").alias("last_updated"),
    )


MARKETS_SQL = f"""markets AS (
  SELECT o_orderkey AS market_id,
         {_topic_sql('o_custkey')} || ' ' || o_custkey AS market_name,
         o_orderpriority AS short_name,
         '/markets/' || o_orderkey AS market_url,
         CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Closed' ELSE 'Unknown' END AS market_status,
         CAST(FLOOR(o_totalprice / 20000) AS BIGINT) AS total_contracts,
         CAST(o_totalprice AS DECIMAL(18,2)) AS total_volume,
         o_orderdate AS last_updated
  FROM orders)"""

# columns that settle which of two equally new line items counts
VERSION_TIES = (
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


def contract_versions(lines: DataFrame) -> DataFrame:
    """Line items as contract rows, all versions."""
    buy = _price(F.col("l_discount")) * 10
    sell = F.when(F.col("l_tax") != 0, _price(F.col("l_tax")) * F.lit("12.5").cast("decimal(10,4)"))
    unpriced = (F.col("l_returnflag") == "R") & (F.col("l_quantity") < 5)
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("contract_id"),
        F.col("l_orderkey").alias("market_id"),
        F.concat(F.lit("Contract "), F.col("l_partkey").cast("string")).alias("contract_name"),
        F.when(F.col("l_linestatus") == "O", "Open").otherwise("Closed").alias("contract_status"),
        _price(F.when(~unpriced, buy)).alias("last_trade_price"),
        _price(buy).alias("best_buy_yes_cost"),
        _price(sell).alias("best_sell_yes_cost"),
        _price(1 - buy).alias("best_buy_no_cost"),
        _price(1 - sell).alias("best_sell_no_cost"),
        _price(F.col("l_quantity") / 50).alias("last_close_price"),
        F.col("l_linenumber").alias("display_order"),
        F.col("l_shipdate").alias("last_updated"),
    )


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_per_key(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"], VERSION_TIES
    )
    return contract_versions(newest)


_VERSION_COLUMNS_SQL = """l_orderkey * 10 + l_linenumber AS contract_id,
         l_orderkey AS market_id,
         'Contract ' || l_partkey AS contract_name,
         CASE WHEN l_linestatus = 'O' THEN 'Open' ELSE 'Closed' END AS contract_status,
         CASE WHEN NOT (l_returnflag = 'R' AND l_quantity < 5)
              THEN CAST(CAST(l_discount AS DECIMAL(10,4)) * 10 AS DECIMAL(10,4)) END AS last_trade_price,
         CAST(CAST(l_discount AS DECIMAL(10,4)) * 10 AS DECIMAL(10,4)) AS best_buy_yes_cost,
         CASE WHEN l_tax <> 0 THEN CAST(CAST(l_tax AS DECIMAL(10,4)) * 12.5 AS DECIMAL(10,4)) END AS best_sell_yes_cost,
         CAST(1 - CAST(l_discount AS DECIMAL(10,4)) * 10 AS DECIMAL(10,4)) AS best_buy_no_cost,
         CASE WHEN l_tax <> 0 THEN CAST(1 - CAST(l_tax AS DECIMAL(10,4)) * 12.5 AS DECIMAL(10,4)) END AS best_sell_no_cost,
         CAST(l_quantity / 50 AS DECIMAL(10,4)) AS last_close_price,
         l_linenumber AS display_order,
         l_shipdate AS last_updated"""

CONTRACTS_SQL = f"""contracts AS (
  SELECT {_VERSION_COLUMNS_SQL}
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS FIRST, {', '.join(VERSION_TIES)}) = 1)"""


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily metrics dated by the day each market was updated."""
    return model.daily_metrics(
        markets(spark, sf_dir),
        contracts(spark, sf_dir),
        metric_date=F.col("last_updated"),
        contracts_unique=True,
    )


METRICS_SQL = """metrics AS (
  SELECT m.market_id, CAST(MIN(m.last_updated) AS DATE) AS metric_date,
         COUNT(DISTINCT c.contract_id) AS total_contracts,
         COALESCE(SUM(c.last_trade_price), 0) AS total_volume,
         COALESCE(AVG(c.last_trade_price), 0) AS avg_trade_price,
         COALESCE(STDDEV_SAMP(CAST(c.last_trade_price AS DOUBLE)), 0) AS price_volatility
  FROM markets m LEFT JOIN contracts c USING (market_id) GROUP BY m.market_id)"""

TABLES_SQL = f"WITH {MARKETS_SQL},\n{CONTRACTS_SQL}\n"
ALL_TABLES_SQL = f"WITH {MARKETS_SQL},\n{CONTRACTS_SQL},\n{METRICS_SQL}\n"

# --- document view ----------------------------------------------------------------------------


def _contracts(count: Column | int, market: Column, old_names: bool) -> Column:
    """The first ``count`` contracts of a market; NULL for a NULL count."""
    nothing = F.lit(None)

    def contract(number: int) -> Column:
        contract_id = market * 10 + F.lit(number)
        name = F.concat(F.lit(f"Contract {number} of "), market.cast("string"))
        step = F.lit(f"0.0{number}").cast("decimal(4,2)")
        return F.struct(
            (nothing.cast("bigint") if old_names else contract_id).alias("id"),
            (nothing.cast("string") if old_names else name).alias("name"),
            (contract_id if old_names else nothing.cast("bigint")).alias("contractId"),
            (name if old_names else nothing.cast("string")).alias("contractName"),
            F.col("line_status").alias("status"),
            _price(F.when(F.col("l_quantity") >= 5 * (number - 1), F.col("buy") + step)).alias("lastTradePrice"),
            F.col("buy").alias("bestBuyYesCost"),
            F.col("sell").alias("bestSellYesCost"),
            F.col("buy_no").alias("bestBuyNoCost"),
            F.col("sell_no").alias("bestSellNoCost"),
            F.col("close").alias("lastClosePrice"),
            F.lit(number).alias("displayOrder"),
        )

    # written out, not a lambda over numbers: lambdas are not compiled
    if isinstance(count, int):
        return F.array(*[contract(i + 1) for i in range(count)])
    return F.slice(F.array(*[contract(i) for i in (1, 2, 3)]), F.lit(1), count)


#: Line items in one task that builds documents; a document has two markets and up to five contracts, which are sorted in the task.
ROWS_PER_TASK = 400_000
#: Rows of one scan task, in their order, within which lines of one part are dealt together.
RUN = 1_000_000


def spread(df: DataFrame, near: str) -> DataFrame:
    """Rows dealt over tasks of bounded size, at least one for each core; rows alike in ``near`` mostly meet.

    The tasks of a scan follow the row groups: a large group is one task however many splits there are, which
    keeps other cores idle and makes sorts of what is built from it spill. Rows are dealt by ``near`` within a run
    of rows, so a value held by many rows is dealt over many tasks.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-df.count() // ROWS_PER_TASK))  # the count comes from the footers
    run = F.floor(F.monotonically_increasing_id() / RUN)
    return df.withColumn("_run", run).repartition(tasks, near, "_run").drop("_run")


#: Line items in one task that writes documents; only the lines are sorted there, not what is built from them.
ROWS_PER_WRITER = 4_000_000


def laid_together(df: DataFrame, near: str) -> DataFrame:
    """Rows for a writer, those alike in ``near`` one after the other in each task, which packs text best.

    The tasks of the scan are taken as they are if they are enough, even and small; otherwise rows are dealt as by ``spread``.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = df.groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.sum("count"), F.max("count"))  # from the footers
    number, rows, largest = tasks.first()
    even = rows and number >= cores and largest <= min(ROWS_PER_WRITER, 2 * rows / cores)
    return (df if even else spread(df, near)).sortWithinPartitions(near)


def _quoted_lines(spark: SparkSession, sf_dir: str, deal: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Line items with their quotes; decimals are made once per line, not once per contract."""
    buy, sell = _price(F.col("l_discount")) * 8, _price(F.col("l_tax")) * 10
    return deal(table(spark, sf_dir, "lineitem"), "l_partkey").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
        F.when(F.col("l_linestatus") == "O", "Open").otherwise("Closed").alias("line_status"),
        _price(buy).alias("buy"),
        _price(sell).alias("sell"),
        _price(1 - buy).alias("buy_no"),
        _price(1 - sell).alias("sell_no"),
        _price(F.col("l_quantity") / 50).alias("close"),
    )


def documents(spark: SparkSession, sf_dir: str, deal: Callable[[DataFrame, str], DataFrame] = spread) -> DataFrame:
    """One snapshot document per line item, typed: extracted_at, source, data.markets.

    ``deal`` lays the lines out over tasks: ``laid_together`` for documents that are written as text.
    """
    line_market = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    part_market = F.col("l_partkey") + F.lit(PART_MARKETS)
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    count = (
        F.when(flag == "N", 3)
        .when(flag == "A", 2)
        .when(quantity < 10, F.lit(None))
        .when(quantity < 20, 0)
        .otherwise(1)
    )
    status = F.when(F.col("l_tax") != 0, F.col("line_status"))
    return _quoted_lines(spark, sf_dir, deal).select(
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("extracted_at"),
        F.concat(F.lit("feed/"), F.col("l_suppkey").cast("string")).alias("source"),
        F.struct(
            F.array(
                F.struct(
                    line_market.alias("id"),
                    F.concat(_topic(F.col("l_partkey")), F.lit(" "), F.col("l_partkey").cast("string")).alias("name"),
                    F.concat("l_returnflag", "l_linestatus").alias("shortName"),
                    F.concat(F.lit("/lines/"), line_market.cast("string")).alias("url"),
                    status.alias("status"),
                    _contracts(count, line_market, old_names=False).alias("contracts"),
                ),
                F.struct(
                    part_market.alias("id"),
                    F.concat(F.lit("Part market "), F.col("l_partkey").cast("string")).alias("name"),
                    F.col("l_returnflag").alias("shortName"),
                    F.concat(F.lit("/parts/"), F.col("l_partkey").cast("string")).alias("url"),
                    F.lit("Open").alias("status"),
                    _contracts(2, part_market, old_names=True).alias("contracts"),
                ),
            ).alias("markets")
        ).alias("data"),
    )


def document_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as JSON text."""
    return documents(spark, sf_dir).select(F.to_json(F.struct("extracted_at", "source", "data")).alias("value"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with typed contract arrays."""
    return flatten_snapshots(documents(spark, sf_dir))


def raw_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows read from JSON text through VARIANT."""
    parsed = document_text(spark, sf_dir).select(F.try_parse_json("value").alias("raw"))
    return flatten_snapshots(parsed)


# n_contracts: NULL for a missing array, 0 for an empty one
RAW_SQL = f"""raw AS (
  SELECT l_orderkey * 10 + l_linenumber AS market_id,
         {_topic_sql('l_partkey')} || ' ' || l_partkey AS market_name,
         l_returnflag || l_linestatus AS short_name,
         '/lines/' || (l_orderkey * 10 + l_linenumber) AS market_url,
         CASE WHEN l_tax = 0 THEN 'Unknown' WHEN l_linestatus = 'O' THEN 'Open' ELSE 'Closed' END AS market_status,
         CASE WHEN l_returnflag = 'N' THEN 3 WHEN l_returnflag = 'A' THEN 2
              WHEN l_quantity < 10 THEN NULL WHEN l_quantity < 20 THEN 0 ELSE 1 END AS n_contracts,
         l_shipdate AS extraction_timestamp, l_discount, l_tax, l_quantity, l_linestatus
  FROM lineitem
  UNION ALL
  SELECT {PART_MARKETS} + l_partkey, 'Part market ' || l_partkey, l_returnflag, '/parts/' || l_partkey, 'Open', 2,
         l_shipdate, l_discount, l_tax, l_quantity, l_linestatus
  FROM lineitem)"""

RAW_CONTRACTS_SQL = """raw_contracts AS (
  SELECT market_id * 10 + j AS contract_id, market_id,
         'Contract ' || j || ' of ' || market_id AS contract_name,
         CASE WHEN l_linestatus = 'O' THEN 'Open' ELSE 'Closed' END AS contract_status,
         CASE WHEN l_quantity >= 5 * (j - 1)
              THEN CAST(CAST(l_discount AS DECIMAL(10,4)) * 8 + CAST(j AS DECIMAL(10,4)) / 100 AS DECIMAL(10,4)) END AS last_trade_price,
         CAST(CAST(l_discount AS DECIMAL(10,4)) * 8 AS DECIMAL(10,4)) AS best_buy_yes_cost,
         CAST(CAST(l_tax AS DECIMAL(10,4)) * 10 AS DECIMAL(10,4)) AS best_sell_yes_cost,
         CAST(1 - CAST(l_discount AS DECIMAL(10,4)) * 8 AS DECIMAL(10,4)) AS best_buy_no_cost,
         CAST(1 - CAST(l_tax AS DECIMAL(10,4)) * 10 AS DECIMAL(10,4)) AS best_sell_no_cost,
         CAST(l_quantity / 50 AS DECIMAL(10,4)) AS last_close_price,
         j AS display_order, extraction_timestamp AS last_updated
  FROM raw JOIN (SELECT unnest([1, 2, 3]) AS j) ON j <= n_contracts)"""

SUMMARY_SQL = """summary AS (
  SELECT market_id, market_name, short_name, market_url, market_status,
         CAST(COALESCE(n_contracts, 0) AS BIGINT) AS total_contracts,
         CAST(0 AS DECIMAL(18,2)) AS total_volume, extraction_timestamp AS last_updated
  FROM raw WHERE market_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY market_id ORDER BY extraction_timestamp DESC NULLS FIRST,
    market_name, short_name, market_url, market_status, COALESCE(n_contracts, 0)) = 1)"""

DETAILS_SQL = """details AS (
  SELECT * FROM raw_contracts
  QUALIFY row_number() OVER (PARTITION BY contract_id ORDER BY last_updated DESC NULLS FIRST,
    market_id, contract_name, contract_status, display_order, last_trade_price NULLS LAST, best_buy_yes_cost,
    best_sell_yes_cost, best_buy_no_cost, best_sell_no_cost, last_close_price) = 1)"""

DOCUMENTS_SQL = f"WITH {RAW_SQL},\n{RAW_CONTRACTS_SQL},\n{SUMMARY_SQL},\n{DETAILS_SQL}\n"
