"""Sources, sinks, table maintenance, streaming and quality checks.

Files are written by Spark from the test tables into the shared folder, then read back. The
landing area of the snapshot documents is written once per session and table folder, as gzip files of
bounded size: as plain text the documents of sf0.1 take 711 MB, made of a table of 11 MB.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.bindings import lens
from tidemark.bindings.lens import ALL_TABLES_SQL, DOCUMENTS_SQL, MARKETS_SQL, RAW_SQL, SUMMARY_SQL, TABLES_SQL
from tidemark.bindings.operator_queries import DETAILS_OUT, MERGED_SUMMARY_SQL, SUMMARY_OUT, merge_sides, trends
from tidemark.bindings.registry import big, date_text, dbl, query, rnd, ts
from tidemark.functions.columns import rounded
from tidemark.operators import quality
from tidemark.operators.flatten import flatten_snapshots
from tidemark.plans import model, refresh, reports, upkeep
from tidemark.session import fresh_path, hadoop_fs, stored
from tidemark.sinks import files, manifest, tables
from tidemark.sinks.managed import ManagedTable, by_hash, by_value
from tidemark.sources import feeds, snapshots
from tidemark.sources import tables as table_sources
from tidemark.streaming import incremental

_LANDED: dict[tuple[str, str, str], str] = {}


def landed(spark, sf, name: str, write) -> str:
    """Path of files written by ``write(path)``, once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _LANDED:
        path = fresh_path(spark, name)
        write(path)
        _LANDED[key] = path
    return _LANDED[key]


def document_files(spark, sf) -> str:
    """Snapshot documents as JSON lines."""
    return landed(spark, sf, "documents", lambda path: files.save_json(lens.documents(spark, sf, lens.laid_together), path, "gzip"))


def broken_files(spark, sf) -> str:
    """The same documents, those of the highest tax cut off in the middle, as .txt.gz files."""

    def write(path):
        text = lens.documents(spark, sf, lens.laid_together).select(
            F.to_json(F.struct("extracted_at", "source", "data")).alias("text"),
            F.col("data.markets")[1]["contracts"][0]["bestSellYesCost"].alias("quote"),
        )
        cut = F.when(F.col("quote") >= F.lit("0.8").cast("decimal(10,4)"), F.substring("text", 1, 60))
        text.select(F.coalesce(cut, "text").alias("value")).write.mode("overwrite").options(**files.text_options("gzip")).text(path)

    return landed(spark, sf, "broken", write)


def event_documents(spark, sf) -> DataFrame:
    """Each event in an envelope taken at its time."""
    rows = lens.table(spark, sf, "events")
    data = rows.select("ts", "event_type", F.struct("event_id", "user_id", "value").alias("event"))
    return files.envelope(data, F.concat(F.lit("events/"), F.col("event_type")), F.col("ts"))


def event_lake(spark, sf) -> str:
    """Event documents under year=/month=/day= folders."""

    def write(path):
        documents = event_documents(spark, sf).withColumn("taken", F.col("data.ts"))
        files.save_by_date(documents, path, "taken", mode="overwrite")

    return landed(spark, sf, "lake", write)


EVENT_SCHEMA = (
    "extracted_at STRING, source STRING, data STRUCT<event_type: STRING, "
    "event: STRUCT<event_id: BIGINT, user_id: BIGINT, value: DOUBLE>>"
)


def read_documents(spark, sf, **options):
    return snapshots.read_documents(spark, document_files(spark, sf), one_per_file=False, **options)


# --- sources ----------------------------------------------------------------------------------


@query(
    "s01_document_scan",
    f"""SELECT {ts('l_shipdate')} AS extracted_at, 'feed/' || l_suppkey AS source, 2 AS n_markets,
       (l_orderkey * 10 + l_linenumber) || ',' || ({lens.PART_MARKETS} + l_partkey) AS markets FROM lineitem""".replace("2 AS", "CAST(2 AS BIGINT) AS"),
)
def _(spark, sf):
    return read_documents(spark, sf).select(
        "extracted_at",
        "source",
        F.size("data.markets").alias("n_markets"),
        F.array_join(F.transform("data.markets", lambda m: m["id"].cast("string")), ",").alias("markets"),
    )


@query(
    "s01b_document_scan_variant",
    DOCUMENTS_SQL + "SELECT market_id, market_name, market_status FROM raw",
)
def _(spark, sf):
    """Whole text to VARIANT, then flattened."""
    text = spark.read.text(document_files(spark, sf))
    return flatten_snapshots(text.select(F.try_parse_json("value").alias("raw"))).select(
        "market_id", "market_name", "market_status"
    )


@query(
    "s02_file_provenance",
    """SELECT strftime(ts, '%Y-%m-%d') AS folder_day, COUNT(*) AS documents FROM events GROUP BY 1""",
)
def _(spark, sf):
    """Day taken from the path of the file each row came from."""
    rows = snapshots.read_documents(spark, event_lake(spark, sf), one_per_file=False, schema=EVENT_SCHEMA)
    path = F.col("source_file")
    parts = [F.regexp_extract(path, rf"/{name}=(\d+)/", 1) for name in files.PARTS]
    return rows.groupBy(F.concat_ws("-", *parts).alias("folder_day")).agg(F.count("*").alias("documents"))


@query(
    "s03_filename_filter",
    "SELECT CAST(YEAR(l_shipdate) AS BIGINT) AS year, COUNT(*) AS documents FROM lineitem GROUP BY 1",
)
def _(spark, sf):
    """Of a .json.gz and a .txt.gz folder only the .json.gz files are taken, by glob and by pattern."""
    both = [document_files(spark, sf), broken_files(spark, sf)]
    rows = snapshots.read_documents(spark, both, one_per_file=False, pattern="*.json.gz", file_regex=r".*\.json\.gz$")
    return rows.groupBy(F.year("extracted_at").alias("year")).agg(F.count("*").alias("documents"))


_BROKEN = "CAST(l_tax AS DECIMAL(10,4)) >= 0.08"


@query(
    "s04_tolerant_load",
    f"""SELECT CASE WHEN {_BROKEN} THEN 'quarantined' ELSE 'good' END AS outcome, COUNT(*) AS documents FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    load = snapshots.load_snapshots(spark, broken_files(spark, sf), one_per_file=False, pattern="*.txt.gz")
    outcomes = [
        frame.agg(F.count("source_file").alias("documents")).select(F.lit(name).alias("outcome"), "documents")
        for name, frame in (("good", load.good), ("quarantined", load.quarantined.filter(F.length("_corrupt_record") == 60)))
    ]
    return outcomes[0].unionByName(outcomes[1])


@query(
    "s04b_copy_into_table",
    f"""SELECT event_type, COUNT(*) AS n, {dbl('SUM(CAST(value AS DECIMAL(18,4)))')} AS total, true AS counted
FROM events GROUP BY 1""",
)
def _(spark, sf):
    """CSV files appended to a table, with the counts of the load."""
    rows = lens.table(spark, sf, "events").select("event_id", "event_type", "value")
    path, target = fresh_path(spark, "stage"), fresh_path(spark, "copied")
    rows.write.option("header", True).csv(path)
    stage = snapshots.Location("events_stage", path, "csv")
    stats = snapshots.copy_into(spark, stage, target, "event_id BIGINT, event_type STRING, value DOUBLE", r".*\.csv$")
    copied = snapshots.read_copied(spark, target)
    return copied.groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.sum(F.col("value").cast("decimal(18,4)")).alias("total"),
        F.lit(stats["rows_loaded"] > 0 and stats["errors_seen"] == 0 and stats["files_loaded"] > 0).alias("counted"),
    )


@query(
    "s04c_copy_skips_loaded_files",
    """SELECT call, CASE call WHEN 1 THEN (SELECT COUNT(*) FROM events WHERE value < 20) WHEN 3 THEN (SELECT COUNT(*) FROM events WHERE value >= 20)
  ELSE 0 END::BIGINT AS rows_loaded, (SELECT COUNT(*) FROM events) AS rows_in_table FROM (VALUES (1::BIGINT), (2), (3), (4)) AS t(call)""",
)
def _(spark, sf):
    """Two waves of files, each loaded twice: the ledger leaves loaded files out before they are opened."""
    path, target = fresh_path(spark, "stage"), fresh_path(spark, "copied")
    events, stage, loaded = lens.table(spark, sf, "events").select("event_id", "value"), snapshots.Location("waves", path), []
    for wave in (F.col("value") < 20, F.col("value") >= 20):
        events.where(wave).write.mode("append").json(path)
        loaded += [snapshots.copy_into(spark, stage, target, "event_id BIGINT, value DOUBLE")["rows_loaded"] for _twice in range(2)]
    calls = spark.createDataFrame(list(enumerate(loaded, 1)), "call BIGINT, rows_loaded BIGINT")
    return calls.withColumn("rows_in_table", snapshots.read_copied(spark, target).agg(F.count("*").alias("n")).scalar())


@query(
    "s05_load_statistics",
    f"""SELECT true AS has_files, COUNT_IF(NOT ({_BROKEN}))::BIGINT AS rows_loaded, COUNT_IF({_BROKEN})::BIGINT AS errors_seen FROM lineitem""",
)
def _(spark, sf):
    documents = snapshots.read_documents(spark, broken_files(spark, sf), one_per_file=False, pattern="*.txt.gz")
    stats = snapshots.load_statistics(documents)
    return stats.select((F.col("files_loaded") > 0).alias("has_files"), "rows_loaded", "errors_seen")


@query(
    "s06_staged_formats",
    f"""SELECT f AS format, event_type, COUNT(*) AS events, {dbl('SUM(CAST(value AS DECIMAL(18,4)))')} AS total
FROM events, (SELECT unnest(['csv', 'json', 'parquet']) AS f) GROUP BY ALL""",
)
def _(spark, sf):
    rows = lens.table(spark, sf, "events").select("event_id", "event_type", "value")
    out = None
    for fmt in ("csv", "json", "parquet"):
        path = landed(spark, sf, f"staged-{fmt}", lambda p, f=fmt: rows.write.option("header", True).format(f).save(p))
        read = snapshots.read_files(spark, path, fmt, rows.schema).select(F.lit(fmt).alias("format"), "event_type", "value")
        out = read if out is None else out.unionByName(read)
    return out.groupBy("format", "event_type").agg(
        F.count("*").alias("events"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total")
    )


@query(
    "s07_outer_array_compressed",
    "SELECT o_orderkey AS id, j::BIGINT AS part FROM orders, (SELECT unnest([0, 1]) AS j)",
)
def _(spark, sf):
    """Gzip files holding arrays of records: one row per element."""

    def write(path):
        key = F.col("o_orderkey")
        pair = F.array(*[F.struct(key.alias("id"), F.lit(i).alias("part")) for i in (0, 1)])
        text = lens.table(spark, sf, "orders").select(F.to_json(pair).alias("value"))
        text.write.option("compression", "gzip").text(path)

    return snapshots.read_files(
        spark, landed(spark, sf, "arrays", write), "json", "id BIGINT, part BIGINT"
    )


@query("s08_named_location", "SELECT event_type, COUNT(*) AS documents FROM events GROUP BY 1")
def _(spark, sf):
    place = snapshots.Location("events_stage", event_lake(spark, sf), "json")
    return place.read(spark, EVENT_SCHEMA).groupBy(F.col("data.event_type").alias("event_type")).agg(
        F.count("*").alias("documents")
    )


@query(
    "s09_partition_scan",
    """SELECT event_id, CAST(day(ts) AS BIGINT) AS day FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'""",
)
def _(spark, sf):
    lake = snapshots.read_lake(spark, event_lake(spark, sf), date(2024, 1, 10), date(2024, 1, 19), EVENT_SCHEMA)
    return lake.select(F.col("data.event.event_id").alias("event_id"), "day")


def stamped_lake(spark, sf) -> str:
    """Event documents as lines under day folders: some stamped with an offset, those of the smallest values cut off."""

    def write(path):
        stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        zone = F.when(F.col("event_type") == "view", "Z").when(F.col("event_type") == "click", "+02:00").otherwise("")
        text = F.to_json(F.struct(F.concat(stamp, zone).alias("extracted_at"), F.lit("events").alias("source"), F.struct("event_id").alias("data")))
        line = F.when(F.col("value") < 1, F.substring(text, 1, 40)).otherwise(text)
        parts = [F.date_format("ts", f).alias(n) for n, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))]
        rows = lens.table(spark, sf, "events").select(line.alias("value"), *parts)
        rows.write.mode("overwrite").partitionBy("year", "month", "day").text(path)

    return landed(spark, sf, "stamped", write)


@query(
    "s09b_lake_tolerant",
    f"""SELECT CAST(day(ts) AS BIGINT) AS day, COUNT_IF(value >= 1)::BIGINT AS documents, COUNT_IF(value < 1)::BIGINT AS unreadable,
  {ts("MIN(CASE WHEN value >= 1 THEN CASE event_type WHEN 'click' THEN ts - INTERVAL 2 HOUR ELSE ts END END)")} AS first_taken
FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' GROUP BY 1""",
)
def _(spark, sf):
    """Offsets are honoured and cut lines are told apart, not read as rows of NULLs."""
    schema = "extracted_at TIMESTAMP_NTZ, source STRING, data STRUCT<event_id: BIGINT>"
    lake = snapshots.read_lake(spark, stamped_lake(spark, sf), date(2024, 1, 5), date(2024, 1, 24), schema)
    bad = snapshots.is_unreadable(lake)
    return lake.select("day", "extracted_at", bad.alias("bad")).groupBy("day").agg(
        F.count_if(~F.col("bad")).alias("documents"), F.count_if("bad").alias("unreadable"), F.min("extracted_at").alias("first_taken")
    )


@query(
    "s10_full_reload",
    DOCUMENTS_SQL + "SELECT market_id, COUNT(*) AS copies, CAST(COALESCE(SUM(n_contracts), 0) AS BIGINT) AS contracts FROM raw GROUP BY 1",
)
def _(spark, sf):
    """Loading the same files twice leaves one copy of each row, contracts included."""
    base = fresh_path(spark, "reload")
    for _round in range(2):
        rows = tables.refresh(flatten_snapshots(read_documents(spark, sf)), base)
    number = F.coalesce(F.array_size("contract_data"), F.lit(0))
    return rows.groupBy("market_id").agg(F.count("*").alias("copies"), F.sum(number).cast("bigint").alias("contracts"))


def _waves(spark, sf):
    """Documents in two parts: taken before 1998 and later."""
    documents, early = lens.documents(spark, sf, lens.laid_together), F.col("extracted_at") < "1998"
    return documents.filter(early), documents.filter(~early)


@query(
    "s11_incremental_load",
    f"WITH {RAW_SQL} SELECT market_status, COUNT(*) AS n, COUNT(DISTINCT market_id) AS markets FROM raw GROUP BY 1",
)
def _(spark, sf):
    """Two waves of files and an idle run: every file is loaded once."""
    landing, target, checkpoint = (fresh_path(spark, n) for n in ("inbox", "raw", "progress"))
    for wave in (*_waves(spark, sf), None):
        if wave is not None:
            files.save_json(wave, landing, "gzip", "append")
        stream = incremental.document_stream(spark, landing, one_per_file=False)
        incremental.append_raw(stream, target, checkpoint).awaitTermination()
    return spark.read.parquet(target).groupBy("market_status").agg(
        F.count("*").alias("n"), F.count_distinct("market_id").alias("markets")
    )


@query("s11b_incremental_upsert", f"WITH {RAW_SQL}, {SUMMARY_SQL} SELECT {SUMMARY_OUT} FROM summary")
def _(spark, sf):
    """The later wave arrives first: older snapshots must not overwrite newer ones."""
    landing, base, checkpoint = (fresh_path(spark, n) for n in ("inbox", "summary", "progress"))
    for wave in reversed(_waves(spark, sf)):
        files.save_json(wave, landing, "gzip", "append")
        stream = incremental.document_stream(spark, landing, one_per_file=False)
        incremental.upsert_summary(stream, base, checkpoint).awaitTermination()
    return tables.read_image(spark, base)


_STAMPED = """CASE l_returnflag WHEN 'A' THEN l_shipdate - INTERVAL 5 HOUR ELSE l_shipdate END"""


@query(
    "s11c_stream_equals_batch",
    f"""SELECT mode, (SELECT COUNT(*) FROM lineitem WHERE l_quantity < 49) AS documents,
  (SELECT COUNT(*) FROM lineitem WHERE l_quantity >= 49) AS unreadable,
  (SELECT {ts(f'MIN({_STAMPED})')} FROM lineitem WHERE l_quantity < 49) AS first_taken,
  (SELECT {ts(f'MAX({_STAMPED})')} FROM lineitem WHERE l_quantity < 49) AS last_taken FROM (VALUES ('batch'), ('stream')) AS t(mode)""",
)
def _(spark, sf):
    """The same files by a load and by a stream: stamps with an offset are read, impossible ones quarantined, by both."""
    documents = lens.table(spark, sf, "lineitem").select(
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("l_returnflag") == "A", "+05:00").otherwise("")).alias("stamp"),
        (F.col("l_quantity") >= 49).alias("odd"),
        F.struct(F.array(F.struct(F.col("l_orderkey").alias("id"))).alias("markets")).alias("data"),
    )
    stamp = F.when(F.col("odd"), F.concat(F.lit("day "), "stamp")).otherwise(F.col("stamp"))
    landing, target, lost = (fresh_path(spark, n) for n in ("inbox", "raw", "lost"))
    documents.select(stamp.alias("extracted_at"), F.lit("s").alias("source"), "data").write.json(landing)
    stream = incremental.document_stream(spark, landing, one_per_file=False)
    incremental.append_raw(stream, target, fresh_path(spark, "progress")).awaitTermination()
    incremental.append_quarantine(stream, lost, fresh_path(spark, "progress")).awaitTermination()
    load = snapshots.load_snapshots(spark, landing, one_per_file=False)
    batch = flatten_snapshots(load.good)

    def facts(mode, raw, bad):
        return raw.agg(
            F.lit(mode).alias("mode"),
            F.count("*").alias("documents"),
            F.min("extraction_timestamp").alias("first_taken"),
            F.max("extraction_timestamp").alias("last_taken"),
        ).withColumn("unreadable", bad.agg(F.count("*").alias("n")).scalar())

    return facts("batch", batch, load.quarantined).unionByName(facts("stream", spark.read.parquet(target), spark.read.parquet(lost)))


@query(
    "s12_table_from_dict",
    "SELECT o_orderkey AS id, o_orderpriority AS label, CAST(o_totalprice AS DOUBLE) AS price, 'orders' AS source_file, true AS stamped FROM orders",
)
def _(spark, sf):
    """A table described by a dict, with audit columns; loaded_at comes from its default."""
    name = "tidemark_described"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    described = {"id": "BIGINT", "label": "VARCHAR(200)", "price": "DECIMAL(18,2)"}
    table_sources.create_table(spark, name, described, fresh_path(spark, "described"))
    lens.table(spark, sf, "orders").createOrReplaceTempView("tidemark_orders_in")
    spark.sql(
        f"""INSERT INTO {name} (id, label, price, source_file)
        SELECT o_orderkey, o_orderpriority, o_totalprice, 'orders' FROM tidemark_orders_in"""
    )
    return spark.table(name).select("id", "label", "price", "source_file", F.col("loaded_at").isNotNull().alias("stamped"))


@query("s13_batch_insert", "SELECT COUNT(*) AS rows, 2 * COUNT(*) AS stored FROM orders")
def _(spark, sf):
    """Two appends; the count of the second comes from its own write."""
    path, rows = fresh_path(spark, "inserted"), lens.table(spark, sf, "orders")
    table_sources.insert_rows(rows, path)
    written = table_sources.insert_rows(rows, path)
    return spark.read.parquet(path).agg(
        F.lit(written).cast("bigint").alias("rows"), F.count("*").alias("stored")
    )


@query(
    "s14_keyed_feed",
    f"""SELECT {ts('ts')} AS extracted_at, 'feed' AS source, event_type AS id, value AS usd, CAST(NULL AS DOUBLE) AS usd_24h_change FROM events
UNION ALL SELECT {ts('ts')}, 'feed', 'user-' || user_id, value * 2, value FROM events""",
)
def _(spark, sf):
    """Objects keyed by id, out of JSON text; a missing attribute is NULL."""
    price, change = F.col("value"), F.lit(None).cast("double")
    keyed = F.create_map(
        F.col("event_type"),
        F.struct(price.alias("usd"), change.alias("usd_24h_change")),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")),
        F.struct((price * 2).alias("usd"), price.alias("usd_24h_change")),
    )
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("extracted_at")
    text = lens.table(spark, sf, "events").select(at, F.lit("feed").alias("source"), keyed.alias("data"))
    return feeds.keyed_records_from_text(files.as_json_text(text))


@query(
    "s15_single_record_feed",
    """SELECT '2024-01-01 00:00:00.000000' AS extracted_at, 'suppliers' AS source, s_name AS name,
       s_acctbal AS main_balance, CAST(s_nationkey AS BIGINT) AS main_nation FROM supplier""",
)
def _(spark, sf):
    record = lens.table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"),
        F.struct(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation")).alias("main"),
    )
    return feeds.single_records(files.envelope(record, "suppliers", datetime(2024, 1, 1)))


# --- sinks ------------------------------------------------------------------------------------


@query(
    "k01_envelope",
    """SELECT '2024-01-01T00:00:00.000000' AS extracted_at, 'orders' AS source,
       '{"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}' AS data FROM orders""",
)
def _(spark, sf):
    rows = lens.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    wrapped = files.envelope(rows, "orders", datetime(2024, 1, 1))
    return wrapped.withColumn("data", F.to_json("data"))


@query(
    "k02_json_sink",
    f"SELECT o_orderkey, o_totalprice, {ts('o_orderdate')} AS o_orderdate, o_orderpriority FROM orders",
)
def _(spark, sf):
    rows = lens.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    return spark.read.schema(rows.schema).json(files.save_json(rows, fresh_path(spark, "json"), "gzip"))


@query(
    "k03_csv_sink",
    DOCUMENTS_SQL
    + "SELECT market_id AS id, market_name AS name, n_contracts IS NULL AS no_contracts FROM raw",
)
def _(spark, sf):
    """The markets array becomes rows, nested arrays JSON text."""
    path = files.save_csv(lens.documents(spark, sf).select("data.markets"), fresh_path(spark, "csv"), compression="gzip")
    read = spark.read.option("header", True).option("escape", '"').csv(path)
    return read.select(F.col("id").cast("bigint").alias("id"), "name", F.col("contracts").isNull().alias("no_contracts"))


@query(
    "k03b_csv_nested_columns",
    """SELECT CAST(event_id AS VARCHAR) AS "event.event_id", CAST(user_id AS VARCHAR) AS "event.user_id" FROM events""",
)
def _(spark, sf):
    nested = event_documents(spark, sf).select("data.event")
    path = files.save_csv(nested, fresh_path(spark, "csv"))
    read = spark.read.option("header", True).csv(path)
    return read.select(F.col("`event.event_id`").alias("event.event_id"), F.col("`event.user_id`").alias("event.user_id"))


@query(
    "k04_format_dispatch",
    """SELECT f AS format, event_type, COUNT(*) AS n FROM events, (SELECT unnest(['csv', 'json']) AS f) GROUP BY ALL""",
)
def _(spark, sf):
    """JSON keeps the envelope, CSV only the data part."""
    documents = event_documents(spark, sf)
    as_json = spark.read.schema(EVENT_SCHEMA).json(files.save(documents, fresh_path(spark, "out"), "json"))
    as_csv = spark.read.option("header", True).csv(files.save(documents, fresh_path(spark, "out"), "csv"))
    both = as_json.select(F.lit("json").alias("format"), "data.event_type").unionByName(
        as_csv.select(F.lit("csv").alias("format"), "event_type")
    )
    return both.groupBy("format", "event_type").agg(F.count("*").alias("n"))


@query(
    "k05_partitioned_write",
    """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, COUNT(*) AS documents,
       COUNT(DISTINCT event_type) AS types FROM events GROUP BY ALL""",
)
def _(spark, sf):
    """Folder names as text, to see their zero padding."""
    rows = spark.read.schema(EVENT_SCHEMA).option("recursiveFileLookup", True).json(event_lake(spark, sf))
    path = F.col("_metadata.file_path")
    parts = [F.regexp_extract(path, rf"/{name}=(\d+)/", 1).alias(name) for name in files.PARTS]
    return rows.select(*parts, "data.event_type").groupBy(*files.PARTS).agg(
        F.count("*").alias("documents"), F.count_distinct("event_type").alias("types")
    )


@query(
    "k06_upload_metadata",
    """SELECT o_orderkey, 'file-' || (o_orderkey % 7) || '.json' AS source_file, '2024-01-01 00:00:00.000000' AS upload_timestamp FROM orders""",
)
def _(spark, sf):
    name = F.concat(F.lit("/tmp/in/file-"), (F.col("o_orderkey") % 7).cast("string"), F.lit(".json"))
    rows = lens.table(spark, sf, "orders").select("o_orderkey")
    return files.with_upload_metadata(rows, name, F.lit(datetime(2024, 1, 1)))


# --- table maintenance --------------------------------------------------------------------------


@query("k07_refresh", f"WITH {MARKETS_SQL} SELECT market_status, COUNT(*) AS n FROM markets GROUP BY 1")
def _(spark, sf):
    base, markets = fresh_path(spark, "refresh"), lens.markets(spark, sf)
    tables.refresh(markets.filter(F.col("market_status") == "Open"), base)
    tables.refresh(markets, base)
    return tables.read_image(spark, base).groupBy("market_status").agg(F.count("*").alias("n"))


@query(
    "k10b_upsert_partitions",
    ALL_TABLES_SQL
    + f""", y AS (SELECT * REPLACE (CAST(date_trunc('month', metric_date) AS DATE) AS metric_date) FROM metrics)
SELECT market_id, {date_text('metric_date')} AS metric_date,
       total_contracts + CASE WHEN metric_date >= DATE '2001-01-01' THEN 1 ELSE 0 END AS total_contracts FROM y""",
)
def _(spark, sf):
    """Metrics partitioned by month; a second run changes the last months only."""
    path = fresh_path(spark, "daily")
    metrics = lens.metrics(spark, sf).withColumn("metric_date", F.trunc("metric_date", "month"))
    metrics = metrics.select("metric_date", "market_id", "total_contracts")
    tables.upsert_partitions(spark, path, metrics, model.DAILY_KEYS, ["total_contracts"], "metric_date")
    late = metrics.filter(F.col("metric_date") >= F.lit(date(2001, 1, 1)))
    late = late.withColumn("total_contracts", F.col("total_contracts") + 1)
    tables.upsert_partitions(spark, path, late, model.DAILY_KEYS, ["total_contracts"], "metric_date")
    return spark.read.parquet(path)


@query(
    "k10c_merge_managed_days",
    ALL_TABLES_SQL
    + f""", y AS (SELECT * REPLACE (CAST(date_trunc('month', metric_date) AS DATE) AS metric_date) FROM metrics)
SELECT market_id, {date_text('metric_date')} AS metric_date,
       total_contracts + CASE WHEN metric_date >= DATE '2001-01-01' THEN 1 ELSE 0 END AS total_contracts FROM y""",
)
def _(spark, sf):
    """The same, each version put in place by the commit log: a failure or a second writer leaves no half-written month."""
    table = ManagedTable(spark, fresh_path(spark, "months"), by_value("metric_date"))
    metrics = lens.metrics(spark, sf).withColumn("metric_date", F.trunc("metric_date", "month"))
    metrics = metrics.select("metric_date", "market_id", "total_contracts")
    table.merge(metrics, model.DAILY_KEYS, ["total_contracts"], ("months", 0))
    late = metrics.filter(F.col("metric_date") >= F.lit(date(2001, 1, 1)))
    late = late.withColumn("total_contracts", F.col("total_contracts") + 1)
    for _repeated in range(2):
        table.merge(late, model.DAILY_KEYS, ["total_contracts"], ("months", 1))
    return table.read()


@query("k11d_bucketed_merge", MERGED_SUMMARY_SQL + f" SELECT {SUMMARY_OUT} FROM merged")
def _(spark, sf):
    """The merge of k08 into a table of key buckets: only buckets with a source row are read and written."""
    target, source = merge_sides(spark, sf)
    table = ManagedTable(spark, fresh_path(spark, "bucketed"), by_hash(["market_id"], 32))
    table.replace(target)
    table.merge(source, ["market_id"], model.SUMMARY_UPDATES, insert_columns=model.SUMMARY_INSERTS, check_unique=False)
    return table.read()


@query("k15_trend_table", TABLES_SQL + f"SELECT market_status, COUNT(*) AS markets, COUNT_IF(avg_price IS NULL)::BIGINT AS unpriced FROM (SELECT m.market_id, market_status, AVG(last_trade_price) AS avg_price FROM markets m LEFT JOIN contracts c USING (market_id) GROUP BY ALL) GROUP BY 1")
def _(spark, sf):
    """Trends kept as a catalog table, replaced by a later run."""
    base, name = fresh_path(spark, "trends"), "tidemark_trends"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    frame = trends(spark, sf)
    tables.create_or_replace(frame.limit(0), name, base)
    table = tables.create_or_replace(frame, name, base)
    return table.groupBy("market_status").agg(
        F.count("*").alias("markets"), F.count_if(F.col("avg_price").isNull()).alias("unpriced")
    )


@query(
    "k16_create_with_defaults",
    """SELECT c_custkey AS market_id, c_name AS market_name, 0.0::DOUBLE AS total_volume, true AS stamped FROM customer""",
)
def _(spark, sf):
    name = "tidemark_defaults"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    described = {
        "market_id": "BIGINT",
        "market_name": "VARCHAR(500)",
        "total_volume": "DECIMAL(18,2)",
        "last_updated": "TIMESTAMP_NTZ",
    }
    location = fresh_path(spark, "defaults")
    for _again in range(2):
        table_sources.create_table(
            spark,
            name,
            described,
            location,
            audit=False,
            defaults={"total_volume": "0.00", "last_updated": "localtimestamp()"},
        )
    lens.table(spark, sf, "customer").createOrReplaceTempView("tidemark_customers")
    spark.sql(f"INSERT INTO {name} (market_id, market_name) SELECT c_custkey, c_name FROM tidemark_customers")
    return spark.table(name).select(
        "market_id", "market_name", "total_volume", F.col("last_updated").isNotNull().alias("stamped")
    )


@query("k17_truncate", "SELECT COUNT(*) AS before, CAST(0 AS BIGINT) AS after FROM orders")
def _(spark, sf):
    base = fresh_path(spark, "truncated")
    before = tables.refresh(lens.table(spark, sf, "orders"), base).agg(F.count("*").alias("before"))
    after = tables.truncate(spark, base).agg(F.count("*"))
    return before.select("before", after.scalar().alias("after"))


# --- quality ------------------------------------------------------------------------------------


def _check_sql(name: str, level: str, issues: str) -> str:
    return f"SELECT '{name}' AS check_name, '{level}' AS level, {issues} AS issue_count, {issues} = 0 AS passed"


@query("dq1_not_empty", _check_sql("staging has rows", "fail", "CAST(0 AS BIGINT)"))
def _(spark, sf):
    return quality.not_empty(read_documents(spark, sf).select("source"), "staging has rows")


@query(
    "dq2_empty_table_found",
    f"WITH {MARKETS_SQL} " + _check_sql("no such status", "fail", "(SELECT CAST(COUNT(*) = 0 AS BIGINT) FROM markets WHERE market_status = 'Void')"),
)
def _(spark, sf):
    return quality.not_empty(lens.markets(spark, sf).filter(F.col("market_status") == "Void"), "no such status")


@query(
    "dq3_null_keys",
    f"WITH {RAW_SQL} " + _check_sql("keys present", "warn", "(SELECT COUNT(*) FROM raw WHERE market_id IS NULL OR n_contracts IS NULL)"),
)
def _(spark, sf):
    return quality.null_keys(lens.raw(spark, sf), ["market_id", "contract_data"], "keys present")


@query(
    "dq4_sample",
    f"WITH {RAW_SQL} SELECT market_id, market_name, {ts('extraction_timestamp')} AS extraction_timestamp FROM raw ORDER BY market_id, raw.extraction_timestamp, market_name LIMIT 3",
)
def _(spark, sf):
    rows = lens.raw(spark, sf).select("market_id", "market_name", "extraction_timestamp")
    return reports.sample_rows(rows, ["market_id", "extraction_timestamp", "market_name"], 3)


@query(
    "dq5_presence_profile",
    f"""WITH {RAW_SQL} SELECT 'Data Check' AS test, COUNT(*) AS total_rows, COUNT(market_id) AS rows_with_market_id,
  COUNT(market_name) AS rows_with_market_name, COUNT(n_contracts) AS rows_with_contracts,
  MIN(market_id) AS min_market_id, MAX(market_id) AS max_market_id FROM raw""",
)
def _(spark, sf):
    present = {
        "rows_with_market_id": "market_id",
        "rows_with_market_name": "market_name",
        "rows_with_contracts": "contract_data",
    }
    return quality.presence_profile(lens.raw(spark, sf), present, "market_id")


@query(
    "dq6_null_key_counts",
    TABLES_SQL
    + """SELECT 'markets without id' AS check_name, COUNT(*) AS issue_count FROM markets WHERE market_id IS NULL
UNION ALL SELECT 'contracts without price', COUNT(*) FROM contracts WHERE last_trade_price IS NULL""",
)
def _(spark, sf):
    return quality.null_key_counts(
        {
            "markets without id": (lens.markets(spark, sf), "market_id"),
            "contracts without price": (lens.contracts(spark, sf), "last_trade_price"),
        }
    )


@query(
    "dq7_row_counts",
    TABLES_SQL
    + "SELECT 'markets' AS table_name, COUNT(*) AS row_count FROM markets UNION ALL SELECT 'contracts', COUNT(*) FROM contracts",
)
def _(spark, sf):
    return reports.row_counts({"markets": lens.markets(spark, sf), "contracts": lens.contracts(spark, sf)})


@query(
    "dq8_freshness",
    f"""SELECT 'Data Freshness' AS check_type, {ts('MAX(ts)')} AS latest_data_timestamp,
       date_diff('hour', MAX(ts), TIMESTAMP '2024-02-02 00:00:00') AS hours_since_update FROM events""",
)
def _(spark, sf):
    return reports.data_freshness(lens.table(spark, sf, "events"), "ts", datetime(2024, 2, 2))


@query("dq9_landed_files", _check_sql("landed files not empty", "fail", "CAST(0 AS BIGINT)"))
def _(spark, sf):
    return quality.landed_files(spark, event_lake(spark, sf))


@query(
    "dq9b_landing_manifest",
    "SELECT event_type, COUNT(*) AS documents, CAST(2 AS BIGINT) AS lost FROM events GROUP BY 1",
)
def _(spark, sf):
    """Landed events, counted; then the file of the smallest path goes missing and that of the largest is emptied."""
    path = fresh_path(spark, "landing")
    files.save_by_date(event_documents(spark, sf), path, "extracted_at")
    manifest.record(spark, path)
    read = spark.read.schema("data STRUCT<event_type: STRING>").json(path)
    counted = stored(read.groupBy(F.col("data.event_type").alias("event_type")).agg(F.count("*").alias("documents")), "counted")
    first, last = manifest.recorded(spark, path).agg(F.min("path"), F.max("path")).first()
    fs, place = hadoop_fs(spark, first)
    fs.delete(place, False)
    fs, place = hadoop_fs(spark, last)
    fs.create(place, True).close()
    lost = manifest.issues(spark, path).where("issue = 'lost'").agg(F.count("*").alias("n"))
    return counted.withColumn("lost", lost.scalar())


@query(
    "dq10_keys_and_references",
    f"""WITH d AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1),
o AS (SELECT COUNT(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))
{_check_sql('line key unique', 'info', '(SELECT COUNT(*) FROM d)')}
UNION ALL {_check_sql('orders have lines', 'info', '(SELECT n FROM o)')}
UNION ALL {_check_sql('order key unique', 'info', 'CAST(0 AS BIGINT)')}""",
)
def _(spark, sf):
    lines, orders = lens.table(spark, sf, "lineitem"), lens.table(spark, sf, "orders")
    parents = lines.select(F.col("l_orderkey").alias("o_orderkey"))
    return quality.quality_report(
        [
            quality.duplicate_keys(lines, ["l_orderkey", "l_linenumber"], "line key unique"),
            quality.orphans(orders, parents, "o_orderkey", "orders have lines"),
            quality.duplicate_keys(orders, ["o_orderkey"], "order key unique"),
        ]
    )


# --- composite ----------------------------------------------------------------------------------


@query(
    "x7_load_snapshots",
    f"""SELECT CAST(unreadable AS VARCHAR) AS unreadable, COUNT(*) AS documents FROM (SELECT {_BROKEN} AS unreadable FROM lineitem) GROUP BY 1""",
)
def _(spark, sf):
    """One pass over the files writes readable and unreadable documents side by side."""
    target = fresh_path(spark, "landed")
    snapshots.land_snapshots(spark, broken_files(spark, sf), target, one_per_file=False, pattern="*.txt.gz")
    return spark.read.parquet(target).groupBy(F.col("unreadable").cast("string").alias("unreadable")).agg(
        F.count("*").alias("documents")
    )


@query(
    "x13_quality_report",
    DOCUMENTS_SQL
    + _check_sql("raw has rows", "fail", "CAST(0 AS BIGINT)")
    + " UNION ALL "
    + _check_sql("raw keys present", "warn", "CAST(0 AS BIGINT)")
    + " UNION ALL "
    + _check_sql("market_id unique", "info", "CAST(0 AS BIGINT)")
    + " UNION ALL "
    + _check_sql("contract_id unique", "info", "CAST(0 AS BIGINT)")
    + " UNION ALL "
    + _check_sql("contracts have a market", "info", "(SELECT COUNT(*) FROM details d ANTI JOIN summary s USING (market_id))")
    + " UNION ALL "
    + _check_sql("one metric row per market and day", "info", "CAST(0 AS BIGINT)"),
)
def _(spark, sf):
    """The whole refresh from landed files to tables, then its checks."""
    result = refresh.run(spark, document_files(spark, sf), fresh_path(spark, "warehouse"), date(2002, 1, 1), one_per_file=False)
    return result.checks


_REFRESHED_METRICS_SQL = f"""SELECT s.market_id, '2002-01-01' AS metric_date, COUNT(DISTINCT contract_id) AS total_contracts,
       {dbl('COALESCE(SUM(last_trade_price), 0)')} AS total_volume, {rnd('COALESCE(AVG(last_trade_price), 0)', 6)} AS avg_trade_price,
       {rnd('COALESCE(STDDEV_SAMP(CAST(last_trade_price AS DOUBLE)), 0)', 6)} AS price_volatility
FROM summary s LEFT JOIN details d USING (market_id) GROUP BY s.market_id"""


def _metrics_out(daily):
    return daily.select(
        "market_id",
        "metric_date",
        "total_contracts",
        "total_volume",
        rounded("avg_trade_price", 6).alias("avg_trade_price"),
        rounded("price_volatility", 6).alias("price_volatility"),
    )


@query(
    "x11b_refresh_from_files",
    DOCUMENTS_SQL + _REFRESHED_METRICS_SQL,
)
def _(spark, sf):
    result = refresh.run(spark, document_files(spark, sf), fresh_path(spark, "warehouse"), date(2002, 1, 1), one_per_file=False)
    return _metrics_out(result.daily_metrics)


_KEPT_UP: dict[tuple[str, str], upkeep.Warehouse] = {}


def _batch_files(spark, sf) -> list[str]:
    """The snapshot documents as three batches of files, the newest first; each batch has its own folder."""
    documents, taken = lens.documents(spark, sf, lens.laid_together), F.col("extracted_at")
    newest, oldest = (F.coalesce(when, F.lit(False)) for when in (taken >= "2000", taken < "1997"))  # undated ones lie in the middle
    batches = [documents.where(newest), documents.where(~newest & ~oldest), documents.where(oldest)]
    return [
        landed(spark, sf, f"batch{n}", lambda path, rows=rows: files.save_json(rows, path, "gzip")) for n, rows in enumerate(batches)
    ]


def kept_up(spark, sf) -> upkeep.Warehouse:
    """All tables after three batches, the newest snapshots first and the oldest twice; once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _KEPT_UP:
        waves = [snapshots.read_documents(spark, path, one_per_file=False) for path in _batch_files(spark, sf)]
        warehouse = upkeep.Warehouse.at(spark, fresh_path(spark, "upkeep"), buckets=16, period="year")
        for number, wave in [*enumerate(waves), (2, waves[2])]:
            upkeep.apply_batch(wave, warehouse, number, metric_date=date(2002, 1, 1))
            warehouse.prune(keep=1, least_age=0)  # no one else reads or writes these tables
        _KEPT_UP[key] = warehouse
    return _KEPT_UP[key]


@query("x11c_incremental_equals_full", DOCUMENTS_SQL + _REFRESHED_METRICS_SQL)
def _(spark, sf):
    """Daily metrics kept up batch by batch equal those of a full refresh."""
    return _metrics_out(kept_up(spark, sf).daily_metrics.read())


@query("x11d_incremental_details", DOCUMENTS_SQL + f"SELECT {DETAILS_OUT} FROM details")
def _(spark, sf):
    return kept_up(spark, sf).contract_details.read()


@query("x11e_incremental_summary", f"WITH {RAW_SQL}, {SUMMARY_SQL} SELECT {SUMMARY_OUT} FROM summary")
def _(spark, sf):
    return kept_up(spark, sf).market_summary.read()


@query(
    "x2_upsert_published_table",
    f"WITH {RAW_SQL}, {SUMMARY_SQL} SELECT market_status, COUNT(*) AS n, {big('SUM(total_contracts)')} AS total_contracts FROM summary GROUP BY 1",
)
def _(spark, sf):
    """A published table merged with itself: counts show updates only, rows stay."""
    base = fresh_path(spark, "upsert")
    summary = stored(model.market_summary(lens.raw(spark, sf)), "summary")  # both merges read it
    for _twice in range(2):
        tables.upsert_table(spark, base, summary, ["market_id"], model.SUMMARY_UPDATES, insert_columns=model.SUMMARY_INSERTS, held=True)
    return tables.read_image(spark, base).groupBy("market_status").agg(
        F.count("*").alias("n"), F.sum("total_contracts").alias("total_contracts")
    )
