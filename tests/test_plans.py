"""Shapes of physical plans that matter at scale."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.bindings import lens
from tidemark.operators import aggregate, joins, latest, merge
from tidemark.bindings import lens
from tidemark.plans import model, reports
from tidemark.sinks import files
from tidemark.sources import snapshots

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_prunes_before_the_exchange(spark):
    text = plan(latest.latest_per_key(lens.table(spark, SF, "events"), ["user_id"], ["ts"], ["event_id"]))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_keep_latest_aggregates_before_its_join(spark):
    text = plan(latest.keep_latest_rows(lens.table(spark, SF, "events"), "user_id", "ts", has_null_keys=False))
    assert "Window" not in text and "partial_max" in text and text.count("Join") == 1


def test_hot_parent_join_can_be_split(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parents = lens.markets(spark, SF).select("market_id")
        children = lens.contract_versions(lens.table(spark, SF, "lineitem")).select("market_id", "contract_id")
        text = plan(joins.with_children(parents, children, "market_id"))
        assert "Inner" in text and "LeftAnti" in text and "LeftOuter" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_copies_of_the_newest_pair_are_split_over_tasks(spark):
    """Two thirds of the rows are copies of one pair: AQE splits them, none is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        copies = F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id"))
        df = spark.range(0, 30_000, 1, 6).select(copies.alias("k"), (F.lit(5) - copies % 2).alias("t"), F.uuid().alias("pad"))
        kept = latest.keep_latest_rows(df, "k", "t", has_null_keys=False)
        assert len(kept.collect()) == 30_000
        assert "skew=true" in plan(kept)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("has_null_keys", [True, False])
def test_no_nested_loops_in_not_in(spark, has_null_keys):
    events = lens.table(spark, SF, "events")
    kept = latest.keep_latest_rows(events, "user_id", "ts", has_null_keys)
    marked = merge.mark_stale(events, events, "user_id", "event_type", "ts", 7, datetime(2024, 1, 31))
    for df in (kept, marked):
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


def test_top_k_is_one_operator(spark):
    assert "TakeOrderedAndProject" in plan(reports.top_markets_by_contracts(lens.markets(spark, SF)))


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(reports.active_markets(lens.markets(spark, SF)).select("market_id"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text
    lines = lens.table(spark, SF, "lineitem").filter(F.col("l_discount") > 0).select("l_orderkey")
    assert "GreaterThan(l_discount,0.0)" in plan(lines)


def test_contracts_are_aggregated_before_the_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = lens.contract_versions(lens.table(spark, SF, "lineitem"))
        for df in (
            reports.overall_statistics(lens.markets(spark, SF), lines),
            reports.markets_by_average_price(lens.markets(spark, SF), lines),
            model.daily_metrics(lens.markets(spark, SF), lines, date(2024, 1, 1), contracts_unique=True),
        ):
            text = plan(df)
            join = text.index("SortMergeJoin")
            assert "HashAggregate" in text[join:], "no aggregation below the join"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_groups_share_without_single_partition_window(spark):
    text = plan(aggregate.share_of_total(lens.table(spark, SF, "events"), ["user_id"], "n", "s", few_groups=False))
    assert "Window" not in text and "Subquery" in text


def test_small_merge_does_not_shuffle_the_target(spark):
    target = lens.markets(spark, SF)
    source = target.filter(F.col("market_id") < 10)
    image = merge.merge_upsert(target, source, ["market_id"], ["market_status"], check_unique=False)
    kept = plan(image).split("Union")[1]
    assert "BroadcastHashJoin" in kept and "SortMergeJoin" not in kept.split("BroadcastExchange")[0]


def test_lake_days_are_pruned(spark, tmp_path):
    df = lens.table(spark, SF, "events").select("event_id", "ts")
    files.save_by_date(df, str(tmp_path), "ts", "parquet", "overwrite")
    lake = spark.read.parquet(str(tmp_path)).filter(snapshots.in_days(date(2024, 1, 3), date(2024, 1, 4)))
    text = plan(lake)
    assert "PartitionFilters: [" in text and "make_date" in text.split("PartitionFilters")[1]
    lake.collect()
    metric = lake._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().get("numFiles")
    assert metric.get().value() <= 8


def test_counting_contracts_reads_one_attribute(spark, tmp_path):
    lens.raw(spark, SF).write.parquet(str(tmp_path / "raw"))
    text = plan(model.market_summary(spark.read.parquet(str(tmp_path / "raw"))).select("market_id", "total_contracts"))
    assert "contract_data:array<struct<id:bigint>>" in text


def test_no_python_in_plans(spark):
    raw = lens.raw(spark, SF)
    for df in (model.market_summary(raw), model.contract_details(raw), reports.price_distribution(lens.contracts(spark, SF))):
        assert "Python" not in plan(df) and "Pandas" not in plan(df)


def test_documents_are_built_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    """One row group, a part holding a third of its rows: dealt over many tasks, each far from the whole; no row lost."""
    monkeypatch.setattr(lens, "ROWS_PER_TASK", 500)
    monkeypatch.setattr(lens, "RUN", 200)
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_partkey")).cast("bigint")
    lines.withColumn("l_partkey", hot).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    documents = lens.documents(spark, str(tmp_path))
    sizes = [r.n for r in documents.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    total = lines.count()
    assert sum(sizes) == total and len(sizes) >= total // 1000 and max(sizes) <= 1500


def test_k13_newest_rows_are_chosen_before_the_exchange(spark):
    """No key is NULL or hot: the rows are ranked, and a map task sends only the newest ones of its keys."""
    raw = lens.raw(spark, SF)
    text = plan(latest.keep_latest_rows(raw, "market_id", "extraction_timestamp"))
    assert text.count("WindowGroupLimit") == 2 and "Join" not in text


@pytest.mark.parametrize("undated", [0, 4])
def test_k13_ranked_rows_equal_joined_ones(spark, rows, monkeypatch, undated):
    time = F.when(F.col("id") % 5 >= undated, F.col("id") % 7)
    df = spark.range(0, 500, 1, 6).select((F.col("id") % 11).alias("k"), time.alias("t"), F.array("id").alias("a"))
    ranked = latest.keep_latest_rows(df, "k", "t")
    assert "Window" in plan(ranked)
    monkeypatch.setattr(latest, "HOT_KEY", 10)
    joined = latest.keep_latest_rows(df, "k", "t")
    assert "Window" not in plan(joined)
    assert rows(ranked) == rows(joined) == rows(latest.keep_latest_rows(df, "k", "t", has_null_keys=False))
    assert latest.keep_latest_rows(df.where("k < 0"), "k", "t").count() == 0
