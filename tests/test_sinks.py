from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.session import shared_dir, stored
from tidemark.sinks import files, tables
from tidemark.sinks.commits import CommitConflict


def test_json_keeps_odd_types_as_text(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, INTERVAL '1' DAY AS i, CAST('x' AS BINARY) AS b, CAST(1.50 AS DECIMAL(4,2)) AS d")
    path = files.save_json(df, str(tmp_path / "j"))
    row = spark.read.json(path).first()
    assert row.id == 1 and row.b == "x" and "1" in row.i and row.d == 1.5


def test_csv_rows_from_markets(spark, tmp_path, rows):
    df = spark.sql("SELECT array(struct(1 AS id, struct('x' AS b) AS a, array(1) AS l), named_struct('id', 2, 'a', struct('y' AS b), 'l', array(2, 3))) AS markets")
    path = files.save_csv(df, str(tmp_path / "c"))
    assert rows(spark.read.option("header", True).option("escape", '"').csv(path)) == [("1", "x", "[1]"), ("2", "y", "[2,3]")]


def test_format_dispatch(spark, tmp_path):
    wrapped = files.envelope(spark.range(2), "src", datetime(2024, 1, 1))
    assert wrapped.first().extracted_at == "2024-01-01T00:00:00.000000"
    assert spark.read.json(files.save(wrapped, str(tmp_path / "a"))).columns == ["data", "extracted_at", "source"]
    assert spark.read.option("header", True).csv(files.save(wrapped, str(tmp_path / "b"), "CSV")).columns == ["id"]
    with pytest.raises(ValueError, match="Unsupported format"):
        files.save(wrapped, str(tmp_path / "c"), "xml")


def test_date_folders_are_padded(spark, tmp_path):
    df = spark.createDataFrame([(1, datetime(2024, 3, 5))], "id INT, ts TIMESTAMP_NTZ")
    files.save_by_date(df, str(tmp_path / "lake"), "ts")
    assert (tmp_path / "lake" / "year=2024" / "month=03" / "day=05").is_dir()


def test_publish_keeps_the_old_image_until_committed(spark, tmp_path, rows):
    base = str(tmp_path / "t")
    tables.publish(spark.range(3), base)
    with pytest.raises(Exception):
        tables.publish(spark.range(3).select(F.raise_error(F.lit("lost")).alias("id")), base)
    assert rows(tables.read_image(spark, base)) == [(0,), (1,), (2,)]
    assert tables.refresh(spark.range(1), base).count() == 1
    assert tables.truncate(spark, base).count() == 0
    assert tables.read_image(spark, base).columns == ["id"]


def test_catalog_table_follows_the_image(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS followed")
    base = str(tmp_path / "t")
    assert tables.create_or_replace(spark.range(3), "followed", base).count() == 3
    assert tables.create_or_replace(spark.range(5), "followed", base).count() == 5
    assert spark.table("followed").count() == 5
    spark.sql("DROP TABLE followed")


def test_upsert_table_counts(spark, tmp_path, rows):
    base = str(tmp_path / "t")
    frame = lambda ids, v: spark.createDataFrame([(i, v) for i in ids], "k BIGINT, v STRING")
    assert tables.upsert_table(spark, base, frame([1, 2], "a"), ["k"], ["v"]) == {"inserted": 2, "updated": 0, "kept": 0}
    assert tables.upsert_table(spark, base, frame([2, 3], "b"), ["k"], ["v"]) == {"inserted": 1, "updated": 1, "kept": 1}
    assert rows(tables.read_image(spark, base)) == [(1, "a"), (2, "b"), (3, "b")]


def test_a_held_source_is_not_stored_again(spark, tmp_path, rows):
    """Two merges of one stored frame: the same counts and rows, and no further copy of it under the shared folder."""
    source = stored(spark.createDataFrame([(1, "a"), (2, "b")], "k BIGINT, v STRING"))
    copies = lambda: len(list(Path(shared_dir(spark)).glob("source-*")))
    base, before = str(tmp_path / "t"), copies()
    assert tables.upsert_table(spark, base, source, ["k"], ["v"], held=True) == {"inserted": 2, "updated": 0, "kept": 0}
    assert tables.upsert_table(spark, base, source, ["k"], ["v"], held=True) == {"inserted": 0, "updated": 2, "kept": 0}
    assert rows(tables.read_image(spark, base)) == [(1, "a"), (2, "b")] and copies() == before


def test_two_writers_of_an_image_lose_nothing(spark, tmp_path, rows):
    base, done = str(tmp_path / "t"), []
    frame = lambda ids, v: spark.createDataFrame([(i, v) for i in ids], "k BIGINT, v STRING")
    tables.refresh(frame([1, 2, 3], "a"), base)

    def interrupt():
        if not done:
            done.append(tables.upsert_table(spark, base, frame([1, 2], "theirs"), ["k"], ["v"]))

    counts = tables.upsert_table(spark, base, frame([2, 4], "ours"), ["k"], ["v"], before_commit=interrupt)
    assert counts == {"inserted": 1, "updated": 1, "kept": 2}
    assert rows(tables.read_image(spark, base)) == [(1, "theirs"), (2, "ours"), (3, "a"), (4, "ours")]


@pytest.mark.parametrize("pruned", [False, True])
def test_a_refresh_that_comes_second(spark, tmp_path, monkeypatch, pruned):
    """It replaces the image that came first; if its own was taken for a crashed one, that is an error, not a lost table."""
    base, write, done = str(tmp_path / "t"), tables._write_image, []
    tables.refresh(spark.range(1), base)

    def slow(df, *args):
        name = write(df, *args)
        if not done:
            done.append(name)
            tables.refresh(spark.range(5), base)
            if pruned:
                (tmp_path / "t" / name).rename(tmp_path / "t" / "pruned")
        return name

    monkeypatch.setattr(tables, "_write_image", slow)
    if pruned:
        with pytest.raises(CommitConflict):
            tables.refresh(spark.range(2), base)
    else:
        tables.refresh(spark.range(2), base)
    assert tables.read_image(spark, base).count() == (5 if pruned else 2)


def test_partition_upsert_leaves_other_partitions_alone(spark, tmp_path, rows):
    path = str(tmp_path / "daily")
    frame = lambda data: spark.createDataFrame(data, "d STRING, k BIGINT, v STRING")
    tables.upsert_partitions(spark, path, frame([("x", 1, "a"), ("y", 1, "a")]), ["d", "k"], ["v"], "d")
    before = sorted(p.name for p in (tmp_path / "daily" / "d=x").glob("*.parquet"))
    tables.upsert_partitions(spark, path, frame([("y", 1, "b"), ("y", 2, "b")]), ["d", "k"], ["v"], "d")
    assert rows(spark.read.parquet(path), "d", "k", "v") == [("x", 1, "a"), ("y", 1, "b"), ("y", 2, "b")]
    assert sorted(p.name for p in (tmp_path / "daily" / "d=x").glob("*.parquet")) == before
    with pytest.raises(ValueError):
        tables.upsert_partitions(spark, path, frame([]), ["k"], ["v"], "d")


def test_null_partition_survives_an_upsert(spark, tmp_path, rows):
    path = str(tmp_path / "daily")
    frame = lambda data: spark.createDataFrame(data, "d STRING, k BIGINT, v STRING")
    tables.upsert_partitions(spark, path, frame([("x", 1, "a"), (None, 1, "a")]), ["d", "k"], ["v"], "d")
    for limit in (1000, 0):
        tables.PARTITION_LIST = limit
        tables.upsert_partitions(spark, path, frame([("x", 1, f"b{limit}"), (None, 2, "n")]), ["d", "k"], ["v"], "d")
    tables.PARTITION_LIST = 1000
    got = rows(spark.read.parquet(path), "d", "k", "v")
    assert got == sorted([("x", 1, "b0"), (None, 1, "a"), (None, 2, "n"), (None, 2, "n")], key=repr)


def test_old_images_are_removed(spark, tmp_path):
    base = str(tmp_path / "t")
    for n in range(4):
        tables.publish(spark.range(n), base)
    assert len(tables.prune_images(spark, base, keep=2)) == 2
    assert tables.read_image(spark, base).count() == 3
    with pytest.raises(ValueError):
        tables.prune_images(spark, base, keep=0)


def test_quality_levels(spark):
    empty = spark.range(0)
    report = quality.quality_report([quality.not_empty(empty, "has rows"), quality.null_keys(empty, ["id"], "keys")])
    with pytest.raises(quality.QualityError, match="has rows"):
        quality.enforce(report)
    warned = quality.null_keys(spark.sql("SELECT CAST(NULL AS INT) AS id"), ["id"], "keys")
    assert quality.enforce(warned).first().issue_count == 1


def test_checks_taken_while_writing(spark, tmp_path, rows):
    base = str(tmp_path / "t")
    checks = [quality.has_rows("has rows"), quality.keys_present(["k"], "keys")]
    frame = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k INT")
    table, report = tables.refresh_checked(frame(1, None), base, checks)
    assert rows(report) == [("has rows", "fail", 0, True), ("keys", "warn", 1, False)] and table.count() == 2
    with pytest.raises(quality.QualityError, match="has rows"):
        tables.refresh_checked(frame(1).where("k > 5"), base, checks)
    assert tables.read_image(spark, base).count() == 2
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("image=")]) == 1


def test_family_checks_scan_each_table_once(spark, tmp_path, rows):
    child = spark.createDataFrame([(1, 1), (1, 1), (2, 2), (3, 9), (4, None)], "c INT, k INT")
    parent = spark.createDataFrame([(1,), (2,), (2,), (5,), (None,)], "k INT")
    names = ("parents", "children", "lost")
    assert rows(quality.family_checks(child, parent, "k", "c", names), "check_name", "issue_count") == [("children", 1), ("lost", 1), ("parents", 1)]
    child.write.parquet(str(tmp_path / "c"))
    parent.write.parquet(str(tmp_path / "p"))
    report = quality.family_checks(spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "p")), "k", "c", names)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") - plan.count("RelationV2") <= 3  # the parent, and the stored counts twice
    empty = quality.family_checks(child.limit(0), parent.limit(0), "k", "c", names)
    assert rows(empty, "issue_count") == [(0,), (0,), (0,)]


def test_orphans_and_duplicates(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k INT")
    parent = spark.createDataFrame([(2,)], "k INT")
    assert quality.orphans(child, parent, "k", "o").first().issue_count == 2
    assert quality.duplicate_keys(child, ["k"], "d").first().issue_count == 1
