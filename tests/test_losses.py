"""Inputs that earlier versions lost, duplicated or mislaid."""

import json
from datetime import datetime

import pytest
from pyspark.sql import types as T

from tidemark.operators import merge, quality
from tidemark.plans import refresh
from tidemark.sinks import tables
from tidemark.sources import snapshots
from tidemark.streaming import incremental


def document(price="0.5000", at="2024-01-01T00:00:00", markets=1):
    contract = {"id": 1, "name": "c", "lastTradePrice": price}
    rows = [{"id": m, "name": f"m{m}", "contracts": [contract]} for m in range(markets)]
    return {"extracted_at": at, "source": "s", "data": {"markets": rows}}


def land(path, **documents):
    path.mkdir(exist_ok=True)
    for name, value in documents.items():
        (path / f"{name}.json").write_text(json.dumps(value))
    return str(path)


def test_a_document_with_one_bad_field_is_in_exactly_one_output(spark, tmp_path):
    path = land(tmp_path / "in", good=document(), bad=document("n/a"))
    load = snapshots.load_snapshots(spark, path)
    for frame in (load.good, load.good.select("extracted_at"), load.good.select("source_file")):
        assert frame.count() == len(frame.collect()) == 1
    assert load.quarantined.count() == len(load.quarantined.collect()) == 1
    stats = {r.source_file.rsplit("/", 1)[1]: (r.rows_loaded, r.errors_seen) for r in load.stats.collect()}
    assert stats == {"good.json": (1, 0), "bad.json": (0, 1)}


def test_stream_and_batch_keep_the_same_documents(spark, tmp_path):
    path = land(tmp_path / "in", good=document(), bad=document("n/a"))
    stream = incremental.document_stream(spark, path)
    incremental.append_raw(stream, str(tmp_path / "raw"), str(tmp_path / "c1")).awaitTermination()
    incremental.append_quarantine(stream, str(tmp_path / "lost"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 1
    assert spark.read.parquet(str(tmp_path / "lost")).count() == 1


@pytest.mark.parametrize(
    ("text", "moment"),
    [
        ("2024-01-01T10:00:00", datetime(2024, 1, 1, 10)),
        ("2024-01-01T10:00:00.250000", datetime(2024, 1, 1, 10, 0, 0, 250000)),
        ("2024-01-01T10:00:00Z", datetime(2024, 1, 1, 10)),
        ("2024-01-01T10:00:00+02:00", datetime(2024, 1, 1, 8)),
        (None, None),
    ],
)
def test_timestamps_with_and_without_offset(spark, tmp_path, text, moment):
    load = snapshots.load_snapshots(spark, land(tmp_path / "in", a=document(at=text)))
    assert [r.extracted_at for r in load.good.collect()] == [moment]


def test_offsets_behind_blanks_are_read_without_trimming_every_text(spark, tmp_path):
    stamps = ["2024-01-01T10:00:00+02:00 ", "2024-01-01T08:00:00Z\n", "2024-01-01T10:00:00+0200", "2024-01-01T08:00:00 "]
    documents = {f"d{i}": document(at=at) for i, at in enumerate(stamps)}
    read = snapshots.read_documents(spark, land(tmp_path / "in", **documents))
    assert {r.extracted_at for r in read.collect()} == {datetime(2024, 1, 1, 8)}
    assert "trim(" not in read._jdf.queryExecution().optimizedPlan().toString()


def test_a_timestamp_that_is_none_is_an_error(spark, tmp_path):
    load = snapshots.load_snapshots(spark, land(tmp_path / "in", a=document(at="soon")))
    assert load.good.count() == 0 and load.quarantined.count() == 1


def test_any_schema_can_be_loaded(spark, tmp_path):
    path = land(tmp_path / "in", a=document())
    load = snapshots.load_snapshots(spark, path, schema="data STRUCT<markets: ARRAY<STRUCT<id: BIGINT>>>")
    assert load.good.count() == 1 and load.quarantined.count() == 0


def test_files_are_copied_once(spark, tmp_path):
    place = snapshots.Location("l", land(tmp_path / "in", a=document()))
    copy = lambda **o: snapshots.copy_into(spark, place, str(tmp_path / "t"), snapshots.SNAPSHOT_SCHEMA, **o)["rows_loaded"]
    assert [copy(), copy()] == [1, 0]
    land(tmp_path / "in", b=document())
    assert [copy(), copy(force=True)] == [1, 2]
    assert snapshots.read_copied(spark, str(tmp_path / "t")).count() == 4


def test_partition_upsert_keeps_columns_and_text_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("01", 1, "a", "then"), ("02", 1, "a", "then")], "month STRING, k BIGINT, v STRING, made STRING")
    first.write.partitionBy("month").parquet(path)
    source = spark.createDataFrame([("01", 1, "b"), ("01", 2, "b")], "month STRING, k BIGINT, v STRING")
    tables.upsert_partitions(spark, path, source, ["month", "k"], ["v"], "month")
    schema = T.StructType.fromDDL("k BIGINT, v STRING, made STRING, month STRING")
    got = rows(spark.read.schema(schema).parquet(path), "month", "k", "v", "made")
    assert got == sorted([("01", 1, "b", "then"), ("01", 2, "b", None), ("02", 1, "a", "then")], key=repr)
    with pytest.raises(merge.DuplicateSourceKeys):
        tables.upsert_partitions(spark, str(tmp_path / "u"), source.union(source), ["month", "k"], ["v"], "month")


def test_crashed_images_do_not_count(spark, tmp_path):
    base = str(tmp_path / "t")
    for n in range(3):
        tables.publish(spark.range(n), base)
    names = sorted(p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("image="))
    for n in (1, 2):
        (tmp_path / "t" / f"{names[n][:14]}-0crash").mkdir()
    gone = tables.prune_images(spark, base, keep=3)
    assert all(name.endswith("0crash") for name in gone) and len(gone) == 2
    assert tables.read_image(spark, base).count() == 2


def test_a_bad_landing_leaves_the_tables_alone(spark, tmp_path):
    warehouse = str(tmp_path / "w")
    refresh.run(spark, land(tmp_path / "one", a=document(markets=2)), warehouse)
    with pytest.raises(quality.QualityError):
        refresh.run(spark, land(tmp_path / "two", a=document(markets=0)), warehouse)
    assert tables.read_image(spark, f"{warehouse}/raw").count() == 2
    folder = land(tmp_path / "three", a=document(markets=1))
    (tmp_path / "three" / "bad.json").write_text("{")
    with pytest.raises(quality.QualityError, match="1 unreadable"):
        refresh.run(spark, folder, warehouse, most_errors=0)
    assert refresh.run(spark, folder, warehouse, most_errors=1).quarantined.count() == 1


def test_insert_if_absent_takes_one_of_equal_keys(spark, rows):
    target = spark.createDataFrame([(1, "a")], "k BIGINT, v STRING")
    source = spark.createDataFrame([(1, "x", 0), (2, "c", 0), (2, "b", 0), (None, "n", 0), (None, "n", 0)], "k BIGINT, v STRING, more INT")
    got = merge.insert_if_absent(target, source, ["k"])
    assert got.columns == ["k", "v"]
    assert rows(got) == sorted([(1, "a"), (2, "b"), (None, "n"), (None, "n")], key=repr)
