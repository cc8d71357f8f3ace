import json

import pytest

from tidemark.operators.flatten import flatten_snapshots
from tidemark.plans import model
from tidemark.sinks.tables import read_image
from tidemark.sources.snapshots import read_documents
from tidemark.streaming import incremental


def write(path, name, day, *markets):
    document = {"extracted_at": f"2024-01-0{day}T00:00:00", "source": "s", "data": {"markets": [{"id": m, "name": f"{name}-{m}"} for m in markets]}}
    (path / f"{name}.json").write_text(json.dumps(document, indent=1))


@pytest.fixture
def landing(tmp_path):
    path = tmp_path / "landing"
    path.mkdir()
    return path


def test_second_run_adds_only_new_files(spark, landing, tmp_path):
    target, checkpoint = str(tmp_path / "raw"), str(tmp_path / "cp")

    def load():
        incremental.append_raw(incremental.document_stream(spark, str(landing)), target, checkpoint).awaitTermination()
        return spark.read.parquet(target).count()

    write(landing, "a", 1, 1, 2)
    assert load() == 2
    assert load() == 2
    write(landing, "b", 2, 1)
    assert load() == 3
    rows = spark.read.parquet(target)
    assert rows.select("source_file").distinct().count() == 2


def test_stream_equals_batch_and_late_files_do_not_win(spark, landing, tmp_path, rows):
    base, checkpoint = str(tmp_path / "summary"), str(tmp_path / "cp")

    def load():
        stream = incremental.document_stream(spark, str(landing), max_files=1)
        incremental.upsert_summary(stream, base, checkpoint).awaitTermination()

    write(landing, "b", 3, 1, 2)
    load()
    write(landing, "a", 1, 2, 3)
    write(landing, "c", 4, 3)
    load()
    batch = model.market_summary(flatten_snapshots(read_documents(spark, str(landing))))
    assert rows(read_image(spark, base), *model.SUMMARY_INSERTS) == rows(batch, *model.SUMMARY_INSERTS)
    assert rows(batch, "market_name") == [("b-1",), ("b-2",), ("c-3",)]


def test_unreadable_files_are_quarantined_once(spark, landing, tmp_path, rows):
    target, checkpoint = str(tmp_path / "bad"), str(tmp_path / "cp")
    write(landing, "a", 1, 1)
    (landing / "bad.json").write_text('{"cut')
    for _ in range(2):
        incremental.append_quarantine(incremental.document_stream(spark, str(landing)), target, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(target), "_corrupt_record") == [('{"cut',)]
