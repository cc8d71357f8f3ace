import gzip
import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.plans import refresh
from tidemark.sinks import files
from tidemark.sources import feeds, snapshots, tables


def document(market, day="2024-01-01", **extra):
    return {"extracted_at": f"{day}T00:00:00", "source": "s", "data": {"markets": [{"id": market, "name": f"m{market}", **extra}]}}


@pytest.fixture
def landing(tmp_path):
    path = tmp_path / "landing"
    path.mkdir()
    (path / "a.json").write_text(json.dumps(document(1), indent=2))
    (path / "b.json").write_text(json.dumps([document(2), document(3)]))
    with gzip.open(path / "c.json.gz", "wt") as f:
        json.dump(document(4), f)
    (path / "bad.json").write_text('{"bad')
    (path / "x.txt").write_text(json.dumps(document(9)))
    (path / "zero.json").touch()
    return str(path)


def test_tolerant_load_and_statistics(spark, landing, rows):
    load = snapshots.load_snapshots(spark, landing)
    assert load.good.count() == 4 and load.quarantined.count() == 1
    assert load.quarantined.first()["_corrupt_record"] == '{"bad'
    stats = snapshots.load_statistics(snapshots.read_documents(spark, landing)).first()
    assert (stats.files_loaded, stats.rows_loaded, stats.errors_seen) == (4, 4, 1)
    assert load.good.filter("source_file LIKE '%c.json.gz'").count() == 1


def test_abort_on_error(spark, landing):
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        snapshots.read_documents(spark, landing, on_error="ABORT_STATEMENT").collect()
    with pytest.raises(ValueError):
        snapshots.read_documents(spark, landing, on_error="SKIP")


def test_one_pass_landing(spark, landing, tmp_path):
    counts = snapshots.land_snapshots(spark, landing, str(tmp_path / "out"))
    assert counts == {"rows_loaded": 4, "errors_seen": 1}
    assert spark.read.parquet(str(tmp_path / "out")).filter("unreadable = 'true'").count() == 1


def test_file_name_filters(spark, landing):
    only = snapshots.read_documents(spark, landing, file_regex=r".*/a\.json$")
    assert only.count() == 1
    assert snapshots.read_documents(spark, landing, pattern="*.txt").count() == 1


def test_empty_files_are_found(spark, landing, tmp_path):
    found = snapshots.empty_files(spark, landing)
    assert len(found) == 1 and found[0].endswith("zero.json")
    with pytest.raises(FileNotFoundError):
        snapshots.empty_files(spark, str(tmp_path / "missing"))


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="Unsupported format"):
        snapshots.read_files(spark, "/nowhere", "xml")


def test_keyed_and_single_feeds(spark, rows):
    text = spark.createDataFrame(
        [('{"extracted_at":"2024-01-01T00:00:00","source":"f","data":{"a":{"usd":1.5},"b":{"usd":2,"usd_24h_change":-1}}}',)],
        "value STRING",
    )
    assert rows(feeds.keyed_records_from_text(text), "id", "usd", "usd_24h_change") == [("a", 1.5, None), ("b", 2.0, -1.0)]
    single = spark.sql("SELECT '2024-01-01T00:00:00' AS extracted_at, 'w' AS source, struct('X' AS name, struct(3 AS temp) AS main) AS data")
    assert feeds.single_records(single).columns == ["extracted_at", "source", "name", "main_temp"]


def test_table_description_and_inserts(spark, tmp_path):
    schema = tables.schema_from_dict({"id": "BIGINT", "name": "VARCHAR(10)"})
    assert schema.names == ["id", "name", "loaded_at", "source_file"]
    path = str(tmp_path / "t")
    assert tables.insert_tuples(spark, [(1, "a"), (2, "b")], "id BIGINT, name STRING", path) == 2
    assert tables.insert_tuples(spark, [(3, "c")], "id BIGINT, name STRING", path) == 1
    assert spark.read.parquet(path).count() == 3


def test_too_long_text_is_refused(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS short_text")
    tables.create_table(spark, "short_text", {"name": "VARCHAR(3)"}, str(tmp_path / "short"), audit=False)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        spark.sql("INSERT INTO short_text VALUES ('abcd')")
    spark.sql("DROP TABLE short_text")


def test_refresh_from_landing(spark, landing, tmp_path, rows):
    first = refresh.run(spark, landing, str(tmp_path / "w"), date(2024, 1, 1)).daily_metrics.count()
    again = refresh.run(spark, landing, str(tmp_path / "w"), date(2024, 1, 1))
    assert rows(again.market_summary, "market_id") == [(1,), (2,), (3,), (4,)]
    assert first == again.daily_metrics.count() == 4
    assert again.checks.filter("NOT passed").count() == 0
    assert again.loaded == {"rows_loaded": 4, "errors_seen": 1}
    assert rows(again.quarantined, "_corrupt_record") == [('{"bad',)]


def test_refresh_of_nothing_fails(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "bad.json").write_text("{")
    with pytest.raises(quality.QualityError, match="staging"):
        refresh.run(spark, str(tmp_path / "in"), str(tmp_path / "w"))


def test_copy_into_counts_files_rows_and_errors(spark, tmp_path, rows):
    stage, target = tmp_path / "stage", str(tmp_path / "t")
    stage.mkdir()
    (stage / "a.csv").write_text("id,name\n1,x\n2,y\n")
    (stage / "b.csv").write_text("id,name\n3,z\nfour,w\n")
    (stage / "skip.dat").write_text("id,name\n9,n\n")
    place = snapshots.Location("stage", str(stage), "csv")
    ddl = "id INT, name STRING"
    first = snapshots.copy_into(spark, place, target, ddl, r".*\.csv$")
    assert first == {"files_loaded": 2, "rows_loaded": 3, "errors_seen": 1}
    assert rows(snapshots.read_copied(spark, target), "id", "name") == [(1, "x"), (2, "y"), (3, "z")]
    again = snapshots.copy_into(spark, place, target, ddl, r".*/a\.csv$")
    assert again == {"files_loaded": 0, "rows_loaded": 0, "errors_seen": 0}
    again = snapshots.copy_into(spark, place, target, ddl, r".*/a\.csv$", force=True)
    assert again == {"files_loaded": 1, "rows_loaded": 2, "errors_seen": 0}
    assert snapshots.read_copied(spark, target).count() == 5
    with pytest.raises(Exception):
        snapshots.copy_into(spark, place, str(tmp_path / "u"), ddl, on_error="ABORT_STATEMENT")


def test_copy_into_from_parquet(spark, tmp_path, rows):
    spark.range(4).write.parquet(str(tmp_path / "p"))
    place = snapshots.Location("p", str(tmp_path / "p"), "parquet")
    assert snapshots.copy_into(spark, place, str(tmp_path / "t"), "id BIGINT")["rows_loaded"] == 4


def lines(path, *ids):
    path.write_text("".join(f'{{"id": {i}}}\n' for i in ids))


def test_copy_into_opens_new_files_only(spark, tmp_path, rows):
    landing, target = tmp_path / "in", str(tmp_path / "t")
    landing.mkdir()
    place = snapshots.Location("l", str(landing))
    lines(landing / "a.json", 1, 2)
    assert snapshots.copy_into(spark, place, target, "id BIGINT") == {"files_loaded": 1, "rows_loaded": 2, "errors_seen": 0}
    (landing / "a.json").chmod(0)  # cannot be opened any more (unless run as root), and must not have to be
    lines(landing / "b.json", 3)
    (landing / "c.json").write_text("{broken")
    read = []
    load = snapshots._load_files
    try:
        snapshots._load_files = lambda s, place, paths, *rest: read.extend(paths) or load(s, place, paths, *rest)
        assert snapshots.copy_into(spark, place, target, "id BIGINT") == {"files_loaded": 2, "rows_loaded": 1, "errors_seen": 1}
    finally:
        snapshots._load_files = load
    assert sorted(p.rsplit("/", 1)[1] for p in read) == ["b.json", "c.json"]
    assert snapshots.copy_into(spark, place, target, "id BIGINT")["files_loaded"] == 0
    (landing / "a.json").chmod(0o644)
    lines(landing / "b.json", 3, 4)  # a changed file is new
    assert snapshots.copy_into(spark, place, target, "id BIGINT")["rows_loaded"] == 2
    assert rows(snapshots.read_copied(spark, target), "id") == [(1,), (2,), (3,), (3,), (4,)]
    assert snapshots.loaded_files(spark, target).count() == 4


def test_two_copies_at_once_load_a_file_once(spark, tmp_path, rows, monkeypatch):
    landing, target, done = tmp_path / "in", str(tmp_path / "t"), []
    landing.mkdir()
    place = snapshots.Location("l", str(landing))
    lines(landing / "a.json", 1)

    def interrupt():
        if not done:
            done.append(1)
            done.append(snapshots.copy_into(spark, place, target, "id BIGINT"))
            lines(landing / "b.json", 2)

    got = snapshots.copy_into(spark, place, target, "id BIGINT", before_commit=interrupt)
    assert got["files_loaded"] == 1 and done[1]["files_loaded"] == 1
    assert rows(snapshots.read_copied(spark, target), "id") == [(1,), (2,)]
    monkeypatch.setattr(snapshots, "_LEDGER_FOLDERS", 2)
    for n in range(3, 6):
        lines(landing / f"{n}.json", n)
        snapshots.copy_into(spark, place, target, "id BIGINT")
    assert snapshots.copy_into(spark, place, target, "id BIGINT")["files_loaded"] == 0
    assert snapshots.loaded_files(spark, target).count() == 5


def test_landed_documents_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    """What the queries land as text is a fraction of the plain text, in files of bounded length, and holds every document."""
    from tidemark.bindings import lens, source_queries

    lines = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_tax double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    day = datetime(1997, 5, 6)
    rows = [(i, i % 90, i % 7, i % 5, float(i % 50), i % 9 / 100, i % 10 / 100, "NAR"[i % 3], "OF"[i % 2], day) for i in range(1000)]
    spark.createDataFrame(rows, lines).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(files, "ROWS_PER_FILE", 100)
    monkeypatch.setattr(source_queries, "_LANDED", {})
    plain = files.save_json(lens.documents(spark, str(tmp_path)), str(tmp_path / "plain"))
    size = lambda path: sum(f.stat().st_size for f in Path(path).rglob("part-*"))
    for landed in (source_queries.document_files(spark, str(tmp_path)), source_queries.broken_files(spark, str(tmp_path))):
        assert size(landed) * 4 < size(plain)
        texts = spark.read.text(landed)
        assert texts.count() == 1000
        assert texts.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 100
    whole = {r.value for r in spark.read.text(plain).collect()}
    assert {r.value for r in spark.read.text(source_queries.document_files(spark, str(tmp_path))).collect()} == whole
