"""Disk that queries which land documents take, against the plain text of the documents they land."""

from pathlib import Path

import pytest

from tidemark import bindings
from tidemark.bindings import lens, source_queries
from tidemark.session import shared_dir
from tidemark.sinks import files

SF = "/root/testdata/sf0.001"
QUERIES = bindings.load_queries()


def size(path):
    return sum(f.stat().st_size for f in Path(path).rglob("*") if f.is_file())


@pytest.fixture(scope="module")
def text_size(spark, tmp_path_factory):
    return size(files.save_json(lens.documents(spark, SF), str(tmp_path_factory.mktemp("plain") / "text")))


#: Query and the most it may leave under the shared folder, as a part of the plain text.
MOST = [
    ("s01_document_scan", 0.2),
    ("s01b_document_scan_variant", 0.2),
    ("s03_filename_filter", 0.4),
    ("s04_tolerant_load", 0.2),
    ("s05_load_statistics", 0.2),
    ("dq1_not_empty", 0.2),
    ("s10_full_reload", 0.2),
    ("s11_incremental_load", 0.15),
    ("s11b_incremental_upsert", 0.1),
    ("x13_quality_report", 0.2),
    ("x11b_refresh_from_files", 0.2),
    ("x11c_incremental_equals_full", 0.3),
    ("x11d_incremental_details", 0.3),
    ("x11e_incremental_summary", 0.3),
]


@pytest.mark.parametrize(("name", "most"), MOST, ids=[name for name, _ in MOST])
def test_disk_of_a_query(spark, text_size, monkeypatch, name, most):
    monkeypatch.setattr(source_queries, "_LANDED", {})
    monkeypatch.setattr(source_queries, "_KEPT_UP", {})
    before = size(shared_dir(spark)) if Path(shared_dir(spark)).exists() else 0
    QUERIES[name](spark, SF).write.format("noop").mode("overwrite").save()
    taken = size(shared_dir(spark)) - before
    assert 0 < taken <= most * text_size


def test_what_a_batch_or_a_merge_stores_for_itself_is_removed(spark, monkeypatch):
    monkeypatch.setattr(source_queries, "_KEPT_UP", {})
    left = lambda: {p.name for n in ("batch", "source", "combined", "staging") for p in Path(shared_dir(spark)).glob(f"{n}-*")}
    before = left()
    for name in ("x11c_incremental_equals_full", "s11b_incremental_upsert", "x13_quality_report"):
        QUERIES[name](spark, SF).count()
    assert left() == before


#: Query and the most it may leave, as a part of the plain text, now that lines alike are written one after the other.
LAID = [
    ("s01_document_scan", 0.058),
    ("s01b_document_scan_variant", 0.058),
    ("dq1_not_empty", 0.058),
    ("s04_tolerant_load", 0.055),
    ("s03_filename_filter", 0.115),
    ("s05_load_statistics", 0.055),
    ("s11b_incremental_upsert", 0.07),
    ("x11b_refresh_from_files", 0.14),
    ("x11d_incremental_details", 0.195),
    ("x11e_incremental_summary", 0.195),
]


@pytest.mark.parametrize(("name", "most"), LAID, ids=[name for name, _ in LAID])
def test_disk_of_a_query_with_lines_laid_together(spark, text_size, monkeypatch, name, most):
    test_disk_of_a_query(spark, text_size, monkeypatch, name, most)


def test_lines_of_an_even_scan_are_written_without_a_shuffle(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = lambda *sizes: spark.createDataFrame([(i,) for i in range(sum(sizes))], "k long")
    even = rows(*[50] * cores).repartition(cores)
    assert lens.laid_together(even, "k").rdd.getNumPartitions() == cores
    plans = [lens.laid_together(df, "k")._jdf.queryExecution().toString() for df in (even, even.coalesce(1))]
    assert ["_run" in plan for plan in plans] == [False, True]
    assert sorted(lens.laid_together(even.coalesce(1), "k").collect()) == sorted(even.collect())
    assert lens.laid_together(even.where("k < 0"), "k").count() == 0
