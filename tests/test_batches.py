"""The batches of the upkeep queries: every document is in one of them, undated ones too, and each batch reads its own files."""

import duckdb
import pytest
from pyspark.sql import functions as F

import check
from tidemark import bindings
from tidemark.bindings import source_queries
from tidemark.sources import snapshots

SF = "/root/testdata/sf0.001"
QUERIES = bindings.load_queries()


@pytest.fixture(scope="module")
def few(spark, tmp_path_factory):
    """A table folder with some line items, every fifth without a date."""
    base = tmp_path_factory.mktemp("few")
    undated = F.when(F.col("l_partkey") % 5 != 0, F.col("l_shipdate")).alias("l_shipdate")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_orderkey < 200")
    lines.select(*[undated if c == "l_shipdate" else c for c in lines.columns]).coalesce(1).write.parquet(f"{base}/lineitem.parquet")
    return str(base)


def test_x11d_batches_lie_in_files_of_their_own(spark, few):
    paths = source_queries._batch_files(spark, few)
    batches = [snapshots.read_documents(spark, p, one_per_file=False) for p in paths]
    years = [b.agg(F.min(F.year("extracted_at")), F.max(F.year("extracted_at")), F.count_if(F.col("extracted_at").isNull())).first() for b in batches]
    assert years[0][0] >= 2000 and years[1][0] >= 1997 and years[1][1] < 2000 and years[2][1] < 1997
    assert [y[2] > 0 for y in years] == [False, True, False]
    assert sum(b.count() for b in batches) == spark.read.parquet(f"{few}/lineitem.parquet").count()


def equals_sql(spark, few, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{few}/lineitem.parquet/*.parquet'")
    return check.compare(spark, db, name, QUERIES[name], bindings.load_oracle()[name], few)


def test_x11e_summary_has_undated_snapshots(spark, few):
    text, _, ok = equals_sql(spark, few, "x11e_incremental_summary")
    assert ok, text
