"""What a refresh leaves behind and how it packs what it writes."""

import json
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.bindings import lens
from tidemark.plans import refresh

DAY = date(2024, 1, 2)


@pytest.fixture
def landing(tmp_path):
    path = tmp_path / "landing"
    path.mkdir()
    for i in range(40):
        markets = [{"id": m, "name": f"m{m}", "contracts": [{"id": m * 10 + j, "lastTradePrice": 0.5} for j in range(3)]} for m in range(i, i + 20)]
        (path / f"{i}.json").write_text(json.dumps({"extracted_at": f"2024-01-01T00:00:{i:02d}", "source": "s", "data": {"markets": markets}}))
    return str(path)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_x13_refresh_removes_its_shuffle_files(spark, landing, tmp_path):
    """At most one small shuffle is left of all that the writes and checks make."""
    before = shuffle_files(spark)
    tables = refresh.run(spark, landing, str(tmp_path / "w"), DAY)
    for _ in range(100):  # they are removed in the background
        left = {name.split("_")[1] for name in shuffle_files(spark) - before}
        if len(left) <= 1:
            break
        time.sleep(0.1)
    assert len(left) <= 1
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert tables.checks.where("not passed").count() == 0
    assert tables.market_summary.count() == 59 and tables.daily_metrics.count() == 59


def test_x11b_staging_is_not_packed_as_tables_are(spark, landing, tmp_path, monkeypatch):
    land, given = refresh.land_snapshots, []
    monkeypatch.setattr(refresh, "land_snapshots", lambda *a, **options: given.append(options["packing"]) or land(*a, **options))
    assert refresh.run(spark, landing, str(tmp_path / "w"), DAY).loaded == {"rows_loaded": 40, "errors_seen": 0}
    assert given == [session.PASSING] and given != [session.COMPACT]


def test_s10_documents_are_built_without_lambdas(spark):
    documents = lens.documents(spark, "/root/testdata/sf0.001", lens.laid_together)
    assert "lambda" not in documents._jdf.queryExecution().analyzed().toString()
    sizes = documents.select(F.transform("data.markets", lambda m: F.array_size(m["contracts"])).alias("n"))
    found = {tuple(r[0]) for r in sizes.distinct().collect()}
    assert found == {(n, 2) for n in (None, 0, 1, 2, 3)}
