"""Batches through all tables against one full refresh; failures in the middle; repetitions; the stream."""

import json
import random
import shutil
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators.flatten import flatten_snapshots
from tidemark.plans import model, upkeep
from tidemark.sinks.managed import ManagedTable
from tidemark.sources.snapshots import read_documents
from tidemark.streaming import incremental

DAY = date(2024, 3, 1)


def snapshot(rng, markets):
    def contract(i):
        price = rng.choice([None, round(rng.random(), 2), 0.5])
        return {"id": i, "name": f"c{i}{rng.choice('ab')}", "status": rng.choice(["Open", None]), "lastTradePrice": price, "displayOrder": (i or 0) % 3}

    taken = rng.choice([None, *[str(datetime(2024, 1, 1) + timedelta(days=d)).replace(" ", "T") for d in range(4)]])
    # contract 7 wanders between markets, and some contracts have no id
    listed = [
        {"id": m, "name": f"m{m}{rng.choice('xy')}", "contracts": [contract(i) for i in rng.sample([m * 10, m * 10 + 1, 7, None], 2)]}
        for m in rng.sample(markets, 2)
    ]
    return {"extracted_at": taken, "source": "s", "data": {"markets": listed}}


@pytest.fixture(scope="module")
def waves(tmp_path_factory):
    """Folders of three waves; the last touches few markets."""
    rng, out = random.Random(9), []
    for n, markets in enumerate((range(1, 9), range(4, 12), [2, 3])):
        folder = tmp_path_factory.mktemp(f"wave{n}")
        for i in range(12 if n < 2 else 2):
            (folder / f"w{n}-{i}.json").write_text(json.dumps(snapshot(rng, list(markets))))
        out.append(str(folder))
    return out


def documents(spark, *folders):
    return read_documents(spark, list(folders))


def state(warehouse, rows):
    details = warehouse.contract_details.read()
    return (
        rows(warehouse.market_summary.read(), *model.SUMMARY_INSERTS),
        rows(details, *sorted(details.columns)),
        rows(daily_out(warehouse.daily_metrics.read())),
    )


def daily_out(daily):
    return daily.select(
        "market_id", "metric_date", "total_contracts", "total_volume", F.round("avg_trade_price", 6), F.round("price_volatility", 9)
    )


def full(spark, rows, *folders):
    raw = flatten_snapshots(documents(spark, *folders))
    summary, details = model.market_summary(raw), model.contract_details(raw).where("contract_id is not null")
    daily = model.daily_metrics(summary, details, DAY, contracts_unique=True)
    return rows(summary, *model.SUMMARY_INSERTS), rows(details, *sorted(details.columns)), rows(daily_out(daily))


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_batches_in_any_order_equal_a_full_refresh(spark, waves, tmp_path, rows, order):
    warehouse = upkeep.Warehouse.at(spark, str(tmp_path), buckets=4)
    for number, wave in enumerate(order):
        done = upkeep.apply_batch(documents(spark, waves[wave]), warehouse, number, metric_date=DAY)
        written = done.daily_metrics["inserted"] + done.daily_metrics["updated"]
        if number:  # what changed bounds what is written
            assert written <= done.market_summary["inserted"] + done.market_summary["updated"] + sum(
                done.market_totals[a] for a in ("inserted", "updated")
            )
    assert state(warehouse, rows) == full(spark, rows, *waves)
    assert warehouse.raw.read().count() == flatten_snapshots(documents(spark, *waves)).count()
    if order[-1] == 2:
        assert written <= 3 and set(done.parts["market_summary"]) <= {"b00000", "b00001", "b00002", "b00003"}
        assert len(done.parts["market_summary"]) <= 2


def test_a_batch_goes_on_after_a_failure(spark, waves, tmp_path, rows, monkeypatch):
    warehouse = upkeep.Warehouse.at(spark, str(tmp_path), buckets=4)
    upkeep.apply_batch(documents(spark, waves[0]), warehouse, 0, metric_date=DAY)
    merge = ManagedTable.merge
    for broken in ("market_totals", "daily_metrics", "contract_details"):
        def failing(self, *args, **kwargs):
            if self.base.endswith(broken):
                raise RuntimeError("lost")
            return merge(self, *args, **kwargs)

        monkeypatch.setattr(ManagedTable, "merge", failing)
        with pytest.raises(RuntimeError):
            upkeep.apply_batch(documents(spark, waves[1]), warehouse, 1, metric_date=DAY)
        monkeypatch.setattr(ManagedTable, "merge", merge)
    # another source in between must not be taken for the interrupted batch
    upkeep.apply_batch(documents(spark, waves[2]), warehouse, 0, "other", metric_date=DAY)
    upkeep.apply_batch(documents(spark, waves[1]), warehouse, 1, metric_date=DAY)
    assert state(warehouse, rows) == full(spark, rows, *waves)
    versions = [t.entry().version for t in (warehouse.raw, warehouse.market_summary, warehouse.market_totals, warehouse.daily_metrics)]
    again = upkeep.apply_batch(documents(spark, waves[1]), warehouse, 1, metric_date=DAY)
    assert not any(again.daily_metrics.values()) and not any(again.contract_details.values())
    assert versions == [t.entry().version for t in (warehouse.raw, warehouse.market_summary, warehouse.market_totals, warehouse.daily_metrics)]
    warehouse.prune(keep=1, least_age=0)
    assert state(warehouse, rows) == full(spark, rows, *waves)


def test_a_new_day_has_every_market(spark, waves, tmp_path):
    warehouse = upkeep.Warehouse.at(spark, str(tmp_path), buckets=2)
    upkeep.apply_batch(documents(spark, waves[0]), warehouse, 0, metric_date=DAY)
    upkeep.apply_batch(documents(spark, waves[2]), warehouse, 1, metric_date=DAY + timedelta(days=1))
    days = warehouse.daily_metrics.read().groupBy("metric_date").count().orderBy("metric_date").collect()
    markets = warehouse.market_summary.read().count()
    assert [r["count"] for r in days][1] == markets and len(days) == 2


def test_follow_a_stream(spark, waves, tmp_path, rows):
    warehouse = upkeep.Warehouse.at(spark, str(tmp_path / "w"), buckets=2)
    landing = tmp_path / "landing"
    landing.mkdir()
    for wave in waves:
        for file in Path(wave).iterdir():
            shutil.copy(file, landing)
        (landing / "broken.json").write_text("{")
        stream = incremental.document_stream(spark, str(landing))
        upkeep.follow(stream, warehouse, str(tmp_path / "cp"), metric_date=DAY).awaitTermination()
    assert state(warehouse, rows) == full(spark, rows, *waves)
    assert rows(warehouse.quarantine.read(), "_corrupt_record") == [("{",)]


def test_a_repeated_batch_reads_no_document(spark, waves, tmp_path, rows):
    warehouse = upkeep.Warehouse.at(spark, str(tmp_path / "w"), buckets=2)
    batch = tmp_path / "batch"
    shutil.copytree(waves[0], batch)
    given = documents(spark, str(batch))
    upkeep.apply_batch(given, warehouse, 0, metric_date=DAY)
    before = state(warehouse, rows)
    shutil.rmtree(batch)  # a scan of these files would fail
    again = upkeep.apply_batch(given, warehouse, 0, metric_date=DAY)
    assert not any(n for counts in (again.market_summary, again.contract_details, again.market_totals, again.daily_metrics) for n in counts.values())
    assert state(warehouse, rows) == before


def test_the_first_batch_is_stored_in_its_tables_only(spark, waves, tmp_path, rows, monkeypatch):
    """Raw rows are read from where they were appended, and what meets an empty table is written at once."""
    from tidemark.sinks import managed

    stores = []
    for module in (upkeep, managed):
        scratch = module.scratch
        monkeypatch.setattr(module, "scratch", lambda df, name, scratch=scratch: stores.append(name) or scratch(df, name))
    warehouse = upkeep.Warehouse.at(spark, str(tmp_path / "w"), buckets=2)
    upkeep.apply_batch(documents(spark, waves[0]), warehouse, 0, metric_date=DAY)
    assert stores == []
    assert state(warehouse, rows) == full(spark, rows, waves[0])
    upkeep.apply_batch(documents(spark, waves[1]), warehouse, 1, metric_date=DAY)
    assert "batch" not in stores and "source" in stores
    assert state(warehouse, rows) == full(spark, rows, *waves[:2])
