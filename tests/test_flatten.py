import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.flatten import flatten_contracts, flatten_snapshots, flatten_struct
from tidemark.plans import model
from tidemark.sources.snapshots import SNAPSHOT_SCHEMA

CONTRACT = {"id": 11, "name": "Yes", "status": "Open", "lastTradePrice": 0.42, "bestBuyYesCost": None, "displayOrder": 1}
DOCUMENTS = [
    {
        "extracted_at": "2024-01-01T06:00:00.123456",
        "source": "feed",
        "data": {
            "markets": [
                {"id": 1, "name": "One", "shortName": "1", "url": "/1", "status": "Open", "contracts": [CONTRACT, {**CONTRACT, "id": 12}]},
                {"id": 2, "name": "Null contracts", "status": None, "contracts": None},
                {"id": 3, "name": "Empty contracts", "contracts": []},
                {"id": 4, "name": "No contracts"},
                {"id": 5, "name": "Old names", "contracts": [{"contractId": 51, "contractName": "Old", "lastClosePrice": 0.5}]},
                {"id": None, "name": "No id", "contracts": [CONTRACT]},
            ]
        },
    },
    {
        "extracted_at": "2024-01-02T06:00:00",
        "source": "feed",
        "data": {"markets": [{"id": 1, "name": "One later", "status": "Closed", "contracts": [{**CONTRACT, "lastTradePrice": 0.5}]}]},
    },
    {"extracted_at": "2024-01-03T06:00:00", "source": "feed", "data": {"markets": None}},
    {"extracted_at": "2024-01-03T06:00:00", "source": "feed"},
]


@pytest.fixture(params=["typed", "variant"])
def raw(request, spark):
    text = spark.createDataFrame([(json.dumps(d),) for d in DOCUMENTS], "value STRING")
    if request.param == "typed":
        return flatten_snapshots(text.select(F.from_json("value", SNAPSHOT_SCHEMA).alias("d")).select("d.*"))
    return flatten_snapshots(text.select(F.parse_json("value").alias("raw")))


def test_one_row_per_market_and_snapshot(raw, rows):
    assert raw.count() == 7
    statuses = {r.market_name: r.market_status for r in raw.collect()}
    assert statuses["One"] == "Open" and statuses["Null contracts"] == "Unknown" and statuses["No contracts"] == "Unknown"
    first = raw.filter("market_name = 'One'").select(F.col("extraction_timestamp").cast("string")).first()[0]
    assert first == "2024-01-01 06:00:00.123456"


def test_contract_counts(raw):
    sizes = {r.market_id: r.total_contracts for r in model.market_summary(raw).collect()}
    assert sizes == {1: 1, 2: 0, 3: 0, 4: 0, 5: 1}
    flagged = {r.market_id: r.total_contracts for r in model.market_summary(raw, null_is_zero=False).collect()}
    assert flagged == {1: 1, 2: None, 3: 0, 4: None, 5: 1}


def test_contracts_and_old_names(raw):
    got = {(r.contract_id, str(r.last_updated)[:10]): r for r in flatten_contracts(raw).collect()}
    assert set(got) == {(11, "2024-01-01"), (12, "2024-01-01"), (51, "2024-01-01"), (11, "2024-01-02")}
    assert got[(51, "2024-01-01")].contract_name == "Old"
    assert got[(51, "2024-01-01")].last_close_price == Decimal("0.5000")
    assert got[(11, "2024-01-01")].best_buy_yes_cost is None


def test_newest_contract_wins(raw):
    got = {r.contract_id: r.last_trade_price for r in model.contract_details(raw).collect()}
    assert got == {11: Decimal("0.5000"), 12: Decimal("0.4200"), 51: None}


def test_odd_variant_elements(spark):
    """Elements that are no objects keep their row, what is no array gives none, and a wrong type fails the whole read."""

    def read(*markets):
        texts = [(json.dumps({"extracted_at": "2024-01-01T06:00:00", "data": {"markets": m}}),) for m in markets]
        return flatten_snapshots(spark.createDataFrame(texts, "value STRING").select(F.parse_json("value").alias("raw")))

    one = {"id": 1, "contracts": [CONTRACT, 7, None, {"contractId": "12", "lastTradePrice": "0.25"}]}
    raw = read([one, 5, None, [one], {"id": "2", "contracts": 3}], {"id": 9}, "none", [])
    assert [r.market_id for r in raw.orderBy("market_id").collect()] == [None, None, None, 1, 2]
    assert {r.market_id: r.total_contracts for r in model.market_summary(raw).collect()} == {1: 4, 2: 0}
    got = sorted((r.contract_id or 0, r.last_trade_price) for r in flatten_contracts(raw).collect() if r.contract_id)
    assert got == [(11, Decimal("0.4200")), (12, Decimal("0.2500"))] and flatten_contracts(raw).count() == 4
    for wrong in ([{"id": "x", "name": "n"}], [{"id": "x", "name": "n"}, 5]):
        with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
            read(wrong).select("market_name").collect()


def test_variant_elements_are_read_in_one_pass(spark):
    """Where all elements are objects, no path is read per attribute: one typed read a market array, one a contract array."""
    text = spark.createDataFrame([(json.dumps(DOCUMENTS[0]),)], "value STRING")
    details = flatten_contracts(flatten_snapshots(text.select(F.parse_json("value").alias("raw"))))
    plan = details._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("THEN variant_get(") == 2 and "variant_get(_contract" not in plan and "variant_get(_market" not in plan


def test_flatten_struct_names_and_json(spark, rows):
    df = spark.sql("SELECT 1 AS id, struct(struct(2 AS c, array(1, 2) AS d) AS b, map('k', 1) AS m) AS a")
    flat = flatten_struct(df)
    assert flat.columns == ["id", "a.b.c", "a.b.d", "a.m"]
    assert tuple(flat.first()) == (1, 2, "[1,2]", '{"k":1}')
