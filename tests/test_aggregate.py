import random
import statistics
from datetime import datetime
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators import aggregate
from tidemark.plans import model, reports


def prices(spark, values):
    return spark.createDataFrame([(None if v is None else Decimal(v),) for v in values], "last_trade_price DECIMAL(10,4)")


def test_bucket_edges(spark):
    values = ["0.10", "0.0999", "0.90", "0.8999", "0", "-0.5", "1.5", None, "0.35"]
    got = {r.price_range: r.num_contracts for r in reports.price_distribution(prices(spark, values)).collect()}
    assert got == {
        "$0.00 - $0.10": 3,
        "$0.10 - $0.20": 1,
        "$0.30 - $0.40": 1,
        "$0.80 - $0.90": 1,
        "$0.90 - $1.00": 2,
    }


@pytest.mark.parametrize("few", [True, False])
def test_shares_sum_to_hundred(spark, few):
    df = spark.range(999).select((F.col("id") % 7).alias("g"))
    shares = aggregate.share_of_total(df, ["g"], "n", "share", few_groups=few).collect()
    assert sum(r.n for r in shares) == 999
    assert abs(sum(r.share for r in shares) - 100) < 0.05


def test_moments_combine_like_one_pass(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(0, 5), Decimal(rnd.randint(0, 10000)) / 10000) for _ in range(300)]
    df = spark.createDataFrame(data, "g INT, v DECIMAL(10,4)")
    stats = aggregate.combined()
    row = df.groupBy("g").agg(*aggregate.moments("v")).agg(*[e.alias(k) for k, e in stats.items()]).first()
    values = [float(v) for _, v in data]
    assert row["count"] == 300 and float(row["sum"]) == pytest.approx(sum(values))
    assert float(row["avg"]) == pytest.approx(statistics.mean(values), abs=1e-7)
    assert row["stddev"] == pytest.approx(statistics.stdev(values))


@pytest.mark.parametrize("mean", ["1000000", "0.5", "-1000000", "-0.5", "0"])
@pytest.mark.parametrize("copies", [1, 10**5, 10**11])
def test_deviation_at_any_size(spark, mean, copies):
    """Two groups of values 0.01 around a mean, and one value that differs from all others, against exact arithmetic."""
    base = Decimal(mean)
    for values in ([base - Decimal("0.01"), base + Decimal("0.01")], [base] * 3 + [base + Decimal("0.0001")]):
        df = spark.createDataFrame([(v,) for v in values], "v DECIMAL(14,4)")
        stats = aggregate.combined(weight=F.lit(copies))
        row = df.groupBy("v").agg(*aggregate.moments("v")).agg(stats["stddev"].alias("d"), stats["count"].alias("n")).first()
        n = len(values) * copies
        m = sum(map(Fraction, values)) / len(values)
        variance = sum((Fraction(v) - m) ** 2 for v in values) * copies / (n - 1)
        assert row.n == n and row.d == pytest.approx(float(variance) ** 0.5, rel=1e-9)


def test_one_value_among_many(spark):
    """All but one of 2 * 10^11 values are equal."""
    for odd in ("0.0001", "-0.0001", "1000000"):
        df = spark.createDataFrame([(Decimal("3.3333"), 2 * 10**11 - 1), (Decimal("3.3333") + Decimal(odd), 1)], "v DECIMAL(14,4), w BIGINT")
        per_value = df.groupBy("v").agg(*aggregate.moments("v"), F.max("w").alias("w"))
        got = per_value.agg(aggregate.combined(weight=F.col("w"))["stddev"]).first()[0]
        n = 2 * 10**11
        exact = (Fraction(odd) ** 2 * (n - 1) / n / (n - 1)) ** Fraction(1, 2)
        assert got == pytest.approx(float(exact), rel=1e-9)


def test_deviation_of_equal_and_single_values(spark):
    def dev(values):
        df = spark.createDataFrame([(Decimal(v),) for v in values], "v DECIMAL(10,4)")
        return df.agg(*aggregate.moments("v")).agg(aggregate.combined()["stddev"]).first()[0]

    assert dev(["0.07"] * 3) == 0.0
    assert dev(["0.5"]) is None


def test_rounding_half_away_from_zero(spark):
    row = spark.sql("SELECT cast(-21.875 AS DECIMAL(10,4)) AS a, cast(0.625 AS DECIMAL(10,4)) AS sell, cast(0.8 AS DECIMAL(10,4)) AS buy, cast(0 AS DECIMAL(10,4)) AS zero")
    got = row.select(c.rounded("a", 2), c.percent_over("sell", "buy"), c.percent_over("sell", "zero"), c.price_change_pct("sell", "zero")).first()
    assert got[0] == -21.88 and got[1] == -21.88 and got[2] is None and got[3] == 0


def test_hour_boundaries(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 59), datetime(2024, 1, 1, 1, 1))], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    assert df.select(c.hours_between("a", "b")).first()[0] == 1


def test_first_keyword_rule_wins(spark):
    df = spark.createDataFrame([("The ELECTION of a president",), ("President of the Senate",), ("nothing",), (None,)], "t STRING")
    got = [r[0] for r in df.select(c.keyword_label("t", reports.CATEGORY_RULES)).collect()]
    assert got == ["Elections", "Presidential", "Other", "Other"]


MARKETS = "market_id BIGINT, market_name STRING, short_name STRING, market_status STRING, total_contracts INT, total_volume DECIMAL(18,2), last_updated TIMESTAMP_NTZ"
AT = datetime(2024, 1, 1, 12)


@pytest.fixture
def tables(spark):
    markets = spark.createDataFrame(
        [
            (1, "Same", "s", "Open", 3, Decimal(10), AT),
            (2, "Same", "s", "Open", 3, Decimal(20), AT),
            (3, "Single", "x", "Unknown", 1, Decimal(0), AT),
            (4, "Empty", "e", "Open", None, Decimal(5), AT),
        ],
        MARKETS,
    )
    p = [(11, 1, "0.1"), (12, 1, "0.3"), (21, 2, "0.5"), (31, 3, "0.9"), (32, 3, None), (99, 77, "1.0")]
    contracts = spark.createDataFrame(
        [(i, m, f"c{i}", "Open", None if v is None else Decimal(v)) for i, m, v in p],
        "contract_id BIGINT, market_id BIGINT, contract_name STRING, contract_status STRING, last_trade_price DECIMAL(10,4)",
    )
    return markets, contracts


def test_markets_of_one_name_merge(tables):
    got = reports.markets_by_average_price(*tables, with_spread=True).collect()
    assert [(r.market_name, r.num_contracts, r.avg_contract_price, r.price_stddev) for r in got] == [("Same", 3, 0.3, 0.2)]


def test_overall_counts_slots_per_contract_row(tables):
    row = reports.overall_statistics(*tables).first()
    assert (row.total_markets, row.total_contract_slots, row.actual_contracts) == (4, 3 * 2 + 3 + 2, 5)
    assert reports.overall_statistics(*tables, dedupe=True).first().total_contract_slots == 7


def test_daily_metrics_of_markets_without_prices(tables):
    rows = {r.market_id: r for r in model.daily_metrics(*tables, AT.date()).collect()}
    assert rows[4].total_contracts == 0 and rows[4].avg_trade_price == 0 and rows[4].price_volatility == 0
    assert rows[3].total_contracts == 2 and rows[3].price_volatility == 0
    assert set(rows) == {1, 2, 3, 4}
    only = model.daily_metrics(*tables, AT.date(), status="Unknown").collect()
    assert [r.market_id for r in only] == [3]


def test_declared_metrics_fan_out(tables):
    rows = {r.market_id: r for r in model.daily_metrics_declared(*tables, AT.date()).collect()}
    assert rows[1].total_volume == Decimal(20) and rows[4].total_volume == Decimal(5)
    assert rows[4].num_active_contracts == 0 and rows[4].avg_last_trade_price is None
    deduped = {r.market_id: r.total_volume for r in model.daily_metrics_declared(*tables, AT.date(), dedupe=True).collect()}
    assert deduped[1] == Decimal(10)


def test_null_counts_lead_the_ranking(tables):
    got = [r.market_name for r in reports.top_markets_by_contracts(tables[0], 2).collect()]
    assert got == ["Empty", "Same"]


def test_trends_keep_nulls(tables):
    rows = {r.market_id: r for r in model.market_trends(*tables).collect()}
    assert rows[4].avg_price is None and rows[3].price_volatility is None and rows[1].max_price == Decimal("0.3")


@pytest.mark.parametrize("orphans", [0, 3])
def test_top_k_joined_equals_the_full_join(spark, orphans):
    child = spark.createDataFrame([(i, 100 + i % 5, 50 - i) for i in range(40)], "id INT, key INT, v INT")
    parent = spark.createDataFrame([(100 + i, f"p{i}") for i in range(orphans, 5)], "key INT, name STRING")
    order = [*c.descending("v"), *c.ascending("id")]
    got = aggregate.top_k_joined(child, parent, "key", order, 6).select("id", "name").collect()
    assert got == aggregate.top_k(child.join(parent, "key"), order, 6).select("id", "name").collect()
    assert len(got) == 6
    few = aggregate.top_k_joined(child.limit(2), parent, "key", order, 6)
    assert few.count() == (2 if not orphans else 0)
