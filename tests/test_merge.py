import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.operators.latest import keep_latest_rows, latest_per_key

TABLE = "k BIGINT, a STRING, b STRING, ts TIMESTAMP_NTZ"
T0 = datetime(2024, 1, 1)


def frame(spark, data):
    return spark.createDataFrame(data, TABLE)


@pytest.fixture
def target(spark):
    return frame(spark, [(1, "a1", "b1", T0), (2, "a2", "b2", T0), (None, "an", "bn", T0), (None, "an2", "bn", T0)])


@pytest.fixture
def source(spark):
    later = T0 + timedelta(days=1)
    return frame(spark, [(2, "A2", "B2", later), (3, "A3", "B3", later), (None, "AN", "BN", later), (None, "AM", "BM", later)])


LIMITS = [0, merge.BROADCAST_LIMIT]


@pytest.mark.parametrize("limit", LIMITS)
def test_upsert(target, source, rows, limit):
    image = merge.merge_upsert(target, source, ["k"], ["a"], ["k", "a", "ts"], action_column="did", broadcast_limit=limit)
    assert rows(image, "k", "a", "b", "did") == sorted(
        [
            (1, "a1", "b1", "kept"),
            (2, "A2", "b2", "updated"),
            (3, "A3", None, "inserted"),
            (None, "an", "bn", "kept"),
            (None, "an2", "bn", "kept"),
            (None, "AN", None, "inserted"),
            (None, "AM", None, "inserted"),
        ],
        key=repr,
    )


@pytest.mark.parametrize("limit", LIMITS)
def test_upsert_is_idempotent(spark, rows, limit):
    target = frame(spark, [(1, "a1", "b1", T0)])
    source = frame(spark, [(1, "x", "y", T0), (2, "z", "w", T0)])
    columns = ["a", "b", "ts"]
    once = merge.merge_upsert(target, source, ["k"], columns, broadcast_limit=limit)
    twice = merge.merge_upsert(once, source, ["k"], columns, broadcast_limit=limit)
    assert rows(once) == rows(twice)


@pytest.mark.parametrize("limit", LIMITS)
def test_disjoint_keys_give_the_union(spark, rows, limit):
    a, b = frame(spark, [(1, "a", "b", T0)]), frame(spark, [(2, "c", "d", T0)])
    assert rows(merge.merge_upsert(a, b, ["k"], ["a", "b", "ts"], broadcast_limit=limit)) == rows(a.union(b))


@pytest.mark.parametrize("limit", LIMITS)
def test_older_source_changes_nothing(spark, rows, limit):
    target = frame(spark, [(1, "new", "b", T0), (2, "undated", "b", None)])
    source = frame(spark, [(1, "old", "b", T0 - timedelta(1)), (2, "dated", "b", T0)])
    image = merge.merge_upsert(target, source, ["k"], ["a", "ts"], newer_by="ts", broadcast_limit=limit)
    assert rows(image, "k", "a") == [(1, "new"), (2, "dated")]


def test_duplicate_source_keys_raise(spark, target):
    with pytest.raises(merge.DuplicateSourceKeys):
        merge.merge_upsert(target, frame(spark, [(5, "a", "b", T0), (5, "c", "d", T0)]), ["k"], ["a"])


def test_size_is_measured(spark):
    small, large = frame(spark, [(1, "a", "b", T0)]), frame(spark, [(1, "a" * 10_000, "b", T0)])
    assert merge.measured_bytes(large) - merge.measured_bytes(small) == 9_999
    assert merge.require_unique(large, ["k"]) == merge.measured_bytes(large)


def test_insert_if_absent(target, source, rows):
    complete = source.dropna(subset=["k"])
    assert rows(merge.insert_if_absent(target.dropna(subset=["k"]), complete, ["k"]), "k", "a") == [(1, "a1"), (2, "a2"), (3, "A3")]


def test_null_rows_are_spread(spark):
    many = spark.range(1000).select(F.lit(None).cast("bigint").alias("k"), F.col("id").cast("string").alias("a"))
    slots = many.select(merge.null_slot(many, ["k"]).alias("s")).distinct().count()
    assert slots > 300
    assert many.na.fill(1, ["k"]).select(merge.null_slot(many, ["k"]).alias("s")).distinct().count() == 1


# --- three-valued NOT IN against a literal evaluation ------------------------------------------


def equal(a, b):
    return None if a is None or b is None else a == b


def conj(values):
    values = list(values)
    if any(v is False for v in values):
        return False
    return None if any(v is None for v in values) else True


def not_in(row, listed):
    found = [conj(equal(x, y) for x, y in zip(row, other)) for other in listed]
    if any(f is True for f in found):
        return False
    return None if any(f is None for f in found) else True


@pytest.mark.parametrize("seed", range(6))
def test_keep_latest_rows_follows_not_in(spark, seed):
    rnd = random.Random(seed)
    key_choices = [1, 2, 3] if seed % 2 else [1, 2, 3, None]
    data = [(i, rnd.choice(key_choices), rnd.choice([1, 2, 3, None, 4])) for i in range(rnd.randint(1, 14))]
    maxima = {}
    for _, k, t in data:
        known = [x for x in (maxima.get(k), t) if x is not None]
        maxima[k] = max(known) if known else None
    wanted = sorted(i for i, k, t in data if not_in((k, t), list(maxima.items())) is not True)
    got = keep_latest_rows(spark.createDataFrame(data, "i INT, k INT, t INT"), "k", "t")
    assert sorted(r.i for r in got.collect()) == wanted


@pytest.mark.parametrize("seed", range(6))
def test_mark_stale_follows_not_in(spark, seed):
    rnd = random.Random(seed)
    now = datetime(2024, 2, 1)
    ids = [1, 2, 3, 4, None] if seed in (1, 4) else [1, 2, 3, 4]
    age = (9, 20) if seed in (2, 5) else (0, 14)
    seen = [(rnd.choice(ids), now - timedelta(days=rnd.randint(*age))) for _ in range(6)]
    table = [(k, "Open") for k in (1, 2, 3, 4, 5, None)]
    recent = [(k,) for k, at in seen if at >= now - timedelta(days=7)]
    wanted = sorted(((k, "Closed" if not_in((k,), recent) is True else s) for k, s in table), key=repr)
    marked = merge.mark_stale(
        spark.createDataFrame(table, "k INT, status STRING"),
        spark.createDataFrame(seen, "k INT, at TIMESTAMP_NTZ"),
        "k",
        "status",
        "at",
        7,
        now,
    )
    assert sorted((tuple(r) for r in marked.collect()), key=repr) == wanted


def test_latest_per_key_is_one_row_per_key(spark, rows):
    rnd = random.Random(7)
    data = [(rnd.choice([1, 2, None]), rnd.choice([None, 1, 2]), rnd.randint(0, 5)) for _ in range(40)]
    got = rows(latest_per_key(spark.createDataFrame(data, "k INT, t INT, tie INT"), ["k"], ["t"], ["tie"]))
    wanted = {}
    for k, t, tie in data:
        rank = (float("inf") if t is None else t, -tie)
        if k not in wanted or rank > wanted[k][0]:
            wanted[k] = (rank, (k, t, tie))
    assert got == sorted((v[1] for v in wanted.values()), key=repr)
