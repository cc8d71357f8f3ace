"""Registered queries against DuckDB on the smallest tables."""

import re
from glob import glob
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from check import compare
from tidemark import bindings

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = bindings.load_queries(), bindings.load_oracle()
IDS = (
    [f"s{i:02d}" for i in range(1, 16)]
    + [f"k{i:02d}" for i in range(1, 18)]
    + [f"p{i}" for i in range(1, 9)]
    + [f"f{i}" for i in range(1, 8)]
    + [f"j{i}" for i in range(1, 9)]
    + [f"u{i}" for i in range(1, 4)]
    + [f"o{i}" for i in range(1, 6)]
    + [f"g{i}" for i in range(1, 15)]
    + [f"a{i}" for i in range(1, 7)]
    + [f"w{i}" for i in range(1, 4)]
    + [f"c{i}" for i in range(1, 16)]
    + [f"v{i}" for i in range(1, 4)]
    + [f"q{i:02d}" for i in range(1, 31)]
    + [f"dq{i}" for i in range(1, 11)]
    + [f"x{i}" for i in range(1, 14)]
)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_operator_id_is_registered():
    stems = {re.match(r"([a-z]+\d+)", name).group(1) for name in QUERIES}
    assert [i for i in IDS if i not in stems] == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_the_driver_sees_every_query():
    assert set(QUERIES) <= set(registered.queries())
    assert set(ORACLE) <= set(registered.oracle_sql())


def test_entry(spark):
    assert registered.entry(spark).count() == 15


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    message, _, good = compare(spark, db, name, QUERIES[name], ORACLE[name], SF)
    assert good, message
