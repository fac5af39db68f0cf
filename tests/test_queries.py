"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as driver
from tidemark.checks.inputs import TABLES
from tidemark.checks.oracles import ORACLES
from tidemark.checks.queries import QUERIES

TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER",
         "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return connection


def _plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else v


def _sorted(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_twin(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    got = df.collect()
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    assert sorted(df.columns) == sorted(columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    assert got
    assert _sorted(df.columns, got) == _sorted(columns, result.fetchall())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[:2] == ["ticker", "date"]
    assert df.count() > 0
