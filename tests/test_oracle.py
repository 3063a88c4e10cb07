"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as contract
from reqloom.plans.oracle import ORACLE
from reqloom.plans.queries import QUERIES
from tests.conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    return connection


def use_folder(duck, folder):
    for name in TABLES:
        duck.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return "NaN" if math.isnan(value) else f"{value:.6f}".replace("-0.000000", "0.000000")
        return "NULL" if value is None else str(value)

    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    use_folder(duck, SMALL)
    df = QUERIES[name](spark, SMALL)
    rows = [tuple(row) for row in df.collect()]
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(rows, df.columns) == canonical(cursor.fetchall(), columns)


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLE)


def test_contract_has_all_queries():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
