"""The registered queries against their SQL on the small tables."""

from __future__ import annotations

import duckdb
import pytest

from reqloom.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    want = sorted(map(repr, cursor.fetchall()))
    df = QUERIES[name](spark, SMALL).select(*columns)
    assert sorted(repr(tuple(row)) for row in df.collect()) == want
