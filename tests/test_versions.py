"""Stored tables under replacement, and builds of the days that an append changes against whole builds."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from reqloom.plans import pipeline as P
from reqloom.plans import touched
from reqloom.sources import versions, writers
from tests.conftest import rows_of


def days_of(rows):
    return sorted(row["d"].day for row in rows.collect())


@pytest.fixture
def dated(spark):
    start = date(2024, 1, 1)
    return spark.createDataFrame([(i, start + timedelta(days=i)) for i in range(5)] + [(9, None)], "v int, d date")


def test_replace_keeps_the_old_table_until_the_end(spark, tmp_path):
    path = str(tmp_path / "t")
    old = writers.replace_table(spark.range(5), path)
    bad = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("died"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="died"):
        writers.replace_table(bad, path)
    assert versions.read(spark, path).count() == old.count() == 5
    # a table may be replaced by one that is computed from it, and a reader of the old one goes on
    new = writers.replace_table(versions.read(spark, path).where("id > 1"), path)
    assert (new.count(), old.count()) == (3, 5)
    writers.replace_table(spark.range(1), path)
    assert len([p for p in (tmp_path / "t").glob("part-*") if list(p.glob("*.parquet"))]) <= 3
    with pytest.raises(versions.VersionError):
        versions.read(spark, str(tmp_path / "none"))


def test_replace_days(spark, tmp_path, dated):
    path = str(tmp_path / "t")
    whole = versions.replace_days(dated, path, "d")
    assert rows_of(whole) == rows_of(dated)
    before = versions.parts_of(spark, path)
    some = dated.where("v < 3").withColumn("v", F.col("v") + 100)
    new = versions.replace_days(some, path, "d", [date(2024, 1, 2), date(2024, 1, 4), date(2024, 2, 1)])
    assert sorted(r["v"] for r in new.collect()) == [0, 2, 4, 9, 101]
    after = versions.parts_of(spark, path)
    assert {k for k in before if before[k] == after.get(k)} == {"2024-01-01", "2024-01-03", "2024-01-05", "none"}
    assert "2024-01-04" not in after and rows_of(whole) == rows_of(dated)
    assert days_of(versions.read(spark, path, [date(2024, 1, 2), date(2024, 3, 1)])) == [2]
    assert versions.read(spark, path, []).count() == 0
    versions.replace(dated, path)
    with pytest.raises(versions.VersionError):
        versions.replace_days(dated, path, "d", [date(2024, 1, 2)])
    assert versions.replace_days(dated.where("v = 1"), path, "d").count() == 1


def requests_on(spark, days, seed):
    """Requests over the given days: frequent paths and users, some silent for long, ties, and one far from all others."""
    draw = random.Random(seed)
    rows = []
    for day in days:
        for i in range(25):
            at = datetime(2024, 1, 1) + timedelta(days=day, hours=draw.choice([0, 7, 23]), seconds=draw.choice([0, 0, 59]))
            rows.append((at, draw.choice(["/a", "/b", f"/odd{day % 3}"]), draw.choice([200, 404, 500]), draw.randint(1, 900),
                         draw.choice(["u", None, f"user{day}"]), f"t{seed}-{day}-{i}"))
    return spark.createDataFrame(rows, "event_timestamp timestamp_ntz, api_path string, status_code int, latency_ms long, user_uid string, trace string")


def test_days_to_rebuild(spark):
    cells = spark.createDataFrame([("a", date(2024, 1, d)) for d in (1, 5, 6, 9)] + [("b", date(2024, 1, d)) for d in (2, 20)], "k string, day date")
    index = touched.key_days(cells, "k", "day")
    assert [d.day for d in touched.days_to_rebuild(index, [date(2024, 1, 5)])] == [1, 5, 6, 9]
    assert [d.day for d in touched.days_to_rebuild(index, [date(2024, 1, 9)])] == [6, 9]
    assert [d.day for d in touched.days_to_rebuild(index, [date(2024, 1, 31)])] == [31]


def test_an_appended_day_gives_what_a_whole_build_gives(spark, tmp_path):
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    writers.append_requests(requests_on(spark, [0, 1, 2, 5, 30], 1), store)
    P.build_metrics(spark.read.parquet(store), out)
    parts = {name: versions.parts_of(spark, f"{out}/warehouse/{name}") for name in P.DAY_COLUMNS}
    # a new last day, and late requests between old days
    writers.append_requests(requests_on(spark, [4, 31], 2), store)
    stored = spark.read.parquet(store)
    days = [date(2024, 1, 5), date(2024, 2, 1)]
    built = P.build_metrics(stored, out, days=days)
    whole = P.build_metrics(stored, str(tmp_path / "whole"))
    assert set(built) == set(whole) == {*P.FROM_CELLS, *P.FROM_REQUESTS}
    for name, table in whole.items():
        assert rows_of(built[name]) == rows_of(table), name
    for name, before in parts.items():
        now = versions.parts_of(spark, f"{out}/warehouse/{name}")
        same = {key for key in before if now.get(key) == before[key]}
        if name not in P.ROLLING_KEYS:
            assert same == set(before) - {d.isoformat() for d in days}, name
        elif "2024-01-01" in before and name != P.SPIKES_TABLE:
            assert "2024-01-01" in same, name
    assert days_of(versions.read(spark, f"{out}/warehouse/{P.CELLS_TABLE}").select(F.to_date("hour_ts").alias("d")).distinct()) == [1, 1, 2, 3, 5, 6, 31]
