"""Bucketed rolling counts against a direct count, on ties, gaps, a hot key and null keys and times."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from reqloom.functions.measures import flag
from reqloom.operators import rolling
from reqloom.operators.rolling import Lookback, key_column, neighbours, rolling_counts
from tests.conftest import rows_of

START = datetime(1969, 12, 31, 22, 0, 0)
LOOKBACKS = [Lookback(3600, "n1", "x1"), Lookback(86400, "n24", "x24")]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(42)
    out = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else draw.choice(["a", "", None])
        # exact hours and days apart, equal times, and microseconds
        offset = timedelta(
            days=draw.choice([0, 0, 1, 2, 9]),
            hours=draw.choice([0, 1, 2, 23]),
            seconds=draw.choice([0, 0, 1, 59, 60, 3599]),
            microseconds=draw.choice([0, 0, 1]),
        )
        out.append((i, key, START + offset, draw.randint(0, 1)))
    out += [(1000 + i, "a", None, 1) for i in range(3)]
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, k string, ts timestamp_ntz, x int")


def expected(rows, seconds):
    result = []
    for _, key, ts, _ in rows:
        if ts is None:
            peers = [r for r in rows if r[1] == key and r[2] is None]
        else:
            low = ts - timedelta(seconds=seconds)
            peers = [r for r in rows if r[1] == key and r[2] is not None and low <= r[2] <= ts]
        result.append((key, ts, len(peers), sum(r[3] for r in peers)))
    return result


@pytest.mark.parametrize("bucket_seconds", [rolling.WHOLE_KEY, 1, 60, 3600])
def test_rolling_counts(frame, rows, bucket_seconds):
    rolled = rolling_counts(frame, "k", "ts", flag(F.col("x") == 1), LOOKBACKS, bucket_seconds)
    for lookback in LOOKBACKS:
        got = rolled.select(key_column().alias("k"), "_ts", lookback.count_name, lookback.flagged_name).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(expected(rows, lookback.seconds), key=repr)


def test_lookback_must_be_whole_buckets(frame):
    with pytest.raises(ValueError):
        rolling_counts(frame, "k", "ts", F.lit(0), [Lookback(90, "n", "x")], 60)


@pytest.mark.parametrize("bucket_seconds", [60, 3600])
def test_neighbours(frame, rows, bucket_seconds):
    keyed = rolling.by_cell(rolling.keyed(frame, "k", "ts", bucket_seconds, id=F.col("id")))
    got = neighbours(keyed, "id", previous="before", following="after", tiebreak="id")
    got = got.select(key_column().alias("k"), "id", "before", "after").collect()
    want = []
    for key in {r[1] for r in rows}:
        ordered = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2] is not None, r[2] or START, r[0]))
        ids = [r[0] for r in ordered]
        want += list(zip([key] * len(ids), ids, [None, *ids], [*ids[1:], None]))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("bucket_seconds", [rolling.WHOLE_KEY, 60])
def test_rows_of_one_instant(spark, monkeypatch, bucket_seconds):
    """Copies of an instant become rows again, in parts, with their neighbours by row."""
    monkeypatch.setattr(rolling, "ROWS_AT_ONCE", 3)
    data = [("a", START, 1)] * 7 + [("a", START + timedelta(seconds=30), 0)] * 2 + [("a", START + timedelta(hours=2), 1)]
    frame = spark.createDataFrame(data, "k string, ts timestamp_ntz, x int")
    instants = rolling.rolling_instants(frame, "k", "ts", F.col("x"), [Lookback(3600, "n", "f")], bucket_seconds)
    assert sorted(r["_rows"] for r in instants.collect()) == [1, 2, 7]
    sides = {"previous": "before", "following": "after"}
    looked = rolling.as_rows(neighbours(instants, "n", **sides, whole_key=bucket_seconds == rolling.WHOLE_KEY), "n", **sides)
    got = sorted((r["_ts"], r["n"], r["f"], r["before"], r["after"]) for r in looked.na.fill(-1).collect())
    second, last = START + timedelta(seconds=30), START + timedelta(hours=2)
    want = [(START, 7, 7, -1, 7)] + [(START, 7, 7, 7, 7)] * 5 + [(START, 7, 7, 7, 9)]
    want += [(second, 9, 7, 7, 9), (second, 9, 7, 9, 1), (last, 1, 1, 9, -1)]
    assert got == sorted(want)


def test_running_mean(frame, rows):
    named = frame.select(F.col("k"), F.col("ts").alias("event_timestamp"), F.lpad("id", 5, "0").alias("trace"), "id")
    got = {r["trace"]: r for r in rolling.running_mean(named, "k", "id").collect()}
    for key in {r[1] for r in rows}:
        ordered = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2] is not None, r[2] or START, r[0]))
        total = 0
        for count, row in enumerate(ordered, 1):
            total += row[0]
            assert got[f"{row[0]:05d}"]["running_count"] == count
            assert got[f"{row[0]:05d}"]["running_mean"] == pytest.approx(total / count)


def test_the_row_shuffle_runs_once(requests):
    from reqloom.operators.errors import errors_rolling
    from reqloom.operators.users import user_rolling_activity

    for df in (errors_rolling(requests), user_rolling_activity(requests, rows_per_user=0)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("REPARTITION_BY_COL") - plan.count("ReusedExchange") <= 1
        assert "ReusedExchange" in plan


def test_busy_users_are_cut_into_buckets(requests):
    """Few, some and all users over the limit, and busy users too many to broadcast: the same rows."""
    from reqloom.operators.users import user_rolling_activity

    ordinary = rows_of(user_rolling_activity(requests))
    counts = sorted(r["count"] for r in requests.groupBy("user_uid").count().collect())
    assert counts[0] < counts[-1]
    for limit in (0, counts[len(counts) // 2]):
        assert rows_of(user_rolling_activity(requests, limit)) == ordinary
    quiet, busy = rolling.split_busy(requests, "user_uid", counts[-1] - 1)
    assert quiet.count() + busy.count() == requests.count() and busy.count() >= counts[-1]
    assert rolling.split_busy(requests, "user_uid", 0, broadcast_bytes=0) == (None, requests)


def test_time_zone_does_not_matter(spark, requests):
    from reqloom.operators.errors import errors_rolling

    utc = rows_of(errors_rolling(requests))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows_of(errors_rolling(requests)) == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_update_running_means(spark):
    state = spark.createDataFrame([("a", 10.0, 2), ("b", 5.0, 1), (None, 1.0, 1)], "k string, running_mean double, running_count bigint")
    batch = spark.createDataFrame([("a", 40.0), ("c", 7.0), (None, 3.0), ("b", None)], "k string, v double")
    got = {r["k"]: (r["running_mean"], r["running_count"]) for r in rolling.update_running_means(state, batch, "k", "v").collect()}
    assert got == {"a": (20.0, 3), "b": (5.0, 1), "c": (7.0, 1), None: (2.0, 2)}
    broken = state.withColumn("running_count", F.lit(-1).cast("bigint"))
    with pytest.raises(Exception, match="Count must be"):
        rolling.update_running_means(broken, batch, "k", "v").collect()
