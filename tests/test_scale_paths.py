"""The ways taken beyond the size checks give the same results as the small-table ways."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from reqloom.operators import drift, errors, latency, quality, selection, staging, users
from reqloom.operators.attach import attach_stats
from reqloom.operators.percentiles import percentile_summary
from reqloom.operators.prefix import sums_before
from reqloom.operators.ranking import Ranking, rank_within
from tests.conftest import rows_of

LARGE = {"single_task_rows": 0, "broadcast_bytes": 0}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one group, many share one value; groups and values may be null."""
    draw = random.Random(7)
    rows = []
    for i in range(3000):
        group = "hot" if i % 3 == 0 else draw.choice(["a", "b", "c", "d", None])
        value = 5 if draw.random() < 0.4 else draw.choice([None, *range(40)])
        rows.append((i, group, value, draw.random() * 100))
    return spark.createDataFrame(rows, "id bigint, g string, v int, x double")


def test_sums_before(skewed):
    order = [F.col("v").asc_nulls_first(), F.col("id")]
    sums = {"before_n": F.lit(1), "before_v": F.col("v")}
    window = Window.partitionBy("g").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    expected = skewed.select("*", *[F.coalesce(F.sum(c).over(window), F.lit(0)).alias(n) for n, c in sums.items()])
    for limit in (0, 10**6):
        assert rows_of(sums_before(skewed, ["g"], order, sums, limit)) == rows_of(expected)


def test_sums_before_without_group(skewed):
    order = [F.col("id")]
    out = sums_before(skewed, [], order, {"n": F.lit(1)}, 0)
    assert all(row["n"] == row["id"] for row in out.collect())


def test_attach_stats(skewed):
    stats = skewed.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.sum("v").alias("total"))
    whole = Window.partitionBy("g")
    expected = skewed.select("*", F.count(F.lit(1)).over(whole).alias("size"), F.sum("v").over(whole).alias("total"))
    for limit in (0, 10**9):
        assert rows_of(attach_stats(skewed, stats, ["g"], "size", limit)) == rows_of(expected)


def test_attach_stats_peels_off_hot_groups_only(spark):
    """Groups below the hot share meet their rows in the shuffle join."""
    rows = spark.range(20_000).select((F.col("id") % 5_000).alias("g"), F.col("id"))
    rows = rows.unionByName(spark.range(10_000).select(F.lit(-1).cast("bigint").alias("g"), F.col("id")))
    stats = rows.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    out = attach_stats(rows, stats, ["g"], "size", 0)
    assert out.count() == 30_000
    assert out.where("g = -1").agg(F.min("size"), F.count(F.lit(1))).first() == (10_000, 10_000)
    assert out.where("g >= 0").agg(F.max("size"), F.count(F.lit(1))).first() == (4, 20_000)


def test_rank_within(skewed):
    rankings = [
        Ranking("r", "rank", "v"),
        Ranking("d", "dense_rank", "x"),
        Ranking("n", "row_number", "v", tiebreak="id"),
    ]
    totals = {"mean": F.avg("x"), "size": F.count(F.lit(1))}
    small = rank_within(skewed, ["g"], rankings, totals)
    large = rank_within(skewed, ["g"], rankings, totals, **LARGE)
    assert rows_of(large) == rows_of(small)


@pytest.mark.parametrize(
    "operator", [latency.latency_rank_daily, errors.top_error_endpoints_daily, users.user_activity_daily]
)
def test_ranked_tables(requests, operator):
    assert rows_of(operator(requests, **LARGE)) == rows_of(operator(requests))


def test_iqr_bounds(spark):
    draw = random.Random(3)
    values = [draw.gauss(0, 10) for _ in range(500)] + [1.0] * 200 + [None, float("nan")]
    df = spark.createDataFrame([(v, i, None) for i, v in enumerate(values)], "value double, i int, `no value` double")
    known = np.array([v for v in values if v is not None and v == v])
    q1, q3 = np.quantile(known, [0.25, 0.75])
    row = {r["column_name"]: r for r in quality.iqr_bounds(df, ["value", "i", "no value"]).collect()}
    assert set(row) == {"value", "i"} and row["value"]["q1"] == pytest.approx(q1)
    assert row["value"]["q3"] == pytest.approx(q3)
    assert row["value"]["lower"] == pytest.approx(q1 - 1.5 * (q3 - q1))


def test_rank_selection(spark):
    """Brackets narrow over several rounds: wide and tied values, infinities, one value, columns beyond one pass."""
    draw = random.Random(4)
    inf = float("inf")
    columns = {
        "wide": [draw.lognormvariate(0, 8) for _ in range(3000)],
        "tied": [float(draw.choice([0, 0, 0, 1, 2])) for _ in range(3000)],
        "signs": [draw.choice([-inf, inf, draw.gauss(0, 1), None, float("nan")]) for _ in range(3000)],
        "same": [7.0] * 3000,
        "few": [float(i) if i < 3 else None for i in range(3000)],
        "none": [None] * 3000,
    }
    schema = ", ".join(f"{name} double" for name in columns)
    df = spark.createDataFrame(list(zip(*columns.values())), schema).repartition(3)
    ranks = lambda n: sorted({0, n // 4, n // 4 + 1, n // 2, n - 1}) if n > 4 else list(range(n))
    for keep, accuracy in ((10, 20), (200, 50), (10**6, 10_000)):
        got = selection.values_at(df, list(columns), ranks, keep, accuracy)
        for name, values in columns.items():
            known = sorted(v for v in values if v is not None and v == v)
            assert got[name] == (len(known), {rank: known[rank] for rank in ranks(len(known))}), (name, keep)
    many = df.select(*[(F.col("wide") + i).alias(f"c{i}") for i in range(30)])
    quartiles = selection.interpolated(many, many.columns, (25, 50, 75), 50, 100)
    for i, name in enumerate(many.columns):
        assert quartiles[name] == pytest.approx(list(np.quantile(np.array(columns["wide"]) + i, [0.25, 0.5, 0.75])))


@pytest.mark.parametrize("ranges", [2, 7, 200])
def test_ks_by_ranges(spark, ranges):
    draw = random.Random(6)
    inf = float("inf")
    names = ("a", "tied", "ends", "gone")

    def sample(n, shift):
        return [(draw.gauss(shift, 1), float(draw.choice([0, 0, 1])), draw.choice([-inf, inf, 0.5, None]), None if shift else 1.0) for _ in range(n)]

    ref, cur = sample(700, 0.0), sample(450, 0.1)
    schema = ", ".join(f"{name} double" for name in names)
    rows = {r["metric"]: r for r in drift.ks_statistics(spark.createDataFrame(ref, schema), spark.createDataFrame(cur, schema), ranges).collect()}
    for i, name in enumerate(names):
        a, b = ([row[i] for row in rows_ if row[i] is not None] for rows_ in (ref, cur))
        gaps = [abs(sum(v <= p for v in a) / len(a) - sum(v <= p for v in b) / len(b)) for p in {*a, *b}] if a and b else [0.0]
        assert (rows[name]["n_ref"], rows[name]["n_cur"]) == (len(a), len(b))
        assert rows[name]["ks_statistic"] == pytest.approx(max(gaps))


def test_ks_statistic_is_the_largest_gap(spark):
    draw = random.Random(5)
    a = [float(draw.randint(0, 30)) for _ in range(200)]
    b = [float(draw.randint(5, 40)) for _ in range(150)]
    points = sorted({*a, *b})
    brute = max(abs(sum(v <= p for v in a) / len(a) - sum(v <= p for v in b) / len(b)) for p in points)
    frames = [spark.createDataFrame([(v,) for v in s], "value double") for s in (a, b)]
    assert drift.ks_statistics(*frames).first()["ks_statistic"] == pytest.approx(brute)


@pytest.mark.parametrize("kind", ["int", "double"])
def test_percentiles(spark, kind):
    draw = random.Random(11)
    groups = {"a": 101, "b": 100, "c": 1, None: 17}
    data = {}
    for group, size in groups.items():
        numbers = [draw.randint(0, 50) if kind == "int" else draw.choice([draw.random() * 9 - 4, 2.5]) for _ in range(size)]
        data[group] = numbers
    rows = [(g, v, 1) for g, vs in data.items() for v in vs] + [("a", None, 1), ("empty", None, 1)]
    if kind == "double":
        rows.append(("a", float("nan"), 1))
    df = spark.createDataFrame(rows, f"g string, v {kind}, n_requests bigint")
    percents = {"p0": 0, "p50": 50, "p95": 95, "p100": 100}
    disc = {r["g"]: r for r in percentile_summary(df, ["g"], "v", percents).collect()}
    cont = {r["g"]: r for r in percentile_summary(df, ["g"], "v", percents, interpolate=True).collect()}
    for group, numbers in data.items():
        ordered = sorted(numbers)
        for name, percent in percents.items():
            position = max(1, -(-len(ordered) * percent // 100))
            assert disc[group][name] == ordered[position - 1], (group, name)
            assert cont[group][name] == pytest.approx(np.quantile(ordered, percent / 100)), (group, name)
    assert disc["empty"]["p50"] is None and cont["empty"]["p50"] is None


def test_staged_table_is_written_to_the_shared_folder(spark):
    staged = staging.stage(spark.range(10).withColumn("t", F.lit("text")))
    assert staging.shared_folder(spark) in staged.inputFiles()[0]
    assert staging.staged_bytes(staged) == 10 * 64 + 40
