"""Latency metrics. Inputs are request rows or pre-aggregated cells (see functions.measures)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reqloom.functions.measures import WEIGHT, cells, total, weighted_mean, with_dims
from reqloom.operators.attach import attach_stats
from reqloom.operators.percentiles import percentile_summary
from reqloom.operators.ranking import Ranking, rank_within
from reqloom.operators.rolling import BUCKET_SECONDS, bucket_of, by_cell, key_column, keyed, neighbours

LATENCY = "latency_ms"
PERCENTS = {"p50_latency_ms": 50, "p95_latency_ms": 95, "p99_latency_ms": 99}


def latency_summary(requests: DataFrame, keys: list[str], percents: dict[str, int] | None = None) -> DataFrame:
    """Requests, mean, max and percentiles of latency per `keys`."""
    weight, value = F.col(WEIGHT), F.col(LATENCY)
    return percentile_summary(
        with_dims(requests, *keys),
        keys,
        LATENCY,
        PERCENTS if percents is None else percents,
        extra={
            "total_requests": total(weight),
            "avg_latency_ms": weighted_mean(weight, value),
            "max_latency_ms": F.max(value),
        },
    )


def latency_kpis(requests: DataFrame) -> DataFrame:
    return latency_summary(requests, ["api_path"])


def latency_hourly(requests: DataFrame) -> DataFrame:
    return latency_summary(requests, ["hour_ts", "api_path"])


def latency_rank_daily(requests: DataFrame, **limits: int) -> DataFrame:
    """Paths of a day ranked by p95 and by mean; the mean over paths and the day's requests beside them."""
    daily = latency_summary(requests, ["day", "api_path"], {"p95_latency_ms": 95}).drop("max_latency_ms")
    ranked = rank_within(
        daily,
        ["day"],
        [
            Ranking("rank_p95_slowest", "rank", "p95_latency_ms"),
            Ranking("dense_rank_avg_slowest", "dense_rank", "avg_latency_ms"),
        ],
        {"day_avg_latency_ms": F.avg("avg_latency_ms"), "day_total_requests": F.sum("total_requests")},
        **limits,
    )
    return ranked.select(
        "day",
        "api_path",
        "total_requests",
        "avg_latency_ms",
        "p95_latency_ms",
        "day_avg_latency_ms",
        "day_total_requests",
        "rank_p95_slowest",
        "dense_rank_avg_slowest",
    )


def rolling_avg_hourly(requests: DataFrame) -> DataFrame:
    """Mean latency per hour and its moving mean over seven rows. One row per hour reaches the ordered window."""
    hourly = cells(requests, "hour_ts", LATENCY).groupBy("hour_ts").agg(
        weighted_mean(F.col(WEIGHT), F.col(LATENCY)).alias("avg_latency_ms")
    )
    seven = Window.orderBy("hour_ts").rowsBetween(-6, 0)
    return hourly.withColumn("rolling_avg_latency_ms", F.avg("avg_latency_ms").over(seven))


def latency_delta(requests: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Change of latency against the previous request of the same path."""
    rows = keyed(requests, "api_path", "event_timestamp", bucket_seconds, trace=F.col("trace"), latency_ms=F.col(LATENCY))
    looked = neighbours(by_cell(rows), LATENCY, previous="prev_latency_ms", tiebreak="trace")
    return looked.select(
        F.col("_ts").alias("event_timestamp"),
        key_column().alias("api_path"),
        "trace",
        LATENCY,
        "prev_latency_ms",
        (F.col(LATENCY) - F.col("prev_latency_ms")).alias("latency_delta_ms"),
    )


def slowest_requests_per_path(requests: DataFrame, k: int = 20) -> DataFrame:
    """The k slowest requests of each path. The row-number filter keeps k rows per path before the shuffle."""
    slowest = Window.partitionBy("api_path").orderBy(F.col(LATENCY).desc_nulls_last(), F.col("trace").asc_nulls_first())
    ranked = requests.select("event_timestamp", "api_path", "trace", LATENCY).withColumn(
        "latency_rownum", F.row_number().over(slowest)
    )
    return ranked.where(F.col("latency_rownum") <= k).withColumn("latency_rownum", F.col("latency_rownum").cast("bigint"))


def latency_row_numbers(requests: DataFrame) -> DataFrame:
    """Row number of every request within its path, slowest first.

    Requests that sort earlier are counted in three steps: slower values of the path, earlier buckets of the same value,
    earlier requests of the same value and bucket. Each step's window covers one such part only.
    """
    rows = requests.select(
        "event_timestamp", "api_path", "trace", LATENCY, bucket_of(F.col("event_timestamp"), BUCKET_SECONDS).alias("_bucket")
    )
    per_bucket = rows.groupBy("api_path", LATENCY, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    per_value = per_bucket.groupBy("api_path", LATENCY).agg(F.sum("_size").alias("_value_size"))
    slower = Window.partitionBy("api_path").orderBy(F.col(LATENCY).desc_nulls_last())
    until_now = Window.unboundedPreceding
    per_value = per_value.select(
        F.col("api_path").alias("_p"),
        F.col(LATENCY).alias("_l"),
        F.coalesce(F.sum("_value_size").over(slower.rowsBetween(until_now, -1)), F.lit(0)).alias("_slower"),
    )
    earlier = Window.partitionBy("api_path", LATENCY).orderBy("_bucket").rowsBetween(until_now, -1)
    per_bucket = per_bucket.withColumn("_earlier", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    offsets = per_bucket.join(
        per_value, F.col("api_path").eqNullSafe(F.col("_p")) & F.col(LATENCY).eqNullSafe(F.col("_l"))
    ).select("api_path", LATENCY, "_bucket", "_size", (F.col("_slower") + F.col("_earlier")).alias("_before"))
    inside = Window.partitionBy("api_path", LATENCY, "_bucket").orderBy("event_timestamp", "trace")
    numbered = attach_stats(
        rows.withColumn("_inside", F.row_number().over(inside)), offsets, ["api_path", LATENCY, "_bucket"], "_size"
    )
    return numbered.select(
        "event_timestamp", "api_path", "trace", LATENCY, (F.col("_before") + F.col("_inside")).alias("latency_rownum")
    )


def latency_vs_path_mean(requests: DataFrame) -> DataFrame:
    """Each request beside the mean latency of its path."""
    stats = requests.groupBy("api_path").agg(
        F.count(F.lit(1)).alias("_size"), F.avg(LATENCY).alias("path_avg_latency_ms")
    )
    rows = requests.select("event_timestamp", "api_path", "trace", LATENCY)
    return attach_stats(rows, stats, ["api_path"], "_size").drop("_size")
