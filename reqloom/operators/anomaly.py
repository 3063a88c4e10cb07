"""Anomaly tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reqloom import schemas as S
from reqloom.functions.measures import flag, is_5xx
from reqloom.operators.attach import attach_stats
from reqloom.operators.errors import DAY, HOUR
from reqloom.operators.latency import LATENCY, latency_summary
from reqloom.operators.rolling import BUCKET_SECONDS, Lookback, key_column, rolling_counts


def anomaly_latency_zscore(requests: DataFrame, limit: float = S.LATENCY_Z_LIMIT) -> DataFrame:
    """Requests whose latency lies `limit` or more sample standard deviations from their path's mean."""
    value = F.col(LATENCY).cast("double")
    stats = requests.groupBy("api_path").agg(
        F.count(F.lit(1)).alias("_size"),
        F.avg(value).alias("avg_latency_ms"),
        F.stddev_samp(value).alias("std_latency_ms"),
    )
    rows = requests.select("event_timestamp", "api_path", LATENCY)
    spread = F.nullif(F.col("std_latency_ms"), F.lit(0.0))
    scored = attach_stats(rows, stats, ["api_path"], "_size").withColumn(
        "z_score", F.try_divide(F.col(LATENCY) - F.col("avg_latency_ms"), spread)
    )
    kept = ~F.isnan("z_score") & (F.abs("z_score") >= limit)
    return scored.where(kept).select(
        "event_timestamp", "api_path", LATENCY, "avg_latency_ms", "std_latency_ms", "z_score"
    )


def anomaly_error_spikes(
    requests: DataFrame,
    min_rate: float = S.SPIKE_MIN_RATE,
    min_diff: float = S.SPIKE_MIN_DIFF,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Requests at which the path's error rate over an hour is high and well above that over a day."""
    rolled = rolling_counts(
        requests,
        "api_path",
        "event_timestamp",
        flag(is_5xx()),
        [Lookback(HOUR, "_n1", "_x1"), Lookback(DAY, "_n24", "_x24")],
        bucket_seconds,
    )
    rates = rolled.select(
        F.col("_ts").alias("event_timestamp"),
        key_column().alias("api_path"),
        F.try_divide("_x1", "_n1").alias("rate_5xx_1h"),
        F.try_divide("_x24", "_n24").alias("rate_5xx_24h"),
    )
    return spikes_of(rates, min_rate, min_diff)


def spikes_of(rates: DataFrame, min_rate: float = S.SPIKE_MIN_RATE, min_diff: float = S.SPIKE_MIN_DIFF) -> DataFrame:
    """Spikes among rows that already carry the hourly and daily rate."""
    return (
        rates.select("event_timestamp", "api_path", "rate_5xx_1h", "rate_5xx_24h")
        .withColumn("rate_diff", F.col("rate_5xx_1h") - F.col("rate_5xx_24h"))
        .where((F.col("rate_5xx_1h") >= min_rate) & (F.col("rate_diff") >= min_diff))
    )


def endpoint_degradation_daily(
    requests: DataFrame,
    min_ratio: float = S.DEGRADATION_MIN_RATIO,
    min_requests: int = S.DEGRADATION_MIN_REQUESTS,
) -> DataFrame:
    """Days on which a path's p95 rose by `min_ratio` or more against its previous day with requests."""
    daily = latency_summary(requests, ["day", "api_path"], {"p95_latency_ms": 95})
    by_day = Window.partitionBy("api_path").orderBy("day")
    before = F.nullif(F.col("prev_p95_latency_ms"), F.lit(0))
    return (
        daily.select("day", "api_path", "total_requests", "p95_latency_ms")
        .withColumn("prev_p95_latency_ms", F.lag("p95_latency_ms").over(by_day))
        .withColumn("p95_change_ratio", F.try_divide(F.col("p95_latency_ms") - F.col("prev_p95_latency_ms"), before))
        .where(
            F.col("prev_p95_latency_ms").isNotNull()
            & (F.col("p95_change_ratio") >= min_ratio)
            & (F.col("total_requests") >= min_requests)
        )
    )
