"""Service-level metrics: shares of requests under 500 ms, 1 s and 2 s."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqloom.functions.measures import WEIGHT, flag, share, total, with_dims
from reqloom.operators.errors import HOUR
from reqloom.operators.latency import LATENCY
from reqloom.operators.percentiles import percentile_summary
from reqloom.operators.rolling import BUCKET_SECONDS, Lookback, as_rows, key_column, neighbours, rolling_instants

# Upper limits in milliseconds, exclusive.
SLA_LIMITS = {"sla_lt_500ms_rate": 500, "sla_lt_1s_rate": 1000, "sla_lt_2s_rate": 2000}


def sla_summary(requests: DataFrame, keys: list[str], percents: dict[str, int]) -> DataFrame:
    """A request without latency counts in the denominator only."""
    weight = F.col(WEIGHT)
    return percentile_summary(
        with_dims(requests, *keys),
        keys,
        LATENCY,
        percents,
        extra={
            "total_requests": total(weight),
            **{name: share(weight, F.col(LATENCY) < limit) for name, limit in SLA_LIMITS.items()},
        },
    )


def sla_kpis(requests: DataFrame) -> DataFrame:
    return sla_summary(requests, ["api_path"], {"p95_latency_ms": 95, "p99_latency_ms": 99})


def sla_hourly(requests: DataFrame) -> DataFrame:
    return sla_summary(requests, ["hour_ts", "api_path"], {"p95_latency_ms": 95})


def sla_daily(requests: DataFrame) -> DataFrame:
    return sla_summary(requests, ["day", "api_path"], {"p95_latency_ms": 95})


def sla_rolling_drift(requests: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Per request: share under 500 ms over the path's last hour and its change against the previous request."""
    rolled = rolling_instants(
        requests,
        "api_path",
        "event_timestamp",
        flag(F.col(LATENCY) < SLA_LIMITS["sla_lt_500ms_rate"]),
        [Lookback(HOUR, "_total", "_ok")],
        bucket_seconds,
    )
    rate, previous = "rolling_sla_rate_500ms_1h", "prev_rolling_sla_rate_500ms_1h"
    rates = rolled.withColumn(rate, F.try_divide("_ok", "_total"))
    trend = as_rows(neighbours(rates, rate, previous=previous), rate, previous=previous)
    return trend.where(F.col(previous).isNotNull()).select(
        F.col("_ts").alias("event_timestamp"),
        key_column().alias("api_path"),
        rate,
        previous,
        (F.col(rate) - F.col(previous)).alias("sla_rate_delta"),
    )
