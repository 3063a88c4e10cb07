"""Small dashboard tables with day and hour as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqloom.functions.measures import (
    WEIGHT,
    cells,
    is_4xx,
    is_5xx,
    share,
    time_of,
    total,
    total_if,
    weight_of,
    weighted_mean,
)


def _with_text_time(requests: DataFrame) -> DataFrame:
    ts = time_of(requests)
    return requests.withColumns(
        {"day": F.date_format(ts, "yyyy-MM-dd"), "hour": F.date_format(ts, "yyyy-MM-dd HH:00:00")}
    )


def local_latency_daily(requests: DataFrame) -> DataFrame:
    ready = _with_text_time(requests)
    weight, latency = weight_of(ready), F.col("latency_ms")
    return ready.groupBy("day", "api_path").agg(
        total(weight).alias("total_requests"),
        weighted_mean(weight, latency).alias("avg_latency_ms"),
        F.max(latency).alias("max_latency_ms"),
    )


def local_errors_hourly(requests: DataFrame) -> DataFrame:
    ready = _with_text_time(requests)
    weight = weight_of(ready)
    return ready.groupBy("hour", "api_path").agg(
        total(weight).alias("total_requests"),
        total_if(weight, is_4xx()).alias("total_4xx"),
        total_if(weight, is_5xx()).alias("total_5xx"),
        share(weight, is_5xx()).alias("error_rate_5xx"),
    )


def local_status_codes(requests: DataFrame) -> DataFrame:
    counts = cells(_with_text_time(requests), "day", "api_path", "status_code")
    return counts.withColumnRenamed(WEIGHT, "total_requests")
