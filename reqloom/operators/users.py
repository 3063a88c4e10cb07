"""User metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqloom.functions.measures import flag, is_4xx, is_5xx, share, total, total_if, weight_of, weighted_mean, with_dims
from reqloom.operators.errors import HOUR
from reqloom.operators.ranking import Ranking, rank_within
from reqloom.operators.rolling import (
    BUCKET_SECONDS,
    ROWS_PER_KEY,
    WHOLE_KEY,
    Lookback,
    as_rows,
    key_column,
    neighbours,
    rolling_instants,
    split_busy,
)

UNAUTHORIZED = 401
FORBIDDEN = 403


def user_kpis(requests: DataFrame) -> DataFrame:
    weight, code = weight_of(requests), F.col("status_code")
    return requests.groupBy("user_uid").agg(
        total(weight).alias("total_requests"),
        total_if(weight, code == UNAUTHORIZED).alias("total_401"),
        total_if(weight, code == FORBIDDEN).alias("total_403"),
        total_if(weight, is_4xx()).alias("total_4xx"),
        total_if(weight, is_5xx()).alias("total_5xx"),
        share(weight, is_4xx()).alias("rate_4xx"),
        share(weight, is_5xx()).alias("rate_5xx"),
        weighted_mean(weight, F.col("latency_ms")).alias("avg_latency_ms"),
    )


def user_activity_daily(requests: DataFrame, **limits: int) -> DataFrame:
    """Users of a day ranked by volume and by mean latency, with the day's mean volume per user."""
    ready = with_dims(requests, "day")
    weight = weight_of(ready)
    daily = ready.groupBy("day", "user_uid").agg(
        total(weight).alias("total_requests"),
        weighted_mean(weight, F.col("latency_ms")).alias("avg_latency_ms"),
    )
    ranked = rank_within(
        daily,
        ["day"],
        [
            Ranking("rank_by_volume", "rank", "total_requests"),
            Ranking("dense_rank_by_latency", "dense_rank", "avg_latency_ms"),
        ],
        {"day_avg_requests_per_user": F.avg("total_requests")},
        **limits,
    )
    return ranked.select(
        "day",
        "user_uid",
        "total_requests",
        "avg_latency_ms",
        "day_avg_requests_per_user",
        "rank_by_volume",
        "dense_rank_by_latency",
    )


def user_auth_errors_daily(requests: DataFrame) -> DataFrame:
    ready = with_dims(requests, "day")
    weight, code = weight_of(ready), F.col("status_code")
    return ready.groupBy("day", "user_uid").agg(
        total_if(weight, code == UNAUTHORIZED).alias("total_401"),
        total_if(weight, code == FORBIDDEN).alias("total_403"),
        total(weight).alias("total_requests"),
        share(weight, code.isin(UNAUTHORIZED, FORBIDDEN)).alias("auth_error_rate"),
    )


def user_rolling_activity(requests: DataFrame, rows_per_user: int = ROWS_PER_KEY) -> DataFrame:
    """Per request: the user's requests and server errors over the last hour, with the count before and after.

    Most users send few requests and are sorted whole; the few with more than `rows_per_user` are cut into buckets.
    """
    needed = requests.select("event_timestamp", "user_uid", "status_code")
    ordinary, busy = split_busy(needed, "user_uid", rows_per_user)
    parts = [(ordinary, WHOLE_KEY), (busy, BUCKET_SECONDS)]
    return reduce(DataFrame.unionByName, [_rolling_activity(rows, width) for rows, width in parts if rows is not None])


def _rolling_activity(requests: DataFrame, bucket_seconds: int) -> DataFrame:
    count = "rolling_requests_1h"
    rolled = rolling_instants(
        requests,
        "user_uid",
        "event_timestamp",
        flag(is_5xx()),
        [Lookback(HOUR, count, "rolling_5xx_1h")],
        bucket_seconds,
    )
    sides = {"previous": "prev_rolling_requests_1h", "following": "next_rolling_requests_1h"}
    looked = neighbours(rolled, count, **sides, also_read=["rolling_5xx_1h"], whole_key=bucket_seconds == WHOLE_KEY)
    trend = as_rows(looked, count, **sides)
    return trend.select(
        F.col("_ts").alias("event_timestamp"),
        key_column().alias("user_uid"),
        count,
        "prev_rolling_requests_1h",
        "next_rolling_requests_1h",
        "rolling_5xx_1h",
        F.try_divide("rolling_5xx_1h", count).alias("rolling_rate_5xx_1h"),
    )
