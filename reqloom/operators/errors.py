"""Error metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqloom.functions.measures import flag, is_4xx, is_5xx, share, total, total_if, weight_of, with_dims
from reqloom.operators.ranking import Ranking, rank_within
from reqloom.operators.rolling import BUCKET_SECONDS, Lookback, as_rows, key_column, neighbours, rolling_instants
from reqloom.schemas import TOP_ENDPOINTS

HOUR = 3600
DAY = 24 * HOUR


def error_summary(requests: DataFrame, keys: list[str]) -> DataFrame:
    ready = with_dims(requests, *keys)
    weight = weight_of(ready)
    return ready.groupBy(*keys).agg(
        total(weight).alias("total_requests"),
        total_if(weight, is_4xx()).alias("total_4xx"),
        total_if(weight, is_5xx()).alias("total_5xx"),
        share(weight, is_4xx()).alias("rate_4xx"),
        share(weight, is_5xx()).alias("rate_5xx"),
    )


def error_kpis(requests: DataFrame) -> DataFrame:
    return error_summary(requests, ["api_path"])


def errors_hourly(requests: DataFrame) -> DataFrame:
    return error_summary(requests, ["hour_ts", "api_path"])


def errors_rolling(requests: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Per request: server errors and requests of its path over the last hour and day, with the rate before and after."""
    rolled = rolling_instants(
        requests,
        "api_path",
        "event_timestamp",
        flag(is_5xx()),
        [
            Lookback(HOUR, "rolling_total_1h", "rolling_5xx_1h"),
            Lookback(DAY, "rolling_total_24h", "rolling_5xx_24h"),
        ],
        bucket_seconds,
    )
    rates = rolled.withColumns(
        {
            "rolling_rate_5xx_1h": F.try_divide("rolling_5xx_1h", "rolling_total_1h"),
            "rolling_rate_5xx_24h": F.try_divide("rolling_5xx_24h", "rolling_total_24h"),
        }
    )
    sides = {"previous": "prev_rate_5xx_1h", "following": "next_rate_5xx_1h"}
    trend = as_rows(neighbours(rates, "rolling_rate_5xx_1h", **sides), "rolling_rate_5xx_1h", **sides)
    return trend.select(
        F.col("_ts").alias("event_timestamp"),
        key_column().alias("api_path"),
        "rolling_5xx_1h",
        "rolling_total_1h",
        "rolling_rate_5xx_1h",
        "prev_rate_5xx_1h",
        "next_rate_5xx_1h",
        "rolling_5xx_24h",
        "rolling_total_24h",
        "rolling_rate_5xx_24h",
    )


def top_error_endpoints_daily(requests: DataFrame, k: int = TOP_ENDPOINTS, **limits: int) -> DataFrame:
    """Paths among a day's first k by server errors (ties kept) or by error rate (ties by path name)."""
    daily = error_summary(requests, ["day", "api_path"]).drop("total_4xx", "rate_4xx")
    ranked = rank_within(
        daily,
        ["day"],
        [
            Ranking("rank_by_5xx", "rank", "total_5xx"),
            Ranking("rownum_by_rate", "row_number", "rate_5xx", tiebreak="api_path"),
        ],
        **limits,
    )
    return ranked.where((F.col("rank_by_5xx") <= k) | (F.col("rownum_by_rate") <= k))


def rolling_error_rate_hourly(requests: DataFrame) -> DataFrame:
    """Error rate over the current and the previous hour of the hourly table; one row per path and hour."""
    hourly = errors_hourly(requests).select("hour_ts", "api_path", "total_requests", "total_5xx")
    frame = "(PARTITION BY api_path ORDER BY hour_ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)"
    return hourly.select(
        "*",
        F.try_divide(F.expr(f"sum(total_5xx) OVER {frame}"), F.expr(f"sum(total_requests) OVER {frame}")).alias(
            "rolling_rate_5xx"
        ),
    )
