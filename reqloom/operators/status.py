"""Status-code metrics. Shares divide counts by their group total: a window over the few codes of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reqloom.functions.measures import WEIGHT, cells
from reqloom.schemas import TOP_ENDPOINTS


def _counts(requests: DataFrame, *dims: str) -> DataFrame:
    return cells(requests, *dims).withColumnRenamed(WEIGHT, "total_requests")


def _with_share(counts: DataFrame, name: str, *group: str) -> DataFrame:
    group_total = F.sum("total_requests").over(Window.partitionBy(*group))
    return counts.withColumn(name, F.try_divide(F.col("total_requests"), group_total))


def status_code_kpis(requests: DataFrame) -> DataFrame:
    return _with_share(_counts(requests, "api_path", "status_code"), "pct_within_endpoint", "api_path")


def status_codes_daily(requests: DataFrame) -> DataFrame:
    return _counts(requests, "day", "api_path", "status_code")


def status_codes_hourly(requests: DataFrame) -> DataFrame:
    return _counts(requests, "hour_ts", "api_path", "status_code")


def status_families_daily(requests: DataFrame) -> DataFrame:
    counts = _counts(requests, "day", "api_path", "status_family")
    return _with_share(counts, "pct_within_day_endpoint", "day", "api_path")


def top_endpoints_per_error_code_daily(requests: DataFrame, k: int = TOP_ENDPOINTS) -> DataFrame:
    """The k busiest paths of each day and error code; ties by path name.

    The row-number filter keeps k rows per day, code and map task before the shuffle, so many paths do no harm.
    """
    daily = _counts(requests.where(F.col("status_code") >= 400), "day", "status_code", "api_path")
    volume = Window.partitionBy("day", "status_code").orderBy(F.col("total_requests").desc())
    ranked = daily.select(
        "*",
        F.row_number()
        .over(
            Window.partitionBy("day", "status_code").orderBy(
                F.col("total_requests").desc(), F.col("api_path").asc_nulls_first()
            )
        )
        .alias("rownum_by_volume"),
    ).where(F.col("rownum_by_volume") <= k)
    # The first k rows hold every path with more requests than any of them, so their rank among themselves is final.
    return ranked.select(
        "day",
        "status_code",
        "api_path",
        "total_requests",
        F.col("rownum_by_volume").cast("bigint").alias("rownum_by_volume"),
        F.rank().over(volume).cast("bigint").alias("rank_by_volume"),
    )
