"""Measures over weighted request rows: a weight of one per row, or the count of a pre-aggregated cell."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEIGHT = "n_requests"


def is_4xx() -> Column:
    return F.col("status_code").between(400, 499)


def is_5xx() -> Column:
    return F.col("status_code") >= 500


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def weight_of(df: DataFrame) -> Column:
    return F.col(WEIGHT) if WEIGHT in df.columns else F.lit(1).cast("bigint")


def total(weight: Column) -> Column:
    return F.coalesce(F.sum(weight), F.lit(0).cast("bigint"))


def total_if(weight: Column, condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0).cast("bigint"))


def share(weight: Column, condition: Column) -> Column:
    return F.try_divide(total_if(weight, condition), total(weight))


def weighted_mean(weight: Column, value: Column) -> Column:
    return F.try_divide(F.sum(value.cast("double") * weight), F.sum(F.when(value.isNotNull(), weight)))


def time_of(df: DataFrame) -> Column:
    """Timestamp of a request row, or the hour of a pre-aggregated cell."""
    return F.col("event_timestamp") if "event_timestamp" in df.columns else F.col("hour_ts")


def in_time_range(
    df: DataFrame, start: datetime | None = None, end: datetime | None = None, with_end: bool = True
) -> DataFrame:
    """Rows from `start` to `end`. A store partitioned by `event_date` is filtered on it too, so other days are not
    read."""

    def literal(moment: datetime) -> Column:
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")

    ts = time_of(df)
    if start:
        df = df.where(ts >= literal(start))
    if end:
        df = df.where(ts <= literal(end) if with_end else ts < literal(end))
    if "event_date" in df.columns:
        if start:
            df = df.where(F.col("event_date") >= F.lit(start.date()))
        if end:
            df = df.where(F.col("event_date") <= F.lit(end.date()))
    return df


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def with_dims(df: DataFrame, *dims: str) -> DataFrame:
    """Adds the derived dimensions among `dims` that the frame does not carry yet."""
    derived = {
        "hour_ts": lambda: hour_of(time_of(df)),
        "day": lambda: F.to_date(time_of(df)),
        "status_family": lambda: F.concat(F.expr("status_code div 100").cast("string"), F.lit("xx")),
    }
    for dim in dims:
        if dim not in df.columns and dim in derived:
            df = df.withColumn(dim, derived[dim]())
    return df


def cells(df: DataFrame, *dims: str) -> DataFrame:
    """Counts per combination of `dims`; counts of cells add up exactly, so cells of cells are cells."""
    ready = with_dims(df, *dims)
    return ready.groupBy(*dims).agg(F.sum(weight_of(ready)).alias(WEIGHT))
