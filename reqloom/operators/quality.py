"""Outlier quality of numeric columns. All columns share each pass over the rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqloom.operators.selection import interpolated
from reqloom.schemas import ERROR, ISSUE, QUALITY_IQR_MULTIPLIER, QUALITY_Z_LIMIT, RULES

INFINITY = float("inf")


class QualityError(ValueError):
    """The data cannot be judged, or did not pass a strict check."""


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def known(name: str) -> Column:
    """Column as a double, NaN as null (Spark's aggregates and comparisons treat NaN as a large number)."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def is_invalid(name: str) -> Column:
    value = F.col(name).cast("double")
    return value.isNull() | F.isnan(value) | (F.abs(value) == INFINITY)


def winsorize(column: Column, lower: float, upper: float) -> Column:
    """Value clipped to [lower, upper]; null and NaN stay."""
    value = column.cast("double")
    return F.when(F.isnan(value), value).when(value.isNotNull(), F.least(F.greatest(value, F.lit(lower)), F.lit(upper)))


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation, one row per column, from one pass."""
    return _per_column(df, columns, {"n": F.count, "mean": F.avg, "std": F.stddev_pop})


def extremes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _per_column(df, columns, {"min_value": F.min, "max_value": F.max})


def _per_column(df: DataFrame, columns: Sequence[str], functions: Mapping) -> DataFrame:
    wide = df.agg(
        *[
            F.struct(F.lit(c).alias("column_name"), *[fn(known(c)).alias(name) for name, fn in functions.items()]).alias(
                f"_{i}"
            )
            for i, c in enumerate(columns)
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))


def iqr_bounds(df: DataFrame, columns: Sequence[str], multiplier: float = QUALITY_IQR_MULTIPLIER) -> DataFrame:
    """Interpolated quartiles and outlier bounds, one row per column with values; exact, by rank selection."""
    rows = []
    for name, (q1, q3) in interpolated(df, columns, (25, 75)).items():
        spread = (q3 - q1) * multiplier
        rows.append((name, q1, q3, q1 - spread, q3 + spread))
    return df.sparkSession.createDataFrame(rows, "column_name string, q1 double, q3 double, lower double, upper double")


def zscore_flags(df: DataFrame, columns: Sequence[str], threshold: float = QUALITY_Z_LIMIT) -> dict[str, Column]:
    """Outlier condition per column. One statistics row comes to the driver and enters the plan as literals."""
    stats = {row["column_name"]: row for row in column_stats(df, columns).collect()}
    flags = {}
    for name in columns:
        mean, std = stats[name]["mean"], stats[name]["std"]
        if std and not math.isnan(std):
            flags[name] = F.coalesce(F.abs((known(name) - mean) / std) > threshold, F.lit(False))
        else:
            flags[name] = F.lit(False)
    return flags


def iqr_flags(
    df: DataFrame, columns: Sequence[str], multiplier: float = QUALITY_IQR_MULTIPLIER
) -> dict[str, Column]:
    """Outlier condition per column, from one row of bounds per column."""
    bounds = {row["column_name"]: row for row in iqr_bounds(df, columns, multiplier).collect()}
    flags = {}
    for name in columns:
        row = bounds.get(name)
        if row is None or math.isnan(row["lower"]) or math.isnan(row["upper"]):
            flags[name] = F.lit(False)
        else:
            value = known(name)
            flags[name] = F.coalesce((value < row["lower"]) | (value > row["upper"]), F.lit(False))
    return flags


def invalid_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null, NaN and infinite values, one row per column."""
    wide = df.agg(*[F.count_if(is_invalid(c)).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "invalid_count")


_METHODS = {"zscore": "zscore_outliers", "iqr": "iqr_outliers"}


def _issue(rule: str, column: str, count: int) -> tuple:
    level, message = RULES[rule]
    return rule, level, message.format(column), {"count": str(count)}


def quality_report(
    df: DataFrame,
    method: str = "zscore",
    z_threshold: float = QUALITY_Z_LIMIT,
    iqr_multiplier: float = QUALITY_IQR_MULTIPLIER,
    strict: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """One summary row (is_valid, errors, warnings, score) and the issues behind it.

    Two passes whatever the number of columns: statistics, then flags and counts. An invalid value is an error, an
    outlier a warning; the score is the share of rows with neither. Strict raises when there is an error.
    """
    spark = df.sparkSession
    columns = numeric_columns(df)
    issues: list[tuple] = []
    score = 1.0
    if columns:
        if method not in _METHODS:
            raise QualityError("Invalid anomaly detection method")
        flags = (
            zscore_flags(df, columns, z_threshold) if method == "zscore" else iqr_flags(df, columns, iqr_multiplier)
        )
        any_flag = F.lit(False)
        for name in columns:
            any_flag = any_flag | is_invalid(name) | flags[name]
        counts = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count_if(any_flag).alias("_bad"),
            *[F.count_if(is_invalid(c)).alias(f"invalid_{i}") for i, c in enumerate(columns)],
            *[F.count_if(flags[c]).alias(f"outlier_{i}") for i, c in enumerate(columns)],
        ).first()
        if counts["_rows"] == 0:
            raise QualityError("Series is empty")
        score = 1.0 - counts["_bad"] / counts["_rows"]
        for i, name in enumerate(columns):
            for rule, count in (("invalid_values", counts[f"invalid_{i}"]), (_METHODS[method], counts[f"outlier_{i}"])):
                if count:
                    issues.append(_issue(rule, name, count))
    errors = sum(level == ERROR for _, level, _, _ in issues)
    if strict and errors:
        raise QualityError("Data quality failed")
    summary = spark.createDataFrame(
        [(errors == 0, errors, len(issues) - errors, score)],
        "is_valid boolean, errors bigint, warnings bigint, score double",
    )
    return summary, spark.createDataFrame(issues, ISSUE)

