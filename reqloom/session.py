"""Spark session settings the package is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "reqloom", master: str | None = None, **settings: str) -> SparkSession:
    """Session in UTC with adaptive execution; `settings` override or extend (dots written as `__`).

    Shuffle partitions are left to the cluster's own setting: AQE merges small ones and splits skewed joins.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
