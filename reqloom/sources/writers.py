"""Sinks: append to the request store, replace a table, define a view, export files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqloom.sources import versions

EXPORT_FORMATS = ("json", "csv", "parquet")


class SinkError(ValueError):
    """A sink was asked for in a way it does not support."""


def _dated(requests: DataFrame, gather_days: bool) -> DataFrame:
    dated = requests.withColumn("event_date", F.to_date("event_timestamp"))
    return dated.hint("rebalance", "event_date") if gather_days else dated


def append_requests(requests: DataFrame, path: str, gather_days: bool = False) -> None:
    """Appends to a parquet store partitioned by day, without any de-duplication. An empty frame adds no rows.

    Logs usually arrive day by day, so tasks write few folders and no shuffle is needed. For input that mixes many
    days, `gather_days` brings a day's rows together first; AQE splits a day that is too large for one file.
    """
    _dated(requests, gather_days).write.mode("append").partitionBy("event_date").parquet(path)


def append_table(requests: DataFrame, table: str, gather_days: bool = False) -> None:
    """As `append_requests`, into a catalogue table."""
    _dated(requests, gather_days).write.mode("append").partitionBy("event_date").saveAsTable(table)


def write_requests(requests: DataFrame, target: str, location: str, gather_days: bool = False) -> None:
    """Sink by name: `table` (catalogue) or `path` (parquet folder)."""
    if target == "table":
        append_table(requests, location, gather_days)
    elif target == "path":
        append_requests(requests, location, gather_days)
    else:
        raise SinkError(f"Unsupported target: {target}")


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Replaces a stored table and returns it; readers see the old rows until all new ones are there, see `versions`."""
    return versions.replace(df, path)


def define_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export(df: DataFrame, fmt: str, path: str) -> None:
    if fmt not in EXPORT_FORMATS:
        raise SinkError(f"Unsupported export format: {fmt}")
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)
