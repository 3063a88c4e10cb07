"""Which days a rolling table has to be built again for, after requests were added on some days, and from which requests.

Look-backs reach a day at most, so requests added on a day change rows of that day and the next. A row also shows its key's
rate at the request before and after, so the key's nearest earlier and later days with requests change as well. All this
is read off a small table of the keys' days.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqloom.operators.staging import stage


def _day(rows: DataFrame, time: str) -> Column:
    """A row's day; the store's partition column where there is one, so that other days are not read."""
    return F.col("event_date") if time == "event_timestamp" and "event_date" in rows.columns else F.to_date(time)


def on_days(rows: DataFrame, days: Sequence[date], time: str = "event_timestamp") -> DataFrame:
    return rows.where(_day(rows, time).isin(list(days)))


def key_days(cells: DataFrame, key: str, time: str) -> DataFrame:
    """`_key` and `_day` with the key's days before and after: one row per key and day, staged."""
    days = cells.select(F.col(key).alias("_key"), F.to_date(time).alias("_day")).where(F.col("_day").isNotNull()).distinct()
    by_day = Window.partitionBy("_key").orderBy("_day")
    steps = {"_before": F.lag("_day"), "_after": F.lead("_day"), "_after_next": F.lead("_day", 2)}
    return stage(days.select("*", *[step.over(by_day).alias(name) for name, step in steps.items()]))


def days_to_rebuild(index: DataFrame, added: Sequence[date]) -> list[date]:
    """The added days, and per key its day before them, the one after, and, where that is the next day, the one after that."""
    next_day = F.when(F.col("_after") == F.date_add("_day", 1), F.col("_after_next"))
    near = index.where(F.col("_day").isin(list(added))).select(F.explode(F.array("_day", "_before", "_after", next_day)).alias("_day"))
    return sorted({*added, *(row["_day"] for row in near.where(F.col("_day").isNotNull()).distinct().collect())})


def rows_for(requests: DataFrame, index: DataFrame, days: Sequence[date], key: str) -> DataFrame:
    """Requests from which a rolling table comes out whole on `days`: those of the keys' days there and of the days before
    and after with requests, each with the day before it for the look-back."""
    near = index.where(F.col("_day").isin(list(days))).select("_key", F.explode(F.array("_day", "_before", "_after")).alias("_at"))
    near = near.where(F.col("_at").isNotNull())
    pairs = near.select("_key", F.explode(F.array("_at", F.date_sub("_at", 1))).alias("_at")).distinct()
    pairs = stage(pairs)
    wanted = [row["_at"] for row in pairs.select("_at").distinct().collect()]
    rows = on_days(requests, wanted)
    condition = rows[key].eqNullSafe(pairs["_key"]) & (_day(rows, "event_timestamp") == pairs["_at"])
    return rows.join(pairs, condition, "left_semi")
