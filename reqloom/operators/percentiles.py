"""Exact percentiles from value counts.

Counting (group, value) first spreads a hot group over all its values and merges on the map side, so no task ever sees
the rows of one group, only its distinct values. Whole milliseconds bound those by the slowest request; for fractional
values the counts are summed per whole part first, and per value only inside one whole part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqloom.functions.measures import WEIGHT, cells
from reqloom.operators.attach import same_keys

_CUM = "_upto"
_ALL = "_all"
_PART = "_whole"


def percentile_summary(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    percents: Mapping[str, int],
    interpolate: bool = False,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per `keys` with percentiles of `value`, over rows or over cells that count WEIGHT times.

    `percents` maps output names to whole percents. Discrete percentiles are the smallest value whose cumulative count
    reaches the percent; interpolated ones lie linearly between the two neighbours. Nulls and NaN do not count.
    `extra` holds further aggregates over the counts per (keys, value), which carry `value` and WEIGHT.
    """
    if _is_fractional(df, value):
        df = df.withColumn(value, F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")))
    counted = cells(df, *keys, value)
    ranked = _ranked(counted, keys, value)
    known = F.col(value).isNotNull()
    aggregates = dict(extra or {})
    if not interpolate:
        for name, percent in percents.items():
            # ceil(percent * count / 100) in whole numbers
            position = F.expr(f"(`{_ALL}` * {percent} + 99) div 100")
            aggregates[name] = F.min(F.when(known & (F.col(_CUM) >= position), F.col(value)))
        return ranked.groupBy(*keys).agg(*[column.alias(name) for name, column in aggregates.items()])

    for name, percent in percents.items():
        below = F.expr(f"((`{_ALL}` - 1) * {percent}) div 100")
        aggregates[f"_lo_{name}"] = F.min(F.when(known & (F.col(_CUM) > below), F.col(value)))
        aggregates[f"_hi_{name}"] = F.min(
            F.when(known & (F.col(_CUM) > F.least(below + 1, F.col(_ALL) - 1)), F.col(value))
        )
        aggregates[f"_at_{name}"] = F.max(F.expr(f"((`{_ALL}` - 1) * {percent}) % 100") / 100)
    wide = ranked.groupBy(*keys).agg(*[column.alias(name) for name, column in aggregates.items()])
    return wide.select(
        *keys,
        *list(extra or {}),
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_at_{n}")).cast("double").alias(n)
            for n in percents
        ],
    )


def _is_fractional(df: DataFrame, value: str) -> bool:
    return isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType, T.DecimalType))


def _ranked(counted: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Adds the cumulative count up to and including each value, and the count of all known values."""
    known = F.when(F.col(value).isNotNull(), F.col(WEIGHT)).otherwise(F.lit(0))
    group = Window.partitionBy(*keys)
    if not _is_fractional(counted, value):
        # the same order for both sums, so that one pass makes them
        ordered = group.orderBy(F.col(value).asc_nulls_last())
        upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return counted.select("*", F.sum(known).over(upto).alias(_CUM), F.sum(known).over(whole).alias(_ALL))

    # An infinite value has no whole part of its own; its greatest or least one keeps the order.
    counted = counted.withColumn(_PART, F.floor(F.greatest(F.least(F.col(value), F.lit(9e18)), F.lit(-9e18))))
    parts = counted.groupBy(*keys, _PART).agg(F.sum(known).alias("_part_n"))
    ordered = group.orderBy(F.col(_PART).asc_nulls_last())
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = parts.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col(_PART).alias("_k_part"),
        F.coalesce(F.sum("_part_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_part_n").over(whole).alias(_ALL),
    )
    inside = Window.partitionBy(*keys, _PART).orderBy(F.col(value)).rowsBetween(Window.unboundedPreceding, 0)
    local = counted.withColumn("_inside", F.sum(known).over(inside))
    pairs = [*[(k, f"_k_{k}") for k in keys], (_PART, "_k_part")]
    return local.join(offsets, same_keys(local, offsets, pairs)).select(
        *counted.columns, (F.col("_before") + F.col("_inside")).alias(_CUM), F.col(_ALL)
    )
