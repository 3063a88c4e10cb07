"""Running sums along an order, without sorting a whole group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqloom.operators import staging
from reqloom.operators.attach import same_keys

_PART = "_part"


def sums_before(
    table: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    sums: Mapping[str, Column],
    single_task_rows: int | None = None,
) -> DataFrame:
    """Adds, per name in `sums`, the sum of the column over the rows of the same group that sort earlier.

    `order` must be total within a group. The table (an aggregated one) is staged and counted. A small one is summed by
    a window per group. A larger one is range-partitioned by (group, order): each range is summed on its own, and the
    totals of earlier ranges, one row per range and group, are added.
    """
    limit = staging.SINGLE_TASK_ROWS if single_task_rows is None else single_task_rows
    staged = staging.stage(table)
    if staged.count() <= limit:
        return staged.select("*", *_running(group, order, sums))

    parts = staging.stage(
        staged.repartitionByRange(*[F.col(g) for g in group], *order).withColumn(_PART, F.spark_partition_id())
    )
    totals = parts.groupBy(*group, _PART).agg(*[F.sum(column).alias(name) for name, column in sums.items()])
    by_part = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"_g_{g}") for g in group],
        F.col(_PART).alias("_p"),
        *[F.sum(name).over(by_part).alias(f"_o_{name}") for name in sums],
    )
    inside = parts.select("*", *_running([*group, _PART], order, sums))
    joined = inside.join(offsets, same_keys(inside, offsets, [*[(g, f"_g_{g}") for g in group], (_PART, "_p")]))
    return joined.select(
        *staged.columns,
        *[(F.coalesce(F.col(f"_o_{name}"), F.lit(0)) + F.col(name)).alias(name) for name in sums],
    )


def _running(group: Sequence[str], order: Sequence[Column], sums: Mapping[str, Column]) -> list[Column]:
    window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return [F.coalesce(F.sum(column).over(window), F.lit(0)).alias(name) for name, column in sums.items()]
