"""Rankings and group totals over an aggregated table whose groups may be too large for one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqloom.operators import staging
from reqloom.operators.attach import attach_stats
from reqloom.operators.prefix import sums_before


@dataclass(frozen=True)
class Ranking:
    """Rank of `by`, highest first; a row number also needs `tiebreak`, lowest first."""

    name: str
    kind: Literal["rank", "dense_rank", "row_number"]
    by: str
    tiebreak: str | None = None

    def order(self) -> list[Column]:
        order = [F.col(self.by).desc_nulls_last()]
        return order + [F.col(self.tiebreak).asc_nulls_first()] if self.tiebreak else order


def rank_within(
    table: DataFrame,
    group: Sequence[str],
    rankings: Sequence[Ranking],
    group_totals: Mapping[str, Column] | None = None,
    single_task_rows: int | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Adds rankings and whole-group aggregates to an aggregated table.

    Staged and counted first. A small table takes plain windows. In a larger one a rank depends only on the value, so
    it is computed once per (group, value) and attached; a row number is a running count along a total order.
    """
    limit = staging.SINGLE_TASK_ROWS if single_task_rows is None else single_task_rows
    group_totals = group_totals or {}
    staged = staging.stage(table)
    if staged.count() <= limit:
        return staged.select("*", *_windows(group, rankings, group_totals))

    out = staged
    for ranking in rankings:
        if ranking.kind == "row_number":
            before = sums_before(out, group, ranking.order(), {ranking.name: F.lit(1)}, single_task_rows)
            out = before.withColumn(ranking.name, F.col(ranking.name).cast("bigint") + 1)
        else:
            out = _attach_rank(out, group, ranking, single_task_rows, broadcast_bytes)
    if group_totals:
        stats = staged.groupBy(*group).agg(
            F.count(F.lit(1)).alias("_size"), *[column.alias(name) for name, column in group_totals.items()]
        )
        out = attach_stats(out, stats, group, "_size", broadcast_bytes).drop("_size")
    return out


def _windows(group: Sequence[str], rankings: Sequence[Ranking], group_totals: Mapping[str, Column]) -> list[Column]:
    functions = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}
    whole = Window.partitionBy(*group)
    return [
        *[functions[r.kind]().over(whole.orderBy(*r.order())).cast("bigint").alias(r.name) for r in rankings],
        *[column.over(whole).alias(name) for name, column in group_totals.items()],
    ]


def _attach_rank(
    table: DataFrame,
    group: Sequence[str],
    ranking: Ranking,
    single_task_rows: int | None,
    broadcast_bytes: int | None,
) -> DataFrame:
    per_value = table.groupBy(*group, ranking.by).agg(F.count(F.lit(1)).alias("_size"))
    step = F.col("_size") if ranking.kind == "rank" else F.lit(1)
    ranks = sums_before(per_value, group, ranking.order(), {ranking.name: step}, single_task_rows)
    ranks = ranks.withColumn(ranking.name, F.col(ranking.name).cast("bigint") + 1)
    return attach_stats(table, ranks, [*group, ranking.by], "_size", broadcast_bytes).drop("_size")
