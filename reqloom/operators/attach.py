"""Per-group statistics beside every row, without a full-partition window over the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqloom.operators import staging

# A group is hot when it holds at least this share of all rows, so there are at most 1,000 hot groups.
HOT_SHARE = 0.001


def same_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality on key pairs: a null key is a group of its own."""
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def attach_stats(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    size_column: str,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Inner join of rows with one statistics row per group.

    The statistics are staged and measured. While small they are broadcast. Beyond that, hot groups, of which there
    can be only 1 / HOT_SHARE, are broadcast and all other groups meet their rows in a shuffle join.
    """
    limit = staging.BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    renamed = stats.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[F.col(c) for c in stats.columns if c not in keys],
    )
    staged = staging.stage(renamed)
    pairs = [(k, f"_key_{k}") for k in keys]
    key_columns = [f"_key_{k}" for k in keys]

    if staging.staged_bytes(staged) <= limit:
        return rows.join(F.broadcast(staged), same_keys(rows, staged, pairs)).drop(*key_columns)

    threshold = HOT_SHARE * (staged.agg(F.sum(size_column)).first()[0] or 0)
    hot = staged.where(F.col(size_column) >= threshold)
    cold = staged.where(F.col(size_column) < threshold)
    hot_keys = hot.select(*key_columns)
    hot_rows = rows.join(F.broadcast(hot), same_keys(rows, hot, pairs))
    other_rows = rows.join(F.broadcast(hot_keys), same_keys(rows, hot_keys, pairs), "left_anti")
    cold_rows = other_rows.join(cold, same_keys(other_rows, cold, pairs))
    return hot_rows.unionByName(cold_rows).drop(*key_columns)
