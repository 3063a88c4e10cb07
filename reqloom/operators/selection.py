"""Exact values at given ranks of many columns, found by narrowing brackets.

A column's values are never sorted or written out. A sketch proposes two values around a rank, one pass counts what lies
below and at them, and the rank is either met or lies in a bracket that holds some thousandth of the values. The next sketch
reads that bracket alone. Once a bracket holds few values, these are collected, a bounded number per rank. All columns
and ranks share each pass, and ties end at the value they share.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Most values of a bracket that are collected, and the sketch's accuracy (a rank is off by 1/ACCURACY at most).
KEEP = 2_000
ACCURACY = 10_000
# Columns whose counts one pass takes; wider tables take several.
COLUMNS_PER_PASS = 25


@dataclass(frozen=True)
class Search:
    """Ranks of a column (from 0) that lie strictly between `low` and `high`: `below` values come before, `inside` between."""

    column: str
    ranks: tuple[int, ...]
    below: int
    inside: int
    low: float | None = None
    high: float | None = None

    def between(self) -> Column:
        value = F.col(self.column)
        condition = value.isNotNull()
        if self.low is not None:
            condition = condition & (value > F.lit(self.low))
        if self.high is not None:
            condition = condition & (value < F.lit(self.high))
        return condition

    def sketch(self, accuracy: int) -> Column:
        """Two values, one at or below the first rank and one at or above the last, as far as the sketch knows."""
        slack = 2.0 / accuracy
        first = max(0.0, (self.ranks[0] - self.below) / self.inside - slack)
        last = min(1.0, (self.ranks[-1] - self.below + 1) / self.inside + slack)
        values = F.when(self.between(), F.col(self.column))
        return F.percentile_approx(values, F.array(F.lit(first), F.lit(last)), F.lit(accuracy))

    def narrowed(self, pivots: Sequence[float], counts: Sequence[int]) -> tuple[dict[int, float], list[Search]]:
        """Ranks met by the pivots, and searches for the others; `counts` are values below and up to each pivot."""
        met = {}
        regions: dict[tuple, list[int]] = {}
        edges = [(self.low, self.below), *[(pivot, upto) for pivot, upto in zip(pivots, counts[1::2])]]
        tops = [*[(pivot, under) for pivot, under in zip(pivots, counts[0::2])], (self.high, self.below + self.inside)]
        for rank in self.ranks:
            for pivot, under, upto in zip(pivots, counts[0::2], counts[1::2]):
                if under <= rank < upto:
                    met[rank] = pivot
            if rank not in met:
                at = sum(rank >= upto for upto in counts[1::2])
                regions.setdefault((*edges[at], *tops[at]), []).append(rank)
        left = [
            replace(self, ranks=tuple(ranks), low=low, below=below, high=high, inside=above - below)
            for (low, below, high, above), ranks in regions.items()
        ]
        return met, left


def values_at(
    df: DataFrame, columns: Sequence[str], ranks_of: Callable[[int], Sequence[int]], keep: int = KEEP, accuracy: int = ACCURACY
) -> dict[str, tuple[int, dict[int, float]]]:
    """Per column its number of values and {rank: value} for the ranks that `ranks_of` names for that number.

    Columns are doubles; null and NaN are no values. Only counts, pivots and at most `keep` values per rank come to the
    driver.
    """
    found: dict[str, tuple[int, dict[int, float]]] = {}
    for start in range(0, len(columns), COLUMNS_PER_PASS):
        part = list(columns[start : start + COLUMNS_PER_PASS])
        names = [f"_{i}" for i in range(len(part))]
        values = df.select(*[_known(c).alias(name) for c, name in zip(part, names)])
        sizes = values.agg(*[F.count(name).alias(name) for name in names]).first()
        met: dict[str, dict[int, float]] = {name: {} for name in names}
        pending = [Search(name, tuple(sorted(set(ranks_of(sizes[name])))), 0, sizes[name]) for name in names if sizes[name]]
        pending = [search for search in pending if search.ranks]
        small = []
        while pending:
            small += [search for search in pending if search.inside <= keep]
            pending = [one for search in pending if search.inside > keep for one in _split(search)]
            if not pending:
                break
            row = values.agg(*[search.sketch(accuracy).alias(f"s{i}") for i, search in enumerate(pending)]).first()
            pivots = [sorted(set(row[f"s{i}"])) for i in range(len(pending))]
            counted = []
            for search, values_ in zip(pending, pivots):
                for pivot in values_:
                    value = F.col(search.column)
                    counted += [F.count_if(value < F.lit(pivot)), F.count_if(value <= F.lit(pivot))]
            counts = list(values.agg(*[c.alias(f"c{i}") for i, c in enumerate(counted)]).first())
            rest, at = [], 0
            for search, values_ in zip(pending, pivots):
                own, at = counts[at : at + 2 * len(values_)], at + 2 * len(values_)
                hits, left = search.narrowed(values_, own)
                met[search.column] |= hits
                rest += left
            pending = rest
        if small:
            listed = [F.array_sort(F.collect_list(F.when(search.between(), F.col(search.column)))).alias(f"l{i}") for i, search in enumerate(small)]
            row = values.agg(*listed).first()
            for i, search in enumerate(small):
                met[search.column] |= {rank: row[f"l{i}"][rank - search.below] for rank in search.ranks}
        found |= {column: (sizes[name], met[name]) for column, name in zip(part, names)}
    return found


def _split(search: Search) -> list[Search]:
    """Neighbouring ranks are searched together, ranks far apart by themselves."""
    groups: list[list[int]] = []
    for rank in search.ranks:
        if groups and rank - groups[-1][-1] <= 1:
            groups[-1].append(rank)
        else:
            groups.append([rank])
    return [replace(search, ranks=tuple(group)) for group in groups]


def _known(name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def interpolated(
    df: DataFrame, columns: Sequence[str], percents: Sequence[int], keep: int = KEEP, accuracy: int = ACCURACY
) -> dict[str, list[float]]:
    """Per column with values, the percentiles that lie linearly between the two values around (n - 1) * percent / 100."""

    def ranks_of(n: int) -> list[int]:
        return [min((n - 1) * p // 100 + step, n - 1) for p in percents for step in (0, 1)]

    out = {}
    for column, (n, values) in values_at(df, columns, ranks_of, keep, accuracy).items():
        if n:
            ranks = ranks_of(n)
            pairs = zip(percents, ranks[0::2], ranks[1::2])
            out[column] = [values[a] + (values[b] - values[a]) * ((n - 1) * p % 100 / 100) for p, a, b in pairs]
    return out
