"""Dashboard pages and free aggregation over the request table."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqloom.functions.measures import (
    WEIGHT,
    cells,
    in_time_range,
    is_4xx,
    is_5xx,
    share,
    total,
    total_if,
    weighted_mean,
)
from reqloom.operators.errors import errors_hourly
from reqloom.operators.latency import LATENCY, PERCENTS
from reqloom.operators.percentiles import percentile_summary
from reqloom.operators.sla import SLA_LIMITS
from reqloom.schemas import SAFE_NAME


def _metrics() -> dict[str, Column]:
    weight, latency = F.col(WEIGHT), F.col(LATENCY)
    return {
        "total_requests": total(weight),
        "avg_latency_ms": weighted_mean(weight, latency),
        "max_latency_ms": F.max(latency),
        "total_4xx": total_if(weight, is_4xx()),
        "total_5xx": total_if(weight, is_5xx()),
        "rate_4xx": share(weight, is_4xx()),
        "rate_5xx": share(weight, is_5xx()),
        **{name: share(weight, latency < limit) for name, limit in SLA_LIMITS.items()},
    }


def clean_names(names: Sequence[str]) -> list[str]:
    """Trimmed names in their first order, each once; empty or unsafe names raise."""
    cleaned = [name.strip() for name in names]
    for name in cleaned:
        if not name:
            raise ValueError("names must not be empty")
        if not re.match(SAFE_NAME, name):
            raise ValueError(f"unsupported characters in name: {name}")
    return list(dict.fromkeys(cleaned))


def aggregate_metrics(
    requests: DataFrame,
    metric_names: Sequence[str],
    group_by: Sequence[str] = (),
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Named metrics per group over an inclusive time range."""
    names, keys = clean_names(metric_names), clean_names(group_by)
    if start and end and end < start:
        raise ValueError("end must not be before start")
    known = {*_metrics(), *PERCENTS}
    unknown = [name for name in names if name not in known]
    if unknown:
        raise ValueError(f"unknown metrics: {unknown}")
    requests = in_time_range(requests, start, end)
    percents = {name: PERCENTS[name] for name in names if name in PERCENTS}
    plain = {name: column for name, column in _metrics().items() if name in names}
    needs_code = any(name.endswith("xx") for name in plain)
    dims = [*keys, LATENCY, *(["status_code"] if needs_code and "status_code" not in keys else [])]
    counted = cells(requests, *dict.fromkeys(dims))
    if percents:
        # The percentile pass re-counts per latency, so code metrics are summed beside it.
        if needs_code:
            counted = counted.withColumn("_4xx", F.when(is_4xx(), F.col(WEIGHT)).otherwise(0))
            counted = counted.withColumn("_5xx", F.when(is_5xx(), F.col(WEIGHT)).otherwise(0))
            codes = counted.groupBy(*keys).agg(
                F.sum(WEIGHT).alias("_all"), F.sum("_4xx").alias("_4xx"), F.sum("_5xx").alias("_5xx")
            )
            code_metrics = {
                "total_4xx": F.col("_4xx"),
                "total_5xx": F.col("_5xx"),
                "rate_4xx": F.try_divide("_4xx", "_all"),
                "rate_5xx": F.try_divide("_5xx", "_all"),
            }
            codes = codes.select(*keys, *[c.alias(n) for n, c in code_metrics.items() if n in names])
        rest = {name: column for name, column in plain.items() if not name.endswith("xx")}
        summary = percentile_summary(counted, keys, LATENCY, percents, extra=rest)
        if needs_code:
            summary = _join_on(summary, codes, keys)
        return summary.select(*keys, *names)
    return counted.groupBy(*keys).agg(*[plain[name].alias(name) for name in names])


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two summaries of the same groups, side by side; null keys match."""
    marked = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    if not keys:
        # one row each
        return left.withColumn("_one", F.lit(1)).join(marked.withColumn("_one", F.lit(1)), "_one").drop("_one")
    condition = [left[k].eqNullSafe(marked[f"_r_{k}"]) for k in keys]
    return left.join(marked, condition).drop(*[f"_r_{k}" for k in keys])


def status_pivot(requests: DataFrame, codes: Sequence[int]) -> DataFrame:
    """Paths by status codes; the codes are given, so no extra job looks for them. Absent pairs count zero.

    `status_other` counts all other codes and requests without one, so a row's counts add up to the path's requests.
    """
    listed = F.col("status_code").isin(list(codes))
    column = F.when(listed, F.col("status_code").cast("string")).otherwise("other")
    counted = cells(requests, "api_path", "status_code").withColumn("_code", column)
    names = [*map(str, codes), "other"]
    pivoted = counted.groupBy("api_path").pivot("_code", names).agg(F.sum(WEIGHT))
    return pivoted.select("api_path", *[F.coalesce(F.col(name), F.lit(0)).alias(f"status_{name}") for name in names])


def executive_overview(requests: DataFrame) -> DataFrame:
    """Requests and server-error rate over everything, from the hourly tables."""
    return errors_hourly(requests).agg(
        F.sum("total_requests").alias("total_requests"),
        F.try_divide(F.sum("total_5xx"), F.sum("total_requests")).alias("error_rate_5xx"),
    )


def status_family_share(requests: DataFrame) -> DataFrame:
    counted = cells(requests, "status_family")
    everything = counted.agg(F.sum(WEIGHT).alias("_all"))
    return counted.select(
        "status_family",
        F.col(WEIGHT).alias("total_requests"),
        F.try_divide(F.col(WEIGHT), everything.scalar()).alias("pct"),
    )


def metric_points(
    wide: DataFrame, ids: Sequence[str], timestamp: str, values: Sequence[str], unit: str | None = None
) -> DataFrame:
    """Wide metric rows as points: name, value, unit, tags, timestamp."""
    numbers = wide.select(*ids, timestamp, *[F.col(v).cast("double").alias(v) for v in values])
    long = numbers.unpivot([*ids, timestamp], list(values), "name", "value")
    pairs = [part for name in ids for part in (F.lit(name), F.col(name).cast("string"))]
    return long.select(
        "name",
        "value",
        F.lit(unit).cast("string").alias("unit"),
        F.create_map(*pairs).alias("tags") if pairs else F.create_map().cast("map<string,string>").alias("tags"),
        F.col(timestamp).alias("timestamp"),
    )


def severity(ratio: Column, medium: float, high: float) -> Column:
    return F.when(ratio >= high, "high").when(ratio >= medium, "medium").otherwise("low")


def count_matches(df: DataFrame, declared_rows: int) -> DataFrame:
    """Declared row count against the rows there are; an empty dataset and a negative count are errors too."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(declared_rows).cast("bigint").alias("declared_rows"),
        (F.col("row_count") > 0).alias("is_non_empty"),
        ((F.lit(declared_rows) >= 0) & (F.col("row_count") == declared_rows)).alias("is_count_ok"),
    )

