"""Pipeline jobs: extract, normalise, append, build the dashboard tables; checks before and after."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reqloom.functions.measures import cells, in_time_range
from reqloom.operators import anomaly, errors, latency, local, sla, status, users
from reqloom.operators.consistency import ConsistencyError, consistency_report
from reqloom.operators.drift import as_monitoring, drift_report
from reqloom.operators.normalize import normalize_flat, normalize_log_entries
from reqloom.operators.quality import quality_report
from reqloom.plans import touched
from reqloom.sources import versions
from reqloom.sources.readers import SourceError, read_logs
from reqloom.sources.writers import define_view, write_requests

Builder = Callable[[DataFrame], DataFrame]

# The table names of the three groups below.
# Built from counts per hour, path, code and latency, which one scan of the requests makes.
FROM_CELLS: dict[str, Builder] = {
    "latency_kpis_view": latency.latency_kpis,
    "dashboard_latency_hourly": latency.latency_hourly,
    "dashboard_latency_endpoint_rank_daily": latency.latency_rank_daily,
    "error_kpis_view": errors.error_kpis,
    "dashboard_errors_hourly": errors.errors_hourly,
    "dashboard_top_error_endpoints_daily": errors.top_error_endpoints_daily,
    "sla_kpis_view": sla.sla_kpis,
    "dashboard_sla_hourly": sla.sla_hourly,
    "dashboard_sla_daily": sla.sla_daily,
    "status_code_kpis_view": status.status_code_kpis,
    "dashboard_status_codes_daily": status.status_codes_daily,
    "dashboard_status_codes_hourly": status.status_codes_hourly,
    "dashboard_status_families_daily": status.status_families_daily,
    "dashboard_top_endpoints_per_error_code_daily": status.top_endpoints_per_error_code_daily,
    "dashboard_endpoint_degradation_daily": anomaly.endpoint_degradation_daily,
}

# Need the requests themselves: a row per request, or a row per user.
FROM_REQUESTS: dict[str, Builder] = {
    "user_kpis_view": users.user_kpis,
    "dashboard_user_activity_daily": users.user_activity_daily,
    "dashboard_user_auth_errors_daily": users.user_auth_errors_daily,
    "dashboard_errors_rolling": errors.errors_rolling,
    "dashboard_sla_rolling_drift": sla.sla_rolling_drift,
    "dashboard_user_rolling_activity": users.user_rolling_activity,
    "dashboard_anomaly_latency_zscore": anomaly.anomaly_latency_zscore,
    "dashboard_anomaly_error_spikes": anomaly.anomaly_error_spikes,
}

LOCAL_TABLES: dict[str, Builder] = {
    "dashboard_latency_daily": local.local_latency_daily,
    "dashboard_errors_hourly": local.local_errors_hourly,
    "dashboard_status_codes": local.local_status_codes,
}

TARGETS = ("warehouse", "local")
CELLS_TABLE = "request_cells_hourly"
CELL_DIMS = ("hour_ts", "api_path", "status_code", "latency_ms")
USER_CELLS_TABLE = "user_cells_daily"
USER_CELL_DIMS = ("day", "user_uid", "status_code", "latency_ms")
ROLLING_TABLE = "dashboard_errors_rolling"
SPIKES_TABLE = "dashboard_anomaly_error_spikes"
USER_ROLLING = "dashboard_user_rolling_activity"
# Rolled up from the users' cells.
USER_TABLES = ("user_kpis_view", "dashboard_user_activity_daily", "dashboard_user_auth_errors_daily")
# Rolling tables and the key whose requests before and after a row it depends on.
ROLLING_KEYS = {
    ROLLING_TABLE: "api_path",
    "dashboard_sla_rolling_drift": "api_path",
    USER_ROLLING: "user_uid",
    SPIKES_TABLE: "api_path",
}
# The column that says a row's day, of tables whose other days a new request leaves as they are.
DAY_COLUMNS = {
    "dashboard_latency_hourly": "hour_ts",
    "dashboard_latency_endpoint_rank_daily": "day",
    "dashboard_errors_hourly": "hour_ts",
    "dashboard_top_error_endpoints_daily": "day",
    "dashboard_sla_hourly": "hour_ts",
    "dashboard_sla_daily": "day",
    "dashboard_status_codes_daily": "day",
    "dashboard_status_codes_hourly": "hour_ts",
    "dashboard_status_families_daily": "day",
    "dashboard_top_endpoints_per_error_code_daily": "day",
    "dashboard_user_activity_daily": "day",
    "dashboard_user_auth_errors_daily": "day",
    **{name: "event_timestamp" for name in ROLLING_KEYS},
}


class PipelineError(ValueError):
    """A job was asked for in a way it does not support."""


def build_metrics(
    requests: DataFrame,
    out: str,
    target: str = "warehouse",
    only: Sequence[str] | None = None,
    days: Sequence[date] | None = None,
) -> dict[str, DataFrame]:
    """Replaces the dashboard tables under `out`/`target` and defines the views `target`_name; the first failure aborts.

    The requests themselves become the view `target`_requests first. They are scanned once for the cells that most tables
    roll up, once for the users' cells, and once per remaining table. Spikes are filtered from the stored rolling rates when
    both are built.

    With `days`, the days that requests were added to since the last build, only what these can change is read and written:
    their own cells; the tables by hour and day, on these days; rolling tables, also on the days around them
    (see touched.days_to_rebuild). Tables over all time, and the day-over-day table, are rolled up from all stored cells;
    z-scores compare every request with its path's mean, so they are built from all requests. The result is that of a
    whole build.
    """
    if target not in TARGETS:
        raise PipelineError(f"Unsupported target for metrics build: {target}")
    by_cells = FROM_CELLS if target == "warehouse" else LOCAL_TABLES
    by_requests = FROM_REQUESTS if target == "warehouse" else {}
    known = {**by_cells, **by_requests}
    names = list(known) if only is None else list(only)
    unknown = [name for name in names if name not in known]
    if unknown:
        raise PipelineError(f"Unknown tables: {unknown}")

    spark, out = requests.sparkSession, f"{out.rstrip('/')}/{target}"
    days = None if days is None else sorted(set(days))
    define_view(requests, f"{target}_requests")
    recent = requests if days is None else touched.on_days(requests, days)
    day_columns = DAY_COLUMNS if target == "warehouse" else {}
    tables: dict[str, DataFrame] = {}
    indexes: dict[str, DataFrame] = {}

    def days_around(key: str) -> tuple[DataFrame, list[date]]:
        if key not in indexes:
            indexes[key] = touched.key_days(*((user_cells, key, "day") if key == "user_uid" else (path_cells, key, "hour_ts")))
        return indexes[key], touched.days_to_rebuild(indexes[key], days)

    def stored_cells(name: str, dims: Sequence[str], day: str) -> DataFrame:
        return versions.replace_days(cells(recent, *dims), f"{out}/{name}", day, days)

    def put(name: str, table: DataFrame, on: Sequence[date] | None) -> DataFrame:
        day = day_columns.get(name)
        if day is None:
            return versions.replace(table, f"{out}/{name}")
        return versions.replace_days(table, f"{out}/{name}", day, on)

    rolling = [name for name in names if name in ROLLING_KEYS]
    path_cells = stored_cells(CELLS_TABLE, CELL_DIMS, "hour_ts") if set(names) & {*by_cells, *rolling} else None
    user_cells = stored_cells(USER_CELLS_TABLE, USER_CELL_DIMS, "day") if set(names) & {*USER_TABLES, USER_ROLLING} else None
    for name in sorted(names, key=list(known).index):
        on = days
        if name in by_cells or name in USER_TABLES:
            source = path_cells if name in by_cells else user_cells
            if days is not None and name in day_columns:
                source = touched.on_days(source, days, "hour_ts" if name in by_cells else "day")
            table = known[name](source)
        elif name == SPIKES_TABLE and ROLLING_TABLE in tables:
            rates = tables[ROLLING_TABLE].withColumnsRenamed(
                {"rolling_rate_5xx_1h": "rate_5xx_1h", "rolling_rate_5xx_24h": "rate_5xx_24h"}
            )
            if days is not None:
                on = days_around("api_path")[1]
                rates = touched.on_days(rates, on)
            table = anomaly.spikes_of(rates)
        elif name in ROLLING_KEYS and days is not None:
            key = ROLLING_KEYS[name]
            index, on = days_around(key)
            table = touched.on_days(by_requests[name](touched.rows_for(requests, index, on, key)), on)
        else:
            table = by_requests[name](requests)
        tables[name] = put(name, table, on)
        define_view(tables[name], f"{target}_{name}")
    return tables


def run_pipeline(
    spark: SparkSession,
    source: str,
    target: str,
    store: str,
    out: str,
    start_from: str | None = None,
    path: str | None = None,
    predicate: str | None = None,
    ingest_ts: datetime | None = None,
    gather_days: bool = False,
) -> dict[str, DataFrame]:
    """Extract, normalise, append to `store`, and build the tables of `target` under `out`: all of them the first time, then
    what the appended days change.

    `gather_days` suits input that mixes many days, see `append_requests`.
    """
    if start_from not in (None, "extract"):
        raise PipelineError("start_from must be None or 'extract'")
    if target not in TARGETS:
        raise PipelineError(f"Unsupported target: {target}")
    raw = read_logs(spark, source, path, predicate)
    normalise = normalize_log_entries if source == "cloud" else normalize_flat
    seen = Observation()
    requests = normalise(raw, ingest_ts=ingest_ts)
    requests = requests.observe(seen, F.collect_set(F.to_date("event_timestamp")).alias("days"), F.count(F.lit(1)).alias("n"))
    write_requests(requests, "path", store, gather_days)
    stored = spark.read.parquet(store)
    first = not versions.is_stored(spark, f"{out.rstrip('/')}/{target}/{CELLS_TABLE}")
    return build_metrics(stored, out, target, days=None if first else seen.get["days"])


def gate(requests: DataFrame, strict: bool = False) -> DataFrame:
    """Consistency, then quality, of the request table, as one row per check; strict raises on any error."""
    monitoring = as_monitoring(requests)
    consistency = consistency_report(monitoring, strict=strict)
    quality, _ = quality_report(monitoring, strict=strict)
    return consistency.select(
        F.lit("consistency").alias("check"),
        F.col("is_consistent").alias("passed"),
        "errors",
        "warnings",
        F.col("quality_score").alias("score"),
    ).unionByName(
        quality.select(F.lit("quality").alias("check"), F.col("is_valid").alias("passed"), "errors", "warnings", "score")
    )


def drift_between(
    requests: DataFrame,
    reference: tuple[datetime, datetime],
    current: tuple[datetime, datetime],
    strict: bool = False,
    ks_method: str = "asymptotic",
) -> tuple[DataFrame, DataFrame] | None:
    """Drift between two time ranges [start, end) of the request table; None when either range has no rows."""

    ref, cur = (as_monitoring(in_time_range(requests, *span, with_end=False)) for span in (reference, current))
    if ref.isEmpty() or cur.isEmpty():
        return None
    return drift_report(ref, cur, strict=strict, ks_method=ks_method)


__all__ = [
    "ConsistencyError",
    "PipelineError",
    "SourceError",
    "build_metrics",
    "drift_between",
    "gate",
    "run_pipeline",
]
