"""Every registered query: operator over the given tables, doubles rounded for comparison."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqloom import schemas as S
from reqloom.functions import hashing, text
from reqloom.operators import (
    anomaly,
    consistency,
    drift,
    errors,
    explore,
    generic,
    latency,
    local,
    quality,
    rolling,
    sla,
    status,
    users,
)
from reqloom.operators.normalize import normalize_flat, normalize_log_entries
from reqloom.operators.staging import new_path
from reqloom.plans import inputs, pipeline
from reqloom.plans.built import BUILT
from reqloom.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
INGEST = datetime(2024, 2, 1)
DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _over(operator: Callable[[DataFrame], DataFrame], source=inputs.requests) -> Query:
    return lambda spark, folder: rounded(operator(source(spark, folder)))


def _synth(spark: SparkSession, folder: str) -> tuple[DataFrame, Column]:
    trace = F.concat(F.lit("trace-"), F.col("event_id").cast("string"))
    return hashing.with_residue(inputs.events(spark, folder), trace, "residue"), F.col("residue")


def synth_status(spark: SparkSession, folder: str) -> DataFrame:
    e, residue = _synth(spark, folder)
    return e.select(
        "event_id",
        hashing.stand_in_status(residue, S.FLAT_STATUS_CODES).alias("flat_status"),
        hashing.stand_in_status(residue, S.ENTRY_STATUS_CODES).alias("entry_status"),
    )


def synth_latency(spark: SparkSession, folder: str) -> DataFrame:
    e, residue = _synth(spark, folder)
    return e.select("event_id", hashing.stand_in_latency(residue).alias("latency_ms"))


def synth_ip(spark: SparkSession, folder: str) -> DataFrame:
    e, residue = _synth(spark, folder)
    return e.select(
        "event_id",
        hashing.stand_in_ip_flat(residue).alias("flat_ip"),
        hashing.stand_in_ip_entry(residue).alias("entry_ip"),
    )


def latency_text_ms(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("k").cast("string")
    written = (
        F.when(F.col("k") % 4 == 0, F.concat(F.lit("0."), F.lpad(k, 3, "0"), F.lit("s")))
        .when(F.col("k") % 4 == 1, F.concat(k, F.lit("s")))
        .when(F.col("k") % 4 == 2, F.concat(F.lit("took "), k, F.lit(".5 seconds")))
        .otherwise(F.lit("unknown"))
    )
    return rounded(inputs.events(spark, folder).select("event_id", text.duration_ms(written).alias("latency_ms")))


def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("o_orderkey") % 4
    written = (
        F.when(number == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(number == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .when(number == 2, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-M-d"))
    )
    o = inputs.table(spark, folder, "orders").select("o_orderkey", written.alias("original"))
    return o.withColumn("parsed", text.parse_date(F.col("original")))


def normalize_text(spark: SparkSession, folder: str) -> DataFrame:
    d = inputs.table(spark, folder, "documents")
    return d.select("doc_id", text.normalize_text(F.col("text")).alias("text"))


def normalize_list(spark: SparkSession, folder: str) -> DataFrame:
    d = inputs.table(spark, folder, "documents")
    items = text.normalize_items(F.split("text", "\n"))
    return d.select("doc_id", F.size(items).alias("n_items"), F.array_join(items, "|").alias("items"))


def aggregate_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        generic.aggregate_metrics(
            inputs.requests(spark, folder),
            [
                " total_requests",
                "avg_latency_ms",
                "max_latency_ms",
                "p95_latency_ms",
                "total_4xx",
                "rate_5xx",
                "sla_lt_1s_rate",
                "total_requests",
            ],
            ["day", "api_path"],
            datetime(2024, 1, 5),
            datetime(2024, 1, 20, 12),
        )
    )


def metric_points(spark: SparkSession, folder: str) -> DataFrame:
    hourly = latency.latency_hourly(inputs.requests(spark, folder))
    points = generic.metric_points(
        hourly, ["api_path"], "hour_ts", ["avg_latency_ms", "p95_latency_ms", "total_requests"]
    )
    return rounded(
        points.select("name", "value", "unit", F.col("tags")["api_path"].alias("tag_api_path"), "timestamp")
    )


def running_mean(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(rolling.running_mean(inputs.requests(spark, folder), "api_path", "latency_ms"))


LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def column_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.column_stats(inputs.table(spark, folder, "lineitem"), LINE_COLUMNS), 4)


def iqr_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.iqr_bounds(inputs.table(spark, folder, "lineitem"), LINE_COLUMNS))


def extremes(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.extremes(inputs.table(spark, folder, "lineitem"), LINE_COLUMNS))


def winsorize(spark: SparkSession, folder: str) -> DataFrame:
    li = inputs.table(spark, folder, "lineitem")
    return rounded(
        li.select(
            "l_orderkey",
            "l_linenumber",
            quality.winsorize(F.col("l_extendedprice"), 5000.0, 60000.0).alias("l_extendedprice"),
        )
    )


def quality_zscore(spark: SparkSession, folder: str) -> DataFrame:
    e = inputs.events(spark, folder)
    return rounded(e.where(quality.zscore_flags(e, ["value"])["value"]).select("event_id", "value"))


def quality_iqr(spark: SparkSession, folder: str) -> DataFrame:
    e = inputs.events(spark, folder)
    return rounded(e.where(quality.iqr_flags(e, ["value"])["value"]).select("event_id", "value"))


def quality_invalid(spark: SparkSession, folder: str) -> DataFrame:
    v = inputs.gapped_values(spark, folder)
    return quality.invalid_counts(v, quality.numeric_columns(v))


def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    v = inputs.gapped_values(spark, folder)
    z, _ = quality.quality_report(v, "zscore")
    q, _ = quality.quality_report(v, "iqr")
    return rounded(
        z.select(F.lit("zscore").alias("method"), "*").unionByName(q.select(F.lit("iqr").alias("method"), "*"))
    )


def consistency_rows(spark: SparkSession, folder: str) -> DataFrame:
    checked = consistency.check_rows(inputs.monitoring_rows(spark, folder))
    names = F.array_join(F.transform("issues", lambda issue: issue["rule"]), ",")
    return rounded(checked.select("record_id", "endpoint", names.alias("rules"), "quality_score"))


def consistency_summary(spark: SparkSession, folder: str) -> DataFrame:
    return consistency.issue_counts(inputs.monitoring_rows(spark, folder))


def consistency_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(consistency.consistency_report(inputs.monitoring_rows(spark, folder)))


def consistency_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    rows = consistency.normalize_rows(inputs.monitoring_rows(spark, folder))
    found = rows.select("record_id", consistency.repeated_values(rows).alias("found"))
    return found.select("record_id", F.size("found").alias("n_repeated"), F.array_join("found", ",").alias("repeated"))


def completeness_score(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.monitoring_rows(spark, folder)
    return rounded(rows.select("record_id", consistency.completeness(rows.columns).alias("quality_score")))


def safe_name_check(spark: SparkSession, folder: str) -> DataFrame:
    p = inputs.table(spark, folder, "pages")
    url = F.col("url")
    return p.select(
        "page_id",
        text.matches(url, S.SAFE_NAME).alias("is_safe_name"),
        text.matches(url, S.SAFE_FILE).alias("is_safe_file"),
        text.matches(url, S.URL).alias("is_url"),
    )


def row_count_check(spark: SparkSession, folder: str) -> DataFrame:
    return generic.count_matches(inputs.requests(spark, folder), inputs.events(spark, folder).count())


def _samples(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return inputs.drift_sample(spark, folder, current=False), inputs.drift_sample(spark, folder, current=True)


def drift_ks_stat(spark: SparkSession, folder: str) -> DataFrame:
    ref, cur = (s.select("latency", "payload_size") for s in _samples(spark, folder))
    return rounded(drift.ks_statistics(ref, cur))


def drift_chi2_stat(spark: SparkSession, folder: str) -> DataFrame:
    ref, cur = (s.select("endpoint", "status_code") for s in _samples(spark, folder))
    return rounded(drift.chi2_statistics(ref, cur))


def drift_features(spark: SparkSession, folder: str) -> DataFrame:
    ref, cur = _samples(spark, folder)
    return rounded(drift.drift_features(ref.unionByName(cur)))


def _tests_of(metrics: DataFrame) -> DataFrame:
    """A row per test; the SQL has the p-value's expansion, which five digits hold."""
    expanded = F.col("rule") == "drift_numeric"
    return rounded(metrics.withColumn("p_value", F.when(expanded, F.round("p_value", 5)).otherwise(F.col("p_value"))))


def drift_report(spark: SparkSession, folder: str) -> DataFrame:
    return _tests_of(drift.drift_report(*_samples(spark, folder))[1])


def drift_report_file(spark: SparkSession, folder: str) -> DataFrame:
    metrics = drift.drift_report(*_samples(spark, folder))[1]
    path = drift.write_drift_report(metrics, new_path(spark))
    return _tests_of(spark.read.schema(metrics.schema).json(path))


def drift_between(spark: SparkSession, folder: str) -> DataFrame:
    """The requests before and after a day; ten times the latency of the samples moves no test."""
    middle = datetime(2024, 1, 16)
    spans = (datetime(2000, 1, 1), middle), (middle, datetime(2100, 1, 1))
    return _tests_of(pipeline.drift_between(inputs.requests(spark, folder), *spans)[1])


def define_view(spark: SparkSession, folder: str) -> DataFrame:
    writers.define_view(status.status_code_kpis(inputs.requests(spark, folder)), "reqloom_status_codes")
    return rounded(spark.table("reqloom_status_codes"))


def run_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over halves of the records: the second builds the days that it adds to. The daily table, as stored."""
    raw, path = inputs.raw_flat(spark, folder), new_path(spark)
    first = F.coalesce(F.col("trace"), F.lit("")).endswith("3")
    for name, part in (("a", raw.where(first)), ("b", raw.where(~first))):
        part.write.json(f"{path}/{name}")
        tables = pipeline.run_pipeline(spark, "jsonl", "local", f"{path}/store", f"{path}/out", path=f"{path}/{name}", ingest_ts=INGEST)
    return rounded(tables["dashboard_latency_daily"])


def drift_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(drift.drift_report(*_samples(spark, folder))[0])


def drift_report_lines(spark: SparkSession, folder: str) -> DataFrame:
    ref, cur = (inputs.line_sample(spark, folder, current) for current in (False, True))
    return _tests_of(drift.drift_report(ref, cur)[1])


# sources, sinks and jobs: the given tables are written to the shared folder and read back


def source_json(spark: SparkSession, folder: str) -> DataFrame:
    """Arrays of 1,000 records at most, each in a file of its own."""
    path = new_path(spark)
    raw = inputs.raw_flat(spark, folder)
    numbered = raw.withColumn("_part", F.floor(F.monotonically_increasing_id() / 1000))
    arrays = numbered.groupBy("_part").agg(F.to_json(F.collect_list(F.struct(*raw.columns))).alias("value"))
    arrays.write.partitionBy("_part").text(path)
    return rounded(normalize_flat(readers.read_logs(spark, "json", path), INGEST))


def source_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark)
    inputs.raw_flat(spark, folder).write.json(path)
    return rounded(normalize_flat(readers.read_logs(spark, "jsonl", path), INGEST))


def source_parquet(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark)
    inputs.raw_flat(spark, folder).write.parquet(path)
    return rounded(normalize_flat(readers.read_logs(spark, "parquet", path), INGEST))


def source_csv(spark: SparkSession, folder: str) -> DataFrame:
    """All columns of flat records, in files of two headers: one has them in another order."""
    path, raw = new_path(spark), inputs.raw_flat(spark, folder).drop("httpRequest")
    first = F.coalesce(F.col("trace"), F.lit("")).endswith("1")
    writers.write_csv(raw.where(first), f"{path}/a")
    writers.write_csv(raw.where(~first).select(*reversed(raw.columns)), f"{path}/b")
    return rounded(normalize_flat(readers.read_logs(spark, "csv", f"{path}/*"), INGEST))


def source_log_entries(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark)
    inputs.log_entries(spark, folder).write.json(path)
    return rounded(normalize_log_entries(readers.read_logs(spark, "cloud", path, "trace IS NOT NULL"), INGEST))


def append_twice(spark: SparkSession, folder: str) -> DataFrame:
    path, requests = new_path(spark), inputs.requests(spark, folder)
    for gather_days in (False, True):
        writers.write_requests(requests, "path", path, gather_days)
    stored = spark.read.parquet(path)
    return stored.groupBy("event_date", "api_path").agg(F.count(F.lit(1)).alias("total_requests"))


def replace_table(spark: SparkSession, folder: str) -> DataFrame:
    path, requests = new_path(spark), inputs.requests(spark, folder)
    writers.replace_table(requests, path)
    return writers.replace_table(rounded(status.status_code_kpis(requests)), path)


def _exported(fmt: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        path, kpis = new_path(spark), rounded(status.status_code_kpis(inputs.requests(spark, folder)))
        writers.export(kpis, fmt, path)
        return spark.read.schema(kpis.schema).option("header", True).format(fmt).load(path)

    return query


def _built(target: str) -> Query:
    """Rows and a sum of every table as stored, once both targets are built under one folder."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        out, requests = new_path(spark), inputs.requests(spark, folder)
        tables = {t: pipeline.build_metrics(requests, out, t) for t in pipeline.TARGETS}[target]
        sums = [
            rounded(tables[name]).agg(
                F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(F.col(measure).cast("double")), 3).alias("total")
            )
            for name, (_, measure) in BUILT[target].items()
        ]
        return reduce(DataFrame.unionByName, sums)

    return query


def drift_severity(spark: SparkSession, folder: str) -> DataFrame:
    """Relative change of each status code's share between the halves, graded."""
    ref, cur = _samples(spark, folder)
    both = ref.select("status_code", F.lit(1).alias("r")).unionByName(cur.select("status_code", F.lit(0).alias("r")))
    counts = both.groupBy("status_code").agg(F.sum("r").alias("n_ref"), F.sum(1 - F.col("r")).alias("n_cur"))
    change = F.abs(F.try_divide(F.col("n_cur") - F.col("n_ref"), F.col("n_ref")))
    return rounded(
        counts.select("status_code", change.alias("change")).withColumn("severity", drift.drift_severity(F.col("change")))
    )


CODES = sorted(S.FLAT_STATUS_CODES)

QUERIES: dict[str, Query] = {
    "normalize_flat": _over(lambda raw: normalize_flat(raw, INGEST), inputs.raw_flat),
    "normalize_flat_without_stand_ins": _over(lambda raw: normalize_flat(raw, INGEST, False), inputs.raw_flat),
    "normalize_log_entries": _over(lambda raw: normalize_log_entries(raw, INGEST), inputs.log_entries),
    "synth_status": synth_status,
    "synth_latency": synth_latency,
    "synth_ip": synth_ip,
    "latency_text_ms": latency_text_ms,
    "parse_dates": parse_dates,
    "normalize_text": normalize_text,
    "normalize_list": normalize_list,
    "aggregate_metrics": aggregate_metrics,
    "status_pivot": _over(lambda r: generic.status_pivot(r, CODES)),
    "status_pivot_few_codes": _over(lambda r: generic.status_pivot(r, [200, 404])),
    "executive_overview": _over(generic.executive_overview),
    "status_family_share": _over(generic.status_family_share),
    "metric_points": metric_points,
    "latency_kpis": _over(latency.latency_kpis),
    "latency_hourly": _over(latency.latency_hourly),
    "latency_rank_daily": _over(latency.latency_rank_daily),
    "error_kpis": _over(errors.error_kpis),
    "errors_hourly": _over(errors.errors_hourly),
    "errors_rolling": _over(errors.errors_rolling),
    "top_error_endpoints_daily": _over(errors.top_error_endpoints_daily, inputs.fine_requests),
    "sla_kpis": _over(sla.sla_kpis),
    "sla_hourly": _over(sla.sla_hourly),
    "sla_daily": _over(sla.sla_daily),
    "sla_rolling_drift": _over(sla.sla_rolling_drift),
    "status_code_kpis": _over(status.status_code_kpis),
    "status_codes_daily": _over(status.status_codes_daily),
    "status_codes_hourly": _over(status.status_codes_hourly),
    "status_families_daily": _over(status.status_families_daily),
    "top_endpoints_per_error_code": _over(status.top_endpoints_per_error_code_daily, inputs.fine_requests),
    "user_kpis": _over(users.user_kpis),
    "user_activity_daily": _over(users.user_activity_daily),
    "user_auth_errors_daily": _over(users.user_auth_errors_daily),
    "user_rolling_activity": _over(users.user_rolling_activity),
    "anomaly_latency_zscore": _over(anomaly.anomaly_latency_zscore),
    "anomaly_error_spikes": _over(anomaly.anomaly_error_spikes),
    "endpoint_degradation_daily": _over(anomaly.endpoint_degradation_daily),
    "local_latency_daily": _over(local.local_latency_daily),
    "local_errors_hourly": _over(local.local_errors_hourly),
    "local_status_codes": _over(local.local_status_codes),
    "explore_status_codes": _over(explore.status_code_distribution),
    "explore_status_families": _over(explore.status_family_distribution),
    "explore_latency_summary": _over(explore.latency_overview),
    "explore_top_endpoints": _over(explore.top_endpoints, inputs.fine_requests),
    "explore_hourly_volume": _over(explore.hourly_volume),
    "explore_daily_volume": _over(explore.daily_volume),
    "rolling_avg_hourly": _over(latency.rolling_avg_hourly),
    "latency_delta": _over(latency.latency_delta),
    "slowest_requests_per_path": _over(latency.slowest_requests_per_path),
    "latency_row_numbers": _over(latency.latency_row_numbers),
    "rolling_error_rate_hourly": _over(errors.rolling_error_rate_hourly),
    "latency_vs_path_mean": _over(latency.latency_vs_path_mean),
    "running_mean": running_mean,
    "column_stats": column_stats,
    "iqr_bounds": iqr_bounds,
    "extremes": extremes,
    "winsorize": winsorize,
    "quality_zscore": quality_zscore,
    "quality_iqr": quality_iqr,
    "quality_invalid": quality_invalid,
    "quality_report": quality_report,
    "consistency_rows": consistency_rows,
    "consistency_summary": consistency_summary,
    "consistency_report": consistency_report,
    "consistency_duplicates": consistency_duplicates,
    "completeness_score": completeness_score,
    "safe_name_check": safe_name_check,
    "row_count_check": row_count_check,
    "drift_ks_stat": drift_ks_stat,
    "drift_chi2_stat": drift_chi2_stat,
    "drift_features": drift_features,
    "drift_report_file": drift_report_file,
    "drift_between": drift_between,
    "define_view": define_view,
    "run_pipeline": run_pipeline,
    "drift_report": drift_report,
    "drift_summary": drift_summary,
    "drift_report_lines": drift_report_lines,
    "drift_severity": drift_severity,
    "source_json": source_json,
    "source_jsonl": source_jsonl,
    "source_parquet": source_parquet,
    "source_csv": source_csv,
    "source_log_entries": source_log_entries,
    "append_twice": append_twice,
    "replace_table": replace_table,
    "export_json": _exported("json"),
    "export_csv": _exported("csv"),
    "export_parquet": _exported("parquet"),
    "build_metrics_warehouse": _built("warehouse"),
    "build_metrics_local": _built("local"),
}
