"""Drift between a reference and a current dataset.

Spark reduces both samples to value counts and these to one row per test; only the p-values of those few rows are
computed on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqloom.functions.pvalues import chi2_p_value, ks_p_value
from reqloom.operators.generic import severity
from reqloom.operators.quality import known
from reqloom.schemas import DRIFT_HIGH, DRIFT_MEDIUM, DRIFT_P_VALUE, RULES

# Tested metric -> the series behind it. Mean and deviation both stand for the raw latency.
METRIC_SERIES = {
    "latency_mean": "latency",
    "latency_std": "latency",
    "is_error": "is_error",
    "payload_size": "payload_size",
}
CATEGORIES = ("endpoint", "status_code")
# Ranges of a column's values that are summed by themselves.
RANGES = 200


class DriftError(ValueError):
    """The datasets cannot be compared, or did not pass a strict check."""


def _series(df: DataFrame) -> dict[str, Column]:
    columns = {}
    if "latency" in df.columns:
        columns["latency"] = F.col("latency").cast("double")
    if "status_code" in df.columns:
        columns["is_error"] = F.col("status_code").cast("int") >= 400
    if "payload_size" in df.columns:
        columns["payload_size"] = F.col("payload_size").cast("double")
    return columns


def drift_features(df: DataFrame) -> DataFrame:
    """The tested metrics per row; `request_count` is the size of the dataset on every row."""
    series = _series(df)
    size = df.agg(F.count(F.lit(1)).alias("n"))
    return df.select(
        *[series[source].alias(metric) for metric, source in METRIC_SERIES.items() if source in series],
        size.scalar().alias("request_count"),
    )


def _counts(ref: DataFrame, cur: DataFrame, name: str) -> DataFrame:
    """Both samples, one column per series, as counts per (series, value); nulls are dropped."""
    columns = ref.columns
    both = ref.withColumn("_ref", F.lit(1)).unionByName(cur.select(*columns).withColumn("_ref", F.lit(0)))
    long = both.unpivot(["_ref"], list(columns), name, "value").where(F.col("value").isNotNull())
    return long.groupBy(name, "value").agg(
        F.sum("_ref").alias("n_ref"), F.sum(F.lit(1) - F.col("_ref")).alias("n_cur")
    )


def ks_statistics(ref: DataFrame, cur: DataFrame, ranges: int = RANGES) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per column of `ref`, with both sample sizes.

    A sketch cuts each column into `ranges`. Within a range running counts give the largest and the least gap; the gaps
    before the range, known from the ranges' totals, shift both. So no values are stored and no task sorts a whole column.
    """
    columns = ref.columns
    known_ref, known_cur = (df.select(*[known(c).alias(c) for c in columns]) for df in (ref, cur))
    steps = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    sketch = [F.percentile_approx(c, steps, F.lit(10 * ranges)).alias(f"p{i}") for i, c in enumerate(columns)]
    edges = known_ref.unionByName(known_cur).agg(*sketch).first()
    counts = _counts(known_ref, known_cur, "metric")
    totals = counts.groupBy("metric").agg(F.sum("n_ref").alias("_n_ref"), F.sum("n_cur").alias("_n_cur"))
    sizes = {row["metric"]: row for row in totals.collect()}
    spans, shares = F.lit(None).cast("bigint"), {"ref": F.lit(None).cast("bigint"), "cur": F.lit(None).cast("bigint")}
    for i, name in enumerate(columns):
        if name in sizes:
            at = F.array(*[F.lit(edge) for edge in sorted(set(edges[f"p{i}"]))])
            is_metric = F.col("metric") == name
            spans = F.when(is_metric, F.size(F.filter(at, lambda edge: edge < F.col("value"))).cast("bigint")).otherwise(spans)
            shares = {side: F.when(is_metric, F.lit(sizes[name][f"_n_{side}"])).otherwise(shares[side]) for side in shares}
    upto = Window.partitionBy("metric", "_span").orderBy("value")
    running = counts.withColumn("_span", spans).select(
        "metric", "_span", "n_ref", "n_cur", *[F.sum(f"n_{side}").over(upto).alias(f"_c_{side}") for side in shares]
    )
    gap = F.coalesce(F.try_divide("_c_ref", shares["ref"]), F.lit(0.0)) - F.coalesce(F.try_divide("_c_cur", shares["cur"]), F.lit(0.0))
    spanned = running.groupBy("metric", "_span").agg(
        F.sum("n_ref").alias("_s_ref"), F.sum("n_cur").alias("_s_cur"), F.max(gap).alias("_most"), F.min(gap).alias("_least")
    )
    # at most `ranges` rows per column from here on
    earlier = Window.partitionBy("metric").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    before = {side: F.coalesce(F.sum(f"_s_{side}").over(earlier), F.lit(0)) for side in shares}
    shift = F.coalesce(F.try_divide(before["ref"], shares["ref"]), F.lit(0.0)) - F.coalesce(
        F.try_divide(before["cur"], shares["cur"]), F.lit(0.0)
    )
    gaps = spanned.select("metric", "_s_ref", "_s_cur", F.greatest(F.abs(shift + F.col("_most")), F.abs(shift + F.col("_least"))).alias("_gap"))
    found = gaps.groupBy("metric").agg(F.sum("_s_ref").alias("n_ref"), F.sum("_s_cur").alias("n_cur"), F.max("_gap").alias("_gap"))
    # an empty sample has no law to be apart from
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    return found.select("metric", "n_ref", "n_cur", F.when(both, F.col("_gap")).otherwise(F.lit(0.0)).alias("ks_statistic"))


def chi2_statistics(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """Chi-square statistic per column of `ref` over the union of its categories; two categories take Yates'
    correction, one category gives zero."""
    columns = ref.columns
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    counts = _counts(ref.select(*texts), cur.select(*texts), "column_name")
    # one row per tested column
    sizes = counts.groupBy(F.col("column_name").alias("_column")).agg(
        F.count(F.lit(1)).alias("n_categories"),
        F.sum("n_ref").cast("double").alias("_n_ref"),
        F.sum("n_cur").cast("double").alias("_n_cur"),
    )
    everything = F.col("_n_ref") + F.col("_n_cur")
    in_category = F.col("n_ref") + F.col("n_cur")
    gaps = []
    for observed, size in (("n_ref", "_n_ref"), ("n_cur", "_n_cur")):
        expected = F.col(size) * in_category / everything
        gap = F.abs(F.col(observed) - expected)
        gap = F.when(F.col("n_categories") == 2, gap - F.least(gap, F.lit(0.5))).otherwise(gap)
        gaps.append(F.try_divide(gap * gap, expected))
    return (
        counts.join(F.broadcast(sizes), F.col("column_name") == F.col("_column"))
        .groupBy("column_name")
        .agg(
            F.max("_n_ref").cast("bigint").alias("n_ref"),
            F.max("_n_cur").cast("bigint").alias("n_cur"),
            F.max("n_categories").alias("n_categories"),
            F.sum(gaps[0] + gaps[1]).alias("_chi2"),
        )
        .select(
            "column_name",
            "n_ref",
            "n_cur",
            "n_categories",
            (F.col("n_categories") - 1).alias("degrees"),
            F.when(F.col("n_categories") > 1, F.col("_chi2")).otherwise(F.lit(0.0)).alias("chi2"),
        )
    )


def drift_report(
    ref: DataFrame,
    cur: DataFrame,
    p_value_threshold: float = DRIFT_P_VALUE,
    strict: bool = False,
    dedupe_metrics: bool = False,
    ks_method: str = "asymptotic",
) -> tuple[DataFrame, DataFrame]:
    """One summary row (is_drift_ok, errors, warnings, drift_score, severity) and one row per test.

    The score is the share of tests without drift; drift is a warning, so errors are always zero. `dedupe_metrics`
    tests the latency once instead of as mean and deviation. `ks_method` is `asymptotic` or, for small samples, `exact`.
    Strict raises when any test drifted.
    """
    spark = ref.sparkSession
    n_ref, n_cur = ref.count(), cur.count()
    if n_ref == 0 or n_cur == 0:
        raise DriftError("Empty datasets provided")

    series_ref, series_cur = _series(ref), _series(cur)
    categories = [c for c in CATEGORIES if c in ref.columns]
    absent = [c for c in [*series_ref, *categories] if c not in series_cur and c not in cur.columns]
    if absent:
        raise DriftError(f"Missing in the current dataset: {absent}")

    tests = []
    if series_ref:
        ks = {
            row["metric"]: row
            for row in ks_statistics(
                ref.select(*[c.cast("double").alias(n) for n, c in series_ref.items()]),
                cur.select(*[series_cur[n].cast("double").alias(n) for n in series_ref]),
            ).collect()
        }
        for metric, source in METRIC_SERIES.items():
            if source not in series_ref or (dedupe_metrics and metric == "latency_std"):
                continue
            row = ks.get(source)
            sizes = (row["n_ref"], row["n_cur"]) if row else (0, 0)
            distance = row["ks_statistic"] if row and all(sizes) else 0.0
            tests.append(("drift_numeric", metric, distance, ks_p_value(distance, *sizes, ks_method)))
    distance = 0.0 if n_ref == n_cur else 1.0
    tests.append(("drift_numeric", "request_count", distance, ks_p_value(distance, n_ref, n_cur, ks_method)))
    if categories:
        chi2 = {
            row["column_name"]: row for row in chi2_statistics(ref.select(*categories), cur.select(*categories)).collect()
        }
        for name in categories:
            row = chi2.get(name)
            if row and not (row["n_ref"] and row["n_cur"]):
                raise DriftError(f"No values of {name} in one dataset")
            statistic, degrees = (row["chi2"], row["degrees"]) if row else (0.0, 0)
            tests.append(("drift_categorical", name, statistic, chi2_p_value(statistic, degrees)))

    rows = []
    for rule, metric, statistic, p in tests:
        is_drift = p < p_value_threshold
        message = RULES[rule][1].format(metric) if is_drift else None
        rows.append((rule, metric, float(statistic), float(p), is_drift, message))
    drifted = sum(row[4] for row in rows)
    score = 1.0 - drifted / len(rows)
    if strict and score < 1.0:
        raise DriftError("Data drift detected")
    metrics = spark.createDataFrame(
        rows, "rule string, metric string, statistic double, p_value double, drifted boolean, message string"
    )
    summary = spark.createDataFrame(
        [(True, 0, drifted, score)], "is_drift_ok boolean, errors bigint, warnings bigint, drift_score double"
    ).withColumn("severity", drift_severity(1 - F.col("drift_score")))
    return summary, metrics


def drift_severity(drift_share: Column, medium: float = DRIFT_MEDIUM, high: float = DRIFT_HIGH) -> Column:
    return severity(drift_share, medium, high)


def write_drift_report(metrics: DataFrame, path: str) -> str:
    """The per-test table as JSON."""
    metrics.coalesce(1).write.mode("overwrite").json(path)
    return path


def as_monitoring(requests: DataFrame) -> DataFrame:
    """Request rows under the names the drift and consistency checks use."""
    names: Sequence[tuple[str, str]] = [
        ("event_timestamp", "timestamp"),
        ("api_path", "endpoint"),
        ("status_code", "status_code"),
        ("latency_ms", "latency"),
        ("payload_size", "payload_size"),
    ]
    return requests.select(*[F.col(old).alias(new) for old, new in names if old in requests.columns])
