"""Consistency, quality and drift on hand-made rows."""

from __future__ import annotations

import math
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from reqloom.functions import pvalues
from reqloom.functions.pvalues import chi2_p_value, ks_p_value, ks_tail
from reqloom.operators import consistency as C
from reqloom.operators import drift as D
from reqloom.operators import quality as Q
from tests.conftest import rows_of

MONITORING = (
    "timestamp string, endpoint string, status_code int, latency double, total_requests bigint, "
    "success_requests bigint, success_rate double"
)
VALID = ("2031-05-04T10:00:00", "/shop/cart", 200, 120.0, 100, 90, 0.9)


def issues_of(spark, row, schema=MONITORING):
    checked = C.check_rows(spark.createDataFrame([row], schema)).first()
    return [(i["rule"], i["level"]) for i in checked["issues"]], checked


def report_of(spark, row, schema=MONITORING):
    return C.consistency_report(spark.createDataFrame([row], schema)).first()


def test_valid_row(spark):
    assert issues_of(spark, VALID)[0] == []
    report = report_of(spark, VALID)
    assert (report["is_consistent"], report["errors"], report["warnings"], report["quality_score"]) == (True, 0, 0, 1.0)


@pytest.mark.parametrize(
    "change, rules",
    [
        ({3: -5.0}, [("business_latency", "error"), ("metric_latency", "error")]),
        ({6: 1.5}, [("cross_success_rate", "warning"), ("metric_success_rate", "error"), ("metric_consistency", "warning")]),
        ({5: 50}, [("cross_success_rate", "warning"), ("metric_consistency", "warning")]),
        ({5: 110, 6: 1.0}, [("cross_success_rate", "warning"), ("metric_counts", "error"), ("metric_consistency", "warning")]),
        ({2: 99}, [("business_status_code", "error")]),
        ({2: 600}, [("business_status_code", "error")]),
        ({2: None}, [("schema", "error")]),
        ({4: 0, 5: 0, 6: 0.5}, [("duplicates", "warning")]),
        ({6: float("nan")}, [("metric_success_rate", "error")]),
    ],
)
def test_broken_rows(spark, change, rules):
    row = tuple(change.get(i, v) for i, v in enumerate(VALID))
    found, _ = issues_of(spark, row)
    assert found == rules
    report = report_of(spark, row)
    assert report["errors"] == sum(level == "error" for _, level in rules)
    assert report["warnings"] == sum(level == "warning" for _, level in rules)


def test_rate_out_of_range_without_counts(spark):
    schema = "timestamp string, endpoint string, status_code int, success_rate double"
    assert issues_of(spark, ("t", "e", 200, 1.5), schema)[0] == [("metric_success_rate", "error")]


def test_foreign_payload_and_text_codes(spark):
    found, _ = issues_of(spark, ("h", 80, "m"), "host string, port int, mode string")
    assert found == [("schema", "error")] * 3
    found, _ = issues_of(spark, ("t", "/a", "abc", "fast"), "timestamp string, endpoint string, status_code string, latency string")
    assert found == [("type_status_code", "error"), ("type_latency", "error"), ("metric_latency", "error")]
    found, _ = issues_of(spark, (5, "/a", 200.0), "timestamp int, endpoint string, status_code double")
    assert found == [("type_timestamp", "error"), ("type_status_code", "error")]


def test_details_and_all_null_row(spark):
    _, checked = issues_of(spark, tuple({5: 50}.get(i, v) for i, v in enumerate(VALID)))
    details = {i["rule"]: i["details"] for i in checked["issues"]}
    assert details["metric_consistency"] == {"computed": "0.5", "reported": "0.9"}
    _, checked = issues_of(spark, (None,) * 7)
    assert checked["quality_score"] == 0.0
    assert [i["rule"] for i in checked["issues"]] == ["schema"] * 3 + ["duplicates"]


def test_repeated_values_across_types(spark):
    schema = "a int, b double, c boolean, d string, e string, f bigint, g double"
    df = spark.createDataFrame([(1, 1.0, True, " X", "x ", 2, 2.5), (0, 0.5, True, "1", "2", 1, float("nan"))], schema)
    rows = C.normalize_rows(df)
    found = [r[0] for r in rows.select(C.repeated_values(rows)).collect()]
    assert found == [["1", "1", "x"], ["1"]]


def test_repeated_values_of_wide_rows(spark):
    """Three hundred fields of four kinds against a walk over each row; the plan holds no comparison of pairs."""
    draw = random.Random(12)
    kinds = ["int", "double", "string", "boolean"]
    values = {"int": lambda: draw.randint(0, 400), "double": lambda: draw.choice([draw.randint(0, 400) / 2, float("nan")]),
              "string": lambda: str(draw.randint(0, 300)), "boolean": lambda: draw.random() < 0.5}
    schema = ", ".join(f"c{i} {kinds[i % 4]}" for i in range(300))
    data = [tuple(None if draw.random() < 0.01 else values[kinds[i % 4]]() for i in range(300)) for _ in range(20)]
    frame = spark.createDataFrame(data, schema)

    def walked(row):
        seen, out = set(), []
        for value in row:
            kind = "text" if isinstance(value, str) else "null" if value is None else "number"
            if value == value and (kind, value) in seen:
                whole = kind == "number" and float(value).is_integer()
                out.append("null" if value is None else str(int(value)) if whole else str(value))
            seen.add((kind, value))
        return out

    assert [r[0] for r in frame.select(C.repeated_values(frame)).collect()] == [walked(row) for row in data]
    assert C.issue_counts(frame).where("rule = 'duplicates'").first()["n_rows"] == 20
    single = spark.createDataFrame([(1,)], "only int")
    assert single.select(C.repeated_values(single)).first()[0] == []


def test_counts_gate_and_strict(spark):
    bad = tuple({3: -5.0}.get(i, v) for i, v in enumerate(VALID))
    df = spark.createDataFrame([VALID] * 9 + [bad], MONITORING)
    assert rows_of(C.issue_counts(df).select("rule", "n_rows")) == [(1, "business_latency"), (1, "metric_latency")]
    assert C.passes_error_gate(df) and not C.passes_error_gate(df, 0.05)
    with pytest.raises(C.ConsistencyError):
        C.consistency_report(df, strict=True)
    with pytest.raises(ValueError):
        C.passes_error_gate(df, 1.5)
    assert C.completeness([]) is not None


def test_input_file(spark, tmp_path):
    (tmp_path / "one.jsonl").write_text("{}\n")
    (tmp_path / "folder").mkdir()
    (tmp_path / "folder" / "a.json").write_text("{}")
    (tmp_path / "folder" / "b.json").write_text("{}")
    assert C.check_input_file(spark, str(tmp_path / "one.jsonl")).count() == 0
    assert C.check_input_file(spark, str(tmp_path / "folder")).first()["rule"] == "file_type"
    missing = C.check_input_file(spark, str(tmp_path / "none.jsonl")).first()
    assert (missing["rule"], missing["details"]) == ("file_exists", {"file": str(tmp_path / "none.jsonl")})


def quality(spark, rows, schema, **options):
    summary, issues = Q.quality_report(spark.createDataFrame(rows, schema), **options)
    return summary.first(), [(i["rule"], i["level"], i["details"].get("count")) for i in issues.collect()]


def test_quality_fixtures(spark):
    schema = "latency double, requests bigint"
    summary, issues = quality(spark, [(120.0, 100)], schema)
    assert (summary["is_valid"], summary["errors"], summary["score"], issues) == (True, 0, 1.0, [])
    # one row has no spread, so nothing can be an outlier
    assert quality(spark, [(100.0, 999999)], schema)[1] == []
    summary, issues = quality(spark, [(float("nan"), 1)], schema)
    assert (summary["is_valid"], summary["score"]) == (False, 0.0)
    assert issues == [("invalid_values", "error", "1")]
    with pytest.raises(Q.QualityError):
        quality(spark, [(float("nan"), 1)], schema, strict=True)
    with pytest.raises(Q.QualityError):
        quality(spark, [(1.0, 1)], schema, method="mad")
    with pytest.raises(Q.QualityError):
        quality(spark, [], schema)
    summary, issues = quality(spark, [("a",)], "name string")
    assert (summary["is_valid"], summary["score"], issues) == (True, 1.0, [])


@pytest.mark.parametrize("method, rule", [("zscore", "zscore_outliers"), ("iqr", "iqr_outliers")])
def test_outliers(spark, method, rule):
    rows = [(float(i % 10), None if i == 5 else 1.0) for i in range(99)] + [(1000.0, 1.0)]
    summary, issues = quality(spark, rows, "x double, y double", method=method)
    assert issues == [(rule, "warning", "1"), ("invalid_values", "error", "1")]
    assert summary["score"] == pytest.approx(0.98)


def test_infinity_hides_z_outliers_only(spark):
    rows = [(float(i % 10),) for i in range(99)] + [(float("inf"),)]
    assert quality(spark, rows, "x double")[1] == [("invalid_values", "error", "1")]
    assert quality(spark, rows, "x double", method="iqr")[1] == [
        ("invalid_values", "error", "1"),
        ("iqr_outliers", "warning", "1"),
    ]


def test_winsorize(spark):
    df = spark.createDataFrame([(v,) for v in (-5.0, 3.0, 50.0, float("nan"), None)], "x double")
    got = [r[0] for r in df.select(Q.winsorize(F.col("x"), 0.0, 10.0)).collect()]
    assert got[:3] == [0.0, 3.0, 10.0] and math.isnan(got[3]) and got[4] is None


# p-values


def test_ks_fixed_points():
    assert ks_p_value(1.0, 3, 3, "exact") == pytest.approx(0.1)
    assert ks_p_value(1.0, 1, 1, "exact") == pytest.approx(1.0)
    assert ks_p_value(0.0, 5, 5, "exact") == 1.0
    assert ks_p_value(0.5, 0, 5) == 1.0
    assert [ks_p_value(1.0, n, n) for n in (1, 2, 3)] == pytest.approx([1.0, 1 / 3, 0.1])


@pytest.mark.parametrize("m, n", [(3, 3), (4, 3), (5, 2), (6, 4), (1, 7)])
def test_ks_equals_enumeration(m, n):
    def distance(places):
        i = j = 0
        gap = 0.0
        for k in range(m + n):
            if k in places:
                i += 1
            else:
                j += 1
            gap = max(gap, abs(i / m - j / n))
        return gap

    gaps = [distance(set(p)) for p in combinations(range(m + n), m)]
    for d in set(gaps):
        assert ks_p_value(d, m, n, "exact") == pytest.approx(sum(g >= d - 1e-12 for g in gaps) / len(gaps))


# Kolmogorov's law for finite samples as published with the matrix method.
@pytest.mark.parametrize("n, d, below", [(10, 0.274, 0.6284796154565), (2000, 0.04, 0.99676943191713676985)])
def test_ks_law_for_finite_samples(n, d, below):
    assert ks_tail(d, n) == pytest.approx(1 - below, rel=1e-9)


def test_ks_expansion_meets_the_matrix():
    for n in (1000, 4000):
        for x in (0.4, 0.7, 1.0, 1.4, 2.0):
            assert pvalues._ks_expansion(x, n) == pytest.approx(pvalues._ks_matrix(x / n**0.5, n), abs=1e-7)
    assert ks_tail(0.016, 16_000) == pytest.approx(1 - 0.99945234913828052085, abs=1e-9)
    # one number: the gap is at least 1/2
    assert ks_tail(0.5, 1) == 1.0 and ks_tail(0.75, 1) == pytest.approx(0.5) and ks_tail(1.0, 1) == 0.0
    # far out, and for any size, without a jump
    assert ks_tail(4.25 / 1e5, 10**10) == pytest.approx(2 * math.exp(-2 * 4.25**2), rel=1e-3)


def test_ks_exact_meets_the_law():
    n = 4000
    d = 120 / n
    assert ks_p_value(d, n, n, "exact") == pytest.approx(ks_tail(d, n // 2), abs=3e-3)
    assert 0 <= ks_p_value(0.5, 9000, 9000, "exact") < 1e-200
    assert 0 < ks_p_value(0.02, 10**9, 5000) < 0.05
    with pytest.raises(ValueError):
        ks_p_value(0.02, 10**9, 5000, "exact")
    with pytest.raises(ValueError):
        ks_p_value(0.02, 5, 5, "auto")


def test_chi2_tail():
    assert chi2_p_value(3.841458820694124, 1) == pytest.approx(0.05)
    for x in (0.1, 1.0, 2.6667, 9.0, 40.0):
        assert chi2_p_value(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)))
        assert chi2_p_value(x, 2) == pytest.approx(math.exp(-x / 2))
        assert chi2_p_value(x, 4) == pytest.approx(math.exp(-x / 2) * (1 + x / 2))
    assert chi2_p_value(0.0, 0) == 1.0


def chi2(spark, ref, cur):
    frames = [spark.createDataFrame([(v,) for v in s], "c string") for s in (ref, cur)]
    return D.chi2_statistics(*frames).first()


def test_chi2_tables(spark):
    row = chi2(spark, "aaa", "bbb")
    assert (row["chi2"], row["degrees"]) == (pytest.approx(8 / 3), 1)
    assert chi2_p_value(row["chi2"], 1) == pytest.approx(0.10247, abs=1e-5)
    assert chi2(spark, "aa", "aaa")["chi2"] == 0.0
    row = chi2(spark, "aaabbc", "abbbcc")
    assert row["degrees"] == 2
    observed = [[3, 2, 1], [1, 3, 2]]
    want = sum(
        (observed[i][j] - 6 * sum(r[j] for r in observed) / 12) ** 2 / (6 * sum(r[j] for r in observed) / 12)
        for i in range(2)
        for j in range(3)
    )
    assert row["chi2"] == pytest.approx(want)


DRIFT = "latency double, status_code int, endpoint string"


def drift(spark, ref, cur, schema=DRIFT, **options):
    summary, metrics = D.drift_report(spark.createDataFrame(ref, schema), spark.createDataFrame(cur, schema), **options)
    return summary.first(), {m["metric"]: m for m in metrics.collect()}


def test_drift_fixtures(spark):
    same = [(100.0, 200, "/a"), (110.0, 200, "/a"), (120.0, 200, "/a")]
    summary, metrics = drift(spark, same, same)
    assert (summary["drift_score"], summary["is_drift_ok"], summary["severity"]) == (1.0, True, "low")
    assert list(metrics) == ["latency_mean", "latency_std", "is_error", "request_count", "endpoint", "status_code"]

    ref, cur = [(100.0, 200, "/a")] * 3, [(1000.0, 500, "/b"), (1200.0, 500, "/b"), (1500.0, 500, "/b")]
    summary, metrics = drift(spark, ref, cur, ks_method="exact")
    assert metrics["latency_mean"]["p_value"] == pytest.approx(0.1)
    assert metrics["endpoint"]["p_value"] == pytest.approx(0.10247, abs=1e-5)
    assert summary["drift_score"] == 1.0
    assert drift(spark, ref[:1], cur[:1], strict=True)[0]["drift_score"] == 1.0
    with pytest.raises(D.DriftError):
        drift(spark, [], same)


def test_drift_flags_and_errors(spark):
    ref = [(float(i), 200, "/a") for i in range(50)]
    cur = [(float(i + 100), 500, "/b") for i in range(50)]
    summary, metrics = drift(spark, ref, cur)
    assert {m for m, row in metrics.items() if row["drifted"]} == {
        "latency_mean", "latency_std", "is_error", "endpoint", "status_code"
    }
    assert (summary["warnings"], summary["drift_score"], summary["severity"]) == (5, pytest.approx(1 / 6), "high")
    assert metrics["endpoint"]["message"] == "Drift detected in metric endpoint"
    assert "latency_std" not in drift(spark, ref, cur, dedupe_metrics=True)[1]
    with pytest.raises(D.DriftError):
        drift(spark, ref, cur, strict=True)
    with pytest.raises(D.DriftError):
        D.drift_report(spark.createDataFrame(ref, DRIFT), spark.createDataFrame(cur, DRIFT).drop("endpoint"))
    # another size alone is drift of the request count
    assert drift(spark, ref, ref * 2)[1]["request_count"]["drifted"]


def test_drift_ignores_nulls(spark):
    ref = [(1.0, 200, "/a"), (None, 200, None)]
    _, metrics = drift(spark, ref, ref)
    assert metrics["latency_mean"]["p_value"] == 1.0
    _, metrics = drift(spark, [(None, 200, "/a")], [(1.0, 200, "/a")])
    assert (metrics["latency_mean"]["statistic"], metrics["latency_mean"]["p_value"]) == (0.0, 1.0)


def test_drift_report_file(spark, tmp_path):
    rows = [(1.0, 200, "/a")]
    _, metrics = D.drift_report(spark.createDataFrame(rows, DRIFT), spark.createDataFrame(rows, DRIFT))
    path = D.write_drift_report(metrics, str(tmp_path / "report"))
    assert spark.read.json(path).count() == 6
