"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

import re

from reqloom.plans.built import BUILT

# k: number in props; h: md5 of the trace as a 128-bit integer
_EVENTS = """
e AS (
  SELECT *, CAST(props->>'$.k' AS INTEGER) AS k, 'trace-' || event_id AS trace, md5('trace-' || event_id) AS digest
  FROM events
),
hashed AS (
  SELECT *,
    CAST('0x' || substr(digest, 1, 8) AS UHUGEINT) * 79228162514264337593543950336
    + CAST('0x' || substr(digest, 9, 8) AS UHUGEINT) * 18446744073709551616
    + CAST('0x' || substr(digest, 17, 8) AS UHUGEINT) * 4294967296
    + CAST('0x' || substr(digest, 25, 8) AS UHUGEINT) AS h
  FROM e
)"""
_STATUS = "CAST([500, 503, 404, 401, 403, 422, 429, 200, 201, 204][CAST({h} % 10 AS INTEGER) + 1] AS INTEGER)"
_ENTRY_STATUS = "CAST([500, 503, 404, 401, 403, 422, 429, 200, 200, 200][CAST({h} % 10 AS INTEGER) + 1] AS INTEGER)"
_LATENCY = "CAST({h} % 1500 AS BIGINT) + 80"
_FLAT_IP = "'10.' || ({h} % 255) || '.' || (({h} // 10) % 255) || '.' || (({h} // 100) % 255)"
_ENTRY_IP = "'10.' || ({h} % 255) || '.' || ({h} % 200) || '.' || ({h} % 100)"


def _requests(path: str) -> str:
    return f"""{_EVENTS},
requests AS (
  SELECT ts AS event_timestamp, {path} AS api_path, {_STATUS.format(h='h')} AS status_code,
    CAST(round(value * 10) AS BIGINT) AS latency_ms, 'user-' || user_id AS user_uid, trace,
    CAST(k AS BIGINT) AS payload_size, CAST(ts AS DATE) AS day, date_trunc('hour', ts) AS hour_ts
  FROM hashed
)"""


_COARSE = _requests("'/v1/' || event_type")
_FINE = _requests("'/v1/' || event_type || '/' || (k % 10)")


def _sql(body: str, fine: bool = False) -> str:
    """Adds the request relation; a body may open with its own common tables."""
    body = body.strip()
    base = _FINE if fine else _COARSE
    return f"WITH {base}, {body[5:]}" if body.startswith("WITH ") else f"WITH {base}\n{body}"


def _events(body: str) -> str:
    body = body.strip()
    return f"WITH {_EVENTS}, {body[5:]}" if body.startswith("WITH ") else f"WITH {_EVENTS}\n{body}"


_4XX = "count(*) FILTER (status_code BETWEEN 400 AND 499)"
_5XX = "count(*) FILTER (status_code >= 500)"
_TOTAL = "count(*) AS total_requests"
_ERRORS = f"""{_TOTAL}, {_4XX} AS total_4xx, {_5XX} AS total_5xx,
  round({_4XX} / count(*), 6) AS rate_4xx, round({_5XX} / count(*), 6) AS rate_5xx"""
_PXX = ", ".join(f"quantile_disc(latency_ms, {q}) AS {n}" for q, n in
                 (("0.50", "p50_latency_ms"), ("0.95", "p95_latency_ms"), ("0.99", "p99_latency_ms")))
_LATENCY_AGG = f"""{_TOTAL}, round(avg(latency_ms), 6) AS avg_latency_ms, max(latency_ms) AS max_latency_ms, {_PXX}"""
_SLA = f"""{_TOTAL}, {", ".join(
    f"round(count(*) FILTER (latency_ms < {limit}) / count(*), 6) AS {name}" for name, limit in
    (("sla_lt_500ms_rate", 500), ("sla_lt_1s_rate", 1000), ("sla_lt_2s_rate", 2000)))},
  quantile_disc(latency_ms, 0.95) AS p95_latency_ms"""


def _roll(key: str, hours: int) -> str:
    return (
        f"OVER (PARTITION BY {key} ORDER BY event_timestamp "
        f"RANGE BETWEEN INTERVAL {hours} HOUR PRECEDING AND CURRENT ROW)"
    )


_FLAG = "CASE WHEN status_code >= 500 THEN 1 ELSE 0 END"
_ROLLING = f"""
WITH rolled AS (
  SELECT event_timestamp, api_path,
    sum({_FLAG}) {_roll('api_path', 1)} AS x1, count(*) {_roll('api_path', 1)} AS n1,
    sum({_FLAG}) {_roll('api_path', 24)} AS x24, count(*) {_roll('api_path', 24)} AS n24
  FROM requests
)"""

_SPACE = "\\t\\n\\x0B\\f\\r \\x1c\\x1d\\x1e\\x1f\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')"


def _squash(text: str) -> str:
    return f"regexp_replace(lower({_strip(text)}), '[{_SPACE}]+', ' ', 'g')"


_RAW_TRACE = "CASE WHEN k <> 99 THEN trace ELSE 'default-trace' END"


def _normalize_flat(stand_ins: bool, nested: bool = True) -> str:
    """`nested` says whether the records have the nested request, which CSV lacks."""
    http = "k % 2 = 1" if nested else "false"

    def known(value: str, stand_in: str) -> str:
        return f"coalesce({value}, {stand_in})" if stand_ins else value

    status = f"""CASE WHEN k % 6 = 3 THEN 404 WHEN k % 6 > 3 THEN 200 WHEN {http} AND k % 8 = 1 THEN 503 END"""
    latency = """CASE WHEN k % 4 IN (2, 3) THEN CAST(round(value * 10) AS BIGINT) END"""
    # a zero latency falls through to the nested 250.7, and that to a stand-in; 0.9 is cut to 0 but is not zero
    latency = f"""CASE WHEN k % 4 = 2 THEN CAST(round(value * 10) AS BIGINT)
      WHEN k % 4 = 3 AND round(value * 10) <> 0 THEN CAST(round(value * 10) AS BIGINT)
      WHEN {http} AND k % 8 < 4 THEN 250 END"""
    address = f"CASE WHEN k % 3 = 2 THEN '192.168.0.' || k WHEN {http} AND k % 8 = 5 THEN '1.2.3.4' END"
    return f"""
WITH {_EVENTS},
t AS (SELECT *, {_RAW_TRACE} AS raw_trace, md5({_RAW_TRACE}) AS d FROM hashed),
g AS (
  SELECT * EXCLUDE (h),
    CAST('0x' || substr(d, 1, 8) AS UHUGEINT) * 79228162514264337593543950336
    + CAST('0x' || substr(d, 9, 8) AS UHUGEINT) * 18446744073709551616
    + CAST('0x' || substr(d, 17, 8) AS UHUGEINT) * 4294967296 + CAST('0x' || substr(d, 25, 8) AS UHUGEINT) AS h
  FROM t
)
SELECT CASE WHEN k % 5 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' WHEN k % 5 = 2 THEN ts - INTERVAL 2 HOUR ELSE ts END
    AS event_timestamp,
  CASE WHEN k % 7 <> 0 THEN 'res_' || event_type ELSE 'unknown' END AS env,
  CASE WHEN k % 3 <> 0 THEN 'service-' || (k % 4) ELSE 'unknown' END AS service,
  CASE WHEN k % 2 = 0 THEN 'v' || (k % 3) ELSE 'v1' END AS version,
  'unknown' AS api_name, 'unknown' AS api_method,
  CASE WHEN k % 11 <> 0 THEN '/v1/' || event_type ELSE '/unknown' END AS api_path,
  CASE WHEN k % 2 = 0 THEN 'POST' ELSE 'GET' END AS request_method,
  '/unknown' AS request_url,
  CAST({known(status, _STATUS.format(h='h'))} AS INTEGER) AS status_code,
  CAST({known(latency, _LATENCY.format(h='h'))} AS BIGINT) AS latency_ms,
  {known(address, _FLAT_IP.format(h='h'))} AS remote_ip,
  'unknown' AS user_agent,
  CASE WHEN user_id % 5 <> 0 THEN 'user-' || user_id ELSE 'anonymous' END AS user_uid,
  raw_trace AS trace,
  CAST(CASE WHEN k % 9 <> 0 THEN k * 10 ELSE 0 END AS BIGINT) AS payload_size
FROM g"""


_TEXT = "k % 4 = 2"
_JSON = "k % 3 <> 0"
_HTTP = "k % 6 <> 0"
_NORMALIZE_ENTRIES = f"""
WITH {_EVENTS}
SELECT ts AS event_timestamp,
  CASE WHEN k % 10 <> 0 THEN 'res_' || event_type ELSE 'unknown' END AS env,
  CASE WHEN k % 7 = 0 THEN 'pod-service' WHEN {_JSON} AND k % 2 = 0 THEN 'json-' || event_type
    WHEN {_TEXT} THEN 'text-' || event_type ELSE 'unknown-service' END AS service,
  CASE WHEN k % 7 = 0 THEN 'v7' WHEN {_TEXT} THEN 'v9' ELSE 'v1' END AS version,
  CASE WHEN {_JSON} AND k % 5 <> 0 THEN '/json/' || event_type WHEN {_TEXT} THEN '/text'
    WHEN {_HTTP} THEN '/http/' || event_type ELSE '/unknown' END AS api_path,
  CASE WHEN {_TEXT} THEN 'PUT' WHEN {_HTTP} AND k % 2 = 0 THEN 'DELETE' ELSE 'GET' END AS request_method,
  CAST(CASE WHEN {_HTTP} AND k % 5 = 1 THEN 502 WHEN {_JSON} AND k % 4 = 0 THEN 201 WHEN {_TEXT} THEN 418
    ELSE {_ENTRY_STATUS.format(h='h')} END AS INTEGER) AS status_code,
  round(CASE WHEN {_HTTP} AND k % 5 = 1 THEN k / 1000.0 * 1000 WHEN {_JSON} AND k % 4 = 0 THEN k WHEN {_TEXT} THEN k
    ELSE {_LATENCY.format(h='h')} END, 6)::DOUBLE AS latency_ms,
  CASE WHEN {_HTTP} AND k % 5 = 3 THEN '8.8.8.8' WHEN {_TEXT} THEN '9.9.9.9' ELSE {_ENTRY_IP.format(h='h')} END
    AS remote_ip,
  CASE WHEN {_JSON} AND k % 2 = 0 THEN 'user-' || user_id WHEN {_TEXT} THEN 'text-user' ELSE 'anonymous' END
    AS user_uid,
  trace
FROM hashed"""

_MONITORING = f"""
WITH raw AS (
  SELECT 'event-' || event_id AS record_id,
    CASE WHEN k <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "timestamp",
    CASE WHEN k <> 1 THEN '/v1/ ' || lower(event_type) END AS endpoint,
    CASE WHEN k % 20 = 0 THEN 'abc' WHEN k % 20 = 1 THEN '99' WHEN k % 20 = 2 THEN '600' WHEN k % 20 = 3 THEN NULL
      ELSE '200' END AS status_code,
    CASE WHEN k <> 4 THEN value - 5 END AS latency,
    CAST(k AS BIGINT) AS total_requests, user_id % 101 AS success_requests, k / 80.0::DOUBLE AS success_rate
  FROM e
),
tagged AS (
  SELECT *, try_cast(status_code AS DOUBLE) AS code,
    CASE WHEN total_requests > 0 THEN success_requests / total_requests END AS computed,
    (CASE WHEN "timestamp" IS NULL THEN 1 ELSE 0 END) + (CASE WHEN endpoint IS NULL THEN 1 ELSE 0 END)
      + (CASE WHEN status_code IS NULL THEN 1 ELSE 0 END) + (CASE WHEN latency IS NULL THEN 1 ELSE 0 END) AS n_null,
    (CASE WHEN total_requests = success_requests THEN 1 ELSE 0 END)
      + (CASE WHEN latency = total_requests OR latency = success_requests THEN 1 ELSE 0 END)
      + (CASE WHEN success_rate = total_requests OR success_rate = success_requests OR success_rate = latency
         THEN 1 ELSE 0 END) AS n_same
  FROM raw
),
ruled AS (
  SELECT *, [r FOR r IN [
    CASE WHEN "timestamp" IS NULL THEN 'schema' END,
    CASE WHEN endpoint IS NULL THEN 'schema' END,
    CASE WHEN status_code IS NULL THEN 'schema' END,
    CASE WHEN status_code IS NOT NULL AND code IS NULL THEN 'type_status_code' END,
    CASE WHEN abs(computed - success_rate) > 0.05 THEN 'cross_success_rate' END,
    CASE WHEN code < 100 OR code > 599 THEN 'business_status_code' END,
    CASE WHEN latency < 0 THEN 'business_latency' END,
    CASE WHEN latency < 0 THEN 'metric_latency' END,
    CASE WHEN success_rate < 0 OR success_rate > 1 THEN 'metric_success_rate' END,
    CASE WHEN success_requests > total_requests THEN 'metric_counts' END,
    CASE WHEN abs(computed - success_rate) > 0.05 THEN 'metric_consistency' END,
    CASE WHEN n_null > 1 OR n_same > 0 THEN 'duplicates' END
  ] IF r IS NOT NULL] AS rules
  FROM tagged
)"""
_LEVEL = "CASE WHEN rule IN ('cross_success_rate', 'metric_consistency', 'duplicates') THEN 'warning' ELSE 'error' END"

_LINE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


def _per_line_column(select: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {select.format(c=f'CAST({c} AS DOUBLE)')} FROM lineitem" for c in _LINE_COLUMNS
    )


_GAPPED = """
WITH v AS (
  SELECT value, CASE WHEN k <> 50 THEN value END AS with_null,
    CASE WHEN k = 51 THEN NULL ELSE value END AS nan_as_null, CASE WHEN k = 52 THEN NULL ELSE value END AS inf_as_null,
    k = 50 OR k = 51 OR k = 52 AS invalid,
    CASE WHEN k = 51 THEN NULL WHEN k = 52 THEN 1e300 ELSE value END AS high
  FROM e
)"""

_SAMPLES = """
WITH s AS (
  SELECT api_path AS endpoint, status_code, latency_ms / 10 AS latency, CAST(payload_size AS DOUBLE) AS payload_size,
    CAST(status_code >= 400 AS INTEGER) AS is_error, event_timestamp < TIMESTAMP '2024-01-16 00:00:00' AS is_ref
  FROM requests
)"""


def _ks(column: str) -> str:
    return f"SELECT '{column}' AS metric, n_ref, n_cur, round(d, 6) AS ks_statistic FROM ({_ks_raw(column)})"


def _ks_raw(column: str) -> str:
    return f"""
SELECT CAST(max(n_ref) AS BIGINT) AS n_ref, CAST(max(n_cur) AS BIGINT) AS n_cur,
  max(abs(c_ref / n_ref - c_cur / n_cur)) AS d
FROM (
  SELECT sum(r) OVER (ORDER BY v) AS c_ref, sum(c) OVER (ORDER BY v) AS c_cur, sum(r) OVER () AS n_ref,
    sum(c) OVER () AS n_cur
  FROM (SELECT {column} AS v, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c FROM s GROUP BY v)
)"""


def _chi2(column: str, digits: int = 6) -> str:
    return f"""
SELECT '{column}' AS column_name, CAST(max(n_ref) AS BIGINT) AS n_ref, CAST(max(n_cur) AS BIGINT) AS n_cur,
  max(cats) AS n_categories, max(cats) - 1 AS degrees,
  round(sum(pow(r - n_ref * (r + c) / (n_ref + n_cur), 2) / (n_ref * (r + c) / (n_ref + n_cur))
    + pow(c - n_cur * (r + c) / (n_ref + n_cur), 2) / (n_cur * (r + c) / (n_ref + n_cur))), {digits}) AS chi2
FROM (
  SELECT r, c, sum(r) OVER () AS n_ref, sum(c) OVER () AS n_cur, count(*) OVER () AS cats
  FROM (SELECT {column} AS v, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c FROM s GROUP BY v)
)"""


_LINE_SAMPLES = """
WITH s AS (
  SELECT l_returnflag AS endpoint, l_linenumber * 100 AS status_code, l_quantity AS latency,
    l_extendedprice AS payload_size, CAST(l_linenumber * 100 >= 400 AS INTEGER) AS is_error, l_orderkey % 2 = 1 AS is_ref
  FROM lineitem
)"""


def _drift_tests(samples: str) -> str:
    """Every test's p-value from its lower tail: Kolmogorov's law by powers of 1 / sqrt(n), the series of the gamma law."""
    numeric = {"latency_mean": "latency", "latency_std": "latency", "is_error": "is_error", "payload_size": "payload_size"}
    distances = [f"SELECT '{m}' AS metric, n_ref, n_cur, d FROM ({_ks_raw(c)})" for m, c in numeric.items()]
    distances.append(
        "SELECT 'request_count', count(*) FILTER (is_ref), count(*) FILTER (NOT is_ref), "
        "CASE WHEN count(*) FILTER (is_ref) = count(*) FILTER (NOT is_ref) THEN 0.0 ELSE 1.0 END FROM s"
    )
    return f"""{samples},
sized AS (SELECT *, round(n_ref * (n_cur / (n_ref + n_cur))) AS n FROM ({" UNION ALL ".join(distances)})),
placed AS (SELECT *, d * sqrt(n) AS x, [pow((k + 0.5) * pi(), 2) FOR k IN range(-40, 40)] AS o,
  [pow(k * pi(), 2) FOR k IN range(-40, 41)] AS v FROM sized),
ks AS (SELECT *, CASE WHEN x * x > 18 OR 2 * n * d <= 1 THEN 0.0 ELSE sqrt(pi() / 2) * (
    list_sum([exp(-u / (2*x*x)) FOR u IN o]) / x
    + list_sum([(u - x*x) * exp(-u / (2*x*x)) FOR u IN o]) / (6 * pow(x, 4) * sqrt(n))
    + list_sum([(6*pow(x,6) + 2*pow(x,4) + (2*pow(x,4) - 5*x*x) * u + (1 - 2*x*x) * u*u) * exp(-u / (2*x*x)) FOR u IN o]) / (72 * pow(x, 7) * n)
    - list_sum([u * exp(-u / (2*x*x)) FOR u IN v]) / (36 * pow(x, 3) * n)
    + list_sum([((5 - 30*x*x) * pow(u,3) + (212*pow(x,4) - 60*x*x) * u*u + (135*pow(x,4) - 96*pow(x,6)) * u - 30*pow(x,6) - 90*pow(x,8))
        * exp(-u / (2*x*x)) FOR u IN o]) / (6480 * pow(x, 10) * pow(n, 1.5))
    + list_sum([(3*x*x*u - u*u) * exp(-u / (2*x*x)) FOR u IN v]) / (216 * pow(x, 6) * pow(n, 1.5))) END AS below FROM placed),
chi2 AS (SELECT *, CAST(degrees AS DOUBLE) / 2 AS a FROM ({_chi2("endpoint", 15)} UNION ALL {_chi2("status_code", 15)})),
tests AS (
  SELECT 'drift_numeric' AS rule, metric, CAST(d AS DOUBLE) AS statistic, CASE WHEN 2 * n * d <= 1 THEN 1.0
    WHEN x * x > 18 THEN 0.0 ELSE greatest(0.0, 1 - below) END AS p
  FROM ks
  UNION ALL
  SELECT 'drift_categorical', column_name, chi2, CASE WHEN chi2 <= 0 THEN 1.0 ELSE greatest(0.0,
    1 - list_sum([exp((a + n) * ln(chi2 / 2) - chi2 / 2 - lgamma(a + n + 1)) FOR n IN range(0, 2001)])) END
  FROM chi2
)"""


def _drift_report(samples: str) -> str:
    return f"""{_drift_tests(samples)}
SELECT rule, metric, round(statistic, 6) AS statistic, CASE WHEN rule = 'drift_numeric' THEN round(p, 5) ELSE round(p, 6) END AS p_value, p < CAST(0.05 AS DOUBLE) AS drifted,
  CASE WHEN p < CAST(0.05 AS DOUBLE) THEN 'Drift detected in metric ' || metric END AS message
FROM tests"""


def _drift_summary(samples: str) -> str:
    return f"""{_drift_tests(samples)}, c AS (
  SELECT count(*) FILTER (p < CAST(0.05 AS DOUBLE)) AS warnings, count(*) AS n FROM tests
)
SELECT true AS is_drift_ok, CAST(0 AS BIGINT) AS errors, warnings, round(1 - warnings / n, 6) AS drift_score,
  CASE WHEN warnings / n >= 0.5 THEN 'high' WHEN warnings / n >= 0.2 THEN 'medium' ELSE 'low' END AS severity
FROM c"""


def _pivot(codes: tuple[int, ...]) -> str:
    counts = ", ".join(f"count(*) FILTER (status_code = {c}) AS status_{c}" for c in codes)
    return f"""SELECT api_path, {counts}, count(*) FILTER (status_code NOT IN {codes}) AS status_other
        FROM requests GROUP BY api_path"""


_VALUE_STATS = "(SELECT avg(value) AS m, stddev_pop(value) AS sd FROM e)"
_VALUE_IQR = "(SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM e)"
_CODES = (200, 201, 204, 401, 403, 404, 422, 429, 500, 503)


def _bounds(column: str) -> str:
    low, high = f"quantile_cont({column}, 0.25)", f"quantile_cont({column}, 0.75)"
    return f"{low} - 1.5 * ({high} - {low}) AS lo_{column}, {high} + 1.5 * ({high} - {low}) AS hi_{column}"


def _z_outlier(column: str) -> str:
    return f"coalesce(abs(({column} - m_{column}) / sd_{column}) > 3, false)"


def _iqr_outlier(column: str) -> str:
    return f"coalesce({column} < lo_{column} OR {column} > hi_{column}, false)"


_REPORT_COLUMNS = ("value", "with_null", "nan_as_null")
_MOMENTS = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS sd_{c}" for c in _REPORT_COLUMNS)
_QUALITY_REPORT = f"""{_GAPPED},
z AS (SELECT *, {", ".join(f"{_z_outlier(c)} AS o_{c}" for c in _REPORT_COLUMNS)}
  FROM v, (SELECT {_MOMENTS} FROM v) AS m),
q AS (SELECT *, {", ".join(f"{_iqr_outlier(c)} AS o_{c}" for c in (*_REPORT_COLUMNS, "high"))}
  FROM v, (SELECT {", ".join(_bounds(c) for c in (*_REPORT_COLUMNS, "high"))} FROM v) AS b)
SELECT 'zscore' AS method, false AS is_valid, CAST(3 AS BIGINT) AS errors,
  CAST({" + ".join(f"CAST(bool_or(o_{c}) AS INTEGER)" for c in _REPORT_COLUMNS)} AS BIGINT) AS warnings,
  round(1 - avg(CAST(invalid OR {" OR ".join(f"o_{c}" for c in _REPORT_COLUMNS)} AS INTEGER)), 6) AS score
FROM z
UNION ALL
SELECT 'iqr', false, CAST(3 AS BIGINT),
  CAST({" + ".join(f"CAST(bool_or(o_{c}) AS INTEGER)" for c in (*_REPORT_COLUMNS, "high"))} AS BIGINT),
  round(1 - avg(CAST(invalid OR {" OR ".join(f"o_{c}" for c in (*_REPORT_COLUMNS, "high"))} AS INTEGER)), 6)
FROM q"""

_TOP_ERRORS = f"""WITH daily AS (
          SELECT day, api_path, {_TOTAL}, {_5XX} AS total_5xx, {_5XX} / count(*) AS r
          FROM requests GROUP BY day, api_path
        ),
        ranked AS (
          SELECT *, rank() OVER (PARTITION BY day ORDER BY total_5xx DESC) AS rank_by_5xx,
            row_number() OVER (PARTITION BY day ORDER BY r DESC, api_path) AS rownum_by_rate
          FROM daily
        )
        SELECT day, api_path, total_requests, total_5xx, round(r, 6) AS rate_5xx, rank_by_5xx, rownum_by_rate
        FROM ranked WHERE rank_by_5xx <= 20 OR rownum_by_rate <= 20"""

_TOP_PER_CODE = f"""WITH daily AS (
          SELECT day, status_code, api_path, {_TOTAL} FROM requests WHERE status_code >= 400
          GROUP BY day, status_code, api_path
        ),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY day, status_code ORDER BY total_requests DESC, api_path)
              AS rownum_by_volume,
            rank() OVER (PARTITION BY day, status_code ORDER BY total_requests DESC) AS rank_by_volume
          FROM daily
        )
        SELECT * FROM ranked WHERE rownum_by_volume <= 20"""

ORACLE: dict[str, str] = {
    "normalize_flat": _normalize_flat(True),
    "normalize_flat_without_stand_ins": _normalize_flat(False),
    "normalize_log_entries": _NORMALIZE_ENTRIES,
    "synth_status": _events(
        f"SELECT event_id, {_STATUS.format(h='h')} AS flat_status, {_ENTRY_STATUS.format(h='h')} AS entry_status FROM hashed"
    ),
    "synth_latency": _events(f"SELECT event_id, {_LATENCY.format(h='h')} AS latency_ms FROM hashed"),
    "synth_ip": _events(
        f"SELECT event_id, {_FLAT_IP.format(h='h')} AS flat_ip, {_ENTRY_IP.format(h='h')} AS entry_ip FROM hashed"
    ),
    "latency_text_ms": _events(
        """SELECT event_id, round(CASE k % 4 WHEN 0 THEN CAST(k AS DOUBLE) WHEN 1 THEN k * 1000.0
        WHEN 2 THEN k * 1000.0 + 500 END, 6)::DOUBLE AS latency_ms FROM e"""
    ),
    "parse_dates": """
WITH w AS (
  SELECT o_orderkey, o_orderdate, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y')
    ELSE strftime(o_orderdate, '%Y-%-m-%-d') END AS original
  FROM orders
)
SELECT o_orderkey, original, coalesce(try_strptime(original, '%Y-%m-%d'), try_strptime(original, '%Y-%m-%d %H:%M:%S'))
  AS parsed
FROM w""",
    "normalize_text": f"SELECT doc_id, {_squash('text')} AS text FROM documents",
    "normalize_list": f"""
WITH i AS (SELECT doc_id, [lower({_strip('x')}) FOR x IN string_split(text, chr(10))] AS items FROM documents)
SELECT doc_id, CAST(len(items) AS INTEGER) AS n_items, array_to_string(items, '|') AS items FROM i""",
    "aggregate_metrics": _sql(
        f"""SELECT day, api_path, {_TOTAL}, round(avg(latency_ms), 6) AS avg_latency_ms,
        max(latency_ms) AS max_latency_ms, quantile_disc(latency_ms, 0.95) AS p95_latency_ms, {_4XX} AS total_4xx,
        round({_5XX} / count(*), 6) AS rate_5xx,
        round(count(*) FILTER (latency_ms < 1000) / count(*), 6) AS sla_lt_1s_rate
        FROM requests
        WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'
        GROUP BY day, api_path"""
    ),
    "status_pivot": _sql(_pivot(_CODES)),
    "status_pivot_few_codes": _sql(_pivot((200, 404))),
    "executive_overview": _sql(
        f"SELECT {_TOTAL}, round({_5XX} / count(*), 6) AS error_rate_5xx FROM requests"
    ),
    "status_family_share": _sql(
        f"""SELECT (status_code // 100) || 'xx' AS status_family, {_TOTAL},
        round(count(*) / sum(count(*)) OVER (), 6) AS pct FROM requests GROUP BY status_family"""
    ),
    "metric_points": _sql(
        """WITH hourly AS (
          SELECT hour_ts, api_path, avg(latency_ms) AS avg_latency_ms,
            CAST(quantile_disc(latency_ms, 0.95) AS DOUBLE) AS p95_latency_ms, CAST(count(*) AS DOUBLE) AS total_requests
          FROM requests GROUP BY hour_ts, api_path
        ),
        points AS (
          SELECT 'avg_latency_ms' AS name, avg_latency_ms AS value, api_path, hour_ts FROM hourly
          UNION ALL SELECT 'p95_latency_ms', p95_latency_ms, api_path, hour_ts FROM hourly
          UNION ALL SELECT 'total_requests', total_requests, api_path, hour_ts FROM hourly
        )
        SELECT name, round(value, 6) AS value, CAST(NULL AS VARCHAR) AS unit, api_path AS tag_api_path,
          hour_ts AS "timestamp" FROM points"""
    ),
    "latency_kpis": _sql(f"SELECT api_path, {_LATENCY_AGG} FROM requests GROUP BY api_path"),
    "latency_hourly": _sql(f"SELECT hour_ts, api_path, {_LATENCY_AGG} FROM requests GROUP BY hour_ts, api_path"),
    "latency_rank_daily": _sql(
        f"""WITH daily AS (
          SELECT day, api_path, {_TOTAL}, avg(latency_ms) AS a, quantile_disc(latency_ms, 0.95) AS p95_latency_ms
          FROM requests GROUP BY day, api_path
        )
        SELECT day, api_path, total_requests, round(a, 6) AS avg_latency_ms, p95_latency_ms,
          round(avg(a) OVER (PARTITION BY day), 6) AS day_avg_latency_ms,
          CAST(sum(total_requests) OVER (PARTITION BY day) AS BIGINT) AS day_total_requests,
          rank() OVER (PARTITION BY day ORDER BY p95_latency_ms DESC) AS rank_p95_slowest,
          dense_rank() OVER (PARTITION BY day ORDER BY a DESC) AS dense_rank_avg_slowest
        FROM daily"""
    ),
    "error_kpis": _sql(f"SELECT api_path, {_ERRORS} FROM requests GROUP BY api_path"),
    "errors_hourly": _sql(f"SELECT hour_ts, api_path, {_ERRORS} FROM requests GROUP BY hour_ts, api_path"),
    "errors_rolling": _sql(
        f"""{_ROLLING}, rates AS (SELECT *, x1 / n1 AS r1, x24 / n24 AS r24 FROM rolled)
        SELECT event_timestamp, api_path, CAST(x1 AS BIGINT) AS rolling_5xx_1h, n1 AS rolling_total_1h,
          round(r1, 6) AS rolling_rate_5xx_1h,
          round(lag(r1) OVER (PARTITION BY api_path ORDER BY event_timestamp), 6) AS prev_rate_5xx_1h,
          round(lead(r1) OVER (PARTITION BY api_path ORDER BY event_timestamp), 6) AS next_rate_5xx_1h,
          CAST(x24 AS BIGINT) AS rolling_5xx_24h, n24 AS rolling_total_24h, round(r24, 6) AS rolling_rate_5xx_24h
        FROM rates"""
    ),
    "top_error_endpoints_daily": _sql(_TOP_ERRORS, fine=True),
    "sla_kpis": _sql(
        f"""SELECT api_path, {_SLA}, quantile_disc(latency_ms, 0.99) AS p99_latency_ms FROM requests GROUP BY api_path"""
    ),
    "sla_hourly": _sql(f"SELECT hour_ts, api_path, {_SLA} FROM requests GROUP BY hour_ts, api_path"),
    "sla_daily": _sql(f"SELECT day, api_path, {_SLA} FROM requests GROUP BY day, api_path"),
    "sla_rolling_drift": _sql(
        f"""WITH rates AS (
          SELECT event_timestamp, api_path, sum(CASE WHEN latency_ms < 500 THEN 1 ELSE 0 END) {_roll('api_path', 1)}
            / count(*) {_roll('api_path', 1)} AS r
          FROM requests
        ),
        trend AS (SELECT *, lag(r) OVER (PARTITION BY api_path ORDER BY event_timestamp) AS p FROM rates)
        SELECT event_timestamp, api_path, round(r, 6) AS rolling_sla_rate_500ms_1h,
          round(p, 6) AS prev_rolling_sla_rate_500ms_1h, round(r - p, 6) AS sla_rate_delta
        FROM trend WHERE p IS NOT NULL"""
    ),
    "status_code_kpis": _sql(
        f"""SELECT api_path, status_code, {_TOTAL},
        round(count(*) / sum(count(*)) OVER (PARTITION BY api_path), 6) AS pct_within_endpoint
        FROM requests GROUP BY api_path, status_code"""
    ),
    "status_codes_daily": _sql(
        f"SELECT day, api_path, status_code, {_TOTAL} FROM requests GROUP BY day, api_path, status_code"
    ),
    "status_codes_hourly": _sql(
        f"SELECT hour_ts, api_path, status_code, {_TOTAL} FROM requests GROUP BY hour_ts, api_path, status_code"
    ),
    "status_families_daily": _sql(
        f"""SELECT day, api_path, (status_code // 100) || 'xx' AS status_family, {_TOTAL},
        round(count(*) / sum(count(*)) OVER (PARTITION BY day, api_path), 6) AS pct_within_day_endpoint
        FROM requests GROUP BY day, api_path, status_family"""
    ),
    "top_endpoints_per_error_code": _sql(_TOP_PER_CODE, fine=True),
    "user_kpis": _sql(
        f"""SELECT user_uid, count(*) FILTER (status_code = 401) AS total_401,
        count(*) FILTER (status_code = 403) AS total_403, {_ERRORS}, round(avg(latency_ms), 6) AS avg_latency_ms
        FROM requests GROUP BY user_uid"""
    ),
    "user_activity_daily": _sql(
        f"""WITH daily AS (
          SELECT day, user_uid, {_TOTAL}, avg(latency_ms) AS a FROM requests GROUP BY day, user_uid
        )
        SELECT day, user_uid, total_requests, round(a, 6) AS avg_latency_ms,
          round(avg(total_requests) OVER (PARTITION BY day), 6) AS day_avg_requests_per_user,
          rank() OVER (PARTITION BY day ORDER BY total_requests DESC) AS rank_by_volume,
          dense_rank() OVER (PARTITION BY day ORDER BY a DESC) AS dense_rank_by_latency
        FROM daily"""
    ),
    "user_auth_errors_daily": _sql(
        f"""SELECT day, user_uid, count(*) FILTER (status_code = 401) AS total_401,
        count(*) FILTER (status_code = 403) AS total_403, {_TOTAL},
        round(count(*) FILTER (status_code IN (401, 403)) / count(*), 6) AS auth_error_rate
        FROM requests GROUP BY day, user_uid"""
    ),
    "user_rolling_activity": _sql(
        f"""WITH rolled AS (
          SELECT event_timestamp, user_uid, count(*) {_roll('user_uid', 1)} AS n, sum({_FLAG}) {_roll('user_uid', 1)} AS x
          FROM requests
        )
        SELECT event_timestamp, user_uid, n AS rolling_requests_1h,
          lag(n) OVER (PARTITION BY user_uid ORDER BY event_timestamp) AS prev_rolling_requests_1h,
          lead(n) OVER (PARTITION BY user_uid ORDER BY event_timestamp) AS next_rolling_requests_1h,
          CAST(x AS BIGINT) AS rolling_5xx_1h, round(x / n, 6) AS rolling_rate_5xx_1h
        FROM rolled"""
    ),
    "anomaly_latency_zscore": _sql(
        """WITH stats AS (
          SELECT event_timestamp, api_path, latency_ms, avg(latency_ms) OVER (PARTITION BY api_path) AS a,
            stddev_samp(latency_ms) OVER (PARTITION BY api_path) AS s
          FROM requests
        )
        SELECT event_timestamp, api_path, latency_ms, round(a, 6) AS avg_latency_ms, round(s, 6) AS std_latency_ms,
          round((latency_ms - a) / nullif(s, 0), 6) AS z_score
        FROM stats WHERE abs((latency_ms - a) / nullif(s, 0)) >= 3"""
    ),
    "anomaly_error_spikes": _sql(
        f"""{_ROLLING}
        SELECT event_timestamp, api_path, round(x1 / n1, 6) AS rate_5xx_1h, round(x24 / n24, 6) AS rate_5xx_24h,
          round(x1 / n1 - x24 / n24, 6) AS rate_diff
        FROM rolled WHERE x1 / n1 >= CAST(0.10 AS DOUBLE) AND x1 / n1 - x24 / n24 >= CAST(0.05 AS DOUBLE)"""
    ),
    "endpoint_degradation_daily": _sql(
        f"""WITH daily AS (
          SELECT day, api_path, quantile_disc(latency_ms, 0.95) AS p95_latency_ms, {_TOTAL}
          FROM requests GROUP BY day, api_path
        ),
        trend AS (
          SELECT *, lag(p95_latency_ms) OVER (PARTITION BY api_path ORDER BY day) AS prev_p95_latency_ms FROM daily
        ),
        scored AS (SELECT *, (p95_latency_ms - prev_p95_latency_ms) / nullif(prev_p95_latency_ms, 0) AS r FROM trend)
        SELECT day, api_path, total_requests, p95_latency_ms, prev_p95_latency_ms, round(r, 6) AS p95_change_ratio
        FROM scored WHERE prev_p95_latency_ms IS NOT NULL AND r >= CAST(0.20 AS DOUBLE) AND total_requests >= 50"""
    ),
    "local_latency_daily": _sql(
        f"""SELECT strftime(event_timestamp, '%Y-%m-%d') AS day, api_path, {_TOTAL},
        round(avg(latency_ms), 6) AS avg_latency_ms, max(latency_ms) AS max_latency_ms
        FROM requests GROUP BY ALL"""
    ),
    "local_errors_hourly": _sql(
        f"""SELECT strftime(event_timestamp, '%Y-%m-%d %H:00:00') AS hour, api_path, {_TOTAL}, {_4XX} AS total_4xx,
        {_5XX} AS total_5xx, round({_5XX} / count(*), 6) AS error_rate_5xx FROM requests GROUP BY hour, api_path"""
    ),
    "local_status_codes": _sql(
        f"""SELECT strftime(event_timestamp, '%Y-%m-%d') AS day, api_path, status_code, {_TOTAL}
        FROM requests GROUP BY ALL"""
    ),
    "explore_status_codes": _sql(
        f"SELECT status_code, {_TOTAL}, round(count(*) / sum(count(*)) OVER (), 6) AS pct FROM requests GROUP BY status_code"
    ),
    "explore_status_families": _sql(
        f"""SELECT coalesce((status_code // 100)::VARCHAR, '<NA>') || 'xx' AS status_family, {_TOTAL},
        round(count(*) / sum(count(*)) OVER (), 6) AS pct FROM requests GROUP BY status_family"""
    ),
    "explore_latency_summary": _sql(
        """SELECT count(latency_ms) AS count, round(avg(latency_ms), 6) AS mean_ms,
        round(quantile_cont(latency_ms, 0.5), 6) AS p50_ms, round(quantile_cont(latency_ms, 0.95), 6) AS p95_ms,
        round(quantile_cont(latency_ms, 0.99), 6) AS p99_ms, CAST(min(latency_ms) AS DOUBLE) AS min_ms,
        CAST(max(latency_ms) AS DOUBLE) AS max_ms FROM requests"""
    ),
    "explore_top_endpoints": _sql(
        f"""SELECT api_path, {_TOTAL}, round(avg(latency_ms), 6) AS avg_latency_ms,
        round(quantile_cont(latency_ms, 0.5), 6) AS p50_latency_ms,
        round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms,
        round(quantile_cont(latency_ms, 0.99), 6) AS p99_latency_ms
        FROM requests GROUP BY api_path ORDER BY quantile_cont(latency_ms, 0.95) DESC, api_path LIMIT 20""",
        fine=True,
    ),
    "explore_hourly_volume": _sql(f"SELECT hour_ts, {_TOTAL} FROM requests GROUP BY hour_ts"),
    "explore_daily_volume": _sql(f"SELECT day, {_TOTAL} FROM requests GROUP BY day"),
    "rolling_avg_hourly": _sql(
        """WITH hourly AS (SELECT hour_ts, avg(latency_ms) AS a FROM requests GROUP BY hour_ts)
        SELECT hour_ts, round(a, 6) AS avg_latency_ms,
          round(avg(a) OVER (ORDER BY hour_ts ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS rolling_avg_latency_ms
        FROM hourly"""
    ),
    "latency_delta": _sql(
        """WITH l AS (
          SELECT event_timestamp, api_path, trace, latency_ms,
            lag(latency_ms) OVER (PARTITION BY api_path ORDER BY event_timestamp, trace) AS prev_latency_ms
          FROM requests
        )
        SELECT *, latency_ms - prev_latency_ms AS latency_delta_ms FROM l"""
    ),
    "slowest_requests_per_path": _sql(
        """WITH r AS (
          SELECT event_timestamp, api_path, trace, latency_ms,
            row_number() OVER (PARTITION BY api_path ORDER BY latency_ms DESC, trace) AS latency_rownum
          FROM requests
        )
        SELECT * FROM r WHERE latency_rownum <= 20"""
    ),
    "latency_row_numbers": _sql(
        """SELECT event_timestamp, api_path, trace, latency_ms,
        row_number() OVER (PARTITION BY api_path ORDER BY latency_ms DESC, event_timestamp, trace) AS latency_rownum
        FROM requests"""
    ),
    "rolling_error_rate_hourly": _sql(
        f"""WITH hourly AS (
          SELECT hour_ts, api_path, {_TOTAL}, {_5XX} AS total_5xx FROM requests GROUP BY hour_ts, api_path
        )
        SELECT *, round(sum(total_5xx) OVER w / sum(total_requests) OVER w, 6) AS rolling_rate_5xx FROM hourly
        WINDOW w AS (PARTITION BY api_path ORDER BY hour_ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)"""
    ),
    "latency_vs_path_mean": _sql(
        """SELECT event_timestamp, api_path, trace, latency_ms,
        round(avg(latency_ms) OVER (PARTITION BY api_path), 6) AS path_avg_latency_ms FROM requests"""
    ),
    "running_mean": _sql(
        """SELECT event_timestamp, api_path, trace, count(*) OVER w AS running_count,
        round(avg(latency_ms) OVER w, 6) AS running_mean FROM requests
        WINDOW w AS (PARTITION BY api_path ORDER BY event_timestamp, trace ROWS UNBOUNDED PRECEDING)"""
    ),
    "column_stats": _per_line_column(
        "count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std"
    ),
    "iqr_bounds": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS lower,
        round(q3 + 1.5 * (q3 - q1), 6) AS upper FROM (
          SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3
          FROM lineitem)"""
        for c in _LINE_COLUMNS
    ),
    "extremes": _per_line_column("round(min({c}), 6) AS min_value, round(max({c}), 6) AS max_value"),
    "winsorize": """SELECT l_orderkey, l_linenumber, round(least(greatest(l_extendedprice, 5000.0::DOUBLE), 60000.0::DOUBLE), 6)
        AS l_extendedprice FROM lineitem""",
    "quality_zscore": _events(
        f"SELECT event_id, round(value, 6) AS value FROM e, {_VALUE_STATS} WHERE abs((value - m) / sd) > 3"
    ),
    "quality_iqr": _events(
        f"""SELECT event_id, round(value, 6) AS value FROM e, {_VALUE_IQR}
        WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)"""
    ),
    "quality_invalid": _events(
        """SELECT 'value' AS column_name, CAST(0 AS BIGINT) AS invalid_count
        UNION ALL SELECT 'with_null', count(*) FILTER (k = 50) FROM e
        UNION ALL SELECT 'with_nan', count(*) FILTER (k = 51) FROM e
        UNION ALL SELECT 'with_inf', count(*) FILTER (k = 52) FROM e
        UNION ALL SELECT 'constant', 0"""
    ),
    "quality_report": _events(_QUALITY_REPORT),
    "consistency_rows": _events(
        f"""{_MONITORING}
        SELECT record_id, endpoint, array_to_string(rules, ',') AS rules, round((8 - n_null) / 8, 6) AS quality_score
        FROM ruled"""
    ),
    "consistency_summary": _events(
        f"""{_MONITORING}, broken AS (SELECT unnest(rules) AS rule FROM ruled)
        SELECT rule, {_LEVEL} AS level, count(*) AS n_rows FROM broken GROUP BY rule"""
    ),
    "consistency_report": _events(
        f"""{_MONITORING}, broken AS (
          SELECT record_id, n_null, unnest(CASE WHEN len(rules) = 0 THEN [NULL] ELSE rules END) AS rule FROM ruled
        ),
        judged AS (SELECT record_id, n_null, rule, CASE WHEN rule IS NOT NULL THEN {_LEVEL} END AS level FROM broken),
        per_row AS (
          SELECT record_id, any_value(n_null) AS n_null, count(*) FILTER (level = 'error') AS e,
            count(*) FILTER (level = 'warning') AS w
          FROM judged GROUP BY record_id
        )
        SELECT sum(e) = 0 AS is_consistent, CAST(sum(e) AS BIGINT) AS errors, CAST(sum(w) AS BIGINT) AS warnings,
          count(*) AS n_rows, round(avg(CASE WHEN e > 0 THEN 1 ELSE 0 END), 6) AS error_ratio,
          round(avg((8 - n_null) / 8), 6) AS quality_score, CAST(NULL AS VARCHAR) AS file
        FROM per_row"""
    ),
    "consistency_duplicates": _events(
        f"""{_MONITORING}, listed AS (
          SELECT record_id, [
            's:' || record_id, coalesce('s:' || "timestamp", 'null'), coalesce('s:' || endpoint, 'null'),
            coalesce('s:' || status_code, 'null'),
            CASE WHEN latency IS NULL THEN 'null' WHEN latency = floor(latency) THEN CAST(CAST(latency AS BIGINT) AS VARCHAR)
              ELSE 'f:' || latency END,
            CAST(total_requests AS VARCHAR), CAST(success_requests AS VARCHAR),
            CASE WHEN success_rate = floor(success_rate) THEN CAST(CAST(success_rate AS BIGINT) AS VARCHAR)
              ELSE 'f:' || success_rate END
          ] AS vals
          FROM ruled
        ),
        repeats AS (SELECT record_id, [x FOR x, i IN vals IF list_position(vals, x) < i] AS found FROM listed)
        SELECT record_id, CAST(len(found) AS INTEGER) AS n_repeated,
          array_to_string([regexp_replace(x, '^[sf]:', '') FOR x IN found], ',') AS repeated
        FROM repeats"""
    ),
    "completeness_score": _events(
        f"{_MONITORING} SELECT record_id, round((8 - n_null) / 8, 6) AS quality_score FROM ruled"
    ),
    "safe_name_check": r"""SELECT page_id, regexp_matches(url, '^[a-zA-Z0-9._:/\-]+$') AS is_safe_name,
        regexp_matches(url, '^[a-zA-Z0-9._/\-]+$') AS is_safe_file, regexp_matches(url, '^https?://[^\s]+$') AS is_url
        FROM pages""",
    "row_count_check": """SELECT count(*) AS row_count, count(*) AS declared_rows,
        count(*) > 0 AS is_non_empty, true AS is_count_ok FROM events""",
    "drift_ks_stat": _sql(f"{_SAMPLES} {_ks('latency')} UNION ALL {_ks('payload_size')}"),
    "drift_chi2_stat": _sql(f"{_SAMPLES} {_chi2('endpoint')} UNION ALL {_chi2('status_code')}"),
    "drift_report": _sql(_drift_report(_SAMPLES)),
    "drift_summary": _sql(_drift_summary(_SAMPLES)),
    "drift_report_lines": _drift_report(_LINE_SAMPLES),
    "drift_features": _sql(
        f"""{_SAMPLES}
        SELECT round(latency, 6) AS latency_mean, round(latency, 6) AS latency_std, status_code >= 400 AS is_error,
          payload_size, count(*) OVER () AS request_count
        FROM s"""
    ),
    "drift_severity": _sql(
        f"""{_SAMPLES}, c AS (
          SELECT status_code, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c FROM s GROUP BY status_code
        )
        SELECT status_code, round(abs((c - r) / r), 6) AS change,
          CASE WHEN abs((c - r) / r) >= 0.5 THEN 'high' WHEN abs((c - r) / r) >= 0.2 THEN 'medium' ELSE 'low' END
            AS severity
        FROM c"""
    ),
    "source_csv": _normalize_flat(True, nested=False),
    "run_pipeline": f"""
SELECT strftime(event_timestamp, '%Y-%m-%d') AS day, api_path, count(*) AS total_requests, round(avg(latency_ms), 6) AS avg_latency_ms,
  max(latency_ms) AS max_latency_ms
FROM ({_normalize_flat(True)}) GROUP BY ALL""",
    "append_twice": _sql(
        "SELECT day AS event_date, api_path, 2 * count(*) AS total_requests FROM requests GROUP BY day, api_path"
    ),
}

# Written to files or tables and read back, the rows are those of the plain query.
_SAME = {
    "source_json": "normalize_flat",
    "source_jsonl": "normalize_flat",
    "source_parquet": "normalize_flat",
    "source_log_entries": "normalize_log_entries",
    "replace_table": "status_code_kpis",
    "define_view": "status_code_kpis",
    "drift_report_file": "drift_report",
    "drift_between": "drift_report",
    "export_json": "status_code_kpis",
    "export_csv": "status_code_kpis",
    "export_parquet": "status_code_kpis",
}
ORACLE |= {name: ORACLE[plain] for name, plain in _SAME.items()}
# These two are registered over more paths than the stored tables have.
_STORED = ORACLE | {"top_error_endpoints_daily": _sql(_TOP_ERRORS), "top_endpoints_per_error_code": _sql(_TOP_PER_CODE)}
ORACLE |= {
    f"build_metrics_{target}": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, round(sum(CAST({measure} AS DOUBLE)), 3) AS total FROM ({_STORED[plain]})"
        for name, (plain, measure) in tables.items()
    )
    for target, tables in BUILT.items()
}

ORACLE = {name: re.sub(r"[ \t]+\n", "\n", sql).strip() for name, sql in ORACLE.items()}
