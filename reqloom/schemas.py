"""Column names, schemas and fixed values shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# Defaults of the normalised request columns.
DEFAULT_ENV = "unknown"
DEFAULT_SERVICE = "unknown"
DEFAULT_VERSION = "v1"
DEFAULT_API_NAME = "unknown"
DEFAULT_API_METHOD = "unknown"
DEFAULT_API_PATH = "/unknown"
DEFAULT_REQUEST_METHOD = "GET"
DEFAULT_REQUEST_URL = "/unknown"
DEFAULT_USER_AGENT = "unknown"
DEFAULT_USER_UID = "anonymous"
DEFAULT_TRACE = "default-trace"
DEFAULT_ENTRY_SERVICE = "unknown-service"

# Stand-in status code for hash % 10 = 0, 1, ..., 9.
FLAT_STATUS_CODES = (500, 503, 404, 401, 403, 422, 429, 200, 201, 204)
ENTRY_STATUS_CODES = (500, 503, 404, 401, 403, 422, 429, 200, 200, 200)

# Label names that carry the service and its version.
LABEL_SERVICE = "k8s-pod/app"
LABEL_VERSION = "k8s-pod/version"

# Accepted identifiers, file paths and links.
SAFE_NAME = r"^[a-zA-Z0-9._:/\-]+$"
SAFE_FILE = r"^[a-zA-Z0-9._/\-]+$"
URL = r"^https?://[^\s]+$"

# Thresholds of the alerts and reports.
SPIKE_MIN_RATE = 0.10
SPIKE_MIN_DIFF = 0.05
LATENCY_Z_LIMIT = 3
DEGRADATION_MIN_RATIO = 0.20
DEGRADATION_MIN_REQUESTS = 50
TOP_ENDPOINTS = 20
QUALITY_Z_LIMIT = 3.0
QUALITY_IQR_MULTIPLIER = 1.5
RATE_TOLERANCE = 0.05
MAX_ERROR_RATIO = 0.1
DRIFT_P_VALUE = 0.05
DRIFT_MEDIUM = 0.2
DRIFT_HIGH = 0.5

# Rule, level and message of every check.
ERROR = "error"
WARNING = "warning"
RULES = {
    "file_exists": (ERROR, "File does not exist"),
    "file_type": (ERROR, "Path is not a file"),
    "schema": (ERROR, "Missing field: {}"),
    "type_timestamp": (ERROR, "timestamp must be string or datetime"),
    "type_status_code": (ERROR, "status_code must be int"),
    "type_latency": (ERROR, "latency must be numeric"),
    "cross_success_rate": (WARNING, "Mismatch between computed and reported success_rate"),
    "business_status_code": (ERROR, "status_code must be between 100 and 599"),
    "business_latency": (ERROR, "latency must be >= 0"),
    "metric_latency": (ERROR, "Latency must be >= 0"),
    "metric_success_rate": (ERROR, "success_rate must be between 0 and 1"),
    "metric_counts": (ERROR, "success_requests > total_requests"),
    "metric_consistency": (WARNING, "success_rate inconsistent with counts"),
    "duplicates": (WARNING, "Duplicate values detected"),
    "invalid_values": (ERROR, "NaN or inf detected in {}"),
    "zscore_outliers": (WARNING, "Outliers detected in column {}"),
    "iqr_outliers": (WARNING, "IQR outliers detected in column {}"),
    "drift_numeric": (WARNING, "Drift detected in metric {}"),
    "drift_categorical": (WARNING, "Drift detected in metric {}"),
}

REQUESTS = T.StructType(
    [
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("env", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("api_name", T.StringType()),
        T.StructField("api_method", T.StringType()),
        T.StructField("api_path", T.StringType()),
        T.StructField("request_method", T.StringType()),
        T.StructField("request_url", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("latency_ms", T.LongType()),
        T.StructField("remote_ip", T.StringType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("user_uid", T.StringType()),
        T.StructField("trace", T.StringType()),
        T.StructField("payload_size", T.LongType()),
    ]
)

# Raw flat record. Codes and latencies are read as text: logs write them as numbers and as strings.
RAW_FLAT = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("resource_type", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("api_name", T.StringType()),
        T.StructField("api_method", T.StringType()),
        T.StructField("api_path", T.StringType()),
        T.StructField("request_method", T.StringType()),
        T.StructField("request_url", T.StringType()),
        T.StructField("status_code", T.StringType()),
        T.StructField("latency_ms", T.StringType()),
        T.StructField("remote_ip", T.StringType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("user_uid", T.StringType()),
        T.StructField("trace", T.StringType()),
        T.StructField("payload_size", T.LongType()),
        T.StructField(
            "httpRequest",
            T.StructType(
                [
                    T.StructField("status", T.StringType()),
                    T.StructField("requestMethod", T.StringType()),
                    T.StructField("requestUrl", T.StringType()),
                    T.StructField("remoteIp", T.StringType()),
                    T.StructField("userAgent", T.StringType()),
                    T.StructField("latency", T.StringType()),
                ]
            ),
        ),
    ]
)

# CSV cannot carry the nested request.
RAW_CSV = T.StructType([f for f in RAW_FLAT.fields if f.name != "httpRequest"])

ENTRY_PAYLOAD = T.StructType(
    [
        T.StructField("service", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("api_path", T.StringType()),
        T.StructField("request_method", T.StringType()),
        T.StructField("status_code", T.StringType()),
        T.StructField("latency_ms", T.StringType()),
        T.StructField("remote_ip", T.StringType()),
        T.StructField("user_uid", T.StringType()),
    ]
)

# Exported log entry: typed parts as structs, free labels as a map, text payload as JSON in a string.
RAW_LOG_ENTRY = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("resource", T.StructType([T.StructField("type", T.StringType())])),
        T.StructField("severity", T.StringType()),
        T.StructField("log_name", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("jsonPayload", ENTRY_PAYLOAD),
        T.StructField("textPayload", T.StringType()),
        T.StructField(
            "httpRequest",
            T.StructType(
                [
                    T.StructField("requestUrl", T.StringType()),
                    T.StructField("requestMethod", T.StringType()),
                    T.StructField("status", T.StringType()),
                    T.StructField("latency", T.StringType()),
                    T.StructField("remoteIp", T.StringType()),
                    T.StructField("userAgent", T.StringType()),
                ]
            ),
        ),
        T.StructField("trace", T.StringType()),
    ]
)

ISSUE = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("details", T.MapType(T.StringType(), T.StringType())),
    ]
)

EVENT_ENVELOPE = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
        T.StructField("timestamp", T.StringType()),
    ]
)
