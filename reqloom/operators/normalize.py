"""Raw log records to the normalised request table."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqloom import schemas as S
from reqloom.functions import hashing, text


def normalize_flat(raw: DataFrame, ingest_ts: datetime | None = None, synthesize_missing: bool = True) -> DataFrame:
    """Flat records (schema RAW_FLAT or a part of it) as the 16 request columns.

    A status code, latency or address of zero or empty text counts as missing and falls through to the nested request,
    then to a stand-in derived from the trace; `synthesize_missing=False` leaves null instead. A time that is missing
    or unreadable becomes `ingest_ts` (default: now). Absent and null fields both take the default.
    """
    present = set(raw.columns)
    nested = _nested_fields(raw, "httpRequest")

    def field(name: str, default: object = None) -> Column:
        column = F.col(name) if name in present else F.lit(None).cast("string")
        return column if default is None else F.coalesce(column, F.lit(default))

    def first_number(flat: str, inner: str) -> Column:
        sources = [F.col(flat)] if flat in present else []
        sources += [F.col("httpRequest")[inner]] if inner in nested else []
        return F.coalesce(*[_truthy_number(c) for c in sources], F.lit(None).cast("double"))

    def first_text(flat: str, inner: str) -> Column:
        sources = [F.col(flat)] if flat in present else []
        sources += [F.col("httpRequest")[inner]] if inner in nested else []
        return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in sources], F.lit(None).cast("string"))

    trace = F.coalesce(field("trace").cast("string"), F.lit(S.DEFAULT_TRACE))
    event_time = _event_time(raw, "timestamp", ingest_ts)
    known = raw.withColumns(
        {
            "_trace": trace,
            "_status": first_number("status_code", "status").cast("int"),
            "_latency": first_number("latency_ms", "latency").cast("bigint"),
            "_address": first_text("remote_ip", "remoteIp"),
        }
    )
    status, latency, address = F.col("_status"), F.col("_latency"), F.col("_address")
    if synthesize_missing:
        gap = status.isNull() | latency.isNull() | address.isNull()
        known = hashing.with_residue(known, F.col("_trace"), "_residue", gap)
        residue = F.col("_residue")
        status = F.coalesce(status, hashing.stand_in_status(residue, S.FLAT_STATUS_CODES))
        latency = F.coalesce(latency, hashing.stand_in_latency(residue))
        address = F.coalesce(address, hashing.stand_in_ip_flat(residue))

    return known.select(
        event_time.alias("event_timestamp"),
        field("resource_type", S.DEFAULT_ENV).alias("env"),
        field("service", S.DEFAULT_SERVICE).alias("service"),
        field("version", S.DEFAULT_VERSION).alias("version"),
        field("api_name", S.DEFAULT_API_NAME).alias("api_name"),
        field("api_method", S.DEFAULT_API_METHOD).alias("api_method"),
        field("api_path", S.DEFAULT_API_PATH).alias("api_path"),
        field("request_method", S.DEFAULT_REQUEST_METHOD).alias("request_method"),
        field("request_url", S.DEFAULT_REQUEST_URL).alias("request_url"),
        status.alias("status_code"),
        latency.alias("latency_ms"),
        address.alias("remote_ip"),
        field("user_agent", S.DEFAULT_USER_AGENT).alias("user_agent"),
        field("user_uid", S.DEFAULT_USER_UID).alias("user_uid"),
        F.col("_trace").alias("trace"),
        F.coalesce(field("payload_size").cast("bigint"), F.lit(0).cast("bigint")).alias("payload_size"),
    )


def normalize_log_entries(
    entries: DataFrame, ingest_ts: datetime | None = None, synthesize_missing: bool = True
) -> DataFrame:
    """Exported log entries (schema RAW_LOG_ENTRY) as the 11 request columns of the dashboard view.

    Each column takes the first source that has it: labels, then the JSON payload, the JSON in the text payload (parsed
    once; text that is not JSON counts as empty) and the HTTP part; for code, latency and address the HTTP part is
    first. Latency is fractional milliseconds.
    """
    parsed = entries.withColumn("_text", F.from_json("textPayload", S.ENTRY_PAYLOAD))
    payload, parsed_text, http, labels = (F.col(c) for c in ("jsonPayload", "_text", "httpRequest", "labels"))

    def whole(column: Column) -> Column:
        """Text as a whole number, a fraction cut off; null where it is no number."""
        return column.try_cast("decimal(38,6)").try_cast("bigint")

    status = [whole(http["status"]), whole(payload["status_code"]), whole(parsed_text["status_code"])]
    latency = [
        text.duration_ms(http["latency"]),
        payload["latency_ms"].try_cast("double"),
        parsed_text["latency_ms"].try_cast("double"),
    ]
    address = [http["remoteIp"], payload["remote_ip"], parsed_text["remote_ip"]]
    known = parsed.withColumns(
        {"_status": F.coalesce(*status), "_latency": F.coalesce(*latency), "_address": F.coalesce(*address)}
    )
    status, latency, address = F.col("_status"), F.col("_latency"), F.col("_address")
    if synthesize_missing:
        gap = status.isNull() | latency.isNull() | address.isNull()
        known = hashing.with_residue(known, F.coalesce(F.col("trace"), F.lit(S.DEFAULT_TRACE)), "_residue", gap)
        residue = F.col("_residue")
        status = F.coalesce(status, hashing.stand_in_status(residue, S.ENTRY_STATUS_CODES).cast("bigint"))
        latency = F.coalesce(latency, hashing.stand_in_latency(residue).cast("double"))
        address = F.coalesce(address, hashing.stand_in_ip_entry(residue))

    return known.select(
        _event_time(entries, "timestamp", ingest_ts).alias("event_timestamp"),
        F.coalesce(F.col("resource")["type"], F.lit(S.DEFAULT_ENV)).alias("env"),
        F.coalesce(
            labels[S.LABEL_SERVICE], payload["service"], parsed_text["service"], F.lit(S.DEFAULT_ENTRY_SERVICE)
        ).alias("service"),
        F.coalesce(
            labels[S.LABEL_VERSION], payload["version"], parsed_text["version"], F.lit(S.DEFAULT_VERSION)
        ).alias("version"),
        F.coalesce(
            payload["api_path"], parsed_text["api_path"], http["requestUrl"], F.lit(S.DEFAULT_API_PATH)
        ).alias("api_path"),
        F.coalesce(
            payload["request_method"],
            parsed_text["request_method"],
            http["requestMethod"],
            F.lit(S.DEFAULT_REQUEST_METHOD),
        ).alias("request_method"),
        status.cast("int").alias("status_code"),
        latency.alias("latency_ms"),
        address.alias("remote_ip"),
        F.coalesce(payload["user_uid"], parsed_text["user_uid"], F.lit(S.DEFAULT_USER_UID)).alias("user_uid"),
        F.col("trace"),
    )


def _event_time(df: DataFrame, name: str, ingest_ts: datetime | None) -> Column:
    now = F.lit((ingest_ts or datetime.now(UTC).replace(tzinfo=None)).isoformat(sep=" ")).cast("timestamp_ntz")
    if name not in df.columns:
        return now
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        column = text.parse_iso_utc(column)
    return F.coalesce(column.cast("timestamp_ntz"), now)


def _truthy_number(column: Column) -> Column:
    """Zero and empty text are null; other text that is no number fails the job, as it should."""
    number = F.nullif(column.cast("string"), F.lit("")).cast("double")
    return F.nullif(number, F.lit(0.0))


def _nested_fields(df: DataFrame, name: str) -> set[str]:
    if name not in df.columns or not isinstance(df.schema[name].dataType, T.StructType):
        return set()
    return set(df.schema[name].dataType.fieldNames())


def drop_repeats(requests: DataFrame) -> DataFrame:
    """Opt-in: one row per (trace, event_timestamp, api_path), for stores that were loaded twice."""
    return requests.dropDuplicates(["trace", "event_timestamp", "api_path"])
