"""The given tables as request logs: the mapping every registered query starts from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reqloom.functions import hashing
from reqloom.schemas import FLAT_STATUS_CODES, LABEL_SERVICE, LABEL_VERSION

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the number in `props` as `k`."""
    return table(spark, folder, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def requests(spark: SparkSession, folder: str, fine: bool = False) -> DataFrame:
    """One request per event: path from the type, user and trace from the ids, latency from the value.

    `fine` splits each path into ten.
    """
    trace = F.concat(F.lit("trace-"), F.col("event_id").cast("string"))
    e = hashing.with_residue(events(spark, folder).withColumn("trace", trace), F.col("trace"), "residue")
    path = [F.lit("/v1/"), F.col("event_type")]
    if fine:
        path += [F.lit("/"), (F.col("k") % 10).cast("string")]
    return e.select(
        F.col("ts").cast("timestamp_ntz").alias("event_timestamp"),
        F.concat(*path).alias("api_path"),
        hashing.stand_in_status(F.col("residue"), FLAT_STATUS_CODES).alias("status_code"),
        F.round(F.col("value") * 10).cast("bigint").alias("latency_ms"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("user_uid"),
        "trace",
        F.col("k").cast("bigint").alias("payload_size"),
    )


def fine_requests(spark: SparkSession, folder: str) -> DataFrame:
    return requests(spark, folder, fine=True)


def _when(*cases: tuple[Column, object], default: object = None) -> Column:
    column = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        column = F.when(condition, value) if column is None else column.when(condition, value)
    return column.otherwise(default if isinstance(default, Column) else F.lit(default))


def raw_flat(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw flat records with gaps, zeros, empty texts, nested requests and unreadable times."""
    k, kind = F.col("k"), F.col("event_type")
    plain = F.date_format("ts", ISO)
    whole = F.round(F.col("value") * 10).cast("bigint").cast("string")
    none = F.lit(None).cast("string")
    return events(spark, folder).select(
        _when(
            (k % 5 == 0, "not a time"),
            (k % 5 == 1, F.concat(plain, F.lit("Z"))),
            (k % 5 == 2, F.concat(plain, F.lit("+02:00"))),
            default=plain,
        ).alias("timestamp"),
        _when((k % 7 != 0, F.concat(F.lit("res_"), kind)), default=none).alias("resource_type"),
        _when((k % 3 != 0, F.concat(F.lit("service-"), (k % 4).cast("string"))), default=none).alias("service"),
        _when((k % 2 == 0, F.concat(F.lit("v"), (k % 3).cast("string"))), default=none).alias("version"),
        _when((k % 11 != 0, F.concat(F.lit("/v1/"), kind)), default=none).alias("api_path"),
        _when((k % 2 == 0, "POST"), default=none).alias("request_method"),
        _when((k % 6 == 1, "0"), (k % 6 == 2, ""), (k % 6 == 3, "404"), (k % 6 > 3, "200"), default=none).alias(
            "status_code"
        ),
        _when((k % 4 == 1, "0"), (k % 4 == 2, F.concat(whole, F.lit(".9"))), (k % 4 == 3, whole), default=none).alias(
            "latency_ms"
        ),
        _when((k % 3 == 1, ""), (k % 3 == 2, F.concat(F.lit("192.168.0."), k.cast("string"))), default=none).alias(
            "remote_ip"
        ),
        _when((F.col("user_id") % 5 != 0, F.concat(F.lit("user-"), F.col("user_id").cast("string"))), default=none).alias(
            "user_uid"
        ),
        _when((k != 99, F.concat(F.lit("trace-"), F.col("event_id").cast("string"))), default=none).alias("trace"),
        _when((k % 9 != 0, (k * 10).cast("bigint")), default=F.lit(None).cast("bigint")).alias("payload_size"),
        F.when(
            k % 2 == 1,
            F.struct(
                _when((k % 8 == 1, "503"), default=none).alias("status"),
                _when((k % 8 < 4, "250.7"), default=none).alias("latency"),
                _when((k % 8 == 5, "1.2.3.4"), default=none).alias("remoteIp"),
            ),
        ).alias("httpRequest"),
    )


def log_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Events as exported log entries whose parts come and go."""
    k, kind = F.col("k"), F.col("event_type")
    none = F.lit(None).cast("string")
    number = k.cast("string")
    payload = F.struct(
        _when((k % 2 == 0, F.concat(F.lit("json-"), kind)), default=none).alias("service"),
        none.alias("version"),
        _when((k % 5 != 0, F.concat(F.lit("/json/"), kind)), default=none).alias("api_path"),
        none.alias("request_method"),
        _when((k % 4 == 0, "201"), default=none).alias("status_code"),
        _when((k % 4 == 0, number), default=none).alias("latency_ms"),
        none.alias("remote_ip"),
        _when((k % 2 == 0, F.concat(F.lit("user-"), F.col("user_id").cast("string"))), default=none).alias("user_uid"),
    )
    as_json = F.concat(
        F.lit('{"service": "text-'),
        kind,
        F.lit('", "version": "v9", "api_path": "/text", "status_code": 418, "latency_ms": '),
        number,
        F.lit(', "remote_ip": "9.9.9.9", "user_uid": "text-user", "request_method": "PUT"}'),
    )
    http = F.struct(
        F.concat(F.lit("/http/"), kind).alias("requestUrl"),
        _when((k % 2 == 0, "DELETE"), default=none).alias("requestMethod"),
        _when((k % 5 == 1, "502"), default=none).alias("status"),
        _when(
            (k % 5 == 1, F.concat(F.lit("0."), F.lpad(number, 3, "0"), F.lit("s"))), (k % 5 == 2, "soon"), default=none
        ).alias("latency"),
        _when((k % 5 == 3, "8.8.8.8"), default=none).alias("remoteIp"),
    )
    return events(spark, folder).select(
        F.date_format("ts", ISO).alias("timestamp"),
        F.when(k % 10 != 0, F.struct(F.concat(F.lit("res_"), kind).alias("type"))).alias("resource"),
        F.when(
            k % 7 == 0,
            F.create_map(F.lit(LABEL_SERVICE), F.lit("pod-service"), F.lit(LABEL_VERSION), F.lit("v7")),
        ).alias("labels"),
        F.when(k % 3 != 0, payload).alias("jsonPayload"),
        _when((k % 4 == 1, "plain text"), (k % 4 == 2, as_json), (k % 4 == 3, '{"service": '), default=none).alias(
            "textPayload"
        ),
        F.when(k % 6 != 0, http).alias("httpRequest"),
        F.concat(F.lit("trace-"), F.col("event_id").cast("string")).alias("trace"),
    )


def monitoring_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events as monitoring records that break every consistency rule somewhere."""
    k = F.col("k")
    none = F.lit(None).cast("string")
    return events(spark, folder).select(
        F.concat(F.lit("event-"), F.col("event_id").cast("string")).alias("record_id"),
        _when((k != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")), default=none).alias("timestamp"),
        _when((k != 1, F.concat(F.lit("  /V1/ \t "), F.upper("event_type"), F.lit(" "))), default=none).alias("endpoint"),
        _when(
            (k % 20 == 0, "abc"), (k % 20 == 1, "99"), (k % 20 == 2, "600"), (k % 20 == 3, none), default="200"
        ).alias("status_code"),
        F.when(k != 4, F.col("value") - 5).alias("latency"),
        k.cast("bigint").alias("total_requests"),
        (F.col("user_id") % 101).alias("success_requests"),
        (k / F.lit(80.0)).alias("success_rate"),
    )


def gapped_values(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers with nulls, NaN and infinities among them, beside clean ones."""
    k = F.col("k")
    return events(spark, folder).select(
        F.col("value"),
        F.when(k != 50, F.col("value")).alias("with_null"),
        F.when(k == 51, F.lit(float("nan"))).otherwise(F.col("value")).alias("with_nan"),
        F.when(k == 52, F.lit(float("inf"))).otherwise(F.col("value")).alias("with_inf"),
        F.lit(7).alias("constant"),
        F.col("event_type"),
    )


def drift_sample(spark: SparkSession, folder: str, current: bool) -> DataFrame:
    """Requests of the first or the second half of the month, under monitoring names."""
    half = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    r = requests(spark, folder)
    r = r.where(F.col("event_timestamp") >= half) if current else r.where(F.col("event_timestamp") < half)
    return r.select(
        F.col("api_path").alias("endpoint"),
        "status_code",
        (F.col("latency_ms") / 10).alias("latency"),
        F.col("payload_size").cast("double").alias("payload_size"),
    )


def line_sample(spark: SparkSession, folder: str, current: bool) -> DataFrame:
    """Order lines of odd or even orders under monitoring names: samples large enough for the limiting distribution."""
    lines = table(spark, folder, "lineitem").where(F.col("l_orderkey") % 2 == (0 if current else 1))
    return lines.select(
        F.col("l_returnflag").alias("endpoint"),
        (F.col("l_linenumber") * 100).alias("status_code"),
        F.col("l_quantity").alias("latency"),
        F.col("l_extendedprice").alias("payload_size"),
    )
