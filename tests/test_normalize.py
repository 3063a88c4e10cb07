from __future__ import annotations

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from reqloom import schemas as S
from reqloom.functions import hashing, text
from reqloom.operators.normalize import drop_repeats, normalize_flat, normalize_log_entries

NOW = datetime(2026, 3, 1, 12)


def flat(spark, *records):
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    return lines.select(F.from_json("value", S.RAW_FLAT).alias("r")).select("r.*")


def entries(spark, *records):
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    return lines.select(F.from_json("value", S.RAW_LOG_ENTRY).alias("r")).select("r.*")


def md5(value: str) -> int:
    return int(hashlib.md5(value.encode()).hexdigest(), 16)


def test_stand_ins_equal_big_integer_arithmetic(spark):
    names = [f"trace-{i}" for i in range(500)] + ["", "é", "default-trace"]
    df = hashing.with_residue(spark.createDataFrame([(n,) for n in names], "t string"), F.col("t"), "r")
    rows = df.select(
        "t",
        hashing.stand_in_status(F.col("r"), S.FLAT_STATUS_CODES).alias("status"),
        hashing.stand_in_latency(F.col("r")).alias("latency"),
        hashing.stand_in_ip_flat(F.col("r")).alias("flat"),
        hashing.stand_in_ip_entry(F.col("r")).alias("entry"),
    ).collect()
    for row in rows:
        h = md5(row["t"])
        assert row["status"] == S.FLAT_STATUS_CODES[h % 10]
        assert row["latency"] == h % 1500 + 80
        assert row["flat"] == f"10.{h % 255}.{(h // 10) % 255}.{(h // 100) % 255}"
        assert row["entry"] == f"10.{h % 255}.{h % 200}.{h % 100}"


def test_minimal_record(spark):
    raw = flat(
        spark,
        {"timestamp": "2031-05-04T10:00:00", "service": "cart", "api_path": "/shop/cart", "request_method": "GET"},
    )
    df = normalize_flat(raw, NOW)
    assert df.schema.names == S.REQUESTS.names
    assert [f.dataType for f in df.schema.fields] == [f.dataType for f in S.REQUESTS.fields]
    row = df.first()
    h = md5("default-trace")
    assert row["trace"] == "default-trace"
    assert row["event_timestamp"] == datetime(2031, 5, 4, 10)
    assert row["status_code"] == S.FLAT_STATUS_CODES[h % 10]
    assert row["latency_ms"] == h % 1500 + 80
    assert row["remote_ip"].startswith("10.")
    assert (row["env"], row["version"], row["api_name"], row["api_method"]) == ("unknown", "v1", "unknown", "unknown")
    assert (row["request_url"], row["user_agent"], row["user_uid"], row["payload_size"]) == (
        "/unknown",
        "unknown",
        "anonymous",
        0,
    )


def test_nested_request(spark):
    raw = flat(
        spark,
        {
            "timestamp": "2031-05-04T10:00:00Z",
            "resource_type": "container",
            "trace": "span-a",
            "httpRequest": {
                "status": 451,
                "requestMethod": "POST",
                "requestUrl": "/shop/pay",
                "remoteIp": "198.51.100.7",
                "userAgent": "probe",
                "latency": 77.9,
            },
        },
    )
    row = normalize_flat(raw, NOW).first()
    assert (row["status_code"], row["latency_ms"], row["remote_ip"]) == (451, 77, "198.51.100.7")
    assert (row["env"], row["request_method"], row["request_url"]) == ("container", "GET", "/unknown")


@pytest.mark.parametrize("missing", [0, "", None])
def test_falsy_values_fall_through(spark, missing):
    record = {"trace": "t", "status_code": missing, "latency_ms": missing, "httpRequest": {"status": 503, "latency": 9}}
    row = normalize_flat(flat(spark, record), NOW).first()
    assert (row["status_code"], row["latency_ms"]) == (503, 9)
    bare = normalize_flat(flat(spark, {"trace": "t", "status_code": missing}), NOW, synthesize_missing=False).first()
    assert (bare["status_code"], bare["latency_ms"], bare["remote_ip"]) == (None, None, None)


def test_unreadable_number_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        normalize_flat(flat(spark, {"status_code": "abc"}), NOW).collect()


@pytest.mark.parametrize(
    "written, read",
    [
        ("2031-05-04T10:00:00", datetime(2031, 5, 4, 10)),
        ("2031-05-04T10:00:00.123456", datetime(2031, 5, 4, 10, 0, 0, 123456)),
        ("2031-05-04T10:00:00Z", datetime(2031, 5, 4, 10)),
        ("2031-05-04T10:00:00+02:00", datetime(2031, 5, 4, 8)),
        ("2031-05-04 10:00:00-05:30", datetime(2031, 5, 4, 15, 30)),
        ("2031-05-04", datetime(2031, 5, 4)),
        ("soon", NOW),
        (None, NOW),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times(spark, written, read, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert normalize_flat(flat(spark, {"timestamp": written}), NOW).first()["event_timestamp"] == read
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_empty_input_keeps_the_schema(spark):
    empty = normalize_flat(spark.createDataFrame([], S.RAW_FLAT), NOW)
    assert empty.count() == 0 and empty.columns == S.REQUESTS.names


def test_log_entry_precedence(spark):
    text_payload = json.dumps({"service": "text", "version": "v3", "api_path": "/t", "status_code": 418, "latency_ms": 5})
    everything = {
        "timestamp": "2031-05-04T10:00:00",
        "resource": {"type": "pod"},
        "labels": {"k8s-pod/app": "label", "k8s-pod/version": "v2"},
        "jsonPayload": {"service": "json", "api_path": "/j", "status_code": 201, "latency_ms": 7, "user_uid": "u"},
        "textPayload": text_payload,
        "httpRequest": {"requestUrl": "/h", "requestMethod": "PUT", "status": 500, "latency": "0.123s", "remoteIp": "9.9.9.9"},
        "trace": "t1",
    }
    text_only = {"textPayload": text_payload, "trace": "t2"}
    broken_text = {"textPayload": "not json", "trace": "t3", "httpRequest": {"requestUrl": "/h", "latency": "soon"}}
    rows = {r["trace"]: r for r in normalize_log_entries(entries(spark, everything, text_only, broken_text), NOW).collect()}
    full = rows["t1"]
    assert (full["env"], full["service"], full["version"], full["api_path"]) == ("pod", "label", "v2", "/j")
    assert (full["status_code"], full["latency_ms"], full["remote_ip"], full["user_uid"]) == (500, 123.0, "9.9.9.9", "u")
    assert full["request_method"] == "PUT"
    assert (rows["t2"]["service"], rows["t2"]["status_code"], rows["t2"]["latency_ms"]) == ("text", 418, 5.0)
    h = md5("t3")
    assert (rows["t3"]["service"], rows["t3"]["version"], rows["t3"]["api_path"]) == ("unknown-service", "v1", "/h")
    assert rows["t3"]["status_code"] == S.ENTRY_STATUS_CODES[h % 10]
    assert rows["t3"]["latency_ms"] == h % 1500 + 80
    assert rows["t3"]["event_timestamp"] == NOW


def test_text_helpers(spark):
    df = spark.createDataFrame(
        [("  A \t\n B  C  ", [" X  y ", "Z"]), ("", []), (None, None)], "t string, a array<string>"
    )
    rows = df.select(text.normalize_text(F.col("t")).alias("t"), text.normalize_items(F.col("a")).alias("a")).collect()
    assert [tuple(r) for r in rows] == [("a b c", ["x  y", "z"]), ("", []), (None, None)]
    durations = spark.createDataFrame([("0.123s",), ("12",), ("none",), ("1.2.3s",), (None,)], "d string")
    assert [r[0] for r in durations.select(text.duration_ms(F.col("d"))).collect()] == [123.0, 12000.0, None, None, None]
    dates = spark.createDataFrame([("2024-01-05",), ("2024-1-5",), ("2024-01-05 06:07:08",), ("5/1/2024",)], "d string")
    assert [r[0] for r in dates.select(text.parse_date(F.col("d"))).collect()] == [
        datetime(2024, 1, 5),
        datetime(2024, 1, 5),
        datetime(2024, 1, 5, 6, 7, 8),
        None,
    ]


def test_normalize_text_equals_python(spark):
    import re

    draws = ["\tTab", "nb sp", "\x1cfs\x1f", "a b", "ÀÉ  Î", "x\x85y", " 　z　 ", "plain text", "a\r\n\r\nb"]
    df = spark.createDataFrame([(d,) for d in draws], "t string")
    got = [r[0] for r in df.select(text.normalize_text(F.col("t"))).collect()]
    assert got == [re.sub(r"\s+", " ", d.strip().lower()) for d in draws]


def test_drop_repeats(spark, requests):
    doubled = requests.unionByName(requests)
    assert drop_repeats(doubled).count() == requests.count()
