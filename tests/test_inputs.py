"""Inputs that arrive with offsets, fractions, or files that differ."""

from __future__ import annotations


from reqloom.operators.explore import hourly_volume
from reqloom.operators.normalize import normalize_log_entries
from reqloom.schemas import RAW_LOG_ENTRY
from reqloom.sources import readers


def test_fractional_payload_numbers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"timestamp": "2024-03-01T00:00:00Z", "jsonPayload": {"latency_ms": 12.5, "status_code": 200.0}, "trace": "t"}\n')
    row = normalize_log_entries(readers.read_jsonl(spark, str(tmp_path), RAW_LOG_ENTRY)).first()
    assert row["status_code"] == 200 and row["latency_ms"] == 12.5


def test_text_times_with_an_offset(spark):
    rows = spark.createDataFrame([("2024-01-01T00:30:00+02:00",)], "event_timestamp string")
    assert "2023-12-31 22:00" in str(hourly_volume(rows).first()) or "2023, 12, 31, 22" in str(hourly_volume(rows).first())


def test_csv_files_of_other_orders_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("trace,service\nt1,svc1\n")
    (tmp_path / "b.csv").write_text("service,trace\nsvc2,t2\n")
    rows = readers.read_csv(spark, str(tmp_path)).select("trace", "service").collect()
    assert sorted(map(tuple, rows)) == [("t1", "svc1"), ("t2", "svc2")]
