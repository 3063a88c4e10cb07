"""Sources, sinks, jobs, exploration, free aggregation and streams."""

from __future__ import annotations

import gzip
import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from reqloom import schemas as S
from reqloom.functions.measures import in_time_range
from reqloom.operators import explore, generic, latency
from reqloom.plans import inputs
from reqloom.plans import pipeline as P
from reqloom.sources import readers, writers
from reqloom.streaming import streams
from tests.conftest import SMALL, rows_of

NOW = datetime(2026, 3, 1)
RECORDS = [
    {"timestamp": "2031-05-04T10:00:00", "trace": f"t{i}", "api_path": "/shop/cart", "status_code": 200, "latency_ms": i + 1}
    for i in range(3)
]


def write(path, text):
    path.write_text(text)
    return str(path)


def test_json_sources(spark, tmp_path):
    array = write(tmp_path / "a.json", json.dumps(RECORDS))
    lines = write(tmp_path / "a.jsonl", "\n\n".join(json.dumps(r) for r in RECORDS) + "\n\n")
    assert rows_of(readers.read_json(spark, array)) == rows_of(readers.read_jsonl(spark, lines))
    assert readers.read_jsonl(spark, lines).count() == 3
    bad = write(tmp_path / "bad.jsonl", json.dumps(RECORDS[0]) + "\n{broken\n")
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_jsonl(spark, bad).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_json(spark, str(tmp_path / "none.json"))


def test_csv_source(spark, tmp_path):
    path = write(tmp_path / "a.csv", "trace,status_code,latency_ms,extra\nt1,404,12,x\nt2,,,y\n")
    df = readers.read_csv(spark, path)
    assert df.columns == ["trace", "status_code", "latency_ms", "extra"]
    out = P.normalize_flat(df, NOW, synthesize_missing=False)
    assert rows_of(out.select("trace", "status_code", "latency_ms")) == [(12, 404, "t1"), (None, None, "t2")]


def test_csv_files_of_several_headers(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    write(folder / "a.csv", "trace,status_code,latency_ms\nt1,404,12\nt2,200,13\n")
    write(folder / "b.csv", 'latency_ms,"trace",extra\n14,"t3, quoted",x\n')
    write(folder / "c.csv", "")
    (folder / "d.csv.gz").write_bytes(gzip.compress(b"status_code,trace\n500,t4\n"))
    got = readers.read_csv(spark, str(folder))
    assert set(got.columns) == {"trace", "status_code", "latency_ms", "extra"}
    got = got.select("trace", "status_code", "latency_ms", "extra")
    want = [("t1", "404", "12", None), ("t2", "200", "13", None), ("t3, quoted", None, "14", "x"), ("t4", "500", None, None)]
    assert sorted(tuple(row) for row in got.collect()) == want
    assert readers.read_csv(spark, str(folder / "c.csv")).count() == 0
    write(folder / "e.csv", "trace,trace\n1,2\n")
    with pytest.raises(readers.SourceError):
        readers.read_csv(spark, str(folder))
    write(folder / "e.csv", "trace,status_code\nonly one\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        readers.read_csv(spark, str(folder)).collect()


def test_source_dispatch(spark, tmp_path):
    entries = [{"timestamp": f"2031-05-04T10:00:0{i}", "severity": "ERROR" if i % 2 else "INFO", "trace": f"t{i}"} for i in range(6)]
    path = write(tmp_path / "e.jsonl", "\n".join(json.dumps(e) for e in entries))
    errors = readers.read_logs(spark, "cloud", path, "severity = 'ERROR'")
    assert {r["trace"] for r in errors.collect()} == {"t1", "t3", "t5"}
    with pytest.raises(readers.SourceError):
        readers.read_logs(spark, "cloud", path)
    with pytest.raises(readers.SourceError):
        readers.read_logs(spark, "json")
    with pytest.raises(readers.SourceError):
        readers.read_logs(spark, "ftp", path)


def test_append_sink(spark, requests, tmp_path):
    store = str(tmp_path / "store")
    writers.write_requests(requests, "path", store)
    n = requests.count()
    writers.append_requests(requests, store, gather_days=True)
    assert spark.read.parquet(store).count() == 2 * n
    writers.append_requests(requests.limit(0), store)
    assert spark.read.parquet(store).count() == 2 * n
    start, end = datetime(2024, 1, 3), datetime(2024, 1, 4)
    day = in_time_range(spark.read.parquet(store), start, end, with_end=False)
    assert day.count() == 2 * requests.where("to_date(event_timestamp) = date'2024-01-03'").count()
    assert "PartitionFilters: [isnotnull(event_date" in day._jdf.queryExecution().toString()
    with pytest.raises(writers.SinkError):
        writers.write_requests(requests, "tape", store)


def test_table_sink_replace_and_view(spark, requests, tmp_path):
    writers.write_requests(requests, "table", "stored_requests")
    writers.write_requests(requests, "table", "stored_requests")
    assert spark.table("stored_requests").count() == 2 * requests.count()
    spark.sql("DROP TABLE stored_requests")
    path = str(tmp_path / "t")
    assert writers.replace_table(spark.range(5), path).count() == 5
    assert writers.replace_table(spark.range(3), path).count() == 3
    writers.define_view(spark.range(4), "four")
    assert spark.table("four").count() == 4


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_export(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    writers.export(spark.range(5).withColumn("t", F.lit("x")), fmt, path)
    assert spark.read.format(fmt).option("header", True).load(path).count() == 5
    with pytest.raises(writers.SinkError):
        writers.export(spark.range(1), "html", path)


def test_build_metrics_equals_the_direct_operators(spark, requests, tmp_path):
    names = [
        "latency_kpis_view",
        "dashboard_latency_endpoint_rank_daily",
        "dashboard_errors_hourly",
        "dashboard_sla_daily",
        "dashboard_status_families_daily",
        "dashboard_top_endpoints_per_error_code_daily",
        "dashboard_errors_rolling",
        "dashboard_anomaly_error_spikes",
    ]
    tables = P.build_metrics(requests, str(tmp_path / "out"), only=names)
    assert set(tables) == set(names)
    for name in names:
        direct = {**P.FROM_CELLS, **P.FROM_REQUESTS}[name](requests)
        assert rows_of(tables[name]) == rows_of(direct), name
        assert spark.table(f"warehouse_{name}").columns == tables[name].columns


def test_targets_share_a_folder(spark, requests, tmp_path):
    out, name = str(tmp_path / "out"), "dashboard_errors_hourly"
    warehouse = P.build_metrics(requests, out, "warehouse", only=[name])[name]
    local = P.build_metrics(requests, out, "local", only=[name])[name]
    assert rows_of(warehouse) == rows_of(P.FROM_CELLS[name](requests))
    assert rows_of(local) == rows_of(P.LOCAL_TABLES[name](requests))
    assert spark.table(f"local_{name}").columns == local.columns != spark.table(f"warehouse_{name}").columns
    assert spark.table("local_requests").columns == requests.columns


def test_all_tables_build(spark, requests, tmp_path):
    few = requests.where(F.col("event_timestamp") < "2024-01-04")
    tables = P.build_metrics(few, str(tmp_path / "all"))
    assert len(tables) == 23 and set(tables) == {*P.FROM_CELLS, *P.FROM_REQUESTS}
    with pytest.raises(P.PipelineError):
        P.build_metrics(few, str(tmp_path / "x"), target="paper")
    with pytest.raises(P.PipelineError):
        P.build_metrics(few, str(tmp_path / "x"), only=["nothing"])


def test_run_pipeline(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", "\n".join(json.dumps(r) for r in RECORDS))
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    for runs in (1, 2):
        tables = P.run_pipeline(spark, "jsonl", "local", store, out, path=path, ingest_ts=NOW)
        row = tables["dashboard_latency_daily"].first()
        assert (row["day"], row["api_path"], row["total_requests"]) == ("2031-05-04", "/shop/cart", 3 * runs)
        assert (row["avg_latency_ms"], row["max_latency_ms"]) == (2.0, 3)
    assert tables["dashboard_errors_hourly"].first()["hour"] == "2031-05-04 10:00:00"
    with pytest.raises(P.PipelineError):
        P.run_pipeline(spark, "jsonl", "local", store, out, start_from="load", path=path)


def test_gates_and_drift_between(spark, requests):
    rows = {r["check"]: r for r in P.gate(requests).collect()}
    assert rows["consistency"]["passed"] and rows["quality"]["passed"]
    broken = requests.withColumn("latency_ms", F.lit(-1).cast("bigint"))
    assert not {r["check"]: r for r in P.gate(broken).collect()}["consistency"]["passed"]
    with pytest.raises(P.ConsistencyError):
        P.gate(broken, strict=True)
    first, second = (datetime(2024, 1, 1), datetime(2024, 1, 10)), (datetime(2024, 1, 10), datetime(2024, 1, 20))
    summary, _ = P.drift_between(requests, first, second)
    assert 0 <= summary.first()["drift_score"] <= 1
    assert P.drift_between(requests, first, (datetime(2030, 1, 1), datetime(2031, 1, 1))) is None


# exploration


def test_exploration_edge_cases(spark):
    df = spark.createDataFrame(
        [("/a", "10", 200, "2024-01-01 00:30:00"), ("/a", "bad", None, "nope"), (None, "30", 404, None), ("/b", None, 200, None)],
        "api_path string, latency_ms string, status_code int, event_timestamp string",
    )
    assert [tuple(r) for r in explore.status_code_distribution(df).collect()] == [(200, 2, 0.5), (404, 1, 0.25), (None, 1, 0.25)]
    assert {r[0] for r in explore.status_family_distribution(df).collect()} == {"2xx", "4xx", "<NA>xx"}
    row = explore.latency_overview(df).first()
    assert (row["count"], row["mean_ms"], row["p50_ms"], row["min_ms"], row["max_ms"]) == (2, 20.0, 20.0, 10.0, 30.0)
    top = [tuple(r) for r in explore.top_endpoints(df, 0, "nothing").collect()]
    assert top == [("/a", 2, 10.0, 10.0, 10.0, 10.0), ("/b", 1, None, None, None, None)]
    assert [tuple(r) for r in explore.daily_volume(df).collect()] == [(datetime(2024, 1, 1).date(), 1)]
    assert [tuple(r) for r in explore.hourly_volume(df).collect()] == [(datetime(2024, 1, 1), 1)]
    with pytest.raises(ValueError, match="the table lacks"):
        explore.hourly_volume(df.drop("event_timestamp"))


def test_empty_latency_overview(spark):
    row = explore.latency_overview(spark.createDataFrame([], "latency_ms bigint")).first()
    assert tuple(row) == (0, None, None, None, None, None, None)


def test_run_exploration(spark, requests, tmp_path):
    paths = explore.run_exploration(requests, str(tmp_path), 3)
    assert set(paths) == {"status_codes", "status_families", "latency_summary", "top_endpoints", "hourly_volume", "daily_volume"}
    assert spark.read.option("header", True).csv(paths["top_endpoints"]).count() == 3


# free aggregation


def test_aggregate_metrics(spark, requests):
    names = ["total_requests", "rate_4xx", "p95_latency_ms", "max_latency_ms"]
    whole = generic.aggregate_metrics(requests, names).first()
    assert whole["total_requests"] == requests.count()
    by_code = generic.aggregate_metrics(requests, names, ["status_code"])
    assert by_code.agg(F.sum("total_requests")).first()[0] == requests.count()
    assert {r["rate_4xx"] for r in by_code.where("status_code between 400 and 499").collect()} == {1.0}
    assert generic.aggregate_metrics(requests, ["avg_latency_ms"], ["api_path"]).columns == ["api_path", "avg_latency_ms"]
    for bad in ([" "], ["a b"], ["unheard_of"]):
        with pytest.raises(ValueError):
            generic.aggregate_metrics(requests, bad)
    with pytest.raises(ValueError):
        generic.aggregate_metrics(requests, names, [], datetime(2024, 2, 1), datetime(2024, 1, 1))
    assert generic.clean_names([" a ", "b", "a"]) == ["a", "b"]


def test_cells_of_cells(requests):
    from reqloom.functions.measures import cells

    stored = cells(requests, *P.CELL_DIMS)
    for operator in (latency.latency_kpis, latency.latency_hourly, P.FROM_CELLS["dashboard_sla_daily"]):
        assert rows_of(operator(stored)) == rows_of(operator(requests))


def test_status_pivot_loses_no_request(spark):
    rows = spark.createDataFrame([("/a", 200), ("/a", 418), ("/a", None), ("/b", 500)], "api_path string, status_code int")
    assert rows_of(generic.status_pivot(rows, [200])) == rows_of(
        spark.createDataFrame([("/a", 1, 2), ("/b", 0, 1)], "api_path string, status_200 long, status_other long")
    )


def test_row_count_check(spark):
    row = generic.count_matches(spark.range(5), 4).first()
    assert (row["is_non_empty"], row["is_count_ok"]) == (True, False)
    row = generic.count_matches(spark.range(0), 0).first()
    assert (row["is_non_empty"], row["is_count_ok"]) == (False, True)


# streams


@pytest.fixture
def request_files(spark, requests, tmp_path):
    folder = str(tmp_path / "in")
    requests.repartitionByRange(3, "event_timestamp").write.parquet(folder)
    return folder


def drain(df, spark, tmp_path, mode, name):
    query = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(tmp_path / f"ck_{name}")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    return spark.table(name)


def test_running_means_stream(spark, requests, request_files, tmp_path):
    stream = spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", 1).parquet(request_files)
    got = drain(streams.running_means(stream, "api_path", "latency_ms"), spark, tmp_path, "complete", "means")
    batch = streams.running_means(requests, "api_path", "latency_ms")
    assert rows_of(got) == rows_of(batch)


def test_hourly_stream_equals_the_batch_for_closed_hours(spark, requests, request_files, tmp_path):
    stream = spark.readStream.schema(requests.schema).parquet(request_files)
    got = drain(streams.hourly_stream(stream), spark, tmp_path, "append", "hours")
    closed = got.agg(F.max("hour_ts")).first()[0]
    batch = P.FROM_CELLS["dashboard_errors_hourly"](requests).where(F.col("hour_ts") <= closed)
    assert rows_of(got.select(batch.columns)) == rows_of(batch)
    assert got.count() > 500


def test_sliding_stream(spark, requests, request_files, tmp_path):
    stream = spark.readStream.schema(requests.schema).parquet(request_files)
    got = drain(streams.hourly_stream(stream, slide="30 minutes"), spark, tmp_path, "append", "slides")
    assert got.where("hour_end - hour_ts = interval 1 hour").count() == got.count() > 0


def test_checks_on_a_stream(spark, tmp_path):
    rows = inputs.monitoring_rows(spark, SMALL)
    rows.write.parquet(str(tmp_path / "m"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "m"))
    got = drain(streams.check_stream(stream), spark, tmp_path, "append", "checked")
    assert rows_of(got.select("record_id", "issues")) == rows_of(streams.check_stream(rows).select("record_id", "issues"))
    assert got.where(F.array_contains("invalid_columns", "latency")).count() == rows.where("latency is null").count()


def test_envelopes(spark, tmp_path):
    folder = tmp_path / "events"
    folder.mkdir()
    good = {"event_id": "e-1", "event_type": "http:request", "source": "api/v1", "payload": {"a": "1"}, "timestamp": "2031-05-04T10:00:00Z"}
    write(folder / "a.txt", "\n".join([json.dumps(good), json.dumps({**good, "event_id": "e 2"}), "junk"]))
    stream = streams.read_envelopes(spark.readStream.format("text").load(str(folder)))
    rows = {r["event_id"]: r for r in drain(stream, spark, tmp_path, "append", "envelopes").collect()}
    assert {k: r["is_valid"] for k, r in rows.items()} == {"e-1": True, "e 2": False, None: False}
    assert (rows["e-1"]["timestamp"], rows["e-1"]["payload"]) == (datetime(2031, 5, 4, 10), {"a": "1"})


def test_request_stream(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    write(folder / "a.jsonl", "\n".join(json.dumps(r) for r in RECORDS))
    stream = streams.read_request_stream(spark, str(folder), S.RAW_FLAT)
    got = drain(P.normalize_flat(stream, NOW), spark, tmp_path, "append", "normalised")
    assert got.agg(F.sum("latency_ms")).first()[0] == 6


@pytest.mark.parametrize("key", ["api_path", "user_uid"])
def test_refresh_on_batch(spark, tmp_path, key):
    """Batches out of order, a key that is silent for weeks, ties, late requests, a null key: as if built at once."""
    from reqloom.operators.errors import errors_rolling
    from reqloom.operators.users import user_rolling_activity

    build = errors_rolling if key == "api_path" else user_rolling_activity
    draw = random.Random(8)
    start = datetime(2024, 1, 1)
    data = []
    for batch, span in enumerate([(0, 3), (2, 5), (20, 21), (1, 2), (20, 40)]):
        for i in range(40):
            name = draw.choice(["/a", "/b", None, f"/only{batch}"])
            at = start + timedelta(days=draw.randint(*span), hours=draw.choice([0, 1, 23]), seconds=draw.choice([0, 0, 30]))
            data.append((batch, at, name, draw.choice([200, 500])))
        if batch in (0, 4):
            data.append((batch, start + timedelta(days=60 * batch), "/silent", 500))
    schema = f"batch int, event_timestamp timestamp_ntz, {key} string, status_code int"
    rows = spark.createDataFrame(data, schema)
    for batch in range(5):
        rows.where(F.col("batch") == batch).drop("batch").coalesce(1).write.parquet(str(tmp_path / "in"), mode="append")
    built: dict = {}

    def refresh(recent, valid_from):
        since = {r[key]: r["valid_from"] for r in valid_from.collect()}
        fresh = streams.valid_rows(build(recent), valid_from, key).collect()
        for name, at in since.items():
            built[name] = [r for r in built.get(name, []) if r["event_timestamp"] < at]
        for r in fresh:
            built[r[key]].append(r)

    stream = spark.readStream.schema(rows.drop("batch").schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = streams.refresh_on_batch(stream, str(tmp_path / "store"), str(tmp_path / "ck"), refresh, key)
    query.awaitTermination(180)
    assert query.exception() is None and spark.read.parquet(str(tmp_path / "store")).count() == len(data)
    whole = build(rows.drop("batch"))
    assert sorted(map(repr, (tuple(r) for part in built.values() for r in part))) == sorted(repr(tuple(r)) for r in whole.collect())


def test_a_refresh_reads_the_days_it_needs(spark, tmp_path):
    """A key's old days, and other keys' days, stay unread; a repeated batch adds nothing."""
    at = [datetime(2024, 1, day) for day in range(1, 11)]
    rows = spark.createDataFrame([(day, "/a", 200) for day in at] + [(at[0], "/b", 200)], "event_timestamp timestamp_ntz, api_path string, status_code int")
    days = rows.select(F.col("api_path").alias("_key"), F.to_date("event_timestamp").alias("event_date"))
    stored = rows.withColumn("event_date", F.to_date("event_timestamp"))
    new = stored.where("event_date = date'2024-01-10'")
    got, valid = streams._affected(stored, days, new, "api_path")
    assert sorted(r["event_timestamp"].day for r in got.collect()) == [7, 8, 9, 10]
    assert [tuple(r) for r in valid.collect()] == [("/a", datetime(2024, 1, 9))]
    assert streams._affected(stored, days, new.limit(0), "api_path") == (None, None)
