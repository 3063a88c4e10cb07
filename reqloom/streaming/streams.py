"""Streams: typed event envelopes, stateless checks, running means and hourly windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reqloom.functions import text
from reqloom.functions.measures import is_4xx, is_5xx, share, total, total_if
from reqloom.operators.consistency import check_rows
from reqloom.operators.quality import is_invalid, numeric_columns
from reqloom.operators.sla import SLA_LIMITS
from reqloom.operators.staging import stage
from reqloom.schemas import EVENT_ENVELOPE, SAFE_NAME


def read_envelopes(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to envelopes, each with `is_valid`: readable, and ids, type and source are safe names."""
    parsed = lines.select(F.from_json(column, EVENT_ENVELOPE).alias("e")).select("e.*")
    names = ("event_id", "event_type", "source")
    valid = F.lit(True)
    for name in names:
        valid = valid & text.matches(F.col(name), SAFE_NAME)
    return parsed.withColumns({"timestamp": text.parse_iso_utc(F.col("timestamp")), "is_valid": valid})


def read_request_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    """Newly arriving JSON-lines files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)


def check_stream(rows: DataFrame) -> DataFrame:
    """The row-consistency rules and the invalid-value check; both are stateless and run on a stream unchanged."""
    invalid = [F.when(is_invalid(c), F.lit(c)) for c in numeric_columns(rows)]
    checked = check_rows(rows)
    return checked.withColumn("invalid_columns", F.array_compact(F.array(*invalid)) if invalid else F.array())


def running_means(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Mean and count per key over all rows seen so far, for update or complete mode. The state is a sum and a count."""
    return rows.groupBy(key).agg(F.avg(value).alias("running_mean"), F.count(value).alias("running_count"))


def hourly_stream(requests: DataFrame, watermark: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Error and service-level counts per path and hour, emitted once the watermark passes.

    With `slide`, overlapping windows of one hour: an approximation of the exact rolling hour on stored rows.
    """
    timed = requests.withColumn("_at", F.col("event_timestamp").cast("timestamp"))
    hour = F.window("_at", "1 hour", slide) if slide else F.window("_at", "1 hour")
    one = F.lit(1).cast("bigint")
    return (
        timed.withWatermark("_at", watermark)
        .groupBy(hour, "api_path")
        .agg(
            total(one).alias("total_requests"),
            total_if(one, is_4xx()).alias("total_4xx"),
            total_if(one, is_5xx()).alias("total_5xx"),
            share(one, is_5xx()).alias("rate_5xx"),
            share(one, is_4xx()).alias("rate_4xx"),
            *[share(one, F.col("latency_ms") < limit).alias(name) for name, limit in SLA_LIMITS.items()],
        )
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("hour_ts"),
            F.col("window.end").cast("timestamp_ntz").alias("hour_end"),
            "api_path",
            "total_requests",
            "total_4xx",
            "total_5xx",
            "rate_5xx",
            "rate_4xx",
            *SLA_LIMITS,
        )
    )


def refresh_on_batch(
    requests: DataFrame,
    store: str,
    checkpoint: str,
    refresh: Callable[[DataFrame, DataFrame], None],
    key: str = "api_path",
) -> StreamingQuery:
    """Appends each micro-batch to the store, then calls `refresh(rows, valid_from)` with what it needs for exact results.

    A batch changes a key's rolling rows from its earliest request on, and the request before that, whose following one is
    new. `valid_from` has a row per key of the batch: `key`, and the time from which the key's rows of any rolling table
    built from `rows` equal those of the whole store; see `valid_rows`. Their look-backs (a day at most) and their previous
    requests are in `rows`, however long the key was silent and however late the batch is.

    The store is partitioned by day and batch; a repeated batch replaces its own partitions. Beside it, `store`_days lists
    each batch's keys and days, so that only days that are needed are read. Requests without a time are stored and take no
    part in a refresh.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dated = batch.withColumns({"event_date": F.to_date("event_timestamp"), "batch_id": F.lit(batch_id)})
        writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("event_date", "batch_id").parquet(store)
        schema = T.StructType([*batch.schema.fields, T.StructField("event_date", T.DateType()), T.StructField("batch_id", T.LongType())])
        stored = spark.read.schema(schema).parquet(store)
        new = stored.where((F.col("batch_id") == batch_id) & F.col("event_date").isNotNull())
        folder = f"{store.rstrip('/')}_days"
        new.select(F.col(key).alias("_key"), "event_date").distinct().write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
        days = spark.read.schema(T.StructType([T.StructField("_key", batch.schema[key].dataType), T.StructField("event_date", T.DateType())])).parquet(folder)
        rows, valid_from = _affected(stored, days, new, key)
        if valid_from is not None:
            refresh(rows.select(batch.columns), valid_from)

    return (
        requests.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _affected(stored: DataFrame, days: DataFrame, new: DataFrame, key: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Stored rows that the refresh of a batch needs, and per key the time from which results are whole.

    Per key: the day of the batch's earliest request, the two latest days with requests before it (they hold the request
    before and the one before that), and the day before the earliest of these, for its look-back. Nothing of the key lies
    between those days, so every day from there on is taken.
    """
    first = new.groupBy(F.col(key).alias("_key")).agg(F.min("event_timestamp").alias("_first"))
    first = stage(first)
    if first.isEmpty():
        return None, None
    known = days.select(F.col("_key").alias("_k"), "event_date").distinct()
    met = first.join(known, F.col("_key").eqNullSafe(F.col("_k")))
    earlier = F.sort_array(F.collect_set(F.when(F.col("event_date") < F.to_date("_first"), F.col("event_date"))), asc=False)
    since = F.date_sub(F.coalesce(F.get("_earlier", F.lit(1)), F.get("_earlier", F.lit(0)), F.to_date("_first")), 1)
    reach = met.groupBy("_key").agg(F.first("_first").alias("_first"), earlier.alias("_earlier")).select("_key", "_first", since.alias("_since"))
    reach = stage(reach)
    # as many dates as days are read
    wanted = reach.select(F.col("_key").alias("_a"), "_since").join(known, F.col("_a").eqNullSafe(F.col("_k")) & (F.col("event_date") >= F.col("_since")))
    dates = [row["event_date"] for row in wanted.select("event_date").distinct().collect()]
    near = stored.where(F.col("event_date").isin(dates))
    rows = near.join(reach, near[key].eqNullSafe(reach["_key"]) & (near["event_date"] >= reach["_since"]))
    before = F.max(F.when(F.col("event_timestamp") < F.col("_first"), F.col("event_timestamp")))
    valid = rows.groupBy("_key", "_first").agg(before.alias("_before"))
    return rows, stage(valid.select(F.col("_key").alias(key), F.coalesce("_before", "_first").alias("valid_from")))


def valid_rows(table: DataFrame, valid_from: DataFrame, key: str = "api_path") -> DataFrame:
    """The rows of a refreshed table that take the place of the stored ones: each key's from its `valid_from` on."""
    since = valid_from.select(F.col(key).alias("_key"), "valid_from")
    both = table.join(since, table[key].eqNullSafe(since["_key"]) & (F.col("event_timestamp") >= F.col("valid_from")))
    return both.select(*[table[name] for name in table.columns])
