"""Exact rolling counts per row for keys that may hold a large part of all rows.

A `RANGE BETWEEN INTERVAL 1 HOUR PRECEDING` window would put all rows of a key in one task and re-add the whole hour for
each row. Here time is cut into buckets. For a row in bucket b and a look-back of L buckets,

    rolling = total of buckets b-L .. b-1  -  part of bucket b-L before the look-back  +  part of bucket b up to the row

The totals come from one small aggregate per (key, bucket). The two parts are running sums inside one bucket, once a
copy of each row, moved forward by the look-back, is placed in the bucket that will subtract it. One shuffle by
(key, bucket) and one running sum therefore give every look-back at once, and a hot key spreads over its buckets.

Rows of one key and instant share their sums, so they are counted first, on the map side, and the instant with its number
of rows is what is copied and summed; it becomes rows again at the end. A bucket holds as many instants as its clock has,
60,000 a minute in milliseconds, however many rows share them.

Keys with few rows need no buckets: WHOLE_KEY makes one bucket of all time, without totals and edges. `split_busy` tells
the two kinds of key apart.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqloom.operators import staging

BUCKET_SECONDS = 60
WHOLE_KEY = 0

# Rows of one key that one task may sort.
ROWS_PER_KEY = 5_000_000
ROWS_AT_ONCE = 65_536

# A null key is a group of its own: (key is null, key or '') never holds a null.
_KEY = ["_key_null", "_key"]
_BUCKET = "_bucket"
_CELL = [*_KEY, _BUCKET]
_NO_TIME = -(2**62)


@dataclass(frozen=True)
class Lookback:
    """Names of the two sums over the last `seconds` seconds, the row and its peers included."""

    seconds: int
    count_name: str
    flagged_name: str


def bucket_of(ts: Column, seconds: int) -> Column:
    """Number of the bucket that holds a timestamp; does not depend on the session zone."""
    if seconds == WHOLE_KEY:
        return F.lit(0).cast("bigint")
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    second_of_day = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    number = F.floor((days * 86400 + second_of_day) / F.lit(seconds)).cast("bigint")
    return F.coalesce(number, F.lit(_NO_TIME).cast("bigint"))


def keyed(rows: DataFrame, key: str, ts: str, bucket_seconds: int, **columns: Column) -> DataFrame:
    """Rows reduced to key, bucket, time and the given columns."""
    return rows.select(
        F.col(key).isNull().alias(_KEY[0]),
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias(_KEY[1]),
        bucket_of(F.col(ts), bucket_seconds).alias(_BUCKET),
        F.col(ts).alias("_ts"),
        *[column.alias(name) for name, column in columns.items()],
    )


def by_cell(rows: DataFrame) -> DataFrame:
    """One shuffle by key and bucket for everything above it: what the windows and the edges of `neighbours` read is
    the same exchange, which Spark then runs once."""
    return rows.repartition(*_CELL)


def split_busy(
    rows: DataFrame, key: str, rows_per_key: int = ROWS_PER_KEY, broadcast_bytes: int = staging.BROADCAST_BYTES
) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of ordinary keys and rows of keys with more than `rows_per_key` rows; None where there are none.

    The busy keys are few, at most rows / rows_per_key, and are broadcast after their size is checked; should they be
    too large for that, all rows count as busy.
    """
    counts = rows.groupBy(F.col(key).alias("_busy")).agg(F.count(F.lit(1)).alias("_rows"))
    busy = staging.stage(counts.where(F.col("_rows") > rows_per_key).select("_busy"))
    if busy.isEmpty():
        return rows, None
    if staging.staged_bytes(busy) > broadcast_bytes:
        return None, rows
    condition = rows[key].eqNullSafe(busy["_busy"])
    return tuple(rows.join(F.broadcast(busy), condition, how) for how in ("left_anti", "left_semi"))


def key_column() -> Column:
    return F.when(~F.col(_KEY[0]), F.col(_KEY[1]))


def rolling_counts(
    rows: DataFrame,
    key: str,
    ts: str,
    flagged: Column,
    lookbacks: Sequence[Lookback],
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Per row: how many rows, and how many flagged ones, of the same key lie in each look-back.

    `flagged` is 0 or 1. Returns the internal key and bucket columns, `_ts` and the sums; see `key_column`.
    """
    return as_rows(rolling_instants(rows, key, ts, flagged, lookbacks, bucket_seconds))


def rolling_instants(
    rows: DataFrame,
    key: str,
    ts: str,
    flagged: Column,
    lookbacks: Sequence[Lookback],
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """As `rolling_counts`, one row per key and instant with the number of its rows, `_rows`; see `as_rows`."""
    in_buckets = bucket_seconds != WHOLE_KEY
    if in_buckets and any(lookback.seconds % bucket_seconds for lookback in lookbacks):
        raise ValueError("a look-back must be a whole number of buckets")
    each = keyed(rows, key, ts, bucket_seconds, _x=flagged)
    base = each.groupBy(*_CELL, "_ts").agg(F.count(F.lit(1)).alias("_n"), F.sum("_x").alias("_x"))

    # kind 0: the instant itself; i: its copy moved forward by look-back i; -i: bucket totals of look-back i
    moved = base.select(
        *_KEY,
        F.inline(
            F.array(
                _cell(F.lit(0), F.col(_BUCKET), F.col("_ts"), F.col("_n"), F.col("_x")),
                *[
                    _cell(
                        F.lit(i),
                        F.col(_BUCKET) + (lookback.seconds // bucket_seconds if in_buckets else 0),
                        F.col("_ts") + F.expr(f"INTERVAL {lookback.seconds} SECOND"),
                        F.col("_n"),
                        F.col("_x"),
                    )
                    for i, lookback in enumerate(lookbacks, 1)
                ],
            )
        ),
    )
    if in_buckets:
        moved = moved.unionByName(_bucket_totals(each, lookbacks, bucket_seconds))
    placed = by_cell(moved)

    # Bucket totals sort first, then rows up to the same instant, then the copies that leave after it.
    phase = F.when(F.col("_kind") < 0, -1).when(F.col("_kind") == 0, 0).otherwise(1)
    upto = Window.partitionBy(*_CELL).orderBy(F.col("_ts").asc_nulls_first(), phase)
    sums = []
    for i, lookback in enumerate(lookbacks, 1):
        for name, column in ((lookback.count_name, "_n"), (lookback.flagged_name, "_x")):
            signed = (
                F.when(F.col("_kind").isin(0, -i), F.col(column))
                .when(F.col("_kind") == i, -F.col(column))
                .otherwise(F.lit(0))
            )
            sums.append(F.sum(signed).over(upto).alias(name))
    return placed.select(*_CELL, "_ts", F.col("_n").alias("_rows"), "_kind", *sums).where(F.col("_kind") == 0).drop("_kind")


def as_rows(instants: DataFrame, value: str | None = None, previous: str | None = None, following: str | None = None) -> DataFrame:
    """A row for each of an instant's rows. Of rows that share an instant, only the first has the instant before as its
    previous row, and only the last the one after as its following row; for the others both hold the own `value`.

    Numbers are made in two steps, so that an instant of billions of rows is no array of that length.
    """
    last = F.floor((F.col("_rows") - 1) / ROWS_AT_ONCE).cast("bigint")
    parts = instants.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    first = F.col("_part") * ROWS_AT_ONCE + 1
    rows = parts.withColumn("_place", F.explode(F.sequence(first, F.least(first + (ROWS_AT_ONCE - 1), F.col("_rows")))))
    edges = {previous: F.col("_place") == 1, following: F.col("_place") == F.col("_rows")}
    sides = {name: F.when(edge, F.col(name)).otherwise(F.col(value)) for name, edge in edges.items() if name}
    return rows.withColumns(sides).drop("_rows", "_part", "_place") if sides else rows.drop("_rows", "_part", "_place")


def _cell(kind: Column, bucket: Column, ts: Column, n: Column, x: Column) -> Column:
    return F.struct(
        kind.cast("int").alias("_kind"),
        bucket.cast("bigint").alias(_BUCKET),
        ts.cast("timestamp_ntz").alias("_ts"),
        n.cast("bigint").alias("_n"),
        x.cast("bigint").alias("_x"),
    )


def _bucket_totals(base: DataFrame, lookbacks: Sequence[Lookback], bucket_seconds: int) -> DataFrame:
    """Per non-empty bucket b and look-back of L buckets: the totals of buckets b-L .. b-1.

    Running sums that end at b-1 and at b-L-1 are subtracted, so a key costs one pass over its non-empty buckets.
    """
    totals = base.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("_n"), F.sum("_x").alias("_x"))
    by_bucket = Window.partitionBy(*_KEY).orderBy(_BUCKET)

    def until(column: str, back: int) -> Column:
        return F.coalesce(F.sum(column).over(by_bucket.rangeBetween(Window.unboundedPreceding, -back)), F.lit(0))

    spans = []
    for lookback in lookbacks:
        buckets = lookback.seconds // bucket_seconds
        spans += [until(c, 1) - until(c, buckets + 1) for c in ("_n", "_x")]
    named = totals.select(*_CELL, *[span.alias(f"_s{i}") for i, span in enumerate(spans)])
    no_time = F.lit(None).cast("timestamp_ntz")
    return named.select(
        *_KEY,
        F.inline(
            F.array(
                *[
                    _cell(F.lit(-i), F.col(_BUCKET), no_time, F.col(f"_s{2 * i - 2}"), F.col(f"_s{2 * i - 1}"))
                    for i in range(1, len(lookbacks) + 1)
                ]
            )
        ),
    )


def neighbours(
    rows: DataFrame,
    value: str,
    previous: str | None = None,
    following: str | None = None,
    tiebreak: str | None = None,
    also_read: Sequence[str] = (),
    whole_key: bool = False,
) -> DataFrame:
    """Value of the previous and following row of the same key in time order.

    Inside a bucket this is LAG and LEAD; the first and last row of a bucket take theirs from the edge of the nearest
    non-empty bucket, found in a table of one row per (key, bucket). `rows` come from `by_cell`; `also_read` names the
    columns of theirs that `value` does not depend on but the result does, so that both sides read the same exchange.
    With `whole_key` all rows of a key are in one bucket, and LAG and LEAD are all there is.
    """
    order = ["_ts", *([tiebreak] if tiebreak else [])]
    by_time = Window.partitionBy(*_CELL).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    if whole_key:
        named = {previous: F.lag, following: F.lead}
        return rows.select("*", *[fn(value).over(by_time).alias(name) for name, fn in named.items() if name])
    instant, seen = F.struct(*order), F.struct(F.col(value).alias("v"), *also_read)
    edges = rows.groupBy(*_CELL).agg(F.min_by(seen, instant).alias("_first"), F.max_by(seen, instant).alias("_last"))
    by_bucket = Window.partitionBy(*_KEY).orderBy(_BUCKET)
    edges = edges.select(
        *_CELL,
        F.lag("_last").over(by_bucket)["v"].alias("_edge_previous"),
        F.lead("_first").over(by_bucket)["v"].alias("_edge_following"),
    )
    sides: Mapping[str, tuple] = {previous: (F.lag, "_edge_previous"), following: (F.lead, "_edge_following")}
    wanted = {name: side for name, side in sides.items() if name}
    looked = rows.select(
        "*",
        *[fn(value).over(by_time).alias(f"_in_{name}") for name, (fn, _) in wanted.items()],
        *[fn(F.lit(True)).over(by_time).alias(f"_has_{name}") for name, (fn, _) in wanted.items()],
    )
    joined = looked.join(edges, _CELL)
    return joined.select(
        *rows.columns,
        *[
            F.when(F.col(f"_has_{name}"), F.col(f"_in_{name}")).otherwise(F.col(edge)).alias(name)
            for name, (_, edge) in wanted.items()
        ],
    )


def running_mean(requests: DataFrame, key: str, value: str) -> DataFrame:
    """Mean of a key's values up to and including each request, in time order.

    Sums of earlier minutes come from one row per (key, minute); inside a minute a window adds the rows.
    """
    rows = keyed(
        requests, key, "event_timestamp", BUCKET_SECONDS, trace=F.col("trace"), _v=F.col(value).cast("double")
    )
    by_bucket = Window.partitionBy(*_KEY).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*_CELL).agg(F.count("_v").alias("_n"), F.sum("_v").alias("_s"))
    offsets = totals.select(
        *_CELL,
        F.coalesce(F.sum("_n").over(by_bucket), F.lit(0)).alias("_n"),
        F.coalesce(F.sum("_s").over(by_bucket), F.lit(0.0)).alias("_s"),
    )
    inside = (
        Window.partitionBy(*_CELL).orderBy("_ts", "trace").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.select(
        "*",
        F.count("_v").over(inside).alias("_in_n"),
        F.coalesce(F.sum("_v").over(inside), F.lit(0.0)).alias("_in_s"),
    )
    count = F.col("_n") + F.col("_in_n")
    return local.join(offsets, _CELL).select(
        F.col("_ts").alias("event_timestamp"),
        key_column().alias(key),
        "trace",
        count.alias("running_count"),
        F.try_divide(F.col("_s") + F.col("_in_s"), count).alias("running_mean"),
    )


def update_running_means(state: DataFrame, batch: DataFrame, key: str, value: str) -> DataFrame:
    """Stored means per key (`key`, `running_mean`, `running_count`) after the values of a batch.

    The batch is summed per key first, so each key meets its state once. A negative stored count fails the job.
    """
    new = batch.groupBy(F.col(key).alias("_new_key")).agg(
        F.coalesce(F.sum(F.col(value).cast("double")), F.lit(0.0)).alias("_sum"), F.count(value).alias("_count")
    )
    stored = state.select(
        F.col(key),
        F.col("running_mean"),
        F.when(F.col("running_count") < 0, F.raise_error(F.lit("Count must be >= 0")).cast("bigint"))
        .otherwise(F.col("running_count"))
        .alias("running_count"),
    )
    joined = stored.join(new, stored[key].eqNullSafe(new["_new_key"]), "full")
    old_count = F.coalesce(F.col("running_count"), F.lit(0))
    new_count = F.coalesce(F.col("_count"), F.lit(0))
    count = old_count + new_count
    mean = F.coalesce(F.col("running_mean"), F.lit(0.0))
    shift = F.coalesce(F.col("_sum"), F.lit(0.0)) - mean * new_count
    return joined.select(
        F.coalesce(F.col(key), F.col("_new_key")).alias(key),
        F.when(count > 0, mean + F.coalesce(F.try_divide(shift, count), F.lit(0.0))).alias("running_mean"),
        count.alias("running_count"),
    )
