"""Staged tables: intermediate results written once to the cluster's shared folder.

A staged table cuts lineage, survives lost executors, gives the optimiser its true size, and lets a plan be chosen by
that size. Only aggregated tables are staged, never the request rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest staged table that one task may sort as a whole.
SINGLE_TASK_ROWS = 1_000_000
# Largest staged table that may be broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024
# Rows of two numbers that one file of a staged table holds; each file costs its task process starts on local folders.
FILE_ROWS = 250_000

_ROW_BYTES = 64
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; where none is named, one in the warehouse, which is shared as well."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def new_path(spark: SparkSession) -> str:
    """A fresh path in the shared folder; what is written there goes when the session's JVM ends."""
    path = f"{shared_folder(spark)}/reqloom-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def stage(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Writes the frame to the shared folder and returns the written table.

    Where a bound of its `rows` is known, and they are short, they are dealt evenly to one file for each FILE_ROWS after the
    work on them is done; else every task writes a file.
    """
    path = new_path(df.sparkSession)
    df = df if rows is None else df.repartition(max(1, -(-rows // FILE_ROWS)))
    df.write.option("compression", "zstd").parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def unstage(*staged: DataFrame) -> None:
    """Deletes tables that `stage` returned; frames built on them can no longer be run."""
    for one in staged:
        context = one.sparkSession.sparkContext
        hadoop = context._jvm.org.apache.hadoop.fs.Path(one.staged_at)
        hadoop.getFileSystem(context._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go as soon as it has ended, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def staged_bytes(staged: DataFrame) -> int:
    """Upper estimate of a staged table's size in memory, from its row count and text lengths."""
    texts = [F.sum(F.octet_length(F.col(f"`{name}`"))) for name, kind in staged.dtypes if kind == "string"]
    row = staged.agg(F.count(F.lit(1)), *texts).first()
    return row[0] * _ROW_BYTES + sum(size or 0 for size in row[1:])
