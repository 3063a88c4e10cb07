"""Stored tables that are replaced, whole or by day, without a moment in which rows are missing.

A table's folder holds its parts, each in a folder of its own that is written once, and a manifest that names the parts
in use. Writers add parts first and put the new manifest in the old one's place last, by a rename. So a reader has either
the old table or the new one, and a job that dies on the way leaves the old. A part stays for one more manifest after the
last that names it, as readers may still hold it, and is then deleted; what a dead job wrote is left. A table has one writer
at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "_manifest.json"
WHOLE = "whole"
NO_DAY = "none"


class VersionError(ValueError):
    """The folder holds no table."""


def _files(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system and context of a folder, and its path."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder, conf = hadoop.Path(path), spark.sparkContext._jsc.hadoopConfiguration()
    return folder.getFileSystem(conf), hadoop.FileContext.getFileContext(folder.toUri(), conf), folder


def _read(spark: SparkSession, path: str) -> dict | None:
    files, _, folder = _files(spark, path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, MANIFEST)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, parts: Mapping[str, str], schema: T.StructType) -> None:
    """Puts a manifest in place, then deletes parts that neither it nor the one before names."""
    before = _read(spark, path)
    files, context, folder = _files(spark, path)
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    kept = sorted(before["parts"].values()) if before else []
    text = json.dumps({"parts": dict(parts), "schema": schema.jsonValue(), "before": kept})
    draft = fs.Path(folder, f"{MANIFEST}.{uuid.uuid4().hex}")
    stream = files.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    overwrite = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(draft, fs.Path(folder, MANIFEST), overwrite)
    for name in set(before["before"] if before else []) - set(kept) - set(parts.values()):
        files.delete(fs.Path(folder, name), True)


def replace(df: DataFrame, path: str) -> DataFrame:
    """Replaces the whole table and returns it."""
    spark, name = df.sparkSession, f"part-{uuid.uuid4().hex}"
    df.write.parquet(f"{path.rstrip('/')}/{name}")
    _publish(spark, path, {WHOLE: name}, df.schema)
    return read(spark, path)


def replace_days(df: DataFrame, path: str, day: str, days: Iterable[date] | None = None) -> DataFrame:
    """Replaces the rows of some days, or all rows by day, and returns the whole table.

    `day` names a date or time column of `df`. With `days`, rows on other days are left out, and a listed day without rows
    loses its own; rows without a day are replaced with the whole table only. A table that was replaced as a whole has no
    days: it has to be replaced by day once, without `days`.
    """
    spark, name = df.sparkSession, f"part-{uuid.uuid4().hex}"
    wanted = None if days is None else sorted(set(days))
    before = _read(spark, path)
    if wanted is not None and before and WHOLE in before["parts"]:
        raise VersionError(f"{path} was replaced as a whole, so its days cannot be replaced")
    dated = df.withColumn("_day", F.coalesce(F.to_date(day).cast("string"), F.lit(NO_DAY)))
    chosen = dated if wanted is None else dated.where(F.col("_day").isin([d.isoformat() for d in wanted]))
    chosen.write.partitionBy("_day").parquet(f"{path.rstrip('/')}/{name}")
    fs, (files, _, folder) = spark.sparkContext._jvm.org.apache.hadoop.fs, _files(spark, path)
    found = [status.getPath().getName() for status in files.listStatus(fs.Path(folder, name))]
    parts = {key: part for key, part in (before["parts"] if before and wanted is not None else {}).items() if date_of(key) not in wanted}
    parts |= {one.removeprefix("_day="): f"{name}/{one}" for one in found if one.startswith("_day=")}
    _publish(spark, path, parts, df.schema)
    return read(spark, path)


def date_of(key: str) -> date | None:
    return None if key in (NO_DAY, WHOLE) else date.fromisoformat(key)


def is_stored(spark: SparkSession, path: str) -> bool:
    return _read(spark, path) is not None


def parts_of(spark: SparkSession, path: str) -> dict[str, str]:
    """The folders in use, by day or under `whole`."""
    found = _read(spark, path)
    if found is None:
        raise VersionError(f"no table in {path}")
    return {key: f"{path.rstrip('/')}/{name}" for key, name in found["parts"].items()}


def read(spark: SparkSession, path: str, days: Iterable[date] | None = None) -> DataFrame:
    """The table as its manifest stands now, or some of its days; later replacements do not change what was read."""
    found = _read(spark, path)
    if found is None:
        raise VersionError(f"no table in {path}")
    schema = T.StructType.fromJson(found["schema"])
    names = {key: name for key, name in found["parts"].items() if days is None or key in {d.isoformat() for d in days}}
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*[f"{path.rstrip('/')}/{name}" for name in names.values()])
