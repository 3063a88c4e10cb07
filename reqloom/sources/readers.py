"""Log sources. Schemas are fixed, never inferred; any malformed record fails the load."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqloom.schemas import RAW_CSV, RAW_FLAT, RAW_LOG_ENTRY


class SourceError(ValueError):
    """A source was asked for in a way it does not support."""


def read_json(spark: SparkSession, path: str, schema: T.StructType = RAW_FLAT) -> DataFrame:
    """JSON files that hold one array of records or one record each; a file is one task, so prefer JSON lines."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = RAW_FLAT) -> DataFrame:
    """One record per line; blank lines are skipped. Files split across tasks."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_CSV) -> DataFrame:
    """CSV files with a header row each, matched by name: columns may come in any order, and be a part of the schema.

    Files are grouped by their header and each group is one scan; a column that a group lacks is null there, one that the
    schema lacks is text. A repeated name in a header fails, as does any malformed record.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for name, header in _headers(spark, path):
        if header:
            groups.setdefault(header, []).append(name)
    kinds = {field.name: field.dataType for field in schema.fields}
    union = None
    for header, names in sorted(groups.items()):
        if len(set(header)) < len(header):
            raise SourceError(f"a column is named twice in {names[0]}")
        present = T.StructType([T.StructField(name, kinds.get(name, T.StringType())) for name in header])
        reader = spark.read.schema(present).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
        rows = reader.csv(names)
        union = rows if union is None else union.unionByName(rows, allowMissingColumns=True)
    if union is None:
        return spark.createDataFrame([], schema)
    return union


def _headers(spark: SparkSession, path: str) -> list[tuple[str, tuple[str, ...]]]:
    """Each file below the path and its column names; an empty file has none. A file's first line is all that is read."""
    names = [row["path"] for row in spark.read.format("binaryFile").load(path).select("path").collect()]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(name: str) -> str | None:
        at = jvm.org.apache.hadoop.fs.Path(name)
        stream = at.getFileSystem(conf).open(at)
        codec = codecs.getCodec(at)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            return lines.readLine()
        finally:
            lines.close()

    with ThreadPoolExecutor(16) as pool:
        found = list(pool.map(first_line, names))
    return [(name, tuple(next(csv.reader([line.removeprefix("\ufeff")]))) if line else ()) for name, line in zip(names, found)]


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_log_entries(spark: SparkSession, path: str, predicate: str) -> DataFrame:
    """All exported log entries (JSON lines) that satisfy a Spark SQL predicate."""
    return read_jsonl(spark, path, RAW_LOG_ENTRY).where(F.expr(predicate))


def read_logs(spark: SparkSession, source: str, path: str | None = None, predicate: str | None = None) -> DataFrame:
    """Source by name: `cloud` (exported log entries, needs a predicate), `json`, `jsonl`, `csv` or `parquet`."""
    readers = {"json": read_json, "jsonl": read_jsonl, "csv": read_csv, "parquet": read_parquet}
    if source == "cloud" and not predicate:
        raise SourceError("a predicate is required when source is 'cloud'")
    if not path:
        raise SourceError("a path is required")
    if source == "cloud":
        return read_log_entries(spark, path, predicate)
    if source not in readers:
        raise SourceError(f"Unsupported source: {source}")
    return readers[source](spark, path)
