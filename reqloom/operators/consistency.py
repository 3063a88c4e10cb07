"""Row consistency: every rule judges every row, in one pass without a shuffle.

Each row gets an array of issues. Rules work on the columns that are there; a null value breaks only the rule that
requires the field. Text columns are normalised first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqloom.functions import text
from reqloom.schemas import ERROR, ISSUE, MAX_ERROR_RATIO, RATE_TOLERANCE, RULES, WARNING

REQUIRED = ("timestamp", "endpoint", "status_code")


class ConsistencyError(ValueError):
    """The data did not pass a strict check."""


def normalize_rows(df: DataFrame) -> DataFrame:
    """Text columns trimmed, lower-cased and with single spaces; items of text lists trimmed and lower-cased."""
    changed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            changed[field.name] = text.normalize_text(F.col(field.name))
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            changed[field.name] = text.normalize_items(F.col(field.name))
    return df.withColumns(changed) if changed else df


def completeness(columns: Sequence[str]) -> Column:
    """Share of non-null fields; zero when there are no fields."""
    if not columns:
        return F.lit(0.0)
    filled = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns])
    return filled / F.lit(len(columns))


def repeated_values(df: DataFrame) -> Column:
    """Values of a row's scalar fields that an earlier field of the row already holds, as text, in the fields' order.

    Numbers and booleans compare by number whatever their type, texts with texts, times with times, null with null. The
    fields are sorted once by kind, value and place, and each is compared with the one before it, so the work and the plan
    grow with the number of fields and not with that of their pairs.
    """
    fields = _scalars(df)
    if len(fields) < 2:
        return F.array().cast("array<string>")
    tagged = [F.struct(_canonical(f).alias("key"), F.lit(i).alias("place"), _as_text(f).alias("text")) for i, f in enumerate(fields)]
    ordered = F.array_sort(F.array(*tagged))
    shifted = F.concat(F.array(F.lit(None).cast("struct<key:string,place:int,text:string>")), F.slice(ordered, 1, len(fields) - 1))
    again = F.zip_with(ordered, shifted, lambda one, before: F.when(one["key"] == before["key"], F.struct(one["place"], one["text"])))
    return F.transform(F.array_sort(F.array_compact(again)), lambda one: one["text"])


def _has_repeats(df: DataFrame) -> Column | None:
    fields = _scalars(df)
    if len(fields) < 2:
        return None
    return F.size(F.array_distinct(F.array(*[_canonical(f) for f in fields]))) < len(fields)


def _scalars(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]


def _family(field: T.StructField) -> str:
    if isinstance(field.dataType, (T.BooleanType, T.NumericType)):
        return "number"
    return "text" if isinstance(field.dataType, T.StringType) else field.dataType.typeName()


def _canonical(field: T.StructField) -> Column:
    """Kind and value as one text, equal for equal values only; NaN equals nothing, so it takes the field's name."""
    column, kind = F.col(f"`{field.name}`"), _family(field)
    value = _as_text(field)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        value = F.when(F.isnan(column.cast("double")), F.lit(f"NaN of {field.name}")).otherwise(value)
    return F.when(column.isNull(), F.lit("null")).otherwise(F.concat(F.lit(f"{kind}:"), value))


def _as_text(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BooleanType):
        text_value = column.cast("int").cast("string")
    elif isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        value = column.cast("double")
        whole = (value == F.floor(value)) & (F.abs(value) < F.lit(9.0e18))
        text_value = F.when(whole, F.floor(value).cast("string")).otherwise(value.cast("string"))
    elif isinstance(field.dataType, T.BinaryType):
        text_value = F.hex(column)
    else:
        text_value = column.cast("string")
    return F.coalesce(text_value, F.lit("null"))


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule where `broken` is true; `subject` completes the message."""

    name: str
    broken: Column
    subject: str = ""
    details: Mapping[str, Column] = field(default_factory=dict)

    @property
    def level(self) -> str:
        return RULES[self.name][0]

    def is_broken(self) -> Column:
        return F.coalesce(self.broken, F.lit(False))

    def issue(self) -> Column:
        pairs = [part for name, value in self.details.items() for part in (F.lit(name), value.cast("string"))]
        details = F.create_map(*pairs) if pairs else F.create_map()
        issue = F.struct(
            F.lit(self.name).alias("rule"),
            F.lit(self.level).alias("level"),
            F.lit(RULES[self.name][1].format(self.subject)).alias("message"),
            details.cast("map<string,string>").alias("details"),
        )
        return F.when(self.broken, issue)


def row_rules(rows: DataFrame) -> list[Rule]:
    """The rules that apply to the columns of normalised rows, in the order they are reported."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}

    def number(name: str) -> Column | None:
        if name not in kinds:
            return None
        if isinstance(kinds[name], T.NumericType):
            return F.col(name).cast("double")
        if isinstance(kinds[name], T.StringType):
            return F.col(name).try_cast("double")
        return F.lit(None).cast("double")

    rules = []
    for name in REQUIRED:
        missing = F.col(name).isNull() if name in kinds else F.lit(True)
        rules.append(Rule("schema", missing, name))

    if "timestamp" in kinds and not isinstance(
        kinds["timestamp"], (T.StringType, T.TimestampType, T.TimestampNTZType, T.DateType)
    ):
        wrong = F.col("timestamp").isNotNull()
        rules.append(Rule("type_timestamp", wrong))
    code, latency = number("status_code"), number("latency")
    total, success, rate = number("total_requests"), number("success_requests"), number("success_rate")
    if code is not None and not isinstance(kinds["status_code"], T.IntegralType):
        is_text = isinstance(kinds["status_code"], T.StringType)
        whole = F.col("status_code").try_cast("bigint") if is_text else F.lit(None)
        wrong = F.col("status_code").isNotNull() & whole.isNull()
        rules.append(Rule("type_status_code", wrong))
    if latency is not None:
        unreadable = F.col("latency").isNotNull() & latency.isNull()
        if not isinstance(kinds["latency"], T.NumericType):
            rules.append(Rule("type_latency", unreadable))

    has_counts = all(c is not None for c in (total, success, rate))
    if has_counts:
        computed = F.try_divide(success, total)
        apart = (total > 0) & ~F.isnan(rate) & (F.abs(computed - rate) > RATE_TOLERANCE)
        rules.append(Rule("cross_success_rate", apart))
    if code is not None:
        rules.append(Rule("business_status_code", ~code.between(100, 599)))
    if latency is not None:
        rules.append(Rule("business_latency", latency < 0))
        rules.append(Rule("metric_latency", unreadable | (latency < 0)))
    if rate is not None:
        rules.append(Rule("metric_success_rate", ~rate.between(0, 1)))
    if total is not None and success is not None:
        rules.append(Rule("metric_counts", success > total))
    if has_counts:
        details = {"computed": computed, "reported": rate}
        rules.append(Rule("metric_consistency", apart, details=details))
    repeats = _has_repeats(rows)
    if repeats is not None:
        details = {"values": F.array_join(repeated_values(rows), ", ")}
        rules.append(Rule("duplicates", repeats, details=details))
    return rules


def check_rows(df: DataFrame) -> DataFrame:
    """Normalised rows with their `issues` and `quality_score`. Map-only, so it also runs on a stream."""
    rows = normalize_rows(df)
    return rows.select(
        "*",
        F.array_compact(F.array(*[rule.issue() for rule in row_rules(rows)])).alias("issues"),
        completeness(rows.columns).alias("quality_score"),
    )


def issue_counts(df: DataFrame) -> DataFrame:
    """Rows per broken rule. One aggregate counts all rules; no issue lists are built."""
    rows = normalize_rows(df)
    rules = row_rules(rows)
    counts = rows.agg(*[F.count_if(rule.is_broken()).alias(f"_{i}") for i, rule in enumerate(rules)])
    long = counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(r.name).alias("rule"), F.lit(r.level).alias("level"), F.col(f"_{i}").alias("n_rows"))
                    for i, r in enumerate(rules)
                ]
            )
        )
    )
    return long.groupBy("rule", "level").agg(F.sum("n_rows").alias("n_rows")).where(F.col("n_rows") > 0)


def _broken_count(rules: list[Rule], level: str) -> Column:
    ones = [rule.is_broken().cast("int") for rule in rules if rule.level == level]
    return reduce(lambda a, b: a + b, ones, F.lit(0))


def consistency_report(df: DataFrame, strict: bool = False, path: str | None = None) -> DataFrame:
    """One row: is_consistent, errors, warnings, rows, error_ratio, quality_score, file. Strict raises on any error."""
    rows = normalize_rows(df)
    rules = row_rules(rows)
    judged = rows.select(
        _broken_count(rules, ERROR).alias("_errors"),
        _broken_count(rules, WARNING).alias("_warnings"),
        completeness(rows.columns).alias("_score"),
    )
    report = judged.agg(
        F.coalesce(F.sum("_errors"), F.lit(0)).alias("errors"),
        F.coalesce(F.sum("_warnings"), F.lit(0)).alias("warnings"),
        F.count(F.lit(1)).alias("n_rows"),
        F.avg((F.col("_errors") > 0).cast("int")).alias("error_ratio"),
        F.avg("_score").alias("quality_score"),
    ).select(
        (F.col("errors") == 0).alias("is_consistent"),
        "errors",
        "warnings",
        "n_rows",
        "error_ratio",
        "quality_score",
        F.lit(path).cast("string").alias("file"),
    )
    if strict and report.first()["errors"]:
        raise ConsistencyError("Data consistency failed")
    return report


def passes_error_gate(df: DataFrame, max_error_ratio: float = MAX_ERROR_RATIO) -> bool:
    """True when at most this share of rows has an error."""
    if not 0 <= max_error_ratio <= 1:
        raise ValueError("max_error_ratio must be between 0 and 1")
    return (consistency_report(df).first()["error_ratio"] or 0.0) <= max_error_ratio


def check_input_file(spark: SparkSession, path: str) -> DataFrame:
    """Issues of an input path: missing, or a folder where one file is expected."""
    issues = []
    try:
        files = spark.read.format("binaryFile").load(path).select("path").limit(2)
        named = [row["path"] for row in files.collect()]
        if not (len(named) == 1 and named[0].rstrip("/").endswith("/" + path.rstrip("/").rsplit("/", 1)[-1])):
            issues.append(("file_type", *RULES["file_type"], {}))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        issues.append(("file_exists", *RULES["file_exists"], {"file": path}))
    return spark.createDataFrame(issues, ISSUE)
