"""Personal data: broad generators propose spans, boosted trees judge them, calibrated thresholds pick redactions.

Base spans follow fixed patterns and checks and are always kept. Generators propose further, overlapping spans per kind:
looser separators, missing prefixes, spelled-out signs. Proposals that meet a base span of their kind, or are evident in
another way (see `evident`), are the positive examples, the others the negative ones; trees learn from format and context.
Per kind, all proposals of a part that the trees did not learn from set the least score at which the wanted precision holds;
proposals beside the base spans at or above it are added. Texts stay in their tasks, only proposals move.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqloom.operators.staging import stage

KINDS = ("email", "ip", "card", "phone")
MAX_EXAMPLES = 20_000
PRECISION = 0.98
TREES, TREE_DEPTH = 10, 4

# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: The same matches without trying anew inside a run of digits: a match begins at a run's start and takes whole runs.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_HOST = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"

_WIDE = (
    re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63})+"),
    re.compile(r"[0-9]{1,4}(?:[.,:][0-9]{1,4}){3}"),
    re.compile(r"[0-9](?:[\x20./-]?[0-9]){11,18}"),
    re.compile(r"(?:\+|00|\()?[0-9](?:[\x20().-]{0,2}[0-9]){6,14}"),
)
_MARK, _DOT = re.compile(r"@|\(at\)|\[at\]"), re.compile(r"\(dot\)|\[dot\]")
_HINTS = (("mail", "contact", "@"), ("ip", "host", "server", "addr"), ("card", "visa", "credit", "pay"), ("phone", "tel", "call", "mobile", "fax"))


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn check."""
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every base span, in order."""
    # what precedes an at sign has none itself, so each sign has one run of signs before it, and the end of the match before
    out, at, last = [], text.find("@"), 0
    while at >= 0:
        start = last + len(text[last:at].rstrip(_LOCAL))
        found = _HOST.match(text, at + 1) if start < at else None
        if found:
            out.append((start, 0, found.end()))
        last = found.end() if found else at + 1
        at = text.find("@", last)
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = re.sub(r"[\x20-]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def proposals(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every proposed span."""
    out, done = [], 0
    for mark in _MARK.finditer(text):
        if mark.start() >= done:
            for m in _WIDE[0].finditer(text, max(done, mark.start() - 66), min(len(text), mark.end() + 300)):
                if m.end() > done:
                    out.append((m.start(), 0, m.end()))
                    done = m.end()
    for kind in (1, 2, 3):
        out += [(m.start(), kind, m.end()) for m in _WIDE[kind].finditer(text)]
    return sorted(out)


def evident(text: str, start: int, kind: int, end: int) -> bool:
    """Whether a proposed span is personal data by evidence that the base patterns do not ask for: a form that becomes a
    base match once its signs are written out, checked digits between any separators, or a word that announces it."""
    span, before = text[start:end], text[max(0, start - 40) : start].lower()
    hinted = any(hint in before for hint in _HINTS[kind])
    digits = "".join(c for c in span if "0" <= c <= "9")
    if kind == 0:
        return EMAIL.fullmatch(_DOT.sub(".", _MARK.sub("@", span)).replace(" ", "")) is not None
    if kind == 1:
        return all(int(part) <= 255 for part in re.split("[.,:]", span)) and (span.count(".") == 3 or hinted)
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and (span[0] == "+" or hinted)


def described(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context of a span as numbers."""
    span, before = text[start:end], text[max(0, start - 40) : start].lower()
    groups = [len(g) for g in re.findall(r"[0-9]+", span)] or [0]
    digits = sum(groups)
    sides = [text[start - 1 : start], text[end : end + 1]]
    return [
        float(kind), end - start, digits, len(groups), max(groups), min(groups), groups[0], groups[-1],
        len(set(re.findall("[0-9]", span))), sum(c.isalpha() for c in span), span.count("."), span.count("-"), span.count(" "), span.count("("),
        float(span[:1] == "+"), float(span[:1] == "0"), *[float(any(hint in before for hint in hints)) for hints in _HINTS],
        *[float(side.isalnum()) + 2.0 * (side in ".,+-/:#_=") for side in sides if True],
    ]


def read(docs: DataFrame) -> DataFrame:
    """doc_id, `row`, `base` (list of start, kind, end) and `proposed` (the same, `met`: meets a base span, `good`: does, or
    is evident otherwise, `x`: features)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = [("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]
        kinds = pa.list_(pa.struct(span)), pa.list_(pa.struct([*span, ("met", pa.bool_()), ("good", pa.bool_()), ("x", pa.list_(pa.float64()))]))
        for batch in batches:
            base, proposed = [], []
            for text in batch.column("_text").to_pylist():
                text = text or ""
                found = base_spans(text)
                more = []
                of_kind = [[(s, e) for s, k, e in found if k == kind] for kind in range(len(KINDS))]
                for start, kind, end in proposals(text):
                    # spans of a kind do not overlap, so the last that starts before the end is the one to be met
                    at = bisect_left(of_kind[kind], (end,)) - 1
                    met = at >= 0 and of_kind[kind][at][1] > start
                    good = met or evident(text, start, kind, end)
                    more.append({"start": start, "kind": kind, "end": end, "met": met, "good": good, "x": described(text, start, kind, end)})
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in found])
                proposed.append(more)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(base, kinds[0]), pa.array(proposed, kinds[1])], names=["doc_id", "row", "base", "proposed"])

    source = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.col("text").alias("_text"))
    kind = dict(source.dtypes)["doc_id"]
    span = "start: long, kind: int, end: long"
    return source.mapInArrow(run, f"doc_id {kind}, row long, base array<struct<{span}>>, proposed array<struct<{span}, met: boolean, good: boolean, x: array<double>>>")


def train(rows: DataFrame, max_examples: int = MAX_EXAMPLES) -> tuple[GBTClassificationModel | None, dict[int, float]]:
    """The trees, learnt from at most about `max_examples` proposals of each label, and each kind's least score.

    The label is whether a proposal is evident or meets a base span. Only the fit is sampled: the least scores come from all
    proposals of the fold that it leaves out, at their own mix. Without proposals of both labels there is no model, and no
    kind has a least score.
    """
    counts = {row.good: row.n for row in rows.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None, {}
    fold = F.pmod(F.xxhash64("start", "row"), F.lit(3))
    share = F.when(F.col("good"), F.lit(max_examples / counts[True])).otherwise(F.lit(max_examples / counts[False]))
    drawn = F.pmod(F.xxhash64("row", "start", "kind"), F.lit(1_000_000)) < share * 1_000_000
    learn = stage(rows.where(drawn & (fold != 0)).select("good", "x")).select(array_to_vector("x").alias("features"), F.col("good").cast("double").alias("label"))
    if learn.select("label").distinct().count() < 2:
        return None, {}
    model = GBTClassifier(maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=0.3, seed=1).fit(learn.coalesce(4))
    rest = judged(model, rows.where(fold == 0).select("kind", "good", "x"))
    held = rest.groupBy("kind", F.round("p", 3).alias("p")).agg(F.sum(F.col("good").cast("int")).alias("good"), F.count(F.lit(1)).alias("n"))
    least: dict[int, float] = {}
    for kind in range(len(KINDS)):
        good = total = 0
        for row in sorted((r for r in held.collect() if r.kind == kind), key=lambda r: -r.p):
            good, total = good + row.good, total + row.n
            if good >= PRECISION * total:
                least[kind] = row.p
    return model, least


def judged(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    """The rows with `p`, the trees' probability that the span is personal data."""
    scored = model.transform(rows.withColumn("features", array_to_vector("x")))
    return scored.withColumn("p", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, `base` and `spans`: lists of (start, kind, end), by start and kind; `spans` has the added ones as well.

    `docs` has doc_id and text; other columns play no part. Kinds are numbers into KINDS, places are code points, ends
    exclusive. Null and empty texts have no spans. Very long texts and words are read whole, in time that grows with their
    length. Rows that repeat are read each. An empty table gives an empty one.
    """
    rows = stage(read(docs))
    each = rows.select("row", F.explode("proposed").alias("s")).select("row", "s.*")
    model, least = train(each)
    none = F.array().cast("array<struct<start: long, kind: int, end: long>>")
    if model is None:
        return rows.select("doc_id", "base", F.col("base").alias("spans"))
    limit = F.element_at(F.create_map(*[F.lit(x) for k, v in {-1: 2.0, **least}.items() for x in (k, v)]), F.col("kind"))
    picked = judged(model, each.where(~F.col("met"))).where(F.round("p", 3) >= F.coalesce(limit, F.lit(2.0)))
    added = picked.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))
    joined = rows.join(added, "row", "left")
    return joined.select("doc_id", "base", F.array_sort(F.array_distinct(F.concat("base", F.coalesce("added", none)))).alias("spans"))


def written(spans) -> F.Column:
    """The spans as kind:start:end, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
