"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A text's features are the shares of its n-grams (see `ngrams`) in 2^18 buckets. Training deals a bounded sample of the
labelled documents among a few tasks; each runs the per-coordinate updates over its share, and the weights are averaged.
Scoring is a sparse dot product with the weights, 1 MB that every task gets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from reqloom.llm.ngrams import BITS, ShapedWords, features
from reqloom.llm.shared import blocks, sums_by_text

MAX_LABELLED = 12_000
SHARDS = 6
THRESHOLD = 0.3
#: Bytes of text that a task works on at once.
BLOCK = 1 << 20


@dataclass(frozen=True)
class Settings:
    """Learning rate `alpha`, its offset `beta`, penalties `l1` and `l2`, passes over the sample, feature scale."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-4
    passes: int = 3
    scale: float = 16.0
    bits: int = BITS


class Leader:
    """Follow-the-regularised-leader state: per coordinate the adjusted gradient sum `z` and squared sum `n`."""

    def __init__(self, settings: Settings) -> None:
        self.settings = settings
        self.z = np.zeros((1 << settings.bits) + 1)
        self.n = np.zeros_like(self.z)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        s, z = self.settings, self.z[at]
        rate = (s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2
        return np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / rate)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        weights = self.weights(at)
        slope = (1 / (1 + np.exp(-np.clip(weights @ values, -35, 35))) - label) * values
        squared = self.n[at]
        step = (np.sqrt(squared + slope * slope) - np.sqrt(squared)) / self.settings.alpha
        self.z[at] += slope - step * weights
        self.n[at] = squared + slope * slope


def sparse(grams: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and values of one text; the last coordinate is the constant."""
    at, counts = np.unique(grams, return_counts=True)
    values = counts * (settings.scale / max(len(grams), 1))
    return np.append(at, 1 << settings.bits), np.append(values, 1.0)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), max_labelled: int = MAX_LABELLED) -> np.ndarray:
    """Weights learnt from `labels` (doc_id, label 0 or 1) and the texts of `docs` (doc_id, text).

    At most about `max_labelled` labelled rows are used, chosen by a hash of their id (a binomial count with that mean);
    that bound lets them be broadcast to the documents. Null ids or labels teach nothing. Without any label all weights
    are 0, and every score is 0.5.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).select("doc_id", "label").distinct()
    total = known.count()
    chosen = known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(max(total, 1))) < max_labelled)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = ShapedWords()
        for block in blocks(batches, "text", BLOCK):
            kinds, edges = features(block, "text", words, settings.bits)
            out = []
            for i in range(block.num_rows):
                at, values = sparse(np.concatenate([g[e[i] : e[i + 1]] for g, e in zip(kinds, edges)]), settings)
                out.append((at.astype(np.int32).tobytes(), values.astype(np.float32).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("label"), pa.array([a for a, _ in out], pa.binary()), pa.array([v for _, v in out], pa.binary())],
                names=["doc_id", "label", "at", "values"],
            )

    kind = dict(texts.dtypes)
    vectors = texts.mapInArrow(extract, f"doc_id {kind['doc_id']}, label {kind['label']}, at binary, values binary")

    def follow(rows: pd.DataFrame) -> pd.DataFrame:
        leader = Leader(settings)
        rows = rows.assign(turn=[hash_order(i) for i in rows["doc_id"]]).sort_values(["turn", "doc_id", "at"], kind="stable")
        for _ in range(settings.passes):
            for at, values, label in zip(rows["at"], rows["values"], rows["label"]):
                leader.learn(np.frombuffer(at, np.int32), np.frombuffer(values, np.float32).astype(float), int(label))
        return pd.DataFrame({"weights": [leader.weights(slice(None)).tobytes()]})

    parts = vectors.withColumn("shard", F.pmod(F.xxhash64(F.col("doc_id"), F.lit("shard")), F.lit(SHARDS)))
    learnt = parts.groupBy("shard").applyInPandas(follow, "weights binary").collect()
    if not learnt:
        return np.zeros((1 << settings.bits) + 1)
    return np.mean([np.frombuffer(row.weights) for row in sorted(learnt, key=lambda row: bytes(row.weights))], axis=0)


def hash_order(key: object) -> int:
    """A fixed shuffled order of ids."""
    return xxhash.xxh64_intdigest(str(key).encode())


def score(
    docs: DataFrame,
    weights: np.ndarray,
    settings: Settings = Settings(),
    columns: tuple[str, ...] = ("doc_id",),
    name: str = "score",
) -> DataFrame:
    """`columns` of `docs` and `name`, the probability of label 1, for every row and its whole text.

    Null and empty texts score the constant alone. Nothing is shuffled; rows that repeat are scored each. Labels, source,
    language and id are no inputs; other columns are passed on or left out as `columns` says.
    """
    table, constant, scale = weights[:-1].astype(np.float32), float(weights[-1]), settings.scale

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = ShapedWords()
        for block in blocks(batches, "_text", BLOCK):
            kinds, edges = features(block, "_text", words, settings.bits)
            total = sum(sums_by_text(table[grams].astype(float), bounds) for grams, bounds in zip(kinds, edges))
            count = np.maximum(sum(np.diff(bounds) for bounds in edges), 1)
            odds = np.clip(constant + total * scale / count, -35, 35)
            passed = [block.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*passed, pa.array(1 / (1 + np.exp(-odds)))], names=[*columns, name])

    source = docs.select(*[F.col(f"`{c}`") for c in columns], F.col("text").alias("_text"))
    out = StructType([*source.schema.fields[:-1], StructField(name, DoubleType())])
    return source.mapInArrow(run, out)


def keep_good(docs: DataFrame, weights: np.ndarray, settings: Settings = Settings(), threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, all columns, that score at least `threshold`."""
    scored = score(docs, weights, settings, tuple(docs.columns), "_quality")
    return scored.where(F.col("_quality") >= threshold).drop("_quality")
