"""Quality rules: plain counts per text, and the log-likelihood ratio of hashed n-grams between two multinomials.

One multinomial is counted over trusted texts, one over the whole corpus. A text's value is the mean over its n-grams of
log p(trusted) - log p(corpus). The threshold is a low quantile of the trusted texts' own values, so the same rows always
give the same verdicts. Counts are vectors of fixed length, summed by bucket in Spark.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from reqloom.llm.ngrams import BITS, ShapedWords, features
from reqloom.llm.shared import blocks, mixed, numbered, Words, sums_by_text, texts_of, windows
from reqloom.operators.selection import values_at

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
QUANTILE = 0.002
SMOOTHING = 1.0

# The characters counted as symbols, and the six white-space bytes.
SYMBOLS = b"#*$%&|<>"
SPACE_BYTES = b" \t\n\x0b\f\r"

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_IS_SPACE = np.isin(np.arange(256), list(SPACE_BYTES))
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def gram_counts(docs: DataFrame, trusted: DataFrame, bits: int = BITS) -> DataFrame:
    """`bucket`, `n` and `n_trusted`: n-grams per hash bucket over all texts, and over the trusted ones.

    The texts meet the trusted ids by a merge join at every size: the ids grow with the corpus. Buckets without any n-gram
    have no row.
    """
    ids = trusted.select("doc_id").where(F.col("doc_id").isNotNull()).distinct().withColumn("_trusted", F.lit(True))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = ShapedWords(), np.zeros((2, 1 << bits), np.int64)
        for block in blocks(batches, "text"):
            good = block.column("_trusted").to_numpy(zero_copy_only=False).astype(bool)
            for grams, bounds in zip(*features(block, "text", words, bits)):
                total[0] += np.bincount(grams, minlength=1 << bits)
                total[1] += np.bincount(grams[np.repeat(good, np.diff(bounds))], minlength=1 << bits)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[0, at]), pa.array(total[1, at])], names=["bucket", "n", "n_trusted"])

    marked = docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left")
    counted = marked.select("text", F.coalesce("_trusted", F.lit(False)).alias("_trusted")).mapInArrow(count, "bucket int, n long, n_trusted long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("n_trusted").alias("n_trusted"))


def ratio_table(docs: DataFrame, trusted: DataFrame, bits: int = BITS, smoothing: float = SMOOTHING) -> np.ndarray:
    """log p(trusted) - log p(corpus) per bucket, each count raised by `smoothing`.

    `trusted` has the ids (doc_id) of the trusted documents; repeats and nulls in it do not matter. Only the two vectors
    of 2^bits counts reach the driver.
    """
    counts = np.full((2, 1 << bits), smoothing)
    for row in gram_counts(docs, trusted, bits).toLocalIterator():
        counts[:, row.bucket] += row.n, row.n_trusted
    corpus, good = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))
    return good - corpus


def symbols_and_letters(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per text: symbols, and code points that are not white space."""
    joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    letter = ((joined & 0xC0) != 0x80) & ~_IS_SPACE[joined]
    return sums_by_text(_IS_SYMBOL[joined].astype(np.int64), bounds), sums_by_text(letter.astype(np.int64), bounds)


def repeated_lines(texts: list[bytes]) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line."""
    out = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        lines = [line for line in text.split(b"\n") if line.strip(SPACE_BYTES)] if b"\n" in text else []
        out[i] = len(lines) - len(set(lines))
    return out


def repeated_words(codes: np.ndarray, bounds: np.ndarray, hashes: np.ndarray, width: int = 3) -> np.ndarray:
    """Per text: words that lie in a run of `width` words which the text has twice or more."""
    runs, edges = windows(hashes[codes], bounds, width)
    texts = np.repeat(np.arange(len(bounds) - 1), np.diff(edges))
    key = mixed(runs + mixed(texts.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    often = np.zeros(len(key), dtype=bool)
    often[order[1:]] |= same
    often[order[:-1]] |= same
    starts = bounds[texts] + np.arange(len(key)) - edges[texts]
    covered = np.zeros(len(codes), dtype=np.int64)
    for i in range(width):
        covered[starts[often] + i] = 1
    return sums_by_text(covered, bounds)


def measure(docs: DataFrame, ratios: np.ndarray | None, columns: tuple[str, ...] = ("doc_id",), bits: int = BITS) -> DataFrame:
    """`columns`, the counts, `base_failed` and `ratio` (mean log ratio, 0 for a text without words; null without `ratios`).

    Every row and whole text; a null text has no words, so it fails. Rows that repeat are measured each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shaped = ShapedWords()
        for block in blocks(batches, "_text"):
            texts, words = texts_of(block, "_text"), Words()
            codes, bounds = numbered(texts, words)
            n_words = np.diff(bounds)
            n_symbols, word_chars = symbols_and_letters(texts)
            repeats = repeated_words(codes, bounds, words.hash_array())
            failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
            counts = [n_words, word_chars, n_symbols, repeated_lines(texts), repeats]
            if ratios is None:
                value = pa.nulls(len(texts), pa.float64())
            else:
                kinds, edges = features(block, "_text", shaped, bits)
                total = sum(sums_by_text(ratios[grams], e) for grams, e in zip(kinds, edges))
                value = pa.array(total / np.maximum(sum(np.diff(e) for e in edges), 1))
            passed = [block.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(
                [*passed, *[pa.array(c.astype(np.int64)) for c in counts], pa.array(failed), value],
                names=[*columns, *_BASE, "base_failed", "ratio"],
            )

    source = docs.select(*[F.col(f"`{c}`") for c in columns], F.col("text").alias("_text"))
    added = [StructField(n, LongType()) for n in _BASE] + [StructField("base_failed", BooleanType()), StructField("ratio", DoubleType())]
    return source.mapInArrow(run, StructType([*source.schema.fields[:-1], *added]))


def threshold_of(measured: DataFrame, trusted: DataFrame, quantile: float = QUANTILE) -> float:
    """The value at the `quantile` of the trusted documents that pass the counts, exact whatever the order; 0 if there is none."""
    ids = trusted.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    passing = measured.where(~F.col("base_failed")).join(ids, "doc_id", "left_semi")
    place = lambda n: [max(0, math.ceil(quantile * n) - 1)]
    n, values = values_at(passing, ["ratio"], place)["ratio"]
    return values[place(n)[0]] if n else 0.0
