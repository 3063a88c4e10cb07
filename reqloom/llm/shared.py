"""What the operators share: reading tables, words as numbers, blocks of an Arrow batch.

Words are the runs `[^\\x20\\x09-\\x0D]+`; on UTF-8 bytes that is what `bytes.split()` gives, and `bytes.lower()` lowers
A-Z alone.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, of: int) -> F.Column:
    """crc32 of the column as text, mod `of`; a null counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(of))


class Words(dict):
    """Numbers for words (bytes) in order of first sight; `hashes[number]` is the word's 64-bit hash."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes = array("Q")

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return number

    def hash_array(self) -> np.ndarray:
        return np.frombuffer(self.hashes, dtype=np.uint64).copy() if self.hashes else np.zeros(0, np.uint64)


def numbered(texts: Iterable[bytes], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The texts' words as numbers, one after the other, and each text's bounds in that array (one more than texts)."""
    get, parts, bounds = words.__getitem__, [], [0]
    for text in texts:
        split = text.split()
        parts.append(np.fromiter(map(get, split), dtype=np.int64, count=len(split)))
        bounds.append(bounds[-1] + len(split))
    return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), np.array(bounds, dtype=np.int64)


def blocks(batches: Iterable[pa.RecordBatch], column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about `most` bytes of text each, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        cut = np.cumsum(sizes, dtype=np.int64) // most
        edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            yield batch.slice(start, end - start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's texts as UTF-8, null as empty."""
    return pc.fill_null(batch.column(column).cast(pa.binary()), b"").to_pylist()


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers so that any bits of the result serve as a hash (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def windows(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of `width` words within a text, and the bounds of each text's runs."""
    n = len(hashes) - width + 1
    sizes = np.maximum(np.diff(bounds) - width + 1, 0)
    out = np.concatenate(([0], np.cumsum(sizes)))
    if n <= 0:
        return np.zeros(0, np.uint64), out
    rolled = np.zeros(n, np.uint64)
    for i in range(width):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    inside = np.ones(n, dtype=bool)
    for i in range(1, width):
        ends = bounds[1:-1] - i
        inside[ends[(ends >= 0) & (ends < n)]] = False
    # a text shorter than the window marks starts of its neighbours only where they cross its end
    return mixed(rolled[inside]), out


def sums_by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each text's values; 0 for a text without any."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[bounds[1:]] - total[bounds[:-1]]
