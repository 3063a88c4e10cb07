"""Alignment of two tokenizers' tokens on the same bytes.

Tokens of both sides that overlap form components, cut where a token of each side ends at the same byte. Every token points
to the token farthest to the right among those it overlaps; doubling these pointers, for all tokens of a block at once, ends
at the last token of each component, which names its group.

Links are pairs of occurrences that end together. How often each pair of ids is linked is counted over all documents: a block
of documents gives each pair once with its number, the blocks' numbers are summed by pair, and each block gets the sums of its
own pairs back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from reqloom.llm.packing import Encoder
from reqloom.llm.shared import blocks
from reqloom.operators.staging import stage

FIRST = "byte_bpe_50k.json"
SECOND = "piece_bpe_32k.model"
BLOCK = 2 << 20
#: Cuts of texts that a process keeps encoded by the piece model.
KEPT = 60_000

_WIDE = re.compile(r"\s\s")
_GAP = re.compile(r"(?<=\S) (?=\S)")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


class Pieces:
    """Token ids (little-endian unsigned 32-bit) by a piece model, which puts a space before each text.

    Where no piece holds a space behind another sign, no piece crosses a single space between words, so words are encoded
    once and kept. A model whose normalisation looks across a space is not meant for this.
    """

    def __init__(self, path: str, most: int = KEPT) -> None:
        import sentencepiece

        self.model, self.most, self.known = sentencepiece.SentencePieceProcessor(model_file=path), most, {}
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.apart = not any(re.search("[^▁]▁", name) for name in names)
        self.bytes = [bytes([int(b[1], 16)]) if (b := _BYTE.fullmatch(name)) else name.replace("▁", " ").encode() for name in names]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, dtype="<u4").tobytes() for ids in self.model.encode(texts, num_threads=1)] if texts else []

    @staticmethod
    def _cuts(text: str) -> list[str]:
        """Cuts at single spaces between words; spaces at the text's ends stay."""
        return _GAP.split(text) if text[:1] == " " or text[-1:] == " " or _WIDE.search(text) else text.split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.most:
            for cut in list(islice(self.known, len(self.known) // 2)):
                del self.known[cut]
        cut = [self._cuts(text) if self.apart else [text] for text in texts]
        first = self._whole([pieces.pop(0) for pieces in cut])
        new = list(set().union(*cut).difference(self.known))
        self.known.update(zip(new, self._whole(new)))
        get = self.known.__getitem__
        return [ids + b"".join(map(get, pieces)) for ids, pieces in zip(first, cut)]


class Sides:
    """Both tokenizers with the bytes of their ids, and ids as text with what follows them in a group."""

    def __init__(self, first: str, second: str) -> None:
        self.a, self.b = Encoder(first), Pieces(second)
        self.bytes = self.a.bytes, self.b.bytes
        self.lengths = tuple(np.array([len(b) for b in side], dtype=np.int64) for side in self.bytes)
        (a, b) = (len(side) for side in self.bytes)
        self.ids = a, b
        self.pair_type = np.dtype(np.uint32 if a * b < 1 << 32 else np.int64)
        self.written = [f"{i}{end}" for n, ends in ((a, ",|"), (b, ",;")) for end in ends for i in range(n)]

    def encode(self, side: int, text: list[str]) -> list[np.ndarray]:
        found = self.a.encode([" " + one for one in text]) if side == 0 else self.b.encode(text)
        return [np.frombuffer(ids, dtype="<u4").astype(np.int64) for ids in found]


@lru_cache(maxsize=1)
def sides(first: str, second: str) -> Sides:
    """The process' tokenizers: tables and kept cuts, bounded in size, outlive a task."""
    return Sides(first, second)


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of a and of b, the token of b that ends its component; ends rise strictly, and both sides end alike.

    Tokens are ranked by their end, a before b. A token points to the token of the other side that holds its last byte, if
    that ranks higher, and to itself otherwise.
    """
    n, m = len(ends_a), len(ends_b)
    in_b, in_a = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    own = np.arange(m)
    follows = np.zeros(m, dtype=bool) if not n else ends_a[np.minimum(in_a, n - 1)] > ends_b
    # numbers: a's tokens, then b's
    pointer = np.concatenate((n + in_b, np.where(follows, in_a, n + own)))
    while True:
        farther = pointer[pointer]
        if (farther == pointer).all():
            return pointer[:n] - n, pointer[n:] - n
        pointer = farther


class Aligned:
    """A block's tokens side by side: ids, text numbers, group numbers (rising over the block), and the links."""

    def __init__(self, texts: list[str], sides: Sides) -> None:
        ids = [[], []]
        none = np.zeros(0, np.int64)
        encoded = [sides.encode(0, texts), sides.encode(1, texts)]
        for text, a, b in zip(texts, *encoded):
            want = b" " + text.encode()
            same = text and all(b"".join([names[i] for i in found.tolist()]) == want for names, found in zip(sides.bytes, (a, b)))
            for side, found in zip(ids, (a, b)):
                side.append(found if same else none)
        self.text, self.counts, self.ids, ends = [], [], [], []
        for side, lengths in zip(ids, sides.lengths):
            count = np.array([len(found) for found in side], dtype=np.int64)
            flat = np.concatenate([none, *side])
            self.counts.append(count)
            self.ids.append(flat)
            self.text.append(np.repeat(np.arange(len(texts)), count))
            ends.append(np.cumsum(lengths[flat]))
        last_a, last_b = terminals(*ends)
        is_last = np.zeros(len(self.ids[1]), dtype=bool)
        is_last[last_b] = True
        number = np.cumsum(is_last) - 1
        self.group = number[last_a], number[last_b]
        self.last_b = np.flatnonzero(is_last)
        self.last_a = np.flatnonzero(np.diff(self.group[0], append=-1) != 0)
        self.groups = np.bincount(self.text[1][self.last_b], minlength=len(texts))
        #: the two tokens that end a group are its one pair that ends together
        self.pair = (self.ids[0][self.last_a] * sides.ids[1] + self.ids[1][self.last_b]).astype(sides.pair_type)

    def written(self, sides: Sides) -> list[str]:
        """Each text's groups, `a1,a2|b1;a3|b2,b3`."""
        total = len(self.ids[0]) + len(self.ids[1])
        (a, b), out = sides.ids, np.zeros(total, np.int64)
        before_b = np.searchsorted(self.group[1], self.group[0])  # b's tokens of earlier groups
        before_a = np.searchsorted(self.group[0], self.group[1], side="right")  # a's tokens up to the own group
        ends = np.zeros(len(self.ids[0]), np.int64), np.zeros(len(self.ids[1]), np.int64)
        ends[0][self.last_a] = a
        ends[1][self.last_b] = b
        out[np.arange(len(self.ids[0])) + before_b] = self.ids[0] + ends[0]
        out[np.arange(len(self.ids[1])) + before_a] = self.ids[1] + ends[1] + 2 * a
        signs = list(map(sides.written.__getitem__, out.tolist()))
        edge = np.concatenate(([0], np.cumsum(self.counts[0] + self.counts[1]))).tolist()
        return ["".join(signs[start:end])[:-1] for start, end in zip(edge, edge[1:])]


def _hashed(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def align(docs: DataFrame, first: str | None = None, second: str | None = None, digest: bool = False) -> DataFrame:
    """A row for each row of `docs` (doc_id, text): its alignment, and how its links stand in the whole corpus.

    doc_id, n_a, n_b, n_groups, n_links, `groups` (ids by group, `a1,a2|b1;a3|b2,b3`), n_best (links whose pair of ids is the
    most frequent one of its b id, ties included), count_sum (corpus-wide links of its links' pairs, summed).

    With `digest`, `groups` is the lower-case hex sha256 of that text (empty stays empty), so that the text is not moved.
    `first` is a byte-level BPE file, encoding a space and the text; `second` a piece model, which adds the space. A text that
    is null or empty, or that one side does not give back byte for byte, has no tokens: counts of 0 and empty `groups`. Texts
    of any length are taken whole. Rows that repeat count and are answered each; other columns are left out; an empty table
    stays empty. A pair's sum is shuffled once per block of texts that holds it; a block is a task's unit, so memory is bounded
    by BLOCK or by one text.
    """
    first, second = first or public_tokenizers.path(FIRST), second or public_tokenizers.path(SECOND)
    source = docs.select("doc_id", F.col("text").alias("_text"))
    kind = source.schema["doc_id"]
    small = [StructField(name, LongType()) for name in _COUNTS]
    blob = [StructField("pairs", BinaryType()), StructField("times", BinaryType())]
    whole = [StructField("block_pairs", ArrayType(LongType())), StructField("block_times", ArrayType(LongType()))]
    written = StructType([StructField("block", LongType()), StructField("is_block", LongType()), kind, *small, StructField("groups", StringType()), *blob, *whole])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = sides(first, second)
        for at, block in enumerate(blocks(batches, "_text", BLOCK)):
            name = (TaskContext.get().partitionId() << 32) + at
            found = Aligned([text or "" for text in block.column("_text").to_pylist()], tools)
            groups = found.written(tools)
            size = block.num_rows
            edge = np.concatenate(([0], np.cumsum(found.groups)))
            pairs, times = [], []
            for start, end in zip(edge.tolist(), edge[1:].tolist()):
                keys, count = np.unique(found.pair[start:end], return_counts=True)
                pairs.append(keys.tobytes())
                times.append(count.astype(np.int32).tobytes())
            keys, count = np.unique(found.pair, return_counts=True)
            numbers = [*found.counts, found.groups, found.groups]
            doc_id = block.column("doc_id")
            columns = [
                pa.array(np.full(size + 1, name)),
                pa.array(np.append(np.zeros(size, np.int64), 1)),
                pa.concat_arrays([doc_id, pa.nulls(1, doc_id.type)]),
                *[pa.array(np.append(number, 0).astype(np.int64)) for number in numbers],
                pa.array([*(map(_hashed, groups) if digest else groups), None], pa.string()),
                pa.array([*pairs, None], pa.binary()),
                pa.array([*times, None], pa.binary()),
                *[pa.array([None] * size + [values.astype(np.int64)], pa.list_(pa.int64())) for values in (keys, count)],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=written.names)

    aligned = stage(source.mapInArrow(encode, written))
    held = aligned.where("is_block = 1").select("block", F.explode(F.arrays_zip("block_pairs", "block_times")).alias("_z"))
    held = held.select("block", F.col("_z.block_pairs").alias("pair"), F.col("_z.block_times").alias("times"))
    sums = stage(held.groupBy("pair").agg(F.sum("times").alias("total")))
    width = len(Pieces(second).bytes)
    most = sums.groupBy((F.col("pair") % width).alias("b")).agg(F.max("total").alias("most"))
    judged = sums.withColumn("b", F.col("pair") % width).join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    back = held.select(F.col("block").alias("_block"), "pair").join(judged, "pair").groupBy("_block").agg(F.sort_array(F.collect_list(F.struct("pair", "total", "best"))).alias("known"))
    rows = aligned.where("is_block = 0").select("block", "doc_id", *_COUNTS, "groups", "pairs", "times")
    result = StructType([kind, *small, StructField("groups", StringType()), StructField("n_best", LongType()), StructField("count_sum", LongType())])

    def answer(docs: pa.Table, known: pa.Table) -> pa.Table:
        values = known.column("known").combine_chunks().flatten() if known.num_rows else None
        names, total, best = (values.field(i).to_numpy(zero_copy_only=False) for i in range(3)) if values is not None and len(values) else (np.zeros(0, np.int64),) * 3
        n_best, count_sum = [], []
        for pairs, times in zip(docs.column("pairs").to_pylist(), docs.column("times").to_pylist()):
            times = np.frombuffer(times, np.int32).astype(np.int64)
            wide = np.uint32 if len(pairs) == 4 * len(times) else np.int64
            at = np.searchsorted(names, np.frombuffer(pairs, wide).astype(np.int64))
            n_best.append(int(times[best[at].astype(bool)].sum()))
            count_sum.append(int((times * total[at]).sum()))
        kept = docs.select(["doc_id", *_COUNTS, "groups"])
        return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))

    return rows.groupBy("block").cogroup(back.groupBy("_block")).applyInArrow(answer, result)
