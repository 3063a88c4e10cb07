"""Packing: documents cut into pieces of at most a window's tokens, the short ones put together by minimum bin slack.

Texts become token ids in the tasks that read them. A document gives full windows and one remaining piece; remaining
pieces are dealt evenly into groups. In a group only the number of pieces of each length matters: a subset-sum over those
counts, held as bits of one integer, finds the multiset that fills a window closest to its capacity, and walking back
through the layers gives how many of each length it takes. The same multiset is used as often as the counts allow.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from reqloom.llm.shared import blocks

WINDOW = 2048
END = 1
GROUP = 16_384
TOKENIZER = "byte_bpe_50k.json"

#: How byte-level models write the bytes that are no visible Latin-1 signs: as the signs from 256 on, in order.
_HIDDEN = [*range(33), *range(127, 161), 173]
_BYTES = {chr(b): b for b in range(256) if b not in _HIDDEN} | {chr(256 + i): b for i, b in enumerate(_HIDDEN)}


class Encoder:
    """Token ids (little-endian unsigned 32-bit) of texts by a byte-level BPE file; special tokens' strings are plain text.

    Where the file splits by the usual pattern and numbers its merges in order, its vocabulary is a table of ranks, and
    tiktoken gives the same ids in less than half the time. Other files go through the tokenizers library. `bytes` has the
    bytes of each id.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        special = {token["content"]: token["id"] for token in content["added_tokens"]}
        spelled = {i: bytes(_BYTES[sign] for sign in token) for token, i in vocabulary.items() if token not in special}
        spelled |= {i: token.encode() for token, i in special.items()}
        self.bytes = [spelled[i] for i in range(len(spelled))]
        self.table = self.tokenizer = None
        if _is_ranked(content, special):
            import tiktoken

            ranks = {self.bytes[i]: i for token, i in vocabulary.items() if token not in special}
            self.table = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        else:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.table is not None:
            return [np.array(self.table.encode_ordinary(text), dtype="<u4").tobytes() for text in texts]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, dtype="<u4").tobytes() for one in found]


def _is_ranked(content: dict, special: dict[str, int]) -> bool:
    """Whether ids of a byte-level file rise with its merges, and nothing but the usual pattern shapes its input."""
    split, model = content["pre_tokenizer"] or {}, content["model"]
    if content["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return False
    merges = [tuple(merge.split(" ") if isinstance(merge, str) else merge) for merge in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in merges]
    plain = len(model["vocab"]) - sum(token in model["vocab"] for token in special)
    return all(low < high for low, high in zip(ids, ids[1:])) and plain == 256 + len(set(ids)) and (not ids or ids[0] >= 256)


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """The process' encoder: its tables outlive a task."""
    return Encoder(path)


def closest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length fill `capacity` closest from below: subset-sum over the counts, longest first."""
    mask, reach, layers = (2 << capacity) - 1, 1, []
    for length in sorted(counts, reverse=True):
        left, step = min(counts[length], capacity // length), 1
        while left and not reach >> capacity:
            times = min(step, left)
            layers.append((length, times, reach))
            reach = (reach | reach << length * times) & mask
            left, step = left - times, 2 * step
        if reach >> capacity:
            break
    goal, used = reach.bit_length() - 1, {}
    for length, times, before in reversed(layers):
        if not before >> goal & 1:
            used[length] = used.get(length, 0) + times
            goal -= length * times
    return used


def fill(lengths: np.ndarray, capacity: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each length (1 to `capacity`): every window is opened by the longest that is left."""
    places: dict[int, list[int]] = defaultdict(list)
    for at in range(len(lengths) - 1, -1, -1):
        places[int(lengths[at])].append(at)
    counts = {length: len(found) for length, found in places.items()}
    window, offset, number = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for longest in sorted(places, reverse=True):
        while counts.get(longest):
            counts[longest] -= 1
            use = closest({k: n for k, n in counts.items() if n}, capacity - longest)
            counts[longest] += 1
            use[longest] = use.get(longest, 0) + 1
            for _ in range(min(counts[k] // n for k, n in use.items())):
                filled = 0
                for length in sorted(use, reverse=True):
                    for _ in range(use[length]):
                        at = places[length].pop()
                        window[at], offset[at] = number, filled
                        filled += length
                number += 1
            for length in use:
                counts[length] = len(places[length])
    return window, offset


def pack(
    docs: DataFrame,
    window: int = WINDOW,
    group: int = GROUP,
    path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and `ids` if asked for.

    `docs` has doc_id and text; other columns play no part. A document is its text's ids and then id 1; a null text is
    empty, so it is the one id 1. Every id lies in exactly one piece. Sequences hold `window` ids at most, gapless from 0;
    what is missing to `window` is padding. Rows that repeat are documents of their own. An empty table gives no piece.
    Groups of about `group` documents are packed by themselves, dealt by a hash of the row's number, so that equal
    documents do not meet in one task.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    groups = max(1, -(-docs.count() // group))
    bin_of = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int")
    source = docs.select("doc_id", F.col("text").alias("_text"), bin_of.alias("_bin"))
    kind = source.schema["doc_id"].dataType
    names = ["start", "length", "ids_crc32", "doc_tokens"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(path), np.array([END], dtype="<u4").tobytes()
        for block in blocks(batches, "_text", 2 << 20):
            rows, values, ids = [], [], []
            for at, found in enumerate(encoder.encode([text or "" for text in block.column("_text").to_pylist()])):
                found += end
                total = len(found) // 4
                for start in range(0, total, window):
                    piece = found[4 * start : 4 * (start + window)]
                    rows.append(at)
                    values.append((start, len(piece) // 4, zlib.crc32(piece), total))
                    if with_ids:
                        ids.append(piece)
            taken = block.select(["doc_id", "_bin"]).take(pa.array(rows, pa.int64()))
            numbers = np.array(values, dtype=np.int64).reshape(-1, 4)
            columns = [*taken.columns, *[pa.array(numbers[:, i]) for i in range(4)], pa.array(ids, pa.binary()) if with_ids else pa.nulls(len(rows), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "_bin", *names, "ids"])

    longs = [StructField(name, LongType()) for name in names]
    pieces = source.mapInArrow(cut, StructType([StructField("doc_id", kind), source.schema["_bin"], *longs, StructField("ids", BinaryType())]))

    def place(key: tuple, rows: pa.Table) -> pa.Table:
        order = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("ids_crc32", "ascending"), ("start", "ascending")])
        number, offset = fill(order.column("length").to_numpy(), window)
        sequence = number + (int(key[0].as_py()) << 32)
        out = order.drop_columns(["_bin"])
        return out.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    fields = [StructField("doc_id", kind), *longs, StructField("ids", BinaryType()), StructField("sequence_id", LongType()), StructField("offset", LongType())]
    packed = pieces.groupBy("_bin").applyInArrow(place, StructType(fields))
    columns = ["doc_id", *names, "sequence_id", "offset"]
    return packed.select(*columns, *(["ids"] if with_ids else []))
