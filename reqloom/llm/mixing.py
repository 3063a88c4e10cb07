"""Mixing sources to target weights.

Each source's documents, in a hashed order, form streams of words that are cut into blocks of equal size. A source takes
part with an exact number of blocks (its quota); blocks beyond one pass over the source are repeated. A splitting tree
deals the quotas out: the root holds all of them, and each node draws from its quotas, by a multivariate hypergeometric
law, what its left half gets; leaves are output shards. No one holds the tree: each task descends from the root to its own
shards, and a node's draws are seeded by its place. A shard's share of a source is a range of the source's permuted blocks,
so shards are disjoint; within a shard the blocks are put in a hashed order.

The driver and the tasks that descend hold one number per source; documents, streams and blocks stay distributed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reqloom.llm.shared import BLOCK_BYTES, WORD, blocks, mixed
from reqloom.operators.staging import stage

_WORD = re.compile(WORD)


@dataclass(frozen=True)
class Plan:
    """`weights` are dealt to the sources by code point, null last, in turn; `total` is the share of all words to take,
    `most` how often a source may be taken; `block` words are drawn at once, `shard` blocks make an output shard, and
    a stream holds about `stream` documents."""

    weights: tuple[int, ...] = (3, 1, 2)
    total: float = 1.5
    most: float = 2.0
    block: int = 256
    shard: int = 4096
    stream: int = 512
    seed: int = 17


def targets(sizes: DataFrame, plan: Plan) -> DataFrame:
    """`source`, `source_size` and `target` of every source of `sizes` (source, size).

    Shares follow the weights; what a source cannot take beyond `most` times its size goes to the others by weight. With
    the sources by most / weight, that is the first count of full ones after which the rest's share fits. The two windows
    have one small row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(plan.weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in plan.weights]), (turn + 1).cast("int"))
    rows = by_source.withColumn("weight", weight).withColumn("limit", F.lit(plan.most) * F.col("source_size"))
    ratio = F.col("limit") / F.col("weight")
    ordered = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before, whole = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = F.lit(plan.total) * F.sum("source_size").over(whole)
    level = (wanted - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    # from the first source whose limit lies above the level, all share that level
    rows = rows.withColumn("ratio", ratio).withColumn("level", level).withColumn("rank", F.row_number().over(ordered))
    shared = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("rank", "level"))).over(whole)
    rows = rows.withColumn("level", shared["level"])
    target = F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return rows.select("source", "source_size", target.alias("target"))


def permuted(at: np.ndarray, size: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """A fixed permutation of 0..size-1 per seed, at the given places: Feistel rounds, walked until inside."""
    half = np.maximum((np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2, 1).astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    value, todo = at.astype(np.uint64), np.ones(len(at), dtype=bool)
    while todo.any():
        i = np.flatnonzero(todo)
        left, right = value[i] >> half[i], value[i] & low[i]
        for turn in range(4):
            key = mixed(right + mixed(seed[i].astype(np.uint64) + np.uint64(turn + 1)))
            left, right = right, left ^ (key & low[i])
        value[i] = (left << half[i]) | right
        todo[i] = value[i] >= size[i].astype(np.uint64)
    return value.astype(np.int64)


def split(quotas: np.ndarray, wanted: int, generator: np.random.Generator) -> np.ndarray:
    """What one half gets of each quota, `wanted` blocks in all."""
    if quotas.sum() < 1_000_000_000:
        return generator.multivariate_hypergeometric(quotas, wanted, method="marginals")
    # beyond the generator's range: each quota's mean share, the rest by largest remainder
    exact = quotas * (wanted / quotas.sum())
    share = np.floor(exact).astype(np.int64)
    share[np.argsort(share - exact, kind="stable")[: wanted - share.sum()]] += 1
    return share


def leaves(quotas: np.ndarray, shards: int, plan: Plan, first: int, last: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, first block per source, blocks per source) of the shards `first` to `last` - 1, from the root down."""
    total = int(quotas.sum())

    def upto(shard: int) -> int:
        return total * shard // shards

    waiting = [(0, shards, np.zeros_like(quotas), quotas)]
    while waiting:
        low, high, start, share = waiting.pop()
        if high <= first or low >= last:
            continue
        if high - low == 1:
            yield low, start, share
            continue
        middle = (low + high) // 2
        generator = np.random.Generator(np.random.Philox(key=plan.seed, counter=[low, high, 0, 0]))
        left = split(share, upto(middle) - upto(low), generator)
        waiting += [(middle, high, start + left, share - left), (low, middle, start, left)]


def mix(docs: DataFrame, plan: Plan = Plan()) -> tuple[DataFrame, DataFrame]:
    """The draws, and one row per document with its source's target.

    `docs` has doc_id, text and source. Draws: `doc_id`, `source`, `text_key` (md5 of the text), `size`, `_row` (number of
    the document's row), `first_word`, `words` (a run of words of the document), `shard`, `place` (the block's place in
    its shard), `part` (order within the block). Documents: `doc_id`, `source`, `size`, `source_size`, `target`, `_row`. A null text has size 0; such
    documents are in no draw. A null source is a source of its own. Rows that repeat are documents of their own. An
    empty table gives two empty ones. A source's words come within one block of its target.
    """
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    order = F.xxhash64(F.lit(plan.seed), F.col("doc_id").cast("string"), F.xxhash64(F.col("text")))
    sized = stage(
        docs.select("doc_id", "source", size.alias("size"), order.alias("order"), F.md5(F.col("text")).alias("text_key"), F.monotonically_increasing_id().alias("_row"))
    )
    counts = sized.groupBy(F.col("source").alias("_s")).agg(F.count(F.lit(1)).alias("documents"))
    goals = stage(targets(sized.select("source", "size"), plan).join(counts, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))
    rows = sized.withColumnRenamed("source", "_s").join(goals, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
    documents = rows.select("doc_id", "source", "size", "source_size", "target", "_row")

    # streams: documents of a source dealt by hash; each stream's words are cut into blocks
    streams = F.greatest(F.ceil(F.col("documents") / plan.stream), F.lit(1))
    rows = rows.where(F.col("size") > 0).withColumn("stream", F.pmod(F.col("order"), streams))
    along = Window.partitionBy("source", "stream").orderBy("order", "doc_id", "size", "_row")
    placed = stage(
        rows.withColumn("start", F.sum("size").over(along) - F.col("size")).select("doc_id", "source", "text_key", "stream", "size", "start", "_row")
    )
    blocks_in = F.ceil(F.sum("size") / plan.block).cast("long")
    held = placed.groupBy("source", "stream").agg(blocks_in.alias("blocks"), F.sum("size").alias("words"))
    by_stream = Window.partitionBy("source").orderBy("stream")
    every = by_stream.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    numbered = stage(
        held.withColumn("first_block", F.sum("blocks").over(by_stream) - F.col("blocks")).withColumn("source_blocks", F.sum("blocks").over(every)).withColumn("source_words", F.sum("words").over(every))
    )
    # quotas: blocks that meet the target, with a block's mean size
    per_source = numbered.groupBy("source").agg(F.max("source_blocks").alias("n"), F.max("source_words").alias("w"))
    wanted = goals.withColumnRenamed("source", "_s").join(per_source, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
    quota = F.least(F.round(F.col("target") * F.col("n") / F.col("w")), F.floor(F.lit(plan.most)) * F.col("n")).cast("long")
    quotas = stage(wanted.select("source", F.col("n").alias("blocks"), quota.alias("quota"), F.xxhash64("source").alias("salt")))
    spark = docs.sparkSession
    table = sorted(quotas.collect(), key=lambda r: (r.source is None, (r.source or "").encode()))
    shares, sizes, salts = (np.array([r[name] for r in table], dtype=np.int64) for name in ("quota", "blocks", "salt"))
    shards = max(1, -(-int(shares.sum()) // plan.shard))
    names = [r.source for r in table]

    # from the root to a shard's blocks in one step: a second one would be a second Python process for every running task
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch) or not names:
                continue
            for leaf, start, share in leaves(shares, shards, plan, int(batch["id"].min()), int(batch["id"].max()) + 1):
                at = np.repeat(np.arange(len(names)), share)
                # the source's blocks in permuted order, pass after pass: turn t is block permuted(t mod blocks)
                turn = np.arange(len(at)) + np.repeat(start - np.cumsum(share) + share, share)
                number = permuted(turn % sizes[at], sizes[at], salts[at] & 0x7FFFFFFF)
                yield pd.DataFrame({"source": [names[i] for i in at], "shard": leaf, "turn": turn, "number": number})

    turns = spark.range(shards).mapInPandas(deal, "source string, shard long, turn long, number long")
    spans = placed.withColumnRenamed("source", "_s").withColumnRenamed("stream", "_t").join(
        numbered.select("source", "stream", "first_block"), F.col("_s").eqNullSafe(F.col("source")) & (F.col("_t") == F.col("stream"))
    )
    ends = F.col("start") + F.col("size")
    touched = spans.select(
        "doc_id", "text_key", "_row", "size", "start", F.col("source").alias("_s"), "first_block",
        F.explode(F.sequence(F.floor(F.col("start") / plan.block), F.floor((ends - 1) / plan.block))).alias("cut"),
    )
    low = F.greatest(F.col("start"), F.col("cut") * plan.block)
    high = F.least(F.col("start") + F.col("size"), (F.col("cut") + 1) * plan.block)
    pieces = touched.select("doc_id", "text_key", "size", "_row", "_s", (F.col("first_block") + F.col("cut")).alias("_n"), (low - F.col("start")).alias("first_word"), (high - low).alias("words"), low.alias("part"))
    # the blocks' number is not seen in the plan: without the hint a range of few shards looks small enough to broadcast
    drawn = pieces.join(turns.hint("merge"), F.col("_s").eqNullSafe(F.col("source")) & (F.col("_n") == F.col("number")))
    place = F.xxhash64(F.lit(plan.seed), "shard", "source", "turn").alias("place")
    return drawn.select("doc_id", "source", "text_key", "size", "_row", "first_word", "words", "shard", place, "part"), documents


def texts(docs: DataFrame, draws: DataFrame) -> DataFrame:
    """The columns of `docs`, one row per draw: `text` is the drawn run of words as it stands in the document.

    A draw of the whole document has the whole text. `n_chars`, if there, is counted anew. Rows that repeat id, source and
    text are told apart by nothing, so their draws read the same text.
    """
    key = ["_id", "_source", "_key"]
    runs = draws.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("text_key").alias("_key")).agg(
        F.collect_list(F.struct("first_word", "words", "size", "shard", "place", "part")).alias("_runs")
    )
    keyed = docs.withColumns({"_i": F.col("doc_id"), "_s": F.col("source"), "_k": F.md5(F.col("text"))})
    one = keyed.dropDuplicates(["_i", "_s", "_k"])
    same = F.col("_i").eqNullSafe(F.col("_id")) & F.col("_s").eqNullSafe(F.col("_source")) & (F.col("_k") == F.col("_key"))
    joined = one.join(runs, same).drop(*key, "_i", "_s", "_k")
    text_at = joined.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK_BYTES // 4):
            rows, out = [], []
            for i, (text, runs_of) in enumerate(zip(batch.column(text_at).to_pylist(), batch.column("_runs").to_pylist())):
                spans = None
                for run in sorted(runs_of, key=lambda r: (r["shard"], r["place"], r["part"])):
                    rows.append(i)
                    if run["words"] == run["size"]:
                        out.append(text)
                        continue
                    spans = spans or [m.span() for m in _WORD.finditer(text)]
                    out.append(text[spans[run["first_word"]][0] : spans[run["first_word"] + run["words"] - 1][1]])
            taken = batch.select(list(range(batch.num_columns - 1))).take(pa.array(rows, pa.int64()))
            columns = list(taken.columns)
            columns[text_at] = pa.array(out, batch.schema.field(text_at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=taken.schema)

    mixed_rows = joined.mapInArrow(cut, StructType(joined.schema.fields[:-1]))
    return mixed_rows.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else mixed_rows
