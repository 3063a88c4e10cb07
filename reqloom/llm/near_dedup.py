"""Near-duplicate classes: five-word shingles, ProbMinHash signatures, banding, verification, components.

Each shingle is a Poisson process whose arrivals, at a rate of its weight, fall on random components; the first arrival on a
component signs it, so two texts agree on a component with the probability of their probability Jaccard similarity. A
shingle's process stops once its arrivals come after all components' signs. A shingle that a text repeats is mostly common
matter and weighs less, down to 1 - LESS. Links are defined on sets: with weights that close, sets at a similarity of 0.8
agree on 0.78 of the components or more where weights are alike, so signatures only choose whom to compare.

Texts with equal words are one node. Nodes that share a band's components fall into a bucket. Within a bucket a node is
paired with the bucket's first node and with its neighbours in the order of the rest of the signature; no bucket is paired
out as a whole or held by one task. Pairs whose signatures agree enough are verified on the shingles themselves. A second
round takes the buckets in which several classes are left: small ones pair all nodes of different classes; the nodes of
large ones are paired by their rarest shingles, a prefix long enough that no two sets of the similarity can miss each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from reqloom.llm.shared import Words, blocks, mixed, numbered, texts_of, windows
from reqloom.operators.staging import stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 24
BAND_ROWS = 4
#: Pairs whose signatures agree less are not verified: five standard deviations below the similarity.
ESTIMATE = 0.5
#: What repeats take from a shingle's weight at most.
LESS = 0.1
NEIGHBOURS = 2
#: Pairs that differ in more of the signature's bits are not compared further: at the similarity a bit differs with
#: a chance of a tenth, so this is near five standard deviations above what is expected.
DIFFERENT = 24
#: A bucket of at most so many nodes pairs all of them that are in different classes.
SMALL = 48
#: Earlier shingles by which a pair that was already given is told; it is given at least once whatever their number.
BEFORE = 8
#: Classes of shingles that are counted to tell rare from common ones; the counts go to every task.
TALLIES = 1 << 16
#: Nodes of one side of a shingle's list that a block of pairs holds.
BLOCK = 1024
#: Bytes of text that a task works on at once.
TEXT_BLOCK = 1 << 20


def shingles_of(texts: list[bytes], words: Words, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, the texts' bounds, and how often each text has each shingle."""
    codes, bounds = numbered(texts, words)
    runs, edges = windows(words.hash_array()[codes], bounds, width)
    text = np.repeat(np.arange(len(texts)), np.diff(edges))
    order = np.lexsort((runs, text))
    runs, text = runs[order], text[order]
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:] != runs[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(first)
    sizes = np.bincount(text[at], minlength=len(texts))
    return runs[at], np.concatenate(([0], np.cumsum(sizes))).astype(np.int64), np.diff(at, append=len(runs))


def weights_of(times: np.ndarray) -> np.ndarray:
    """Weights of shingles that a text has so often: 1 for one, and never less than 1 - LESS."""
    return 1.0 - LESS * (1.0 - 1.0 / times)


def signatures(shingles: np.ndarray, weights: np.ndarray, bounds: np.ndarray, length: int) -> np.ndarray:
    """One row of `length` shingle hashes per text; a row of zeros for a text without shingles."""
    texts = len(bounds) - 1
    text = np.repeat(np.arange(texts), np.diff(bounds))
    first = np.full(texts * length, np.inf)
    sign = np.zeros(texts * length, np.uint64)
    last = np.full(texts, np.inf)
    when, alive, turn = np.zeros(len(shingles)), np.arange(len(shingles)), 0
    while len(alive):
        turn += 1
        noise = mixed(shingles[alive] + np.uint64(turn * 0x9E3779B97F4A7C15 % (1 << 64)))
        when[alive] -= np.log(((noise >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / weights[alive]
        keep = when[alive] < last[text[alive]]
        alive, noise = alive[keep], noise[keep]
        slot = text[alive] * length + (mixed(noise + np.uint64(1)) % np.uint64(length)).astype(np.int64)
        np.minimum.at(first, slot, when[alive])
        won = first[slot] == when[alive]
        sign[slot[won]] = shingles[alive[won]]
        changed = np.unique(text[alive])
        last[changed] = first.reshape(texts, length)[changed].max(axis=1)
    return sign.reshape(texts, length)


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, `text_key` (md5 of the text), `digest` (md5 of its lower-cased words), `n` shingles, `signature`.

    `b0` and `b1` hold one bit of each component of the signature.
    """
    length = BANDS * BAND_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "_text", TEXT_BLOCK):
            texts, words = [text.lower() for text in texts_of(block, "_text")], Words()
            shingles, bounds, times = shingles_of(texts, words)
            rows = signatures(shingles, weights_of(times), bounds, length).astype(np.uint32).view(np.int32)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * length), pa.array(rows.ravel()))
            digest = pa.array([hashlib.md5(b" ".join(text.split())).digest() for text in texts], pa.binary())
            bits = np.zeros((len(texts), 128), dtype=np.uint8)
            bits[:, :length] = rows & 1
            words64 = np.packbits(bits, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("text_key"), digest, pa.array(np.diff(bounds)), flat, *[pa.array(words64[:, i]) for i in range(2)]],
                names=["doc_id", "text_key", "digest", "n", "signature", "b0", "b1"],
            )

    source = docs.select("doc_id", F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"), F.col("text").alias("_text"))
    fields = [source.schema["doc_id"], StructField("text_key", StringType()), StructField("digest", BinaryType())]
    sketch = [StructField("signature", ArrayType(IntegerType())), StructField("b0", LongType()), StructField("b1", LongType())]
    return source.mapInArrow(run, StructType([*fields, StructField("n", LongType()), *sketch]))


def alike(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Whether two texts' bits differ little enough for the signatures to be compared."""
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1])) <= DIFFERENT


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root` (the least node of its component) for every node of `edges` (a, b) that is not itself a root.

    Alternating large and small stars; every round is written to the shared folder. A round moves each edge once, and only
    minima are gathered by node.
    """

    def mark(rows: DataFrame) -> tuple:
        return tuple(rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    rows = stage(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), edges.count())
    before = mark(rows)
    while True:
        both = rows.union(rows.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("at"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("at")).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "at")
        joined = large.join(least, F.col("a") == F.col("at"))
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("at").alias("a"), F.col("m").alias("b")))
        # an edge gives one large star's edge, and that one small star's edge and at most one of its node
        rows = stage(small.where("a != b").distinct(), 2 * before[0])
        after = mark(rows)
        if after == before:
            return rows.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after


def neighbours(buckets: DataFrame, distance: int = NEIGHBOURS) -> DataFrame:
    """Pairs (a, b) of nodes at most `distance` apart in a bucket's order. Sorted ranges, so a large bucket is many tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            held = [np.concatenate((old[-distance:], batch.column(name).to_numpy())) for old, name in zip(held, ("bucket", "node", "b0", "b1"))]
            keys, nodes, b0, b1 = held
            pairs = []
            for gap in range(1, distance + 1):
                differ = sum(np.bitwise_count((b[gap:] ^ b[:-gap]).view(np.uint64)).astype(np.int64) for b in (b0, b1))
                same = (keys[gap:] == keys[:-gap]) & (differ <= DIFFERENT)
                pairs.append((nodes[:-gap][same], nodes[gap:][same]))
            a, b = (np.concatenate([p[i] for p in pairs]) for i in range(2))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    ordered = buckets.repartitionByRange("bucket", "rest", "node").sortWithinPartitions("bucket", "rest", "node")
    return ordered.select("bucket", "node", "b0", "b1").mapInArrow(run, "a long, b long").where("a != b")


def verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose signatures agree enough and whose shingle sets have a Jaccard similarity of `similarity`."""
    signature = nodes.select("node", "signature")
    near = (
        pairs.distinct()
        .join(signature.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a")
        .join(signature.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b")
        .where(F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda same: same)) >= ESTIMATE * BANDS * BAND_ROWS)
        .select("a", "b")
    )
    both = near.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b").join(
        sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a"
    )
    common = F.size(F.array_intersect("x", "y"))
    # 1e-9: a share of exactly the similarity counts, whatever its last binary digit
    return both.where(common >= (similarity - 1e-9) * (F.size("x") + F.size("y") - common)).select("a", "b")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, text_key, `class_id` (least doc_id of its class), `class_size`, `keep`.

    `docs` has doc_id and text; other columns play no part. Two texts are linked if their sets of five-word shingles (A-Z
    lower-cased) have a Jaccard similarity of at least `similarity`, or if their words are the same; classes are the
    connected components. Null and empty texts have the same, empty words and form one class; texts under five words are
    linked to equal ones only. `keep` marks one document per class, the first by id and text (null ids last); of rows that
    repeat id and text, all are marked alike. A class of null ids alone has a null class_id. An empty table gives an empty
    one.
    """
    rows = stage(signed(docs).withColumn("row", F.monotonically_increasing_id()))
    nodes = stage(
        rows.groupBy("digest")
        .agg(F.min_by(F.struct("row", "text_key", "n", "signature", "b0", "b1"), "row").alias("first"))
        .select("digest", F.col("first.row").alias("node"), *[f"first.{c}" for c in ("text_key", "n", "signature", "b0", "b1")])
    )
    shingled = nodes.where("n > 0")
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.struct(
            F.xxhash64(i, F.slice("signature", i * BAND_ROWS + 1, F.lit(BAND_ROWS))).alias("bucket"),
            F.xxhash64(F.slice("signature", ((i + 1) % BANDS) * BAND_ROWS + 1, F.lit(1))).alias("rest"),
        ),
    )
    every = shingled.select("node", "b0", "b1", F.posexplode(bands).alias("band", "at")).select("node", "b0", "b1", "band", "at.bucket", "at.rest")
    heads = every.groupBy("bucket").agg(F.min(F.struct("node", "b0", "b1")).alias("head"), F.count(F.lit(1)).alias("held")).where("held > 1")
    buckets = stage(every.join(heads, "bucket"))
    stars = buckets.where((F.col("head.node") != F.col("node")) & alike((F.col("head.b0"), F.col("head.b1")), (F.col("b0"), F.col("b1"))))
    stars = stars.select(F.col("head.node").alias("a"), F.col("node").alias("b"))
    # a bucket's row gives a pair with its first node and NEIGHBOURS more
    most = (1 + NEIGHBOURS) * buckets.count()
    candidates = stage(stars.union(neighbours(buckets)).distinct(), most)
    sets = stage(_sets(docs, nodes.join(buckets.select("node").distinct(), "node", "left_semi")))
    # one pair per node first, with the least node it met; then what still lies between classes
    first = candidates.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = stage(verified(first, nodes, sets, similarity), most)
    roots = components(links)
    others = _between(candidates, roots)
    links = stage(links.union(verified(others, nodes, sets, similarity)), most)
    roots = components(links)
    more = _rest(buckets, roots, sets, similarity).join(candidates, ["a", "b"], "left_anti")
    links = stage(links.union(verified(more, nodes, sets, similarity)))
    roots = components(links)

    of_node = nodes.select("digest", "node").join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"))
    placed = rows.select("doc_id", "text_key", "digest").join(of_node, "digest")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    classes = placed.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"), F.min(order).alias("_first"))
    out = placed.join(classes, "root")
    keep = F.col("doc_id").eqNullSafe(F.col("_first.doc_id")) & (F.col("text_key") == F.col("_first.text_key"))
    return out.select("doc_id", "text_key", "class_id", "class_size", keep.alias("keep"))


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """`node` and its distinct shingles (32-bit hashes) for the given nodes, read from one of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "_text", TEXT_BLOCK):
            shingles, bounds, _ = shingles_of([text.lower() for text in texts_of(block, "_text")], Words())
            values = pa.array((shingles >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays([block.column("node"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)], names=["node", "shingles"])

    keyed = docs.select(F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"), F.col("text").alias("_text"))
    # of exact copies one goes on from each task that reads some
    keyed = keyed.groupBy("text_key").agg(F.any_value("_text").alias("_text"))
    found = keyed.join(nodes.select("text_key", "node"), "text_key").select("node", "_text")
    return found.mapInArrow(run, "node long, shingles array<int>")


def _classed(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """`rows` with `class`, the root of its `node`."""
    named = roots.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
    return rows.join(named, F.col("node") == F.col("_n"), "left").withColumn("class", F.coalesce("_r", "node")).drop("_n", "_r")


def _between(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose nodes are in different classes."""
    a = _classed(pairs.withColumnRenamed("a", "node"), roots).withColumnsRenamed({"node": "a", "class": "ca"})
    b = _classed(a.withColumnRenamed("b", "node"), roots).withColumnsRenamed({"node": "b", "class": "cb"})
    return b.where("ca != cb").select("a", "b")


def _several(buckets: DataFrame) -> DataFrame:
    """The rows of buckets with more than one class, with `held`, their number of rows."""
    found = buckets.groupBy("bucket").agg(F.min("class").alias("_low"), F.max("class").alias("_high"), F.count(F.lit(1)).alias("held"))
    return buckets.drop("held").join(found.where("_low != _high").select("bucket", "held"), "bucket")


def _crossed(buckets: DataFrame) -> DataFrame:
    """All pairs of nodes of different classes in buckets of at most SMALL rows."""
    small = buckets.where(F.col("held") <= SMALL).select("bucket", "node", "class", "b0", "b1")
    other = small.select("bucket", *[F.col(c).alias(f"_{c}") for c in ("node", "class", "b0", "b1")])
    near = alike((F.col("b0"), F.col("b1")), (F.col("_b0"), F.col("_b1")))
    met = small.join(other, "bucket").where((F.col("node") < F.col("_node")) & (F.col("class") != F.col("_class")) & near)
    return met.select(F.col("node").alias("a"), F.col("_node").alias("b"))


def _prefixed(nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs of nodes of different classes that may have the similarity: none that has it is missing.

    `nodes` has node, class, b0 and b1. Shingles are ordered from the rarest, as far as the counts of TALLIES classes of them
    tell: any order that all sets share will do. Two sets of the similarity share one among the first of each. The smaller set
    needs fewer of them than the larger, so shingles of a common template stay out of its part. A shingle's list is paired in
    blocks of BLOCK by BLOCK nodes.
    """
    each = sets.join(nodes, "node").select("node", "class", "b0", "b1", "shingles")
    shingle = each.select(F.explode("shingles").alias("shingle"))
    tally = shingle.groupBy(F.pmod("shingle", F.lit(TALLIES)).alias("of")).agg(F.count(F.lit(1)).alias("n"))
    common = np.zeros(TALLIES, np.int64)
    for row in tally.collect():  # TALLIES rows at most
        common[row.of] = row.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("shingles")
            sizes = np.diff(lists.offsets.to_numpy())
            shingles, text = lists.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((shingles, common[shingles % TALLIES], text))
            ranked, n = shingles[order], sizes[text]
            at = np.arange(len(ranked)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
            least = lambda share: np.ceil(share * n - 1e-6)
            kept = np.flatnonzero(at <= n - least(similarity) + 1)
            early = (at <= n - least(2 * similarity / (1 + similarity)) + 1)[kept]
            held = np.minimum(at[kept] - 1, BEFORE)
            edges = np.concatenate(([0], np.cumsum(held)))
            before = ranked[np.repeat(kept - held, held) + np.arange(edges[-1]) - np.repeat(edges[:-1], held)]
            of_node = [batch.column(name).take(pa.array(text[kept])) for name in ("node", "class", "b0", "b1")]
            columns = [*of_node, pa.array(n[kept].astype(np.int32)), pa.array(ranked[kept]), pa.array(at[kept].astype(np.int32))]
            columns += [pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(before)), pa.array(early)]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "class", "b0", "b1", "n", "shingle", "at", "before", "early"])

    listed = stage(each.mapInArrow(run, "node long, class long, b0 long, b1 long, n int, shingle int, at int, before array<int>, early boolean"))
    lists = listed.groupBy("shingle").agg(
        F.min("class").alias("_low"), F.max("class").alias("_high"),
        F.ceil(F.count_if("early") / BLOCK).alias("rows"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("columns"),
    )
    placed = listed.join(lists.where("_low != _high and rows > 0").select("shingle", "rows", "columns"), "shingle")
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    own = lambda count: F.pmod(F.xxhash64("node"), F.col(count))
    names = ("node", "class", "b0", "b1", "n", "at", "before")
    short = placed.where("early").select("shingle", *names, own("rows").alias("row"), every("columns").alias("column"))
    long = placed.select("shingle", *[F.col(c).alias(f"_{c}") for c in names], every("rows").alias("row"), own("columns").alias("column"))
    ordered = (F.col("n") < F.col("_n")) | ((F.col("n") == F.col("_n")) & (F.col("node") < F.col("_node")))
    # what follows the first shingle they share must be enough
    common = 1 + F.least(F.col("n") - F.col("at"), F.col("_n") - F.col("_at"))
    enough = common >= similarity / (1 + similarity) * (F.col("n") + F.col("_n")) - 1e-6
    near = alike((F.col("b0"), F.col("b1")), (F.col("_b0"), F.col("_b1")))
    # a pair that shares one of the shingles just before comes from that one
    first = ~F.arrays_overlap("before", "_before")
    found = short.join(long, ["shingle", "row", "column"]).where((F.col("class") != F.col("_class")) & ordered & enough & near & first)
    return found.select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct()


def _rest(buckets: DataFrame, roots: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs of different classes that the first round did not compare, from buckets that still hold several classes.

    Buckets of at most SMALL rows pair all their nodes, the nodes of larger ones are paired by prefixes of their shingles.
    """
    several = stage(_several(_classed(buckets.select("bucket", "node", "b0", "b1"), roots)))
    large = several.where(F.col("held") > SMALL).select("node", "class", "b0", "b1").distinct()
    return _crossed(several).union(_prefixed(large, sets, similarity)).distinct()


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of `docs`, all columns, without all but one document of each near-duplicate class."""
    kept = near_duplicates(docs, similarity).where("keep").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    keyed = docs.withColumns({"_i": F.col("doc_id"), "_k": F.md5(F.coalesce(F.col("text"), F.lit("")))})
    found = keyed.join(kept, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key")), "left_semi")
    # rows that repeat id and text: one stays
    return found.dropDuplicates(["_i", "_k"]).drop("_i", "_k")
