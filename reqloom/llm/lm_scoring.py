"""Language-model scoring by context-tree weighting over bytes.

A text is coded as its words (A-Z lower-cased), each followed by one space, and a line feed for its end. Every byte is
eight binary decisions; each has a context tree over the `depth` bytes before it (spaces before the text's start). A tree
node holds the zeros and ones seen there and their Krichevsky-Trofimov block probability, and weighs it against its
children's product: P = (KT + product of the children) / 2. That depends on counts only, so the training texts can be
counted anywhere and in any order, and the model is what sequential weighting would have reached. A text is scored with
the model as trained: each decision's probability mixes the estimates of all depths by the nodes' weights.

Texts are read once into blocks, as numbers of the block's distinct words. Only a block's distinct words and its distinct
grams (a context and its byte) move between tasks, to be counted, and to bring their values back to the block. No table
grows on the driver: it holds the nodes of depth 0 and 1, 65,535 at most. Counted grams reach a task in the order of their
contexts, which works on some hundred thousand at once, cut between contexts of three bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reqloom.llm.shared import Words, blocks, numbered, sums_by_text, texts_of
from reqloom.operators.staging import stage

DEPTH = 5
SPACE = 0x20
#: Bytes of text in a block, and in the part of a block that is worked on at once; counted grams worked on at once.
BLOCK, PART, CHUNK = 32 << 20, 1 << 18, 50_000
#: Grams that share so many bytes of context are worked on at once.
CUT = 3
#: Shares that the contexts below one node are dealt into.
SHARES = 16
HALF = np.log(0.5)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x >= 0.5, by Stirling's series at x + 8."""
    shifted, product = x + 8.0, x.copy()
    for i in range(1, 8):
        product = product * (x + i)
    square = 1 / (shifted * shifted)
    series = (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square / 1680))) / shifted
    return (shifted - 0.5) * np.log(shifted) - shifted + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def block_probability(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1.0)


def grams_of(coded: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Context and byte, in one number, of each byte of each coded text, and the texts' bounds.

    The number's low byte is the byte itself, its highest the byte just before, then the one before that, and so on.
    """
    pad = bytes([SPACE]) * depth
    joined = np.frombuffer(b"".join([pad + text for text in coded]), dtype=np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(bounds[-1]) + depth * (np.repeat(np.arange(len(coded)), sizes) + 1)
    keys = joined[at]
    for back in range(1, depth + 1):
        keys |= joined[at - back] << (8 * (depth + 1 - back))
    return keys, bounds


def decisions(grams: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The eight tree keys and bits of each gram, shape (8, grams): a key is the bits so far, with a leading one, and the context."""
    context, byte = grams >> 8, grams & 255
    keys = np.stack([(((1 << j) | (byte >> (8 - j))) << (8 * depth)) | context for j in range(8)])
    return keys, np.stack([(byte >> (7 - j)) & 1 for j in range(8)])


class Level:
    """The nodes of one depth: sorted keys, counts, log of the weighted probability, weight of the own estimate."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray | None) -> None:
        self.keys, self.zeros, self.ones = keys, zeros, ones
        own = block_probability(zeros, ones)
        self.log = own if children is None else np.logaddexp(HALF + own, HALF + children)
        self.weight = np.ones(len(own)) if children is None else np.exp(HALF + own - self.log)

    def mix(self, keys: np.ndarray, bits: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        """Probability of the bits at these keys, given what the next depth says; one half where nothing was seen."""
        if not len(self.keys):
            return np.full(len(keys), 0.5)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        estimate = (np.where(bits == 1, self.ones[at], self.zeros[at]) + 0.5) / (self.zeros[at] + self.ones[at] + 1.0)
        return np.where(self.keys[at] == keys, self.weight[at] * estimate + (1 - self.weight[at]) * deeper, 0.5)


def raised(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys of a sorted array and the sums of the values of each."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], *[np.add.reduceat(v, starts) if len(starts) else v for v in values]


def levels(grams: np.ndarray, counts: np.ndarray, depth: int, top: int) -> list[Level]:
    """Levels from `depth` up to `top`, of counted grams whose contexts share what lies above `top`."""
    keys, bits = decisions(grams, depth)
    order = np.argsort(keys.ravel(), kind="stable")
    weights, bit = np.tile(counts.astype(float), 8)[order], bits.ravel()[order]
    keys, zeros, ones = raised(keys.ravel()[order], weights * (bit == 0), weights * (bit == 1))
    out = [Level(keys, zeros, ones, None)]
    for _ in range(depth - top):
        last = out[-1]
        keys, zeros, ones, children = raised(last.keys >> 8, last.zeros, last.ones, last.log)
        out.append(Level(keys, zeros, ones, children))
    return out


def probabilities(grams: np.ndarray, found: list[Level], depth: int, start: int, deeper: np.ndarray | None = None) -> np.ndarray:
    """Probability of each decision, shape (8, grams), after mixing the given levels, the deepest of depth `start`."""
    keys, bits = decisions(grams, depth)
    p = np.full(keys.shape, 0.5) if deeper is None else deeper
    flat = p.ravel()
    for i, level in enumerate(found):
        flat = level.mix(keys.ravel() >> (8 * (depth - start + i)), bits.ravel(), flat)
    return flat.reshape(keys.shape)


def looked_up(wanted: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The value of each wanted key, all of which are among `keys`, which ascend; in their order, a search stays near the last."""
    order = np.argsort(wanted)
    out = np.empty(len(wanted), values.dtype)
    out[order] = values[np.searchsorted(keys, wanted[order])]
    return out


def packed(data: np.ndarray | bytes) -> bytes:
    return pa.compress(data if isinstance(data, bytes) else data.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> bytes:
    return pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True)


def encoded(docs: DataFrame) -> DataFrame:
    """One row per block of texts: its documents, their words as numbers, and its distinct words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, block in enumerate(blocks(batches, "_text", BLOCK)):
            words, pieces, sizes = Words(), [], []
            for piece in blocks([block], "_text", PART):
                codes, bounds = numbered((text.lower() for text in texts_of(piece, "_text")), words)
                pieces.append(codes.astype("<i4"))
                sizes.append(np.diff(bounds))
            codes, bounds = np.concatenate(pieces), np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
            spelled = b" ".join(words)
            del words, pieces
            lists = [pa.ListArray.from_arrays(pa.array([0, block.num_rows], pa.int32()), block.column(c)) for c in ("doc_id", "held_out")]
            sizes = pa.array([[len(codes), len(bounds), len(spelled)]], pa.list_(pa.int64()))
            data = [pa.array([packed(x)]) for x in (codes, bounds, spelled)]
            yield pa.RecordBatch.from_arrays([pa.array([first + number]), *lists, sizes, *data], names=["block", "ids", "held", "sizes", "codes", "bounds", "spelled"])

    source = docs.select("doc_id", "held_out", F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    kind = dict(source.dtypes)["doc_id"]
    return source.mapInArrow(
        run, f"block long, ids array<{kind}>, held array<boolean>, sizes array<long>, codes binary, bounds binary, spelled binary"
    )


class Block:
    """A block read back: `codes`, `bounds`, the `words`, and `train`, whether each document trains the model."""

    def __init__(self, row: dict) -> None:
        n_codes, n_bounds, n_spelled = row["sizes"]
        self.codes = np.frombuffer(unpacked(row["codes"], 4 * n_codes), "<i4") if n_codes else np.zeros(0, "<i4")
        self.bounds = np.frombuffer(unpacked(row["bounds"], 8 * n_bounds), np.int64)
        self.words = unpacked(row["spelled"], n_spelled).split() if n_spelled else []
        self.train = ~np.array(row["held"], dtype=bool)

    def word_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Each word's hash and its count in training documents."""
        keys = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words)).view(np.int64)
        each = np.repeat(self.train, np.diff(self.bounds))
        counts = np.zeros(len(self.words), np.int64)
        for start in range(0, len(each), PART):
            some = slice(start, start + PART)
            counts += np.bincount(self.codes[some][each[some]], minlength=len(counts))
        return keys, counts

    def between(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Words of the documents from `start` to before `end`, and each one's bounds there."""
        bounds = self.bounds[start : end + 1]
        return self.codes[bounds[0] : bounds[-1]], bounds - bounds[0]

    def parts(self) -> Iterator[tuple[int, int, list[bytes]]]:
        """First and last document of a part of about PART bytes, and its coded texts."""
        start, held, size = 0, [], 0
        for i in range(len(self.train)):
            text = b" ".join(map(self.words.__getitem__, self.codes[self.bounds[i] : self.bounds[i + 1]].tolist()))
            held.append(text + b" \n" if text else b"\n")
            size += len(held[-1])
            if size >= PART or i == len(self.train) - 1:
                yield start, i + 1, held
                start, held, size = i + 1, [], 0

    def gram_counts(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The block's distinct grams, ascending, and their counts in training documents."""
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start, end, coded in self.parts():
            grams, bounds = grams_of(coded, depth)
            train = np.repeat(self.train[start:end], np.diff(bounds))
            seen, times = np.unique(grams[train], return_counts=True)
            unseen = np.unique(grams[~train])
            keys += [seen, unseen]
            counts += [times, np.zeros(len(unseen), np.int64)]
            if len(keys) > 32 or end == len(self.train):
                joined = np.concatenate(keys)
                order = np.argsort(joined, kind="stable")
                keys, counts = ([merged] for merged in raised(joined[order], np.concatenate(counts)[order]))
        (keys,), (counts,) = keys, counts
        return keys, counts


def entries(rows: DataFrame, what: str, depth: int) -> DataFrame:
    """`of_block`, `key` and `n` (count in training) of each block's distinct words or grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block, of = Block(batch.slice(at, 1).to_pylist()[0]), batch.column("block")[at].as_py()
                keys, counts = block.word_counts() if what == "words" else block.gram_counts(depth)
                for start in range(0, len(keys), 100_000):
                    some = slice(start, start + 100_000)
                    number = np.full(len(keys[some]), of)
                    yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(keys[some]), pa.array(counts[some])], names=["of_block", "key", "n"])

    return rows.select("block", "held", "sizes", "codes", "bounds", "spelled").mapInArrow(run, "of_block long, key long, n long")


def whole_contexts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Tables of about `most` rows from batches in the order of `place`, none cut within a place.

    Even places have the nodes for the odd ones that follow; a table whose odd places go on from the one before has them too.
    """
    held, size, enough = [], 0, most
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= enough:
            rows = pa.Table.from_batches(held).combine_chunks()
            place = rows.column("place").to_numpy()
            end = int(np.searchsorted(place, place[-1]))
            of_nodes = place[-1] >> 9 << 9
            first, stop = np.searchsorted(place, [of_nodes, of_nodes + 1]) if place[-1] % 2 else (end, end)
            if end > stop - first:
                yield rows.slice(0, end)
                rows = pa.concat_tables([rows.slice(first, stop - first), rows.slice(end)])
            held, size = rows.to_batches(), rows.num_rows
            enough = max(most, 2 * size)
    if size:
        yield pa.Table.from_batches(held)


def in_order(rows: DataFrame, *together: F.Column) -> DataFrame:
    """Rows alike in these columns in one task, in the order of `place`."""
    return rows.repartition(*together).sortWithinPartitions("place", "key")


def placed(counted: DataFrame, depth: int, cut: int) -> DataFrame:
    """Grams with their place: their contexts' first `cut` bytes, doubled, and one."""
    return counted.withColumn("place", F.shiftright("key", 8 * (depth + 1 - cut)) * 2 + 1)


SUMS = "key long, zeros double, ones double, log double"


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "log")])


def arrays(rows: pa.Table | pa.RecordBatch) -> list[np.ndarray]:
    """Keys, zeros, ones and log of the children's product, ascending by key."""
    columns = [rows.column(c).to_numpy() for c in ("key", "zeros", "ones", "log")]
    order = np.argsort(columns[0], kind="stable")
    return [c[order] for c in columns]


def given_up(level: Level) -> pa.RecordBatch:
    """What a level's nodes add to the level above."""
    columns = raised(level.keys >> 8, level.zeros, level.ones, level.log)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "zeros", "ones", "log"])


def inner_nodes(counted: DataFrame, depth: int, cut: int, chunk: int) -> DataFrame:
    """Nodes of depth `cut` - 1, from the sums that the trees below give up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_contexts(batches, chunk):
            yield given_up(levels(rows.column("key").to_numpy(), rows.column("n").to_numpy(), depth, cut)[-1])

    return stage(summed(in_order(placed(counted.where("n > 0"), depth, cut), F.col("place")).mapInArrow(run, SUMS)))


def upper_levels(nodes: DataFrame, cut: int) -> list[Level]:
    """Levels above `nodes`, up to 0; 256 * 255 rows at most reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield given_up(Level(*arrays(batch)))

    rows = sorted(summed(nodes.mapInArrow(run, SUMS)).collect())
    table = np.array([tuple(row) for row in rows], dtype=float).reshape(-1, 4)
    out = [Level(table[:, 0].astype(np.int64), *table[:, 1:].T)]
    for _ in range(cut - 2):
        out.append(Level(*raised(out[-1].keys >> 8, out[-1].zeros, out[-1].ones, out[-1].log)))
    return out


def gram_scores(counted: DataFrame, depth: int, chunk: int = CHUNK) -> DataFrame:
    """`key` and `log_p` (base 10) of every gram, counted in training or not."""
    cut = min(CUT, depth)
    nodes = inner_nodes(counted, depth, cut, chunk)
    upper = upper_levels(nodes, cut)
    at = F.col("key").bitwiseAND(F.lit((1 << 8 * (cut - 1)) - 1)) * 512

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_contexts(batches, chunk):
            is_gram = rows.column("place").to_numpy() % 2 == 1
            of_nodes, of_grams = rows.filter(pa.array(~is_gram)), rows.filter(pa.array(is_gram))
            grams, counts = of_grams.column("key").to_numpy(), of_grams.column("n").to_numpy()
            seen = counts > 0
            found = [*levels(grams[seen], counts[seen], depth, cut), Level(*arrays(of_nodes))]
            p = probabilities(grams, found, depth, depth)
            p = probabilities(grams, upper, depth, cut - 2, p)
            yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(np.log10(p).sum(axis=0))], names=["key", "log_p"])

    # a node goes to every share; one that meets itself again in a task does no harm
    grams = placed(counted, depth, cut).withColumn("share", F.shiftright("place", 1) % SHARES)
    copies = nodes.withColumn("place", at).withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SHARES - 1).cast("long"))))
    both = in_order(grams.unionByName(copies, allowMissingColumns=True), F.shiftright("place", 9), F.col("share"))
    return both.drop("share").mapInArrow(run, "key long, log_p double")


def score(docs: DataFrame, held_out: str = "held_out", depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every whole text.

    `docs` has doc_id, text and a boolean `held_out`; texts not held out train the model (null: not held out); other
    columns play no part. `base_score` is the log10 probability under smoothed word frequencies, `score` that under the
    weighted trees. A null or empty text is its end alone. Rows that repeat train and are scored each. Without any
    training text every decision is one half. An empty table gives an empty one. Words are told apart by a 64-bit hash.

    A word or gram has one row per block that holds it, so no group grows with its number of occurrences. A word found in
    one block only needs no way back: its count is the block's own.
    """
    marked = docs.select("doc_id", "text", F.coalesce(F.col(held_out), F.lit(False)).alias("held_out"))
    rows = stage(encoded(marked))
    texts = rows.agg(F.sum(F.size(F.filter("held", lambda held: ~held))).alias("n")).first()[0] or 0
    words, grams = entries(rows, "words", depth), stage(entries(rows, "grams", depth))

    counted = stage(words.withColumn("value", F.sum("n").over(Window.partitionBy("key"))))
    gram_counts = stage(grams.groupBy("key").agg(F.sum("n").alias("n")))
    scores = gram_scores(gram_counts, depth)
    # a word's first block speaks for it
    first = counted.groupBy("key").agg(F.max("value").alias("value")).where("value > 0")
    known_words, kinds = first.agg(F.coalesce(F.sum("value"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = known_words + texts, kinds + (texts > 0)
    divisor = tokens + 0.1 * (distinct + 1)

    words_back = counted.where("value != n").select("of_block", F.lit(True).alias("word"), "key", F.col("value").cast("double").alias("value"))
    grams_back = grams.select("of_block", "key").join(scores, "key").select("of_block", F.lit(False).alias("word"), "key", F.col("log_p").alias("value"))
    back = words_back.union(grams_back)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block(left.select(["held", "sizes", "codes", "bounds", "spelled"]).to_pylist()[0])
        word = right.column("word").to_numpy().astype(bool)
        key, value = right.column("key").to_numpy(), right.column("value").to_numpy()
        hashes, own = block.word_counts()
        count = own.astype(float)
        if word.any():
            order = np.argsort(key[word])
            known, total = key[word][order], value[word][order]
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            count = np.where(known[at] == hashes, total[at], count)
        order = np.argsort(key[~word])
        keys, log_p = key[~word][order], value[~word][order]
        known, log_base = (count > 0).astype(np.int64), np.log10((count + 0.1) / divisor)
        n_known, base, full, size = (np.zeros(len(block.train), kind) for kind in (np.int64, float, float, float))
        for start, end, coded in block.parts():
            grams, bounds = grams_of(coded, depth)
            full[start:end] = sums_by_text(looked_up(grams, keys, log_p), bounds)
            size[start:end] = np.diff(bounds)
            codes, bounds = block.between(start, end)
            n_known[start:end] = sums_by_text(known[codes], bounds) + (texts > 0)
            base[start:end] = sums_by_text(log_base[codes], bounds) + np.log10((texts + 0.1) / divisor)
        ids, held = (left.column(name).combine_chunks().flatten() for name in ("ids", "held"))
        n_tokens = np.diff(block.bounds) + 1
        columns = [ids, held, n_tokens, n_known, np.full(len(n_tokens), tokens), base, full, -full / np.log10(2) / size]
        return pa.table(dict(zip(("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"), columns)))

    kind = dict(docs.dtypes)["doc_id"]
    return (
        rows.groupBy("block")
        .cogroup(back.groupBy("of_block"))
        .applyInArrow(
            run,
            f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
            "bits_per_byte double",
        )
    )
