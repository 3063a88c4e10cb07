"""Each operator on awkward rows, and against a plain version where SQL has none."""

from __future__ import annotations

import json
import math
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from reqloom.llm import line_dedup, lm_scoring, mixing, near_dedup, packing, personal_data, quality, quality_rules, secret_scan, top_k
from reqloom.llm.shared import mixed
from reqloom.operators import staging

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, block long, n int"
LONG = "lorem ipsum dolor " * 20_000

ROWS = [
    (1, "alpha beta gamma delta epsilon zeta\nshared line", "en", "a", 1, 0.1, 1, 1),
    (2, "alpha beta gamma delta epsilon zeta\nshared line", "en", "a", 1, None, None, None),
    (2, "alpha beta gamma delta epsilon zeta\nshared line", "en", "a", 1, None, None, None),
    (3, None, None, None, None, None, None, None),
    (4, "", "en", "b", 0, 0.2, 2, 2),
    (5, " \t\n\x0b ", "en", "b", 5, 0.2, 2, 2),
    (6, LONG, "en", "c", len(LONG), 0.2, 2, 2),
    (None, "one two three", "en", "a", 3, 0.2, 2, 2),
    (8, "mail x.y@mail.example.com 10.0.0.1 and 4111 1111 1111 1111 or +1 (743) 555-3824", "en", None, 3, 0.2, 2, 2),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_line_dedup(odd, none):
    kept = line_dedup.drop_common_lines(odd, min_documents=2)
    rows = {(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in kept.collect()}
    assert (1, 2, 2, "") in rows and (3, 1, 0, "") in rows and (4, 1, 0, "") in rows and (5, 2, 0, " \t\n\x0b ") in rows
    assert kept.count() == len(ROWS) and set(kept.columns) == {*odd.columns, "n_lines", "n_dropped"}
    assert line_dedup.drop_common_lines(none).count() == 0


def test_quality(odd, none, documents, spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    weights = quality.train(documents, labels)
    rows = quality.score(odd, weights).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert set(quality.keep_good(odd, weights, threshold=0.0).columns) == set(odd.columns)
    assert quality.score(none, weights).count() == 0
    assert not quality.train(none, labels).any() and not quality.train(documents, labels.limit(0)).any()


def test_quality_of_held_out_documents(spark):
    from reqloom.llm.queries import op6_quality

    folder = SMALL.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    held = op6_quality(spark, folder).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9


def test_updates_follow_the_regularised_leader():
    settings = quality.Settings(bits=2, l1=0.1)
    leader, z, n = quality.Leader(settings), np.zeros(5), np.zeros(5)
    for at, values, label in (([0, 4], [1.0, 1.0], 1), ([0, 1, 4], [0.5, 2.0, 1.0], 0), ([1, 4], [1.0, 1.0], 1)):
        leader.learn(np.array(at), np.array(values), label)
        w = [0.0 if abs(z[i]) <= 0.1 else -(z[i] - math.copysign(0.1, z[i])) / ((1 + math.sqrt(n[i])) / 0.3 + 1e-4) for i in range(5)]
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip(at, values))))
        for i, v in zip(at, values):
            g = (p - label) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.3 * w[i]
            n[i] += g * g
    assert np.allclose(leader.z, z) and np.allclose(leader.n, n)


def test_quality_rules(odd, none, documents, spark):
    ratios = quality_rules.ratio_table(documents, documents.select("doc_id").limit(50))
    assert quality_rules.measure(none, ratios).count() == 0
    for docs in (odd, documents):
        texts = [r.text for r in docs.select("text").collect()]
        for text, row in zip(texts, quality_rules.measure(docs, ratios, ("doc_id",)).collect()):
            w, t = words(text), text or ""
            runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
            seen: dict = {}
            for run in runs:
                seen[run] = seen.get(run, 0) + 1
            covered = {i + j for i, run in enumerate(runs) if seen[run] > 1 for j in range(3)}
            lines = [x for x in t.split("\n") if words(x)]
            assert (row.n_words, row.word_chars, row.n_symbols) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t))
            assert (row.n_dup_lines, row.n_repeat_words) == (len(lines) - len(set(lines)), len(covered))
            assert row.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_mixing(odd, none, documents):
    draws, rows = mixing.mix(none)
    assert draws.count() == 0 and rows.count() == 0
    draws, rows = mixing.mix(odd)
    assert rows.count() == len(ROWS)
    assert {r._row for r in draws.collect()} <= {r._row for r in rows.where("size > 0").collect()}
    assert mixing.texts(odd, draws).columns == odd.columns
    draws, rows = mixing.mix(documents)
    taken = draws.groupBy("source").agg(F.sum("words").alias("taken")).join(rows.select("source", "target", "source_size").distinct(), "source").collect()
    assert all(abs(r.taken - r.target) <= 300 for r in taken)
    assert abs(sum(r.target for r in taken) / sum(r.source_size for r in taken) - 1.5) < 1e-9
    assert draws.groupBy("_row").agg(F.sum("words").alias("t"), F.max("size").alias("s")).where("t > 2 * s").count() == 0
    text = {r.doc_id: r.text for r in documents.collect()}
    for r in mixing.texts(documents, draws).limit(200).collect():
        assert r.text in text[r.doc_id]
    again = {tuple(r) for r in mixing.mix(documents)[0].drop("_row").collect()}
    assert again == {tuple(r) for r in draws.drop("_row").collect()}


def test_mixing_draws_in_one_python_step(documents, capsys):
    # each further step in a stage is one more Python process for every task that runs
    draws, _ = mixing.mix(documents)
    draws.explain()
    assert capsys.readouterr().out.count("MapInPandas") == 1


def test_permutation_and_tree():
    for size in (1, 2, 7, 100, 1000):
        at = np.arange(size)
        assert sorted(mixing.permuted(at, np.full(size, size), np.full(size, 5)).tolist()) == at.tolist()
    quotas, plan = np.array([5, 0, 17, 90]), mixing.Plan()
    found = list(mixing.leaves(quotas, 7, plan, 0, 7))
    assert [f[0] for f in found] == list(range(7)) and (sum(f[2] for f in found) == quotas).all()
    assert all((a[1] + a[2] == b[1]).all() for a, b in zip(found, found[1:]))
    one = next(mixing.leaves(quotas, 7, plan, 3, 4))
    assert (one[1] == found[3][1]).all() and (one[2] == found[3][2]).all()


def test_packing(odd, none, documents):
    assert packing.pack(none).count() == 0
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    tokenizer.encode_special_tokens = True
    for docs in (odd, documents):
        texts = sorted((r.doc_id or 0, r.text or "") for r in docs.select("doc_id", "text").collect())
        ids = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], dtype="<u4") for _, t in texts]
        rows = packing.pack(docs, with_ids=True).collect()
        want = sorted((d, len(x), s, zlib.crc32(x[s : s + 2048].tobytes())) for (d, _), x in zip(texts, ids) for s in range(0, len(x), 2048))
        assert want == sorted((r.doc_id or 0, r.doc_tokens, r.start, r.ids_crc32) for r in rows)
        held: dict = {}
        for r in rows:
            assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
            held.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for pieces in held.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= 2048


def test_other_files_go_through_the_library(tmp_path):
    content = json.loads(open(public_tokenizers.path(packing.TOKENIZER), encoding="utf-8").read())
    content["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(content))
    other, texts = packing.Encoder(str(path)), ["one two", "", " <|endoftext|> é"]
    assert other.table is None
    want = Tokenizer.from_file(str(path))
    want.encode_special_tokens = True
    assert [np.frombuffer(ids, "<u4").tolist() for ids in other.encode(texts)] == [want.encode(t, add_special_tokens=False).ids for t in texts]


def test_closest_is_the_best_sum():
    import itertools

    rng = random.Random(1)
    for _ in range(30):
        lengths = [rng.randint(1, 60) for _ in range(9)]
        counts = {x: lengths.count(x) for x in lengths}
        used = packing.closest(counts, 100)
        best = max(s for n in range(10) for c in itertools.combinations(lengths, n) if (s := sum(c)) <= 100)
        assert sum(k * n for k, n in used.items()) == best and all(n <= counts[k] for k, n in used.items())


def test_cuts_do_not_change_ids():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    texts = ["a  b   c\n\n d\t e", " x", "x ", "", "don't we'll <|endoftext|> é  ü", "1 2\n 3 \n4", "\n \n", "a  b"]
    tokenizer.encode_special_tokens = True
    rng, signs = random.Random(1), [*"aB1 '._\n\t\r\x00\x1c\x7f\x85\xa0\xad\xb2éßŁƂ中🙂\u3000\u200b\u0301", "'s", "'ll", "  "]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    encoder = packing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    assert encoder.table is not None
    for start in range(0, len(texts), 500):
        some = texts[start : start + 500]
        for text, found in zip(some, encoder.encode(some)):
            assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def plain_classes(rows):
    """Least id of each document's class, by comparing all pairs."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = [words((text or "").translate(lower)) for _, text in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in split]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if split[i] == split[j] or both and both >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {rows[i][0]: min(rows[j][0] for j in range(len(rows)) if find(j) == find(i)) for i in range(len(rows))}


def test_near_duplicates(odd, none, spark):
    assert near_dedup.near_duplicates(none).count() == 0
    rows = near_dedup.near_duplicates(odd).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows}
    assert by[1].class_id == by[2].class_id == 1 and by[1].class_size == 3 and by[3].class_id == by[4].class_id == by[5].class_id == 3
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == 5
    texts = []
    for i in range(40):
        base = [f"w{i}x{j}" for j in range(60)]
        texts.append(" ".join(base))
        for change in (1, 2, 3, 8):
            copy = list(base)
            for k in range(change):
                copy[7 * k + 3] = f"other{change}"
            texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == plain_classes(rows)


def linked_by_rare_shingles(rows):
    """Least id of each document's class, by counting for all pairs the shingles that not all documents have."""
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (text.split() for _, text in rows)]
    shared = set.intersection(*sets)
    holders: dict = {}
    for i, one in enumerate(sets):
        for shingle in one - shared:
            holders.setdefault(shingle, []).append(i)
    both: dict = {}
    for held in holders.values():
        for pair in ((a, b) for a in held for b in held if a < b):
            both[pair] = both.get(pair, len(shared)) + 1
    least = list(range(len(rows)))
    assert len(shared) < 0.8 * 2 * min(map(len, sets)) / 1.8
    for (a, b), n in sorted(both.items()):
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            least[b] = min(least[a], least[b])
    return {rows[i][0]: rows[least[i]][0] for i in range(len(rows))}


def test_near_duplicates_in_a_template_group(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 256)
    template, rng = [f"t{j}" for j in range(404)], random.Random(3)
    rows = []
    for i in range(1000):
        # two texts of a pair share up to 2 words of their own, all others the template alone, at 0.797
        head = [f"p{i}x{j}" for j in range(rng.choice((0, 1, 2)))]
        rows += [(2 * i + k, " ".join(template + head + [f"o{i}x{k}x{j}" for j in range(51 - len(head))])) for k in range(2)]
    rows = [(i, text) for i, (_, text) in enumerate(rng.sample(rows, len(rows)))]
    want = linked_by_rare_shingles(rows)
    assert 600 < sum(least != i for i, least in want.items()) < 750
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    missed = sum(r.class_id != want[r.doc_id] for r in found)
    assert len(found) == len(rows) and missed == 0


def test_near_duplicates_with_repeated_blocks(spark):
    rows = []
    for i in range(12):
        shared, block = [f"s{i}x{j}" for j in range(400)], [f"b{i}x{j}" for j in range(66 + i % 2 * 25)]
        rows += [(2 * i, " ".join(shared)), (2 * i + 1, " ".join(shared + block * 300))]
    want = plain_classes(rows)
    assert len(set(want.values())) == 12
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in found} == want


def test_edges_are_staged_in_few_files(spark, monkeypatch):
    # three files for each task that writes cost the task as many process starts, for a handful of edges
    monkeypatch.setattr(staging, "FILE_ROWS", 150)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        few = near_dedup.components(spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long"))
        many = near_dedup.components(spark.createDataFrame([(i, i + 1) for i in range(0, 800, 2)], "a long, b long"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(few.inputFiles()) == 1 and 2 <= len(many.inputFiles()) <= 6
    assert {tuple(row) for row in few.collect()} == {(i, 0) for i in range(1, 51)}
    assert {tuple(row) for row in many.collect()} == {(i + 1, i) for i in range(0, 800, 2)}


def test_signatures_hold_little_of_a_batch():
    draw = random.Random(9)
    texts = [" ".join(draw.choice("abcdefgh") + str(draw.randrange(999)) for _ in range(2000)) for _ in range(600)]
    batch, seen = pa.RecordBatch.from_pydict({"_text": texts}), []
    tracemalloc.start()
    for block in near_dedup.blocks([batch], "_text", near_dedup.TEXT_BLOCK):
        raw = near_dedup.texts_of(block, "_text")
        seen += raw
        shingles, bounds, times = near_dedup.shingles_of(raw, near_dedup.Words())
        near_dedup.signatures(shingles, near_dedup.weights_of(times), bounds, near_dedup.BANDS * near_dedup.BAND_ROWS)
    held = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    # blocks of 8 MB, all of these texts at once, held 115 MB
    assert seen == [text.encode() for text in texts] and held < 50


def test_signatures_estimate_probability_jaccard():
    shingles = mixed(np.arange(1, 301, dtype=np.uint64))
    a, b = shingles[:250], shingles[50:]
    signs = near_dedup.signatures(np.concatenate([a, b]), np.ones(500), np.array([0, 250, 500]), 4096)
    assert abs((signs[0] == signs[1]).mean() - 200 / 300) < 0.05
    empty = near_dedup.signatures(np.zeros(0, np.uint64), np.zeros(0), np.array([0, 0]), 8)
    assert empty.shape == (1, 8) and not empty.any()


def test_weighted_signatures():
    """Repeats weigh less; agreement follows the probability Jaccard similarity of the weights."""
    texts = [b"a b c d e f " * 40 + b" ".join(b"w%d" % i for i in range(60)), b" ".join(b"w%d" % i for i in range(20, 80)) + b" a b c d e f" * 2]
    shingles, bounds, times = near_dedup.shingles_of(texts, near_dedup.Words())
    weights = near_dedup.weights_of(times)
    assert times.max() > 30
    assert weights.max() == 1.0 and 1.0 - near_dedup.LESS <= weights.min() < 0.91
    sides = [dict(zip(shingles[low:high].tolist(), weights[low:high])) for low, high in zip(bounds, bounds[1:])]
    every = set(sides[0]) | set(sides[1])
    similarity = sum(
        1 / sum(max(sides[0].get(y, 0) / sides[0][x], sides[1].get(y, 0) / sides[1][x]) for y in every) for x in set(sides[0]) & set(sides[1])
    )
    signs = near_dedup.signatures(shingles, weights, bounds, 4096)
    assert abs((signs[0] == signs[1]).mean() - similarity) < 0.05


def sequential_tree(data, text, depth):
    """Log10 probability of a coded text after training on the coded texts of `data`: plain sequential counting."""
    counts: dict = {}

    def path(history, byte):
        history = (b" " * depth + history)[-depth:]
        for j in range(8):
            node = (1 << j) | (byte >> (8 - j))
            yield [(node, history[depth - d :]) for d in range(depth + 1)], (byte >> (7 - j)) & 1

    for one in data:
        for i, byte in enumerate(one):
            for nodes, bit in path(one[:i], byte):
                for key in nodes:
                    counts.setdefault(key, [0, 0])[bit] += 1
    children: dict = {}
    for node, context in counts:
        if context:
            children.setdefault((node, context[1:]), []).append((node, context))

    def own(key):
        a, b = counts[key]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def weighted(key):
        if len(key[1]) == depth:
            return own(key)
        return float(np.logaddexp(math.log(0.5) + own(key), math.log(0.5) + sum(map(weighted, children[key]))))

    total = 0.0
    for i, byte in enumerate(text):
        for nodes, bit in path(text[:i], byte):
            p = 0.5
            for key in reversed(nodes):
                if key not in counts:
                    p = 0.5
                    continue
                estimate = (counts[key][bit] + 0.5) / (sum(counts[key]) + 1)
                share = 1.0 if len(key[1]) == depth else math.exp(math.log(0.5) + own(key) - weighted(key))
                p = share * estimate + (1 - share) * p
            total += math.log10(p)
    return total


def test_lm_scoring(odd, none, spark):
    assert lm_scoring.score(none.withColumn("held_out", F.lit(False))).count() == 0
    held = odd.withColumn("held_out", F.col("doc_id") == 8)
    rows = lm_scoring.score(held).collect()
    assert len(rows) == len(ROWS) and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}
    unseen = lm_scoring.score(odd.withColumn("held_out", F.lit(True))).where("doc_id = 4").first()
    assert unseen.n_known == 0 and abs(unseen.score - 8 * math.log10(0.5)) < 1e-9
    texts = ["The cat sat", "the dog sat", "", "a cat", "the cow"]
    table = spark.createDataFrame([(i, t, i == 4) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
    coded = [" ".join([*t.lower().split(), "\n"]).encode() for t in texts]
    for r in lm_scoring.score(table, depth=2).collect():
        assert abs(r.score - sequential_tree(coded[:4], coded[r.doc_id], 2)) < 1e-6
        assert abs(r.bits_per_byte + r.score / math.log10(2) / len(coded[r.doc_id])) < 1e-9


def test_lm_scoring_cuts_grams_between_contexts(spark):
    """Grams of one two-byte context are worked on in pieces that are small, whole by three bytes, and give the same scores."""
    rng = np.random.default_rng(3)
    tail = rng.integers(97, 101, (3000, 4))
    keys = np.unique(sum((tail[:, i] << (8 * (3 - i)) for i in range(4)), (32 << 40) | (101 << 32)))
    keys = np.concatenate([keys, keys[:40] + (1 << 32), keys[:1] + (1 << 40)])
    counts = rng.integers(0, 4, len(keys))
    contexts = np.unique(keys >> 32)
    rows = pa.table({"place": np.concatenate([contexts * 512, (keys >> 24) * 2 + 1]), "key": np.concatenate([contexts, keys])}).sort_by("place")
    pieces = list(lm_scoring.whole_contexts(iter(rows.to_batches(max_chunksize=10)), 20))
    seen = np.concatenate([p["key"].to_numpy()[p["place"].to_numpy() % 2 == 1] for p in pieces])
    assert seen.tolist() == keys.tolist() and len(pieces) >= 4 and max(map(len, pieces)) <= 2 * 64 + 12
    cut = [set(p["place"].to_pylist()) for p in pieces]
    assert all(x.isdisjoint(place for place in y if place % 2) for x, y in zip(cut, cut[1:]))
    assert all(place >> 9 << 9 in x for x in cut for place in x)

    counted = spark.createDataFrame([(int(k), int(n)) for k, n in zip(keys, counts)], "key long, n long")
    trained = counts > 0
    found = lm_scoring.levels(keys[trained], counts[trained], 5, 0)
    whole = dict(zip(keys.tolist(), np.log10(lm_scoring.probabilities(keys, found, 5, 5)).sum(axis=0)))
    for chunk in (20, 10**6):
        got = {r.key: r.log_p for r in lm_scoring.gram_scores(counted, 5, chunk).collect()}
        assert got.keys() == whole.keys() and max(abs(got[k] - whole[k]) for k in got) < 1e-9


def test_lm_scoring_holds_little_of_a_block():
    """Beside its result, counting the grams of a block takes memory for a part of it."""
    rng = np.random.default_rng(1)
    words = [b"w%d" % i for i in range(300)]
    codes = rng.integers(0, 300, 1_500_000).astype("<i4")
    bounds = np.arange(0, len(codes) + 1, 500)
    spelled = b" ".join(words)
    data = {"codes": codes, "bounds": bounds, "spelled": spelled}
    block = lm_scoring.Block({k: lm_scoring.packed(v) for k, v in data.items()} | {"sizes": [len(codes), len(bounds), len(spelled)], "held": [i % 10 == 0 for i in range(len(bounds) - 1)]})
    tracemalloc.start()
    keys, counts = block.gram_counts(5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    texts = [text for _, _, part in block.parts() for text in part]
    assert counts.sum() == sum(len(text) for i, text in enumerate(texts) if i % 10)
    assert peak < 32 << 20, peak


def test_personal_data(odd, none):
    assert personal_data.find(none).count() == 0
    rows = {r.doc_id: r for r in personal_data.find(odd).collect()}
    text = ROWS[-1][1]
    assert [text[s.start : s.end] for s in rows[8].base] == ["x.y@mail.example.com", "10.0.0.1", "4111 1111 1111 1111", "+1 (743) 555-3824"]
    assert rows[3].base == [] and rows[3].spans == []
    assert personal_data.base_spans("1.2.3.999 a@b") == []


def test_long_words_take_linear_time():
    """Ten million signs without white space; each of them would be a start anew."""
    begun = time.perf_counter()
    for word in ("1" * 10**7, "x" * 10**7 + "!y@z.example", "1." * (5 * 10**6), "a@" * 10**6, "+1(" * 10**6):
        personal_data.base_spans(word)
    assert time.perf_counter() - begun < 60
    assert personal_data.base_spans("x" * 10**6 + "@a.b")[0] == (0, 0, 10**6 + 4)


def test_evident_spans_are_added(spark):
    """Forms that the base patterns miss are added where the trees have learnt them; look-alikes stay out."""
    draw = random.Random(2)
    rows = []
    for i in range(1200):
        number = "".join(str(draw.randint(0, 9)) for _ in range(15))
        check = next(str(d) for d in range(10) if personal_data.luhn(number + str(d)))
        card = ".".join((number + check)[j : j + 4] for j in (0, 4, 8, 12))
        phone = f"{draw.randint(200, 999)}.{draw.randint(200, 999)}.{draw.randint(1000, 9999)}"
        filler = " ".join(draw.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(12))
        shape = i % 4
        text = [f"{filler} mail jo{i} (at) host{i} (dot) org {filler}", f"{filler} card {card} {filler}", f"{filler} call {phone} {filler}",
                f"{filler} part {draw.randint(10**9, 10**10)} of {draw.randint(10**9, 10**10)} {filler}"][shape]
        rows.append((i, text, shape))
    found = personal_data.find(spark.createDataFrame(rows, "doc_id long, text string, shape int")).collect()
    added = {shape: 0 for shape in range(4)}
    for r in found:
        assert {tuple(s) for s in r.base} <= {tuple(s) for s in r.spans}
        added[rows[r.doc_id][2]] += len(r.spans) > len(r.base)
    assert added[0] > 250 and added[2] > 250 and added[3] < 15, added


@pytest.mark.parametrize("source", ["documents", "random"])
def test_base_spans_equal_plain_search(documents, source):
    draw = random.Random(5)
    pieces = ["a", "b_", "%", "@", "@", ".", "-", " ", "\n", "1", "22", "255", ".", "+", "(", "+1 ", "é", "4111111111111111"]
    texts = [row.text for row in documents.collect()] if source == "documents" else ["".join(draw.choices(pieces, k=60)) for _ in range(3000)]
    for text in texts:
        text, want = text or "", []
        for kind, pattern in enumerate((personal_data.EMAIL, personal_data.IP, personal_data.CARD, personal_data.PHONE)):
            for m in pattern.finditer(text):
                digits = re.sub("[^0-9]", "", m.group())
                if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                    continue
                if kind == 2 and not (12 <= len(digits) <= 19 and personal_data.luhn(digits)):
                    continue
                if kind == 3 and not 9 <= len(digits) <= 15:
                    continue
                want.append((m.start(), kind, m.end()))
        assert personal_data.base_spans(text) == sorted(want)


def test_luhn():
    assert personal_data.luhn("4111111111111111") and not personal_data.luhn("4111111111111112")


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(700)]
    rows += [(700, None), (701, [1.0, None] + [0.0] * 6), (702, [float("nan")] * 8), (None, [1.0] * 8), (650, rows[650][1]), *[(800 + i, rows[3][1]) for i in range(400)]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found: dict = {}
    for r in top_k.top_k(table, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and i not in (700, 701, 702)]
    for query in {i for i, _ in good if i % 50 == 0}:
        # rows that repeat a query's id are ranked together
        asked = [v for i, v in good if i == query]
        scores = sorted(((sum(a * b for a, b in zip(v, w)), i) for v in asked for i, w in good if i != query), key=lambda s: (-s[0], s[1]))
        assert found[query] == scores[:5]
    assert top_k.top_k(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert top_k.top_k(few, F.col("vec_id") % 50 == 0).count() == 2


def test_top_k_of_repeated_queries_and_large_products(spark):
    """Rows of one query id are ranked together, as SQL does; products that floats cannot hold are refused."""
    schema = "vec_id long, embedding array<double>, rank int, block long"
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [3.0, 1.0]), (2, [1.0, 4.0]), (50, [5.0, 5.0])]
    table = spark.createDataFrame([(*row, 7, 8) for row in rows], schema)
    got: dict = {}
    for r in top_k.top_k(table, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    for query in (0, 50):
        pairs = [(v, w, i) for q, v in rows if q == query for i, w in rows if i != query]
        want = sorted(((sum(int(256 * a) * int(256 * b) for a, b in zip(v, w)), i) for v, w, i in pairs), key=lambda s: (-s[0], s[1]))
        assert got[query] == want[:5]
    with pytest.raises(ValueError):
        top_k.top_k(spark.createDataFrame([(0, [4e5, 1.0], 1, 1)], schema), F.col("vec_id") % 50 == 0)


def test_tree_keeps_its_bounds():
    points = np.random.default_rng(2).normal(size=(1500, 4))
    points[300:900] = points[0]
    tree = top_k.Tree(points)
    assert sorted(tree.order.tolist()) == list(range(1500))
    for centre, radius, _, first, last, leaf in tree.nodes:
        if leaf:
            away = np.sqrt(((points[tree.order[first:last]] - points[centre]) ** 2).sum(axis=1))
            assert away.max() <= radius + 1e-9 and np.allclose(away, tree.point_parent[first:last])


def test_secret_scan(odd, none, documents):
    assert secret_scan.scan(none).count() == 0
    assert secret_scan.scan(odd).where("doc_id in (3, 4, 5)").count() == 0
    rows = secret_scan.scan(documents).collect()
    text = {r.doc_id: words(r.text) for r in documents.collect()}
    assert rows and all(text[r.doc_id][r.position] == r.word and r.run in r.word for r in rows)


def test_every_run_of_a_word_is_scanned(spark):
    long, url = "aB3" * 8, "https://host/abcdefghijklmnop?token=" + "Zz9" * 7
    text = f"id={long},token={long}x;password=hunter2 {url} see password: s3cret end short=abc1"
    rows = secret_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    found = sorted((r.position, r.offset, r.run) for r in rows)
    want = [(0, long), (0, long + "x"), (0, "hunter2"), (1, "//host/abcdefghijklmnop"), (1, "Zz9" * 7), (4, "s3cret")]
    assert all(r.word[r.offset : r.offset + len(r.run)] == r.run for r in rows)
    assert [(position, run) for position, _, run in found] == want


def test_pipeline(spark, none):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, none.select(*corpus_pipeline.COLUMNS), SMALL)
        assert out.columns == list(corpus_pipeline.COLUMNS) and out.count() == 0
    assert corpus_pipeline.run(spark, SMALL).count() > 0
    once = corpus_pipeline.one_of_each_class(spark, docs, SMALL)
    classes = near_dedup.near_duplicates(docs).select("class_id").distinct().count()
    assert once.count() == classes
