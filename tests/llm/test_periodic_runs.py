"""Runs against every period tried by itself, and the query against the same on the small table."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from reqloom.llm import periodic_runs
from reqloom.llm.queries import op11_periodic_runs

SMALL = "/root/testdata/sf0.001"


def plain_runs(words, least=6, periods=4):
    """(start, length, period) of every run: for each period, the stretches of words equal to those a period later."""
    found = set()
    for q in range(1, len(words) // periods + 1):
        start = 0
        for end in range(len(words) - q + 1):
            if end == len(words) - q or words[end] != words[end + q]:
                length = end - start + q
                if length >= max(least, periods * q):
                    if not any(words[start : start + length - p] == words[start + p : start + length] for p in range(1, q)):
                        found.add((start, length, q))
                start = end + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_texts(seed):
    draw = random.Random(seed)
    texts = []
    for _ in range(300):
        words = [draw.randrange(draw.choice([1, 2, 3, 40])) for _ in range(draw.randint(0, 120))]
        for _ in range(draw.randint(0, 4) if words else 0):
            start, q = draw.randrange(len(words)), draw.randint(1, 15)
            for i in range(start + q, min(len(words), start + draw.randint(1, 8 * q))):
                words[i] = words[i - q]
        texts.append(words)
    bounds = np.concatenate(([0], np.cumsum([len(words) for words in texts])))
    codes = np.array([word for words in texts for word in words])
    found = periodic_runs.found_runs(periodic_runs.numbered_by_text(codes, bounds), bounds).tolist()
    want = [[i, *run] for i, words in enumerate(texts) for run in plain_runs(words)]
    assert len(want) > 100 and found == want


def test_grammar_gives_the_text_back():
    draw = random.Random(9)
    bounds = np.array([0, 400, 400, 1000])
    codes = np.array([draw.randrange(4) for _ in range(1000)])
    symbols = periodic_runs.numbered_by_text(codes, bounds)
    grammar = periodic_runs.repair(symbols, np.repeat(np.arange(3), np.diff(bounds)))

    def words(symbol):
        if symbol < grammar.terminals:
            return [symbol]
        rule = symbol - grammar.terminals
        return words(grammar.left[rule]) + words(grammar.right[rule])

    assert [word for symbol in grammar.top for word in words(symbol)] == symbols.tolist()
    pairs = list(zip(grammar.top, grammar.top[1:]))
    assert all(a == b or pairs.count((a, b)) == 1 for a, b in pairs)


ODD = [
    (1, "a b a b a b a b a b", 1),
    (1, "a b a b a b a b a b", 1),
    (2, None, 2),
    (3, "", None),
    (4, " \t\n\x0b ", 4),
    (None, "x x x x x x", 5),
    (6, "x y " * 30_000, 6),
    (7, "é é\x0bé\té é é A a", 7),
    (8, "wide " + "z" * 100_000, 8),
]


def test_odd_rows(spark):
    rows = spark.createDataFrame(ODD, "doc_id int, text string, runs int")
    got = {(r.doc_id, r.n_words, tuple(tuple(run) for run in r.runs), r.collapsed) for r in periodic_runs.runs(rows).collect()}
    assert got == {
        (1, 10, ((0, 10, 2),), "a b"),
        (2, 0, (), ""),
        (3, 0, (), ""),
        (4, 0, (), ""),
        (None, 6, ((0, 6, 1),), "x"),
        (6, 60_000, ((0, 60_000, 2),), "x y"),
        (7, 8, ((0, 6, 1),), "é A a"),
        (8, 2, (), "wide " + "z" * 100_000),
    }
    assert periodic_runs.runs(rows).count() == len(ODD) and periodic_runs.runs(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.runs(rows, periods=3)


def test_query_against_plain_runs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {row.doc_id: row for row in op11_periodic_runs(spark, SMALL).collect()}
    assert len(got) == len(docs)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    compared = 0
    for doc in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", doc.text or "")
        h, n = zlib.crc32(str(doc.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 2000:
            continue
        runs = plain_runs(words)
        row, compared = got[doc.doc_id], compared + len(runs)
        best = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=(None, None, None))
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (best[1] * 1000 // best[2] if runs else None)
        assert row.runs_sha256 == sha("".join(f"{s},{length},{q}\n" for s, length, q in runs))
        assert row.collapsed_sha256 == sha(collapsed(words, runs))
    assert compared > 10
