"""Groups and links against the tokenizers' whole output and a walk over byte offsets."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from reqloom.llm import alignment
from reqloom.llm.queries import op12_token_alignment

SMALL = "/root/testdata/sf0.001"
SIGNS = [*range(33, 127), *range(161, 173), *range(174, 256)]


@pytest.fixture(scope="module")
def models():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def tokens(text, models):
    """(id, bytes) of both sides; none where a side does not give the text back."""
    first, second = models
    if not text:
        return [], []
    shown = {chr(b): b for b in SIGNS}
    shown |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in SIGNS)}
    a = [(i, bytes(shown[sign] for sign in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def plain(texts, models):
    """The answer of every text by one walk over byte offsets."""
    answers, links = [], []
    for text in texts:
        a, b = tokens(text, models)
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in (a, b)]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups = []
        for side, end in zip((a, b), ends):
            cut = np.searchsorted(end, common, side="right").tolist()
            groups.append([",".join(str(i) for i, _ in side[low:high]) for low, high in zip([0, *cut], cut)])
        groups = ["|".join(pair) for pair in zip(*groups)]
        last = [dict(zip(end, (i for i, _ in side))) for side, end in zip((a, b), ends)]
        links.append([(last[0][e], last[1][e]) for e in common])
        answers.append([len(a), len(b), len(groups), len(links[-1]), ";".join(groups)])
    count = Counter(pair for found in links for pair in found)
    best: dict = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [(*answer, sum(count[pair] == best[pair[1]] for pair in found), sum(count[pair] for pair in found)) for answer, found in zip(answers, links)]


ODD = [
    (1, "Hello, world: café naïve 123,456"),
    (1, "Hello, world: café naïve 123,456"),
    (2, None),
    (3, ""),
    (4, "  two  spaces \n\n and\ttabs \x00 \x1f  "),
    (None, "中文 русский \U0001f600\U0001f468‍\U0001f469 é"),
    (6, "a▁b ▁ c"),
    (7, "<s> <|endoftext|> <unk> <0x0A> </s>"),
    (8, " "),
    (9, "trailing "),
    (10, " leading"),
    (11, "x" * 30_000),
    (12, "word another " * 20_000),
    (13, " no break 　wide"),
]


def test_odd_rows(spark, models):
    rows = spark.createDataFrame([(i, text, 1, 2) for i, text in ODD], "doc_id long, text string, n_a int, block int")
    names = ("n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")
    got = sorted((repr(r.doc_id), *[r[name] for name in names]) for r in alignment.align(rows).collect())
    assert got == sorted((repr(i), *answer) for (i, _), answer in zip(ODD, plain([text for _, text in ODD], models)))
    assert alignment.align(rows.limit(0)).count() == 0


def test_query_against_the_walk(spark, models):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for doc, (*counts, groups, n_best, count_sum) in zip(docs, plain([doc.text for doc in docs], models)):
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        want[doc.doc_id] = (*counts, n_best, count_sum, digest)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    got = {row.doc_id: tuple(row[name] for name in names) for row in op12_token_alignment(spark, SMALL).collect()}
    assert got == want


def test_doubling_reaches_long_chains():
    # tokens of one side straddle those of the other, so 4,000 tokens are one group
    a, b = np.arange(3, 6003, 3), np.append(np.arange(2, 6000, 3), 6000)
    a[-1] = 6000
    last_a, last_b = alignment.terminals(a, b)
    assert set(last_a) == set(last_b) == {len(b) - 1}
