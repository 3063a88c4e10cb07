"""Hashed word n-grams: numbers below `1 << bits` for the words, word pairs and word shapes of texts."""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import xxhash

from reqloom.llm.shared import Words, mixed, numbered, texts_of, windows

BITS = 18

#: Bytes by class: capitals A, other letters and bytes of non-ASCII characters a, digits 9, the rest themselves.
_SHAPE = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 57 if 48 <= b <= 57 else b for b in range(256)
)
_AGAIN, _OTHER = (np.uint64(xxhash.xxh64_intdigest(name)) for name in (b"pair again", b"pair other"))
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)


def shape(word: bytes) -> bytes:
    """The word's character classes with runs shortened to two signs: `Hello!!!` gives `Aaa!!`."""
    return _RUNS.sub(rb"\1\1", word.translate(_SHAPE))


class ShapedWords(Words):
    """Words that also know the number of their shape, up to `most` of them; a full table starts anew at a new block."""

    def __init__(self, most: int = 100_000) -> None:
        super().__init__()
        self.most = most
        self.renew()

    def renew(self) -> None:
        self.clear()
        self.hashes, self.shapes, self.shape_of = array("Q"), Words(), []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh64_intdigest(word.lower()))
        self.shape_of.append(self.shapes[b"shape " + shape(word)])
        return number


def features(block: pa.RecordBatch, column: str, words: ShapedWords, bits: int = BITS) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Hashed n-grams of the block's texts, kind by kind, each with the texts' bounds.

    Kinds: words with A-Z lower-cased, pairs of them, shapes of the words as written, runs of three shapes, and for each
    pair of neighbours whether the second repeats the first.
    """
    if len(words) > words.most:
        words.renew()
    codes, bounds = numbered(texts_of(block, column), words)
    hashes = words.hash_array()[codes]
    shapes = words.shapes.hash_array()[np.array(words.shape_of, dtype=np.int64)[codes]] if len(codes) else hashes
    kinds = [windows(hashes, bounds, 1), windows(hashes, bounds, 2), windows(shapes, bounds, 1), windows(shapes, bounds, 3)]
    followed = np.ones(len(codes), dtype=bool)
    followed[bounds[1:][np.diff(bounds) > 0] - 1] = False
    again = (codes[1:] == codes[:-1])[followed[:-1]]
    kinds.append((np.where(again, _AGAIN, _OTHER), kinds[1][1]))
    low = np.uint64((1 << bits) - 1)
    return [(grams & low).astype(np.int64) for grams, _ in kinds], [edges for _, edges in kinds]
