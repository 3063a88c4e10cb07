"""Periodic runs of words, found once per rule of a grammar.

Each text is compressed by Re-Pair: pairs of neighbouring symbols that occur twice and more become rules, the most frequent
first, until no pair repeats. A run lies in full in the expansion of some lowest rule, where it crosses the boundary between
the rule's two parts, or it crosses a boundary of what is left at the top. So runs are looked for around each rule's boundary
once, at one place of the text where the rule stands, and around the boundaries at the top; what a rule holds is carried to
all places that derive from it, and overlapping pieces of equal period are merged.

The texts of a block are compressed side by side with numpy: symbols belong to one text each, and a round replaces all pairs
that beat their neighbours, which includes the most frequent pair of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from reqloom.llm.shared import Words, blocks, texts_of

LEAST_WORDS = 6
LEAST_PERIODS = 4
BLOCK = 2 << 20
#: What a task keeps of word numbers before it starts anew.
MOST_WORDS = 100_000

RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])


class Grammar(NamedTuple):
    """Rules by number from `terminals` on: two parts and the place of one occurrence; sizes of all symbols in words.

    `top` and `at` are the symbols that are left, text after text, and their places.
    """

    terminals: int
    left: np.ndarray
    right: np.ndarray
    place: np.ndarray
    size: np.ndarray
    top: np.ndarray
    at: np.ndarray


def repair(symbols: np.ndarray, text: np.ndarray) -> Grammar:
    """Re-Pair over texts side by side; `symbols` number the words anew in each text, `text` numbers the texts.

    A pair across two texts occurs once, so it never becomes a rule. Pairs found to be single stay so and are left out of
    later rounds, as are texts whose round replaced nothing.
    """
    terminals = int(symbols.max()) + 1 if len(symbols) else 0
    at, open_ = np.arange(len(symbols)), np.ones(len(symbols), dtype=bool)
    size, total = [np.ones(terminals, np.int64)], terminals
    rules: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    ended: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols) > 1:
        first, second = symbols[:-1], symbols[1:]
        # of equal symbols in a row, every other pair counts
        index = np.arange(len(first))
        twin = first == second
        begins = twin & ~np.concatenate(([False], twin[:-1]))
        since = index - np.maximum.accumulate(np.where(begins, index, 0))
        often = np.bincount(symbols, minlength=total) > 1
        place = np.flatnonzero(open_[:-1] & ~(twin & (since & 1 == 1)) & often[first] & often[second])
        key = first[place] * total + second[place]
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate(([True], np.diff(key[order]) != 0)) if len(key) else np.zeros(0, bool)
        group = np.cumsum(fresh) - 1
        count = np.bincount(group) if len(group) else np.zeros(0, np.int64)
        # groups by falling count, then by first place
        rank = np.empty(len(count), np.int64)
        rank[np.lexsort((place[order][fresh], -count))] = np.arange(len(count))
        turn = np.full(len(symbols) + 1, len(count), np.int64)
        kept = count[group] > 1
        turn[place[order][kept] + 1] = rank[group[kept]]
        inner = turn[1:-1]
        won = np.flatnonzero((inner < len(count)) & (inner < turn[:-2]) & (inner < turn[2:]))
        uses = np.bincount(inner[won], minlength=len(count))
        won = won[uses[inner[won]] > 1]
        # single pairs, and pairs with a word that the text has once, are settled
        open_[:-1] &= twin | (inner < len(count))
        if not len(won):
            break
        names, one, number = np.unique(inner[won], return_index=True, return_inverse=True)
        rules.append((first[won[one]], second[won[one]], at[won[one]]))
        sizes = np.concatenate(size) if len(size) > 1 else size[0]
        size = [sizes, sizes[rules[-1][0]] + sizes[rules[-1][1]]]
        symbols = symbols.copy()
        symbols[won] = total + number
        open_[won] = True
        open_[np.maximum(won - 1, 0)] = True
        total += len(names)
        stays = np.ones(len(symbols), dtype=bool)
        stays[won + 1] = False
        busy = np.zeros(int(text[-1]) + 1, dtype=bool)
        busy[text[won]] = True
        going = busy[text]
        ended.append((symbols[stays & ~going], at[stays & ~going]))
        stays &= going
        symbols, at, text, open_ = symbols[stays], at[stays], text[stays], open_[stays]
    ended.append((symbols, at))
    top, place = (np.concatenate(parts) for parts in zip(*ended))
    order = np.argsort(place, kind="stable")
    empty = np.zeros(0, np.int64)
    left, right, where = (np.concatenate(parts) for parts in zip(*rules)) if rules else (empty, empty, empty)
    return Grammar(terminals, left, right, where, np.concatenate(size), top[order], place[order])


def recurring(symbols: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """For k = 1, 2, 4 ... while k < `longest`: k, and for each place the distance to where its k symbols come next.

    The distance is 0 where they do not come again. Numbers of 2k symbols are made from those of k; places whose k symbols
    are single drop out.
    """
    n, k = len(symbols), 1
    number, alive = symbols.astype(np.int64), np.arange(n)
    while len(alive) and k < longest:
        names = number[alive]
        order = np.argsort(names, kind="stable")
        sorted_names, sorted_at = names[order], alive[order]
        same = sorted_names[1:] == sorted_names[:-1]
        distance = np.zeros(n, np.int64)
        distance[sorted_at[:-1][same]] = np.diff(sorted_at)[same]
        yield k, distance
        again = np.zeros(len(alive), dtype=bool)
        again[1:] |= same
        again[:-1] |= same
        dense = np.cumsum(np.concatenate(([True], ~same))) - 1
        number = np.full(n + k, -1, np.int64)
        number[sorted_at[again]] = dense[again]
        alive = np.sort(sorted_at[again])
        alive = alive[number[alive + k] >= 0]
        joined = number[alive] * (int(dense[-1]) + 1) + number[alive + k]
        number[alive] = joined
        k *= 2


def _same_right(symbols: np.ndarray, end: int, period: int, last: int) -> int:
    """The first place from `end` on, or `last`, that differs from the one a period before."""
    step = 64
    while end < last:
        stop = min(end + step, last)
        differs = symbols[end:stop] != symbols[end - period : stop - period]
        if differs.any():
            return end + int(differs.argmax())
        end, step = stop, step * 4
    return end


def _same_left(symbols: np.ndarray, start: int, period: int, least: int) -> int:
    """The least place from which on all to `start` equal the ones a period after."""
    step = 64
    while start > least:
        stop = max(start - step, least)
        differs = (symbols[stop:start] != symbols[stop + period : start + period])[::-1]
        if differs.any():
            return start - int(differs.argmax())
        start, step = stop, step * 4
    return start


def _chains(keys: tuple[np.ndarray, ...], start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merges intervals of equal keys and period that overlap by a period and more: rows' order, first rows, last ends."""
    order = np.lexsort((end, start, period, *keys))
    s, e, p = start[order], end[order], period[order]
    apart = np.ones(len(order), dtype=bool)
    apart[1:] = p[1:] != p[:-1]
    for key in keys:
        apart[1:] |= np.diff(key[order]) != 0
    # the farthest end so far within equal keys: ends are lifted by the number of the key
    lift = np.cumsum(apart) * (int(end.max(initial=0)) + 1)
    reach = np.maximum.accumulate(e + lift) - lift
    apart[1:] |= s[1:] > reach[:-1] - p[1:]
    firsts = np.flatnonzero(apart)
    return order, order[firsts], np.maximum.reduceat(e, firsts) if len(firsts) else e


def found_runs(symbols: np.ndarray, bounds: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> np.ndarray:
    """Runs of texts side by side: rows of text, start (in the text), length, period, sorted by text, start, period.

    `periods` has to be 4 and more: around a boundary, the starts looked at are spaced for that.
    """
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    grammar = repair(symbols, text)
    sizes, rules = grammar.size, len(grammar.left)
    # boundaries: one in each rule, and those of the top within a text; owners are rules, then texts
    inside = np.flatnonzero(text[grammar.at[1:]] == text[grammar.at[:-1]]) + 1
    border = np.concatenate((grammar.place + sizes[grammar.left], grammar.at[inside]))
    owner = np.concatenate((np.arange(rules), rules + text[grammar.at[inside]]))
    low = np.concatenate((grammar.place, bounds[:-1]))[owner]
    high = np.concatenate((grammar.place + sizes[grammar.terminals :], bounds[1:]))[owner]
    wide = high - low >= least
    border, owner, low, high = border[wide], owner[wide], low[wide], high[wide]
    hits: list[tuple[np.ndarray, ...]] = []
    for k, distance in recurring(symbols, max(int((high - low).max(initial=0)) // 2, 2)):
        near = (distance > 0) & (distance <= k)
        if not near.any():
            continue
        touched = np.zeros(len(bounds) - 1, dtype=bool)
        touched[text[near]] = True
        some = np.flatnonzero(touched[text[np.minimum(low, len(text) - 1)]] & ((k == 1) | (2 * k < high - low)))
        for j in range(5):
            start = border[some] - j * max(k // 2, 1)
            fits = start >= low[some]
            pick, start = some[fits], start[fits]
            hit = near[start]
            pick, start = pick[hit], start[hit]
            period = distance[start]
            fits = start + k + period <= high[pick]
            hits.append((owner[pick][fits], low[pick][fits], high[pick][fits], start[fits], (start + k + period)[fits], period[fits]))
    if not hits:
        return np.zeros((0, 4), np.int64)
    owner, low, high, start, end, period = (np.concatenate(parts) for parts in zip(*hits))
    _, one, reach = _chains((owner,), start, end, period)
    held: list[tuple[int, int, int, int]] = []
    for at, e in zip(one.tolist(), reach.tolist()):
        p = int(period[at])
        s = _same_left(symbols, int(start[at]), p, int(low[at]))
        e = _same_right(symbols, e, p, int(high[at]))
        if e - s >= max(least, periods * p):
            held.append((int(owner[at]), s, e, p))
    if not held:
        return np.zeros((0, 4), np.int64)
    rows = np.array(held, dtype=np.int64)
    ruled = rows[rows[:, 0] < rules]
    parts = [rows[rows[:, 0] >= rules][:, 1:]]
    if len(ruled):
        ruled = ruled[np.argsort(ruled[:, 0], kind="stable")]
        wanted, count = np.unique(ruled[:, 0], return_counts=True)
        begin = np.concatenate(([0], np.cumsum(count)))
        texts = np.zeros(len(bounds) - 1, dtype=bool)
        texts[text[grammar.place[wanted]]] = True
        symbol, at = grammar.top[texts[text[grammar.at]]], grammar.at[texts[text[grammar.at]]]
        while len(symbol):
            rule = symbol[symbol >= grammar.terminals] - grammar.terminals
            at = at[symbol >= grammar.terminals]
            slot = np.minimum(np.searchsorted(wanted, rule), len(wanted) - 1)
            match = wanted[slot] == rule
            times = count[slot[match]]
            row = np.repeat(begin[slot[match]], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            shift = np.repeat(at[match] - grammar.place[rule[match]], times)
            parts.append(np.stack([ruled[row, 1] + shift, ruled[row, 2] + shift, ruled[row, 3]], axis=1))
            symbol = np.concatenate((grammar.left[rule], grammar.right[rule]))
            at = np.concatenate((at, at + sizes[grammar.left[rule]]))
    start, end, period = np.concatenate(parts).T
    owner = text[start]
    _, one, end = _chains((owner,), start, end, period)
    owner, start, period = owner[one], start[one], period[one]
    out = np.stack([owner, start - bounds[owner], end - start, period], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def numbered_by_text(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Numbers for (text, word), so that no two texts share one."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = text * (int(codes.max(initial=0)) + 1) + codes
    return np.unique(key, return_inverse=True)[1].astype(np.int64)


def runs(docs: DataFrame, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> DataFrame:
    """`doc_id`, n_words, runs (start, length, period by start, then period) and `collapsed`, a row for each row of `docs`.

    A run is a stretch of words with smallest period q, at least `least` words and `periods` (4 or more) times q long, that no
    neighbouring word extends. `collapsed` keeps, joined by a space, the words that no run contains after its first q words.
    Words are compared as written. A null text is empty; texts without words have no runs and an empty `collapsed`. Texts of
    any length are taken whole; a block holds one text at least. Rows that repeat are answered each; columns other than
    doc_id and text are left out; an empty table stays empty. Nothing is shuffled.
    """
    if periods < 4:
        raise ValueError("runs of fewer than four periods are not looked for")
    source = docs.select("doc_id", F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Words()
        for block in blocks(batches, "_text", BLOCK):
            if len(numbers) > MOST_WORDS:
                numbers = Words()
            yield _answers(block, numbers, least, periods)

    fields = [source.schema["doc_id"], StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())]
    return source.mapInArrow(run, StructType(fields))


def _answers(block: pa.RecordBatch, numbers: Words, least: int, periods: int) -> pa.RecordBatch:
    split = [text.split() for text in texts_of(block, "_text")]
    bounds = np.concatenate(([0], np.cumsum([len(words) for words in split], dtype=np.int64)))
    get = numbers.__getitem__
    codes = np.fromiter((number for words in split for number in map(get, words)), dtype=np.int64, count=int(bounds[-1]))
    found = found_runs(numbered_by_text(codes, bounds), bounds, least, periods)
    # words that some run holds after its first period
    edge = np.zeros(len(codes) + 1, np.int64)
    start = bounds[found[:, 0]] + found[:, 1]
    np.add.at(edge, start + found[:, 3], 1)
    np.add.at(edge, start + found[:, 2], -1)
    stays = np.cumsum(edge[:-1]) == 0
    collapsed = [b" ".join(words) for words in split]
    for i in np.unique(found[:, 0]).tolist():
        collapsed[i] = b" ".join([word for word, stay in zip(split[i], stays[bounds[i] : bounds[i + 1]].tolist()) if stay])
    offsets = np.searchsorted(found[:, 0], np.arange(block.num_rows + 1))
    each = pa.StructArray.from_arrays([pa.array(found[:, i]) for i in (1, 2, 3)], names=RUN.names)
    return pa.RecordBatch.from_arrays(
        [
            block.column("doc_id"),
            pa.array(np.diff(bounds)),
            pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), each),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )
