"""Periodic runs of words: maximal pairs from the LCP-interval tree of each text.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are identical) of length at least
``max(least, 2 * q)`` that no neighbouring word extends with that period. Such a stretch from ``s`` is the maximal
pair of the places ``s`` and ``s + q``: equal for ``length - q`` words, with other words (or the text's end) before
and after. So the runs are the maximal pairs whose distance is at most their common length, and common length
plus distance at least ``least``; of pairs with one start and length, the smallest distance is the period.

1. Only texts that repeat ``least / 2`` words take part: others hold no run.
2. The suffixes of a block of texts are sorted together by doubling; the ranks of every doubling are kept and give
   the common lengths of neighbours.
3. The tree is walked bottom up. A node keeps its places in order, cut into lists of equal left words. When two
   children meet at a node, each place of the smaller one looks at the places of the larger one within the node's
   length, and jumps over whole lists of its own left word: what it visits is put out.

The pairs that are put out number at most a small multiple of the text's words, and each place is entered at most
log(words) times. Texts are worked on whole, in blocks; memory grows with the longest text. Words are runs without the
bytes 09-0D and 20, compared by 64-bit hashes.

Null, empty and wordless texts have no runs and an empty ``collapsed`` text; rows are independent, so repeated ids and
rows without an id have each their own result; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import Words, grams, prepare, words

LEAST = 12
RUNS = "array<struct<start: long, length: long, period: long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def suffixes(word: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of all rows, and the words that each has in common with the one before it.

    ``row`` ascends; suffixes of different rows have nothing in common. Words are ordered by their values.
    """
    n = len(word)
    end = np.searchsorted(row, row, side="right")
    rank = np.unique(word, return_inverse=True)[1].astype(np.int64)
    order = np.lexsort((rank, row))
    new = np.ones(n, bool)
    new[1:] = (rank[order[1:]] != rank[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, h = [], 1
    while True:
        levels.append((h, rank.astype(np.int32)))
        alone = np.bincount(rank, minlength=n)[rank] == 1
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        ahead = open_ + h
        second = np.where(ahead < end[open_], rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        open_, key, first = open_[by], key[by], rank[open_[by]]
        at = np.arange(len(open_))
        fresh = np.ones(len(open_), bool)
        fresh[1:] = key[1:] != key[:-1]
        group = np.ones(len(open_), bool)
        group[1:] = first[1:] != first[:-1]
        rank = rank.copy()
        rank[open_] = first + np.maximum.accumulate(np.where(fresh, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        h *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    common = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for h, of in reversed(levels):
        inside = (a < end[order[:-1]]) & (b < end[order[1:]])
        same = inside & (of[np.minimum(a, n - 1)] == of[np.minimum(b, n - 1)])
        common[1:] += np.where(same, h, 0)
        a, b = a + np.where(same, h, 0), b + np.where(same, h, 0)
    return order, common


class _Places:
    """Places of a node in order; ``cuts`` are those whose left word is not that of the place before them."""

    __slots__ = ("at", "cuts")

    def __init__(self, place: int):
        self.at, self.cuts = [place], [place]

    def add(self, x: int, left: list[int]) -> None:
        i = bisect_left(self.at, x)
        own = left[x]
        if i < len(self.at):
            after = self.at[i]
            was = i == 0 or left[self.at[i - 1]] != left[after]
            now = left[after] != own
            if was and not now:
                del self.cuts[bisect_left(self.cuts, after)]
            elif now and not was:
                self.cuts.insert(bisect_left(self.cuts, after), after)
        if i == 0 or left[self.at[i - 1]] != own:
            self.cuts.insert(bisect_left(self.cuts, x), x)
        self.at.insert(i, x)

    def pairs(self, x: int, length: int, least: int, left: list[int], out: list[tuple[int, int, int]]) -> None:
        """Put out (start, length, distance) of the maximal pairs of ``x`` and a place here that can be a run."""
        at, own, last = self.at, left[x], x + length
        i = bisect_left(at, x - length)
        while i < len(at) and (y := at[i]) <= last:
            if left[y] == own:
                k = bisect_right(self.cuts, y)
                if k == len(self.cuts):
                    return
                i = bisect_left(at, self.cuts[k], i)
                continue
            far = abs(x - y)
            if length + far >= least:
                out.append((min(x, y), length + far, far))
            i += 1


def _joined(one: _Places, two: _Places, length: int, least: int, left: list[int], out: list[tuple[int, int, int]]) -> _Places:
    if len(one.at) < len(two.at):
        one, two = two, one
    for x in two.at:
        one.pairs(x, length, least, left, out)
    for x in two.at:
        one.add(x, left)
    return one


def maximal_pairs(order: np.ndarray, common: np.ndarray, left: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(start, length, distance) of all maximal pairs that satisfy the constraints of a run."""
    shortest = -(-least // 2)
    out: list[tuple[int, int, int]] = []
    before = common >= shortest
    follows = np.append(before[1:], False)
    leaves = np.flatnonzero(before | follows)
    left_of = left.tolist()
    lengths = np.where(follows, np.append(common[1:], 0), 0)[leaves].tolist()
    stack: list[tuple[int, _Places]] = []
    for x, nearest in zip(order[leaves].tolist(), lengths, strict=True):
        node = _Places(x)
        while stack and stack[-1][0] > nearest:
            length, other = stack.pop()
            node = _joined(other, node, length, least, left_of, out)
        if stack and stack[-1][0] == nearest:
            stack[-1] = (nearest, _joined(stack[-1][1], node, nearest, least, left_of, out))
        elif nearest:
            stack.append((nearest, node))
    return out


def runs_of(w: Words, least: int = LEAST) -> np.ndarray:
    """Rows ``row, start, length, period`` of the runs of a block, ordered so; starts count from the row's first word."""
    none = np.zeros((0, 4), np.int64)
    at, value = grams(w.hash, w.row, -(-least // 2))
    if not len(at):
        return none
    by = np.lexsort((value, w.row[at]))
    row, value = w.row[at][by], value[by]
    repeats = np.unique(row[1:][(row[1:] == row[:-1]) & (value[1:] == value[:-1])])
    if not len(repeats):
        return none
    used = np.flatnonzero(np.isin(w.row, repeats))
    row = w.row[used]
    order, common = suffixes(w.hash[used], row)
    left = np.full(len(used), -1, np.int64)
    # A number for each different word; the first word of a row has no left word.
    left[1:] = np.where(row[1:] == row[:-1], np.unique(w.hash[used], return_inverse=True)[1][:-1], -1)
    found = np.array(maximal_pairs(order, common, left, least), np.int64).reshape(-1, 3)
    if not len(found):
        return none
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    start, length, period = found[keep].T
    place = used[start]
    out = np.column_stack([w.row[place], place - w.begin[w.row[place]], length, period])
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _kept(w: Words, runs: np.ndarray) -> np.ndarray:
    """Which words of the block no run covers after its first period."""
    first = w.begin[runs[:, 0]] + runs[:, 1]
    change = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(change, first + runs[:, 3], 1)
    np.add.at(change, first + runs[:, 2], -1)
    return np.cumsum(change[:-1]) == 0


def find_runs(docs: DataFrame, least: int = LEAST, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, runs, collapsed`` of every row.

    ``runs`` are ordered by start, then period. ``collapsed`` is the text without the words that a run repeats
    (those after its first period), with one space between words.
    """
    if least < 2:
        raise ValueError("least must be 2 or more")
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            counts, offsets, found, texts = [], [0], [], []
            for w in words(b.column(1)):
                runs = runs_of(w, least)
                kept = _kept(w, runs)
                begin = np.searchsorted(runs[:, 0], np.arange(w.rows + 1))
                for i in range(w.rows):
                    parts = w.buffer[w.offsets[i] : w.offsets[i + 1]].tobytes().split()
                    counts.append(len(parts))
                    offsets.append(offsets[-1] + int(begin[i + 1] - begin[i]))
                    if begin[i + 1] > begin[i]:
                        parts = compress(parts, kept[w.of_row(i)].tolist())
                    texts.append(b" ".join(parts))
                found.append(runs[:, 1:])
            every = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
            structs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in every.T], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs), pa.array(texts, pa.binary()).cast(pa.string())],
                names=[key, "n_words", "runs", "collapsed"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string").alias("text")).mapInArrow(run, f"`{key}` {kind}, n_words long, runs {RUNS}, collapsed string")


def longest(runs: Column) -> Column:
    """The run of greatest length; of equal ones that of smallest start, then period; null if there is none."""
    ranked = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = F.array_max(ranked)
    return F.when(F.size(runs) > 0, F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))
