"""Benchmark passages in documents, reordered ones too, by greedy string tiling.

Words are runs of letters and digits, ASCII case folded. A benchmark item's seeds are its runs of
``SEED`` words; each task looks the runs of its documents up in the sorted seeds, and only documents
that share a seed with an item are compared with it. The comparison marks tiles: the longest common
runs of unmarked words first, found with running Karp-Rabin hashes at a falling search length, each
confirmed word by word; every word belongs to one tile at most. The share of an item's words under
tiles does not depend on the order of its parts. Pairs at or above the threshold are contaminated.

The seeds are broadcast in blocks of a bounded number of bytes, one pass over the documents for each
block; an item of fewer words than a seed is its own seed. Null and empty texts and items match
nothing. Repeated documents and items are compared each; other columns are not looked at; an empty
table on either side gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import grams, prepare, stored, words

#: Words of a seed, and of the shortest tile.
SEED = 4
#: Share of an item's words that tiles must cover.
COVERAGE = 0.5
#: Bytes of benchmark text that are broadcast together.
BLOCK_BYTES = 8 << 20

_BASE = 0x5851F42D4C957F2D


def _prefixes(tokens: np.ndarray) -> tuple[list[int], list[int]]:
    """Prefix hashes and powers, so that any run's hash takes one step."""
    h, p = [0], [1]
    for t in tokens.tolist():
        h.append((h[-1] * _BASE + t) & 0xFFFFFFFFFFFFFFFF)
        p.append((p[-1] * _BASE) & 0xFFFFFFFFFFFFFFFF)
    return h, p


def tiles(text: np.ndarray, item: np.ndarray, shortest: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy tiling of two word sequences: (start in text, start in item, length), longest first."""
    a, b = text.tolist(), item.tolist()
    (ha, pa_), (hb, _) = _prefixes(text), _prefixes(item)
    free_a, free_b = [True] * len(a), [True] * len(b)
    out: list[tuple[int, int, int]] = []
    search = max(shortest, min(len(a), len(b)))
    while True:
        longest, found = _scan(a, b, ha, hb, pa_, free_a, free_b, search)
        if longest > 2 * search:
            search = longest
            continue
        for length, i, j in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            # Tiles marked before may have taken an end of this match; what is left in one piece still counts now.
            n = 0
            while n < length and free_a[i + n] and free_b[j + n]:
                n += 1
            if n >= search:
                free_a[i : i + n] = [False] * n
                free_b[j : j + n] = [False] * n
                out.append((i, j, n))
        if search > 2 * shortest:
            search //= 2
        elif search > shortest:
            search = shortest
        else:
            # One more look at the shortest length, until it marks nothing.
            if not found:
                return sorted(out, key=lambda x: (-x[2], x[0], x[1]))


def _runs(free: list[bool], size: int) -> Iterator[int]:
    """Starts of the windows of ``size`` unmarked words."""
    run = 0
    for i, ok in enumerate(free):
        run = run + 1 if ok else 0
        if run >= size:
            yield i - size + 1


def _scan(a, b, ha, hb, power, free_a, free_b, size) -> tuple[int, list[tuple[int, int, int]]]:
    """Maximal common runs of at least ``size`` unmarked words; stops early when one is over twice as long."""
    if size > min(len(a), len(b)):
        return 0, []
    mask, at = 0xFFFFFFFFFFFFFFFF, defaultdict(list)
    scale = power[size] if size < len(power) else pow(_BASE, size, 1 << 64)
    for j in _runs(free_b, size):
        at[(hb[j + size] - hb[j] * scale) & mask].append(j)
    longest, found = 0, []
    for i in _runs(free_a, size):
        for j in at.get((ha[i + size] - ha[i] * scale) & mask, ()):
            if i and j and free_a[i - 1] and free_b[j - 1] and a[i - 1] == b[j - 1]:
                continue  # part of the run that began before
            n = 0
            while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                n += 1
            if n > 2 * size:
                return n, []
            if n >= size:
                longest = max(longest, n)
                found.append((n, i, j))
    return longest, found


@dataclass
class Items:
    """Benchmark items of a block and the sorted seeds that lead to them."""

    ids: list
    tokens: list[np.ndarray]
    seeds: np.ndarray
    owners: np.ndarray
    short: dict[int, list[int]]  # items of fewer words than a seed, by their length


def index_items(ids: list, texts: pa.Array, seed: int) -> Items:
    tokens = [np.zeros(0, np.uint64)] * len(ids)
    for w in words(texts, lower=True, plain=True):
        for i in range(w.rows):
            tokens[w.first + i] = w.hash[w.of_row(i)]
    seeds, owners, short = [], [], defaultdict(list)
    for i, t in enumerate(tokens):
        size = min(seed, len(t))
        if size:
            h = grams(t, np.zeros(len(t), np.int64), size)[1]
            seeds.append(h)
            owners.append(np.full(len(h), i))
            if size < seed:
                short[size].append(i)
    if not seeds:
        return Items(ids, tokens, np.zeros(0, np.uint64), np.zeros(0, np.int64), short)
    every, owner = np.concatenate(seeds), np.concatenate(owners)
    order = np.lexsort((owner, every))
    return Items(ids, tokens, every[order], owner[order], short)


def _hits(hashes: np.ndarray, items: Items) -> np.ndarray:
    at = np.searchsorted(items.seeds, hashes)
    at[at == len(items.seeds)] = 0
    return np.flatnonzero(items.seeds[at] == hashes) if len(items.seeds) else np.zeros(0, np.int64)


def _near(positions: np.ndarray, tokens: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The words under the seeds, in order, with a separator after each stretch, and their places."""
    covered = np.unique((positions[:, None] + np.arange(size)).ravel())
    gap = np.flatnonzero(np.diff(covered) > 1) + 1
    # No word hashes to the separator 0, up to a chance of 2 ** -64.
    values = np.insert(tokens[covered], gap, np.uint64(0))
    return values, np.insert(covered, gap, -1)


def _pairs(w, items: Items, seed: int, coverage: float) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """(row, item, tiles) of the contaminated pairs of a block of documents."""
    candidates: dict[tuple[int, int], set[int]] = defaultdict(set)
    for size in (seed, *items.short):
        at, hashes = grams(w.hash, w.row, size)
        for h in _hits(hashes, items).tolist():
            low = int(np.searchsorted(items.seeds, hashes[h], "left"))
            high = int(np.searchsorted(items.seeds, hashes[h], "right"))
            for owner in items.owners[low:high].tolist():
                if min(seed, len(items.tokens[owner])) == size:
                    candidates[int(w.row[at[h]]), owner].add(int(at[h]))
    for (row, owner), positions in sorted(candidates.items()):
        item = items.tokens[owner]
        size = min(seed, len(item))
        values, places = _near(np.array(sorted(positions)), w.hash, size)
        # No tile leaves the words under seeds, so these bound what can be covered.
        if len(np.unique(positions_of(values, item, size))) < coverage * len(item):
            continue
        found = tiles(values, item, size)
        if sum(n for _, _, n in found) >= coverage * len(item):
            yield row, owner, [(int(places[i]) - int(w.begin[row]), j, n) for i, j, n in found]


def positions_of(values: np.ndarray, item: np.ndarray, size: int) -> np.ndarray:
    """Places in ``item`` that lie under a run of ``size`` words it shares with ``values``."""
    if len(values) < size or len(item) < size:
        return np.zeros(0, np.int64)
    own = grams(item, np.zeros(len(item), np.int64), size)[1]
    shared = np.flatnonzero(np.isin(own, grams(values, np.zeros(len(values), np.int64), size)[1]))
    return (shared[:, None] + np.arange(size)).ravel()


_TILES = pa.list_(pa.struct([("start", pa.int32()), ("item_start", pa.int32()), ("length", pa.int32())]))


def _blocks(benchmark: DataFrame, item_key: str, item_text: str, block: int) -> Iterator[pa.Table]:
    """The benchmark in pieces whose texts have about ``block`` bytes, from files in the shared folder."""
    rows = benchmark.select(F.col(item_key).alias("item_id"), F.col(item_text).cast("string").alias("text")).filter("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block))
    if n == 1:
        yield rows.toArrow()
        return
    dealt = stored(rows.repartition(n).withColumn("block", F.spark_partition_id()), "benchmark")
    for i in range(n):
        yield dealt.filter(F.col("block") == i).select("item_id", "text").toArrow()


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    seed: int = SEED, coverage: float = COVERAGE, block: int = BLOCK_BYTES,
) -> DataFrame:
    """``key, item_id, item_words, covered, coverage, tiles`` of every contaminated pair."""
    spark = docs.sparkSession
    prepare(spark)
    kind, item_kind = docs.schema[key].dataType.simpleString(), benchmark.schema[item_key].dataType.simpleString()
    shape = f"`{key}` {kind}, item_id {item_kind}, item_words long, covered long, coverage double, tiles array<struct<start: int, item_start: int, length: int>>"
    found = None
    for rows in _blocks(benchmark, item_key, item_text, block):
        column = rows["text"].combine_chunks() if rows.num_rows else pa.array([], pa.string())
        shared = spark.sparkContext.broadcast(index_items(rows["item_id"].to_pylist(), column, seed))

        def run(batches, shared=shared):
            items = shared.value
            for b in batches:
                out = []
                for w in words(b.column(1), lower=True, plain=True):
                    out += [(w.first + row, owner, t) for row, owner, t in _pairs(w, items, seed, coverage)]
                covered = [sum(n for _, _, n in t) for _, _, t in out]
                sizes = [len(items.tokens[owner]) for _, owner, _ in out]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array([r for r, _, _ in out], pa.int64())),
                        pa.array([items.ids[owner] for _, owner, _ in out], rows.schema.field("item_id").type),
                        pa.array(sizes, pa.int64()), pa.array(covered, pa.int64()),
                        pa.array([c / n for c, n in zip(covered, sizes, strict=True)], pa.float64()),
                        pa.array([[{"start": i, "item_start": j, "length": n} for i, j, n in t] for _, _, t in out], _TILES),
                    ],
                    names=[key, "item_id", "item_words", "covered", "coverage", "tiles"],
                )

        part = docs.select(F.col(key), F.col(text).cast("string").alias("text")).mapInArrow(run, shape)
        found = part if found is None else found.union(part)
    return found


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    seed: int = SEED, coverage: float = COVERAGE, block: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that no benchmark item contaminates."""
    prepare(docs.sparkSession)
    for rows in _blocks(benchmark, item_key, item_text, block):
        column = rows["text"].combine_chunks() if rows.num_rows else pa.array([], pa.string())
        docs = _without(docs, index_items(rows["item_id"].to_pylist(), column, seed), text, seed, coverage)
    return docs


def _without(docs: DataFrame, items: Items, text: str, seed: int, coverage: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    @F.pandas_udf("boolean")
    def leaks(texts: pd.Series) -> pd.Series:
        found = np.zeros(len(texts), bool)
        for w in words(pa.array(texts, pa.string(), from_pandas=True), lower=True, plain=True):
            found[[w.first + row for row, _, _ in _pairs(w, shared.value, seed, coverage)]] = True
        return pd.Series(found)

    return docs.filter(~leaks(F.col(text).cast("string")))
