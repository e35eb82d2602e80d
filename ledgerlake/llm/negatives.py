"""Hard negatives by exact inner product: residue-number-system products, windowed selection.

A score is the integer inner product of two vectors. Their components are reduced modulo several primes to
residues around zero, so small that float32 sums over a piece of the dimensions stay exact; one matrix product a
prime and piece gives the scores modulo each prime, and Chinese remaindering the signed scores. As many primes are
taken as the largest components of the two blocks need.

Anchors are dealt evenly into tiles of bounded size in the shared folder. A tile is broadcast, multiplied with blocks
of every task's rows, and destroyed before the next one, its lists written to the shared folder:
1. each anchor's first ``positives`` other rows of its label (an anchor's lists have that length at most),
2. for each of these, the first ``negatives`` rows of other labels with a score in the window
   ``low * positive <= 100 * negative <= high * positive``.
A task keeps one list of bounded length for each anchor (and positive); lists are merged in two levels.

Rows without an id or a label, and vectors that are null or hold a null or a component that is not finite (once scaled),
take no part.
An anchor meets the rows of its length but those with its own id. Higher scores come first, ties by smaller id;
repeated ids each count as a row, but an anchor id is asked once, with its smallest label and vector. Scores
outside the range of a long are set to its ends. Windows are compared without overflow. Empty tables give an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare, stored

#: Anchors of a tile and rows of a block.
TILE = 1024
BLOCK = 2048
#: Lists merged by one group of the first level are those of every SLOTS-th task.
SLOTS = 64
_LONG = np.iinfo(np.int64)
#: Sums of float32 integers up to this size are exact.
_EXACT = 1 << 24
#: With residues of at most 510, a piece holds 64 dimensions.
_LARGEST = 1021


@functools.cache
def primes() -> list[int]:
    """Odd primes: from the largest one up to ``_LARGEST`` downwards, then upwards from there."""
    limit = 4096
    flags = np.ones(limit, bool)
    flags[:2] = False
    for i in range(2, 64):
        flags[i * i :: i] = False
    every = np.flatnonzero(flags)[1:].tolist()
    return [p for p in reversed(every) if p <= _LARGEST] + [p for p in every if p > _LARGEST]


def moduli(most: int) -> list[int]:
    """Primes whose product is above ``4 * most``: enough for signed values up to ``most``."""
    chosen, product = [], 1
    for p in primes():
        if chosen and product > 4 * most:
            return chosen
        chosen.append(p)
        product *= p
    raise ValueError("components are too large")


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Whole numbers modulo an odd prime, from -(p-1)/2 to (p-1)/2, as float32; the remainder of floats is exact."""
    r = np.fmod(x, p)
    half = (p - 1) // 2
    return np.where(r > half, r - p, np.where(r < -half, r + p, r)).astype(np.float32)


def product_modulo(q: np.ndarray, c: np.ndarray, p: int) -> np.ndarray:
    """``q @ c.T`` modulo ``p``, from 0 to p-1, by exact float32 products over pieces of the dimensions."""
    a, b = residues(q, p), residues(c, p)
    piece = max(1, (_EXACT - 1) // ((p - 1) // 2) ** 2)
    total = np.zeros((len(q), len(c)), np.int64)
    for low in range(0, q.shape[1], piece):
        total += (a[:, low : low + piece] @ b[:, low : low + piece].T).astype(np.int64)
    return total % p


def inner_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact signed inner products of two matrices of whole numbers (float64), held to the range of a long.

    The scores are put together digit by digit, in the mixed radix of the primes; the last digit carries the sign.
    """
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), np.int64)
    most = int(np.abs(q).max()) * int(np.abs(c).max()) * q.shape[1]
    wide = most > 1 << 60
    value, modulus = np.zeros((len(q), len(c)), object if wide else np.int64), 1
    chosen = moduli(most)
    for p in chosen:
        digit = (product_modulo(q, c, p) - (value % p).astype(np.int64)) * pow(modulus, -1, p) % p
        if p == chosen[-1]:
            digit = np.where(digit > p // 2, digit - p, digit)
        if wide:
            value = value + digit.astype(object) * modulus
        else:
            # Products may wrap, the sum ends within a long.
            value = (value.astype(np.uint64) + digit.astype(np.uint64) * np.uint64(modulus)).astype(np.int64)
        modulus *= p
    return np.clip(value, _LONG.min, _LONG.max).astype(np.int64) if wide else value


class Lists:
    """The ``k`` first (score downwards, id upwards) of each of ``n`` lists."""

    def __init__(self, n: int, k: int):
        self.score, self.id, self.has = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64), np.zeros((n, k), bool)

    def add(self, score: np.ndarray, ids: np.ndarray, has: np.ndarray) -> None:
        """Offer columns to each list: scores and which of them count, (n, columns), and ascending ids."""
        k = self.score.shape[1]
        if score.shape[1] > k:
            at = _first(score, has, k)
            score, has, ids = np.take_along_axis(score, at, 1), np.take_along_axis(has, at, 1), ids[at]
        else:
            ids = np.broadcast_to(ids, score.shape)
        score, ids, has = np.hstack([self.score, score]), np.hstack([self.id, ids]), np.hstack([self.has, has])
        # ~score is -score - 1: it orders downwards and cannot overflow.
        order = np.lexsort((ids, ~score, ~has), axis=1)[:, :k]
        self.score, self.id, self.has = (np.take_along_axis(x, order, 1) for x in (score, ids, has))


def _first(score: np.ndarray, has: np.ndarray, k: int) -> np.ndarray:
    """Columns of the first ``k`` entries that count; of equal scores those further left."""
    n = score.shape[1]
    if np.abs(np.where(has, score, 0)).max(initial=0) >= _LONG.max // (n + 1):
        known, score = np.unique(score, return_inverse=True)
        score = score.reshape(has.shape)
    ranked = np.where(has, score * n + (n - 1 - np.arange(n)), _LONG.min)
    return np.argpartition(ranked, n - k, axis=1)[:, n - k :]


def _rows(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, floored vectors) of a batch of usable rows, by vector length, ids ascending."""
    ids, labels, vectors = np.asarray(batch.column(0)), np.asarray(batch.column(1)), batch.column(2)
    lengths = np.asarray(pc.list_value_length(vectors))
    for dim in np.unique(lengths):
        at = np.flatnonzero(lengths == dim)
        at = at[np.argsort(ids[at], kind="stable")]
        values = np.asarray(vectors.take(pa.array(at)).flatten()).reshape(len(at), dim)
        yield ids[at], labels[at], np.floor(scale * values)


class Tile:
    """Anchors of one vector length: ids, labels, vectors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors

    def blocks(self, batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Scores of the anchors and blocks of rows of their length, the rows' ids and whether labels agree."""
        for b in batches:
            for ids, labels, vectors in _rows(b, scale):
                if vectors.shape[1] != self.vectors.shape[1]:
                    continue
                for low in range(0, len(ids), BLOCK):
                    part = slice(low, low + BLOCK)
                    yield inner_products(self.vectors, vectors[part]), ids[part], self.labels[:, None] == labels[part][None, :]


def _tiles(rows: pa.Table, scale: int) -> list[Tile]:
    parts: dict[int, list] = {}
    for b in rows.to_batches():
        for found in _rows(b, scale):
            parts.setdefault(found[2].shape[1], []).append(found)
    return [Tile(*(np.concatenate(x) for x in zip(*p, strict=True))) for _, p in sorted(parts.items())]


_SHAPE = "anchor_id long, place int, id long, score long, slot int"
_SCHEMA = pa.schema([("anchor_id", pa.int64()), ("place", pa.int32()), ("id", pa.int64()), ("score", pa.int64()), ("slot", pa.int32())])


def _listed(tile: Tile, lists: Lists, places: int) -> pa.RecordBatch:
    """The entries of all lists; list ``i`` belongs to anchor ``i // places`` and its positive ``i % places``."""
    row, column = np.nonzero(lists.has)
    slot = TaskContext.get().partitionId() % SLOTS
    return pa.RecordBatch.from_arrays(
        [
            pa.array(tile.ids[row // places]), pa.array((row % places).astype(np.int32)), pa.array(lists.id[row, column]),
            pa.array(lists.score[row, column]), pa.array(np.full(len(row), slot, np.int32)),
        ],
        schema=_SCHEMA,
    )


def _positives(batches: list[pa.RecordBatch], tiles: list[Tile], k: int, scale: int) -> Iterator[pa.RecordBatch]:
    found = [Lists(len(t.ids), k) for t in tiles]
    for b in batches:
        for tile, lists in zip(tiles, found, strict=True):
            for score, ids, same in tile.blocks([b], scale):
                lists.add(score, ids, same & (tile.ids[:, None] != ids[None, :]))
    for tile, lists in zip(tiles, found, strict=True):
        yield _listed(tile, lists, 1)


def bounds(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of a window: low * positive <= 100 * score <= high * positive."""
    least = [max(_LONG.min, min(_LONG.max, -(-low * int(s) // 100))) for s in score]
    most = [max(_LONG.min, min(_LONG.max, high * int(s) // 100)) for s in score]
    return np.array(least, np.int64), np.array(most, np.int64)


def _negatives(batches, tiles: list[Tile], windows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int, scale: int) -> Iterator[pa.RecordBatch]:
    """``windows`` of a tile: (least, greatest, whether it is one), each (anchors, positives)."""
    found = [[Lists(len(t.ids), k) for _ in range(w[0].shape[1])] for t, w in zip(tiles, windows, strict=True)]
    for b in batches:
        for tile, (least, most, has), places in zip(tiles, windows, found, strict=True):
            for score, ids, same in tile.blocks([b], scale):
                other = ~same & (tile.ids[:, None] != ids[None, :])
                for j, lists in enumerate(places):
                    lists.add(score, ids, other & has[:, j, None] & (score >= least[:, j, None]) & (score <= most[:, j, None]))
    for tile, places in zip(tiles, found, strict=True):
        for j, lists in enumerate(places):
            out = _listed(tile, lists, 1)
            yield out.set_column(1, _SCHEMA.field(1), pa.array(np.full(len(out), j, np.int32)))


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """The ``k`` first of each (anchor, place): of the lists of some tasks, then of all."""
    order = [F.col("score").desc(), F.col("id")]
    some = Window.partitionBy("anchor_id", "place", "slot").orderBy(*order)
    every = Window.partitionBy("anchor_id", "place").orderBy(*order)
    first = lists.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
    return first.withColumn("rank", F.row_number().over(every)).filter(F.col("rank") <= k)


def _windows(tile: Tile, positives: pa.Table, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    where = {int(x): i for i, x in enumerate(tile.ids)}
    least, most, has = np.zeros((len(where), k), np.int64), np.zeros((len(where), k), np.int64), np.zeros((len(where), k), bool)
    score = np.asarray(positives["score"])
    lows, highs = bounds(score, low, high)
    for anchor, rank, one, other in zip(positives["anchor_id"].to_pylist(), positives["rank"].to_pylist(), lows, highs, strict=True):
        if (i := where.get(anchor)) is not None:
            least[i, rank - 1], most[i, rank - 1], has[i, rank - 1] = one, other, True
    return least, most, has


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
    key: str = "vec_id", vector: str = "embedding", label: str = "label", tile: int = TILE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of the windows' first rows.

    ``anchors`` has the columns of ``rows``.
    """
    spark = rows.sparkSession
    prepare(spark)
    picked = [F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v")]
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) != float("inf")))
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite
    candidates = rows.select(*picked).filter(usable)
    one = anchors.select(*picked).filter(usable).groupBy("id").agg(F.min(F.struct("label", "v")).alias("first"))
    asked = stored(one.select("id", "first.label", "first.v"), "anchors")
    tiles = -(-asked.count() // tile)
    dealt = stored(asked.repartition(max(1, tiles)).withColumn("tile", F.spark_partition_id()), "tiles")
    parts = []
    for i in range(tiles):
        mine = _tiles(dealt.filter(F.col("tile") == i).select("id", "label", "v").toArrow(), scale)
        shared = spark.sparkContext.broadcast(mine)

        def best(batches, shared=shared):
            yield from _positives(batches, shared.value, positives, scale)

        found = stored(_merged(candidates.mapInArrow(best, _SHAPE), positives), "positives")
        # At most ``positives`` rows for each anchor of the tile.
        known = found.select("anchor_id", "rank", "score").toArrow()
        windows = spark.sparkContext.broadcast([_windows(t, known, positives, low, high) for t in mine])

        def within(batches, shared=shared, windows=windows):
            yield from _negatives(batches, shared.value, windows.value, negatives, scale)

        lists = stored(_merged(candidates.mapInArrow(within, _SHAPE), negatives), "negatives")
        shared.destroy()
        windows.destroy()
        parts.append(
            lists.select("anchor_id", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(
                found.select("anchor_id", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), ["anchor_id", "place"]
            )
        )
    out = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    if not parts:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    return found.select(*out)
