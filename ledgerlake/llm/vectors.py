"""Exact top-k search by integer inner product: tiled matrix products, merged top lists.

Queries are dealt evenly into tiles of bounded size in the shared folder; one tile at a time is
broadcast, its finished lists are written and the broadcast is destroyed. A task multiplies the tile with blocks of its shard, keeps the ``k`` best of each block by
partial selection, and the lists of tasks are merged in a tree: by (query, slot), then by query.

Vectors that are null, or hold a null or a non-finite component, take no part, and neither do rows
without an id. A query meets all rows but those with its own id, and of these the ones of its
length. Equal scores go to the smaller id; repeated ids each count as a row, but a query id is asked
once, with its smallest vector. Scores outside the range
of a long are set to its ends. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import batch, prepare, stored

#: Queries of a tile (the broadcast is at most this many vectors) and rows of a block.
TILE = 2048
BLOCK = 2048
#: Lists merged by one group of the tree's first level are those of every SLOTS-th task.
SLOTS = 64
_LONG = np.iinfo(np.int64)


def quantised(b: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, floored components) of the usable rows of a batch, by vector length."""
    ids, vectors = b.column(0), b.column(1)
    lengths = np.asarray(pc.list_value_length(vectors).fill_null(-1)) if len(b) else np.zeros(0, int)
    known = np.asarray(ids.is_valid())
    for dim in np.unique(lengths[known]):
        if dim < 0:
            continue
        rows = np.flatnonzero((lengths == dim) & known)
        flat = vectors.take(pa.array(rows)).flatten().cast(pa.float64())
        values = flat.to_numpy(zero_copy_only=False).reshape(len(rows), dim)
        fine = np.isfinite(values).all(axis=1)  # a null reads as NaN
        if fine.any():
            yield np.asarray(ids.take(pa.array(rows[fine])).cast(pa.int64())), np.floor(scale * values[fine])


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products as int64; the arithmetic is chosen by the largest possible sum."""
    dim = q.shape[1]
    if dim == 0:
        return np.zeros((len(q), len(c)), np.int64)
    most = float(np.abs(q).max()) * float(np.abs(c).max()) * dim
    if most < 2**24:
        return (q.astype(np.float32) @ c.astype(np.float32).T).astype(np.int64)
    if most < 2**53:
        return (q @ c.T).astype(np.int64)
    whole_q = [[int(x) for x in row] for row in q]
    whole_c = [[int(x) for x in row] for row in c]
    out = np.empty((len(q), len(c)), np.int64)
    for i, a in enumerate(whole_q):
        for j, b in enumerate(whole_c):
            out[i, j] = min(max(sum(x * y for x, y in zip(a, b, strict=True)), _LONG.min), _LONG.max)
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, score) of the k best entries of each row; ``ids`` ascend, so the column breaks ties."""
    rows, n = scores.shape
    if n <= k:
        at = np.tile(np.arange(n), (rows, 1))
    elif np.abs(scores).max(initial=0) < _LONG.max // (n + 1):
        ranked = scores * n + (n - 1 - np.arange(n))
        at = np.argpartition(ranked, n - k, axis=1)[:, n - k :]
    else:
        at = np.argsort(-scores.astype(object), axis=1, kind="stable")[:, :k]
    row = np.repeat(np.arange(rows), at.shape[1])
    at = at.ravel()
    return row, ids[at], scores[row, at]


class _Lists:
    """The k best candidates of each query so far; a list is cut whenever it has grown long."""

    def __init__(self, n: int, k: int):
        self.n, self.k, self.parts, self.size = n, k, [], 0

    def add(self, part: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.parts.append(part)
        self.size += len(part[0])
        if self.size > 16 * self.n * self.k:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        row, ids, score = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        # ~score is -score - 1: it orders downwards and cannot overflow.
        order = np.lexsort((ids, ~score, row))
        row, ids, score = row[order], ids[order], score[order]
        first = np.searchsorted(row, row, side="left")
        keep = np.arange(len(row)) - first < self.k
        self.parts = [(row[keep], ids[keep], score[keep])]
        self.size = int(keep.sum())
        return self.parts[0]


def _search(batches: Iterator[pa.RecordBatch], tile: list[tuple[np.ndarray, np.ndarray]], k: int, scale: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    lists = [_Lists(len(ids), k) for ids, _ in tile]
    for b in batches:
        for ids, vectors in quantised(b, scale):
            order = np.argsort(ids, kind="stable")
            ids, vectors = ids[order], vectors[order]
            for (queries, q), found in zip(tile, lists, strict=True):
                if q.shape[1] != vectors.shape[1]:
                    continue
                for low in range(0, len(ids), BLOCK):
                    some, c = ids[low : low + BLOCK], vectors[low : low + BLOCK]
                    scores = _products(q, c)
                    own = np.isin(queries, some)
                    if own.any():
                        # The rows of these queries are selected without the columns of their own id.
                        for i in np.flatnonzero(own):
                            free = some != queries[i]
                            row, best, score = _best(scores[i : i + 1, free], some[free], k)
                            found.add((row + i, best, score))
                        others = np.flatnonzero(~own)
                        row, best, score = _best(scores[others], some, k)
                        found.add((others[row], best, score))
                    else:
                        found.add(_best(scores, some, k))
    slot = TaskContext.get().partitionId() % SLOTS
    for (queries, _), found in zip(tile, lists, strict=True):
        row, ids, score = found.cut()
        yield batch(schema, queries[row], ids, score, np.full(len(row), slot, np.int32))


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, key: str = "vec_id", vector: str = "embedding", tile: int = TILE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of ``rows`` for each of ``queries``."""
    spark = rows.sparkSession
    prepare(spark)
    picked = [F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")]
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    asked = queries.select(*picked).filter(F.col("id").isNotNull() & usable).groupBy("id").agg(F.min("v").alias("v"))
    asked = stored(asked, "asked")
    n = asked.count()
    # Round-robin dealing makes tiles of n / tiles queries each, so none exceeds its bound by more than one a source task.
    tiles = -(-n // tile)
    out_schema = "query_id long, vec_id long, score long, slot int"
    arrow = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("slot", pa.int32())])
    result = "query_id long, rank int, vec_id long, score long"
    if not tiles:
        return spark.createDataFrame([], result)
    dealt = stored(asked.repartition(tiles).withColumn("tile", F.spark_partition_id()), "queries")
    candidates = rows.select(*picked)
    order = [F.col("score").desc(), F.col("vec_id")]
    some = Window.partitionBy("query_id", "slot").orderBy(*order)
    every = Window.partitionBy("query_id").orderBy(*order)
    found = None
    for i in range(tiles):
        # One tile is on the driver and in the tasks at a time; its lists are in the shared folder when the next one comes.
        shared = spark.sparkContext.broadcast(_tile(dealt.filter(F.col("tile") == i).select("id", "v").toArrow(), scale))

        def search(batches, shared=shared):
            yield from _search(batches, shared.value, k, scale, arrow)

        lists = candidates.mapInArrow(search, out_schema).withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
        lists = lists.withColumn("rank", F.row_number().over(every)).filter(F.col("rank") <= k)
        done = stored(lists.select("query_id", "rank", "vec_id", "score"), "lists")
        shared.destroy()
        found = done if found is None else found.union(done)
    return found


def _tile(rows: pa.Table, scale: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The queries of a tile by vector length."""
    out: dict[int, tuple[list, list]] = {}
    for b in rows.to_batches():
        for ids, vectors in quantised(b, scale):
            kept = out.setdefault(vectors.shape[1], ([], []))
            kept[0].append(ids)
            kept[1].append(vectors)
    return [(np.concatenate(ids), np.concatenate(vectors)) for ids, vectors in out.values()]
