"""Helpers shared by the operators: session preparation, Arrow access, vectorised word hashing.

A task sees Arrow batches. Words are found and hashed on the UTF-8 buffer of a whole batch at
once, in blocks of bounded size, so the cost per word is a few numpy operations.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import work_dir

#: Bytes of text that are looked at together inside a task; a longer text is a block of its own.
BLOCK_BYTES = 1 << 18
#: Upper bound for an Arrow batch sent to a Python worker; it is held on both sides, by every running task.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 1024
#: Settings of the workers: one thread a task for matrix products, and large arrays returned to the system when freed.
WORKER = {"OPENBLAS_NUM_THREADS": "1", "MALLOC_MMAP_THRESHOLD_": str(2 << 20), "MALLOC_TRIM_THRESHOLD_": str(4 << 20), "MALLOC_ARENA_MAX": "2"}


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package and keep Arrow batches small for long texts."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
    spark.sparkContext.environment.update(WORKER)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to the shared working folder and read it back.

    Cuts the lineage with files that outlive any executor, and computes ``df`` once.
    """
    path = f"{work_dir(df.sparkSession)}/{what}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scrambling (xor-shift and multiply), on uint64 arrays."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


_ODD = 0x9E3779B97F4A7C15 | 1
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
_POWERS: list[np.ndarray] = []

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IDENTITY = np.arange(256, dtype=np.uint8)
#: Separators of plain words: everything in ASCII that is neither a letter nor a digit.
_NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 19)
        up = np.full(size, _ODD, dtype=np.uint64)
        down = np.full(size, pow(_ODD, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _POWERS[0], _POWERS[1]


@dataclass
class Words:
    """Words of the rows ``first .. first+rows-1`` of a batch; offsets are bytes in ``buffer``."""

    first: int
    rows: int
    buffer: np.ndarray
    offsets: np.ndarray  # of the rows in the buffer, rows + 1 of them
    row: np.ndarray  # row of each word, counted from ``first``
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    begin: np.ndarray  # index of each row's first word, rows + 1 of them

    def of_row(self, i: int) -> slice:
        return slice(int(self.begin[i]), int(self.begin[i + 1]))


def text_buffer(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; a null counts as empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    if text.null_count:
        text = text.fill_null("")
    if len(text) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type) else np.int32
    buffers = text.buffers()
    offsets = np.frombuffer(buffers[1], dtype=kind)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def _hash_segments(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the slices, by prefix sums over bounded pieces of the buffer."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        low = int(start[i])
        j = max(i + 1, int(np.searchsorted(end, low + BLOCK_BYTES, side="right")))
        high = int(end[j - 1])
        up, down = _powers(high - low + 1)
        prefix = np.empty(high - low + 1, dtype=np.uint64)
        prefix[0] = 0
        np.cumsum(_BYTE[raw[low:high]] * up[: high - low], out=prefix[1:])
        s, e = start[i:j] - low, end[i:j] - low
        out[i:j] = mix((prefix[e] - prefix[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def words(text: pa.Array, lower: bool = False, plain: bool = False, block: int = BLOCK_BYTES) -> Iterator[Words]:
    """Word tables of a string column, block by block.

    Words are maximal runs without the bytes 09-0D and 20 (``plain``: without any ASCII character
    that is no letter or digit); ``lower`` folds A-Z before hashing.
    """
    data, offsets = text_buffer(text)
    separator = _NOT_ALNUM if plain else _SPACE
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + block, side="right")) - 1)
        last = min(last, n)
        low, high = int(offsets[first]), int(offsets[last])
        raw = data[low:high]
        own = offsets[first : last + 1] - low
        inside = ~separator[raw]
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[own] = True
        before = np.concatenate(([False], inside[:-1])) if len(raw) else inside
        start = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.concatenate((inside[1:], [False])) if len(raw) else inside
        end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        folded = _LOWER[raw] if lower else raw
        begin = np.searchsorted(start, own, side="left")
        row = np.repeat(np.arange(last - first), np.diff(begin))
        yield Words(first, last - first, raw, own, row, start, end, _hash_segments(folded, start, end), begin)
        first = last


def grams(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the runs of ``k`` words that stay inside one row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    acc = hashes[:n].copy()
    for j in range(1, k):
        acc *= np.uint64(0x9FB21C651E98DF25)
        acc += hashes[j : j + n]
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    return at, mix(acc[at] + np.uint64(k))


def whole(hashes: np.ndarray) -> np.uint64:
    """Hash of a whole word sequence."""
    return grams(hashes, np.zeros(len(hashes), np.int64), len(hashes))[1][0]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def rolled(hashes: np.ndarray, k: int, salt: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive words, from prefix sums."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = _powers(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(hashes ^ np.uint64(salt)) * up[:n], out=prefix[1:])
    return mix((prefix[k:] - prefix[: n - k + 1]) * down[: n - k + 1])


#: Bits (as a power of two) of a sieve: 1 MB, whatever the input.
SIEVE = 23


def sieve_slot(hashed: Column) -> Column:
    """Slot of a 64-bit hash in a sieve."""
    return hashed.bitwiseAND((1 << SIEVE) - 1)


def sieve(hashed: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size: it lets through the rows with the hashes in ``column``, and few others.

    Where so many hashes go in that it fills, it lets everything through: more is moved, nothing is lost.
    """
    slot = hashed.select(sieve_slot(F.col(column)).alias("slot"))
    bits = slot.select(F.shiftrightunsigned("slot", 5).cast("int").alias("word"), F.expr("shiftleft(1L, cast(slot & 31 AS int))").alias("bit"))
    rows = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2 ** (SIEVE - 5) rows
    out = np.zeros(1 << (SIEVE - 5), np.uint32)
    out[np.asarray(rows["word"])] = np.asarray(rows["bits"]).astype(np.uint32)
    return out


def passes(bitmap: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bitmap[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1 == 1
