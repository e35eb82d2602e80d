"""Packing of tokenised texts into sequences by bounded-space online best fit.

A task tokenises its texts, cuts only documents that are longer than a sequence, and places every piece
as it comes: the open bins, at most ``open_bins`` of them, are keyed by free space in a bitset, the
piece goes to the bin with the least free space that holds it, and when a bin too many is open the
fullest one closes. What a task still has open at its end (a bounded number of bins) is packed on
in a tree: the open bins of ``FAN_IN`` tasks are placed into each other as if they were pieces, again with at
most ``open_bins`` of them open, until one group is left. So no group has more than FAN_IN * open_bins bins. Texts are read and tokenised once; only rows about pieces are written and shuffled.

Null and empty texts are documents of the end token alone. Every row is a document, repeated rows too;
other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
import struct
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import batch, mix, prepare, stored
from ledgerlake.llm.token_counts import merged_ids, special_strings, tokenizer

TOKENIZER = "word_bpe_49k.json"
LENGTH = 4096
END = 1
OPEN_BINS = 64
FAN_IN = 64
#: Entries of each of a worker's two caches; once one is full, what it lacks is encoded each time.
CACHE = 1 << 19

# Characters that the tokenizer's normaliser and this module treat alike: one lower-case character each,
# composed, and of the same class for both patterns.
_SAFE = [chr(c) for c in range(0x250) if not 0x1C <= c <= 0x1F and c != 0x85 and len(chr(c).lower()) == 1 and unicodedata.normalize("NFC", chr(c)) == chr(c)]
_UNSAFE = re.compile("[^" + "".join(map(re.escape, _SAFE)) + "]")
_LETTERS = "".join(re.escape(c) for c in _SAFE if unicodedata.category(c)[0] == "L")
_NUMBERS = "".join(re.escape(c) for c in _SAFE if unicodedata.category(c)[0] == "N")
_SPLIT = re.compile(rf"[{_LETTERS}]+|[{_NUMBERS}]|'(?:[stmd]|re|ve|ll)|[^\t\n\x0b\x0c\r \xa0{_LETTERS}{_NUMBERS}]+")


class _Pieces(dict):
    """Pre-token to the bytes of its ids (little-endian, 32 bits)."""

    def __init__(self, path: str):
        super().__init__()
        self.model = tokenizer(path).model

    def __missing__(self, piece: str) -> bytes:
        ids = _packed(merged_ids(self.model, piece))
        if len(piece) <= 64 and len(self) < CACHE:
            self[piece] = ids
        return ids


class _Chunks(dict):
    """Text between spaces to the bytes of its ids: white space separates pre-tokens and is dropped."""

    def __init__(self, path: str):
        super().__init__()
        self.pieces = _Pieces(path)

    def __missing__(self, chunk: str) -> bytes:
        ids = b"".join(map(self.pieces.__getitem__, _SPLIT.findall(chunk)))
        if len(chunk) <= 64 and len(self) < CACHE:
            self[chunk] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_encoded = functools.cache(_Chunks)


def token_bytes(text: str, path: str) -> bytes:
    """Ids of a whole text as little-endian 32-bit numbers, the same as the tokenizer's."""
    if special_pattern(path).search(text) or _UNSAFE.search(text):
        return _packed(tokenizer(path).encode(text, add_special_tokens=False).ids)
    return b"".join(map(_encoded(path).__getitem__, text.lower().split()))


special_pattern = functools.cache(special_strings)


class BestFit:
    """Open bins keyed by free space; bit ``f`` of ``bits`` is set while a bin has ``f`` free."""

    def __init__(self, length: int, open_bins: int):
        self.length, self.open_bins = length, open_bins
        self.bits, self.by_free, self.count, self.made = 0, defaultdict(list), 0, 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        taken = bins.pop()
        if not bins:
            self.bits ^= 1 << free
            del self.by_free[free]
        self.count -= 1
        return taken

    def place(self, size: int) -> tuple[int, int, int | None]:
        """(bin, offset in it, bin closed for it or None) of a piece of 1 to ``length`` tokens."""
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            chosen = self._take(free)
        else:
            free, chosen = self.length, self.made
            self.made += 1
        closed = None
        if free == size:
            closed = chosen
        else:
            self.by_free[free - size].append(chosen)
            self.bits |= 1 << (free - size)
            self.count += 1
            if self.count > self.open_bins:
                closed = self._take((self.bits & -self.bits).bit_length() - 1)
        return chosen, self.length - free, closed

    def still_open(self) -> dict[int, int]:
        """Free space of every open bin."""
        return {b: free for free, bins in self.by_free.items() for b in bins}


_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, task long, unfilled boolean"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("task", pa.int64()), ("unfilled", pa.bool_())]
)


def _pack(batches: Iterator[pa.RecordBatch], path: str, length: int, open_bins: int) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    fit, waiting, done = BestFit(length, open_bins), defaultdict(list), []
    end = _packed([END])

    def flushed(unfilled: bool) -> pa.RecordBatch:
        rows = [*done]
        done.clear()
        columns = list(zip(*rows, strict=True)) if rows else [()] * 7
        return batch(_ARROW, *columns, [task] * len(rows), [unfilled] * len(rows))

    for b in batches:
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            ids = memoryview(token_bytes(text or "", path) + end)
            n = len(ids) // 4
            for piece, start in enumerate(range(0, n, length)):
                size = min(length, n - start)
                chosen, offset, closed = fit.place(size)
                waiting[chosen].append((doc_id, piece, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]), task << 40 | chosen, offset))
                if closed is not None:
                    done += waiting.pop(closed)
        if len(done) > 10_000:
            yield flushed(False)
    yield flushed(False)
    for rows in waiting.values():
        done += rows
        if len(done) > 10_000:
            yield flushed(True)
    yield flushed(True)


def _join_bins(key, bins: pd.DataFrame, length: int, open_bins: int) -> pd.DataFrame:
    """Place the bins of some tasks into each other; at most ``open_bins`` are open at a time.

    They come in an order by a hash: sorted by size, the full ones would be closed before those that fill them up.
    """
    bins = bins.iloc[np.argsort(mix(bins.bin.to_numpy().astype(np.uint64)), kind="stable")]
    fit, first, into, shift = BestFit(length, open_bins), {}, [], []
    for name, used in zip(bins.bin, bins.used, strict=True):
        chosen, offset, _ = fit.place(int(used))
        into.append(first.setdefault(chosen, name))
        shift.append(offset)
    still = {first[b] for b in fit.still_open()}
    return pd.DataFrame({"bin": bins.bin, "into": into, "shift": shift, "task": int(key[0]), "used": bins.used, "open": [i in still for i in into]})


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, length: int = LENGTH, open_bins: int = OPEN_BINS) -> DataFrame:
    """One row a piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    prepare(docs.sparkSession)
    path = path or public_tokenizers.path(TOKENIZER)
    chosen = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    placed = stored(chosen.mapInArrow(lambda batches: _pack(batches, path, length, open_bins), _SCHEMA), "pieces")
    unfilled = placed.filter("unfilled")
    level = unfilled.groupBy(F.col("sequence_id").alias("bin"), "task").agg(F.sum("length").alias("used"))
    moved = None
    while True:
        grouped = level.withColumn("task", F.floor(F.col("task") / FAN_IN)).groupBy("task")
        steps = stored(grouped.applyInPandas(lambda k, bins: _join_bins(k, bins, length, open_bins), "bin long, into long, shift long, task long, used long, open boolean"), "bins")
        if moved is None:
            moved = steps.select("bin", "into", "shift")
        else:
            later = steps.select(F.col("bin").alias("into"), F.col("into").alias("last"), F.col("shift").alias("more"))
            onward = (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")  # closed bins stay where they are
            moved = stored(moved.join(later, "into", "left").select("bin", F.coalesce("last", "into").alias("into"), onward), "moved")
        if (steps.agg(F.max("task")).first()[0] or 0) == 0:
            break
        level = steps.filter("open").groupBy(F.col("into").alias("bin"), "task").agg(F.sum("used").alias("used"))
    out = ["doc_id", "piece", "start", "length", "ids_crc32"]
    merged = unfilled.join(moved, unfilled["sequence_id"] == moved["bin"]).select(*out, F.col("into").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset"))
    return placed.filter("NOT unfilled").select(*out, "sequence_id", "offset").unionByName(merged)
