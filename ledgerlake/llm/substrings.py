"""Removal of passages that occur more than once, by super-k-mers.

A window is ``window`` consecutive words. Each window has a minimiser, the least of its runs of ``m`` words
in a fixed order of their hashes. Consecutive windows with one minimiser form a super-k-mer and travel
as one packed string to the bucket of that minimiser; all windows with the same words meet there, and
sorting their 128-bit hashes counts them.

Frequent runs come last in the order, so a common line or phrase is a minimiser only of windows made
of common runs alone; such windows lie in passages that repeat word for word, and equal super-k-mers
of a task travel as one string with its places. What is frequent is counted over all texts beforehand,
in a table of fixed size; a run counts as frequent if it is so in some task. Buckets grow in number with
the input, so that each stays within a bounded size.

Null, empty and short texts have no window and lose nothing. Every row counts as a document, so of
repeated rows all windows repeat. Other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import batch, grams, mix, passes, prepare, rolled, sieve, sieve_slot, stored, words

WINDOW = 35
MINIMISER = 5
#: Slots in which runs are counted, and the share of a task's runs that makes a slot frequent.
SLOTS = 1 << 18
FREQUENT = 1 / (1 << 15)
#: Packed bytes that a task holds before it sends them, and that a bucket should have in all.
HELD_BYTES = 24 << 20
BUCKET_BYTES = 16 << 20
LEAST_BUCKETS = 1024
_FIRST, _SECOND = 0x243F6A8885A308D3, 0x13198A2E03707344


def _slot(run: np.ndarray) -> np.ndarray:
    return (mix(run ^ np.uint64(_FIRST)) >> np.uint64(64 - 18)).astype(np.int64)


def _frequent_slots(texts: DataFrame, m: int) -> tuple[np.ndarray, int]:
    """Slots of frequent runs of ``m`` words as a bitmap, and the bytes of all texts."""
    schema = pa.schema([("slot", pa.int32()), ("size", pa.int64())])

    def run(batches):
        seen, size = np.zeros(SLOTS, np.int64), 0
        for b in batches:
            for w in words(b.column(0)):
                size += len(w.buffer)
                seen += np.bincount(_slot(grams(w.hash, w.row, m)[1]), minlength=SLOTS)
        hot = np.flatnonzero(seen > max(8, FREQUENT * seen.sum()))
        yield batch(schema, np.append(hot, -1), np.append(np.zeros(len(hot), np.int64), size))

    slots = texts.select("text").mapInArrow(run, "slot int, size long").groupBy("slot").agg(F.sum("size").alias("size")).toArrow()  # at most SLOTS + 1 rows
    at, size = np.asarray(slots["slot"]), np.asarray(slots["size"])
    frequent = np.zeros(SLOTS, bool)
    frequent[at[at >= 0]] = True
    return frequent, int(size[at < 0].sum())


def super_runs(hashes: np.ndarray, row: np.ndarray, frequent: np.ndarray, window: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, minimiser) of the super-k-mers of a block of words."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # Runs across rows keep the name 0; they never lie in a window of one row.
    named = np.zeros(len(hashes) - m + 1, np.uint64)
    at, value = grams(hashes, row, m)
    named[at] = value
    order = (mix(named ^ np.uint64(_SECOND)) >> np.uint64(1)) | (frequent[_slot(named)].astype(np.uint64) << np.uint64(63))
    place = np.lib.stride_tricks.sliding_window_view(order, window - m + 1).argmin(axis=1) + np.arange(n)
    inside = np.flatnonzero(row[:n] == row[window - 1 :])
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    own = place[inside]
    new = np.concatenate(([True], (own[1:] != own[:-1]) | (np.diff(inside) != 1)))
    first = inside[new]
    last = inside[np.append(np.flatnonzero(new)[1:] - 1, len(inside) - 1)]
    return first, last, named[own[new]]


_PACKED = pa.schema([("bucket", pa.int64()), ("strings", pa.binary()), ("places", pa.binary())])


class _Held:
    """Super-k-mers of a task by bucket; equal strings are kept once with all their places."""

    def __init__(self):
        self.buckets: dict[int, dict[bytes, list[int]]] = defaultdict(dict)
        self.size = 0
        self.press = zstandard.ZstdCompressor(level=3)

    def add(self, bucket: int, string: bytes, *place: int) -> None:
        strings = self.buckets[bucket]
        places = strings.get(string)
        if places is None:
            strings[string] = list(place)
            self.size += len(string) + 100
        else:
            places.extend(place)
            self.size += 24

    def sent(self) -> Iterator[pa.RecordBatch]:
        rows = []
        for bucket, strings in self.buckets.items():
            sizes = np.array([x for s, p in strings.items() for x in (len(s), len(p) // 3)], np.int64)
            places = np.array([x for p in strings.values() for x in p], np.int64)
            head = np.array([len(strings)], np.int64)
            rows.append((bucket, self.press.compress(b"".join(strings)), self.press.compress(head.tobytes() + sizes.tobytes() + places.tobytes())))
        for low in range(0, len(rows), 256):
            yield batch(_PACKED, *zip(*rows[low : low + 256], strict=True))
        self.buckets.clear()
        self.size = 0


def _unpacked(strings: bytes, places: bytes) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(text, string lengths, occurrences of each string, places as rows of id, text hash, first word)."""
    release = zstandard.ZstdDecompressor()
    numbers = np.frombuffer(release.decompress(places), np.int64)
    n = int(numbers[0])
    sizes = numbers[1 : 1 + 2 * n].reshape(-1, 2)
    return release.decompress(strings), sizes[:, 0], sizes[:, 1], numbers[1 + 2 * n :].reshape(-1, 3)


_RANGES = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])


def _repeats(packed: pa.Table, window: int) -> pa.Table:
    """Word ranges under windows that occur more than once in a bucket."""
    parts = [_unpacked(s, p) for s, p in zip(packed["strings"].to_pylist(), packed["places"].to_pylist(), strict=True)]
    text = b"".join(p[0] for p in parts)
    sizes, times, places = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    strings = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets.tobytes()), pa.py_buffer(text))
    string, place, one, two = [], [], [], []
    for w in words(strings):
        n = max(0, len(w.hash) - window + 1)
        inside = np.flatnonzero(w.row[:n] == w.row[window - 1 :]) if n else np.zeros(0, np.int64)
        string.append(w.first + w.row[inside])
        place.append(inside - w.begin[w.row[inside]])
        one.append(rolled(w.hash, window, _FIRST)[inside])
        two.append(rolled(w.hash, window, _SECOND)[inside])
    string, place, one, two = (np.concatenate(x) for x in (string, place, one, two))
    order = np.lexsort((two, one))
    same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    again = times[string] > 1
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    hit = np.flatnonzero(again)
    if not len(hit):
        return _RANGES.empty_table()
    s, p = string[hit], place[hit]
    new = np.concatenate(([True], (s[1:] != s[:-1]) | (np.diff(p) != 1)))
    at = np.flatnonzero(new)
    s, low, high = s[at], p[at], p[np.append(at[1:] - 1, len(p) - 1)] + window
    # Each range of a string holds at every place of the string.
    begin = np.concatenate(([0], np.cumsum(times)))
    which = np.repeat(np.arange(len(s)), times[s])
    nth = np.arange(len(which)) - np.repeat(np.cumsum(times[s]) - times[s], times[s])
    found = places[begin[s[which]] + nth]
    return pa.table([found[:, 0], found[:, 1], (found[:, 2] + low[which]).astype(np.int32), (found[:, 2] + high[which]).astype(np.int32)], schema=_RANGES)


#: Stands for a null id inside this module; texts with the same id and hash share their ranges anyway.
_NO_ID = -(1 << 63)


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.col(text).cast("string")
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("id"), F.xxhash64(body).alias("text_hash"), body.alias("text"))


def repeated_ranges(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, m: int = MINIMISER) -> DataFrame:
    """``id, text_hash, low, high``: word ranges under windows that start anywhere else too."""
    spark = docs.sparkSession
    prepare(spark)
    texts = _keyed(docs, key, text)
    frequent, size = _frequent_slots(texts, m)
    buckets = max(LEAST_BUCKETS, -(-4 * size // BUCKET_BYTES))
    shared = spark.sparkContext.broadcast(frequent)

    def cut(batches):
        held, hot = _Held(), shared.value
        for b in batches:
            ids, hashes = np.asarray(b.column(0)), np.asarray(b.column(1))
            for w in words(b.column(2)):
                first, last, value = super_runs(w.hash, w.row, hot, window, m)
                row = w.row[first]
                of = (mix(value) % np.uint64(buckets)).astype(np.int64)
                raw = w.buffer.tobytes()
                for bucket, low, high, i, h, at in zip(
                    of.tolist(), w.start[first].tolist(), w.end[last + window - 1].tolist(), ids[w.first + row].tolist(),
                    hashes[w.first + row].tolist(), (first - w.begin[row]).tolist(), strict=True,
                ):
                    held.add(bucket, raw[low:high], i, h, at)
                if held.size > HELD_BYTES:
                    yield from held.sent()
        yield from held.sent()

    packed = texts.select("id", "text_hash", "text").mapInArrow(cut, "bucket long, strings binary, places binary")
    return packed.groupBy("bucket").applyInArrow(lambda rows: _repeats(rows, window), "id long, text_hash long, low int, high int")


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def _left(ids: pa.Array, texts: list, spans: list) -> pa.RecordBatch:
    """What is left of some texts without the word ranges in ``spans``."""
    out = []
    for body, found in zip(texts, spans, strict=True):
        own = (body or "").encode().split()
        kept = own
        if found:
            cover = np.zeros(len(own) + 1, np.int64)
            np.add.at(cover, [r["low"] for r in found], 1)
            np.add.at(cover, [r["high"] for r in found], -1)
            kept = [own[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]
        out.append((len(own), len(own) - len(kept), b" ".join(kept)))
    kept = pa.array([x[2] for x in out], pa.binary()).cast(pa.string())
    return batch(_KEPT, ids, [x[0] for x in out], [x[1] for x in out], kept)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, m: int = MINIMISER) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: what is left of each text, its words joined by one space.

    Only texts that may lose words meet their ranges in a shuffle; a sieve tells the others apart.
    """
    ranges = repeated_ranges(docs, key, text, window, m).distinct()
    spans = stored(ranges.groupBy("id", "text_hash").agg(F.collect_list(F.struct("low", "high")).alias("spans")), "spans")
    shared = docs.sparkSession.sparkContext.broadcast(sieve(spans, "text_hash"))
    texts = _keyed(docs, key, text).withColumn("slot", sieve_slot(F.col("text_hash")))
    shape = "doc_id long, n_words long, n_removed long, kept string"

    def whole_texts(batches):
        for b in batches:
            some = b.filter(pa.array(~passes(shared.value, np.asarray(b.column(2)))))
            yield _left(some.column(0), some.column(1).to_pylist(), [None] * len(some))

    def touched(batches):
        for b in batches:
            yield b.filter(pa.array(passes(shared.value, np.asarray(b.column(4))))).select(["doc_id", "id", "text_hash", "text"])

    def without_ranges(batches):
        for b in batches:
            yield _left(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist())

    some = texts.mapInArrow(touched, "doc_id long, id long, text_hash long, text string")
    joined = some.join(spans, ["id", "text_hash"], "left").select("doc_id", "text", "spans").mapInArrow(without_ranges, shape)
    return texts.select("doc_id", "text", "slot").mapInArrow(whole_texts, shape).union(joined)
