"""Token counts of whole texts: a broadcast table of frequent pre-tokens, worker caches for the rest.

A byte-level BPE never merges across pre-tokens, so a text's token count is the sum of the counts of
its pre-tokens. Tier one maps the frequent pre-tokens of *this* corpus to their counts: every task
counts the pre-tokens of all its texts in a bounded summary, the summaries (one row a task, never
the pre-tokens of the corpus) are merged in a tree, and the result of fixed size is broadcast.
Tier two encodes what is left with the tokenizer and keeps it in a bounded cache of the worker.
The table decides only how fast an answer is found, not the answer.

Null and empty texts have 0 bytes and 0 tokens. Texts with characters outside the alphabet for which the split is
reproduced here are split by the tokenizer's own pre-tokenizer, and their pieces go through the same two tiers; only
texts with a special string go to the tokenizer whole. Repeated rows are counted each; other columns of the input are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import pickle
import re
import unicodedata
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from ledgerlake.llm.common import batch, prepare, stored, words

TOKENIZER = "byte_bpe_50k.json"
#: Entries of the broadcast table, and of a task's summary.
FREQUENT = 1 << 15
#: Entries of a worker's own cache; once it is full, what it lacks is encoded each time.
CACHE = 1 << 18
#: Summaries merged by one task.
FAN_IN = 8
_PIECE = 1 << 16
#: Longer pre-tokens are encoded whenever they occur.
LONGEST = 64

#: Characters whose class is the same for this module's pattern and for the tokenizer's: up to U+024F.
_SAFE = [chr(c) for c in range(0x250) if not 0x1C <= c <= 0x1F and c != 0x85]


def _class(kind: str) -> str:
    return "".join(re.escape(c) for c in _SAFE if unicodedata.category(c)[0] == kind)


_SPACES = r"\t\n\x0b\x0c\r \xa0"
_UNSAFE = re.compile("[^" + "".join(re.escape(c) for c in _SAFE) + "]")
_SPLIT = re.compile(
    f" ?[{_class('L')}]+| ?[{_class('N')}]+|'(?:[stmd]|re|ve|ll)| ?[^{_SPACES}{_class('L')}{_class('N')}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)


@functools.cache
def tokenizer(path: str) -> Tokenizer:
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@functools.cache
def byte_alphabet() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte, as a table for ``str.translate``."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(0x100 + i) for i, b in enumerate(hidden)}


def merged_ids(model: models.BPE, piece: str) -> list[int]:
    """Ids of one pre-token of a byte-level vocabulary."""
    return [t.id for t in model.tokenize(piece.encode().decode("latin-1").translate(byte_alphabet()))]


def special_strings(path: str) -> re.Pattern:
    found = [a.content for a in tokenizer(path).get_added_tokens_decoder().values()]
    return re.compile("|".join(map(re.escape, found)) or r"(?!)")


def pieces(text: str) -> Iterator[list[str]]:
    """Pre-tokens of a text, in lists of bounded length."""
    if len(text) <= _PIECE:
        yield _SPLIT.findall(text)
        return
    some: list[str] = []
    for m in _SPLIT.finditer(text):
        some.append(m[0])
        if len(some) >= _PIECE:
            yield some
            some = []
    yield some


class _Heaviest:
    """Counts of hashed words with one spelling each; the lightest go when there are too many."""

    def __init__(self, size: int):
        self.size, self.hash, self.count, self.spelling = size, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, object)

    def add(self, hashes: np.ndarray, counts: np.ndarray, spellings: np.ndarray) -> None:
        self.hash, at, back = np.unique(np.concatenate((self.hash, hashes)), return_index=True, return_inverse=True)
        self.count = np.bincount(back, weights=np.concatenate((self.count, counts))).astype(np.int64)
        self.spelling = np.concatenate((self.spelling, spellings))[at]
        if len(self.hash) > 4 * self.size:
            self.cut()

    def cut(self) -> None:
        kept = np.lexsort((self.hash, -self.count))[: self.size]
        self.hash, self.count, self.spelling = self.hash[kept], self.count[kept], self.spelling[kept]

    def packed(self) -> bytes:
        self.cut()
        return pickle.dumps((self.hash, self.count, list(self.spelling)))


_SPACED = np.uint64(0x8F1BBCDCBFA53E0B)


def _summarise(texts: Iterator[pa.Array], size: int) -> bytes:
    """Heaviest runs of letters or digits, with the space before them, of all texts of a task."""
    seen = _Heaviest(size)
    for text in texts:
        found, counts, spellings = [], [], []
        for w in words(text, plain=True):
            raw = w.buffer
            # A word that begins a text has no space of its own before it.
            spaced = (w.start > w.offsets[w.row]) & (raw[w.start - 1] == 0x20) if len(w.start) else np.zeros(0, bool)
            value, at, n = np.unique(np.where(spaced, w.hash ^ _SPACED, w.hash), return_index=True, return_counts=True)
            low = w.start[at] - spaced[at]
            short = w.end[at] - low <= LONGEST
            data = raw.tobytes()
            found.append(value[short])
            counts.append(n[short])
            spellings += [data[a:b] for a, b in zip(low[short].tolist(), w.end[at][short].tolist(), strict=True)]
        if found:
            seen.add(np.concatenate(found), np.concatenate(counts), np.array(spellings, object))
    return seen.packed()


def _merged(summaries: Iterable[bytes], size: int) -> _Heaviest:
    total = _Heaviest(size)
    for blob in summaries:
        hashes, counts, spellings = pickle.loads(blob)
        total.add(hashes, counts, np.array(spellings, object))
    return total


def frequent_pretokens(docs: DataFrame, text: str = "text", size: int = FREQUENT) -> list[str]:
    """The heaviest word pre-tokens of all texts, ``size`` of them at most."""
    shape = "task long, summary binary"
    schema = pa.schema([("task", pa.int64()), ("summary", pa.binary())])

    def summarise(batches):
        summary = _summarise((b.column(0) for b in batches), size)
        yield batch(schema, [TaskContext.get().partitionId()], [summary])

    def merge(key, rows):
        return rows.head(1).assign(summary=_merged(rows.summary, size).packed())

    level = stored(docs.select(F.col(text).cast("string").alias("text")).mapInArrow(summarise, shape), "pretokens")
    while level.count() > FAN_IN:
        level = level.withColumn("task", F.floor(F.col("task") / FAN_IN))
        level = stored(level.groupBy("task").applyInPandas(merge, shape), "pretokens")
    total = _merged([r.summary for r in level.collect()], size)
    total.cut()
    return [x.decode() for x in total.spelling]


class _Cache(dict):
    """Pre-token to token count; what is missing is encoded and kept."""

    def __init__(self, path: str, frequent: dict[str, int]):
        super().__init__(frequent)
        self.most, self.encode = len(frequent) + CACHE, tokenizer(path)
        self.model, self.split = self.encode.model, self.encode.pre_tokenizer.pre_tokenize_str

    def __missing__(self, piece: str) -> int:
        n = len(merged_ids(self.model, piece))
        if len(piece) <= LONGEST and len(self) < self.most:
            self[piece] = n
        return n


_CACHES: dict = {}


def _count(text: str, cache: _Cache, special: re.Pattern) -> int:
    if special.search(text):
        return len(cache.encode.encode(text, add_special_tokens=False).ids)
    get = cache.__getitem__
    if _UNSAFE.search(text):
        return sum(get(text[a:b]) for _, (a, b) in cache.split(text))
    return sum(sum(map(get, some)) for some in pieces(text))


def _is_pretoken(encode: Tokenizer, piece: str) -> bool:
    return len(encode.pre_tokenizer.pre_tokenize_str(piece)) == 1 if _UNSAFE.search(piece) else _SPLIT.fullmatch(piece) is not None


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """``key``, UTF-8 length ``n_bytes`` and ``n_tokens`` of every row's whole text."""
    spark = docs.sparkSession
    prepare(spark)
    path = path or public_tokenizers.path(TOKENIZER)
    special = special_strings(path)
    encode = tokenizer(path)
    top = [p for p in frequent_pretokens(docs, text, frequent) if _is_pretoken(encode, p)]
    shared = spark.sparkContext.broadcast({p: len(merged_ids(encode.model, p)) for p in top})
    name = uuid.uuid4().hex

    def run(batches):
        cache = _CACHES.get(name)
        if cache is None:
            _CACHES.clear()
            cache = _CACHES[name] = _Cache(path, shared.value)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
            counts = pa.array([_count(t, cache, special) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), sizes, counts], names=[key, "n_bytes", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string").alias("text")).mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_tokens long")
