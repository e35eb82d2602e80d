"""Language of texts and of the spans in them: scripts, per-word scores, Viterbi with a switching penalty.

A word is a maximal run of letters and marks of one script. Its letters' script narrows the languages to those that
use the script in what was learnt (all, with equal scores, where none does). Its score for a language is the log
rate of its letter triples (with its ends) and of the word as a whole, against the language's words; the best
language has 0 and the others at least ``-CLIP``, so a single word cannot force a change. The best path over the
words, where each change of language costs ``SWITCH``, labels every word; neighbours of one language are a span.
A text's language holds most letters of its spans (of equal ones, the first by name), its score is the share of them.

The rates come from all learnable texts: counts of hashed triples and words by language, summed by Spark, in tables of
a fixed number of buckets. Only these tables reach the driver, 2 * BUCKETS + scripts rows a language at most; more
than ``MOST`` different languages are refused with an error.

Null texts and those without a letter are ``und`` with score 0 and no spans; so is every text where nothing could
be learnt. Texts are read whole; memory grows with the longest one. Rows are independent, so repeated ids have
each their own result; a row without an id is labelled, but neither learnt from nor held out. An empty table gives an
empty result; other columns than id, text and language are not looked at.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import mix, prepare, text_buffer
from ledgerlake.llm.labelled import remainder

UNKNOWN = "und"
BUCKETS = 1 << 16
MOST = 128
#: Cost of a change of language, and the most that one word speaks against a language.
SWITCH = 6.0
CLIP = 4.0
#: Weight of the letter triples' and of the whole word's log rate.
TRIPLES, WHOLE = 0.5, 0.5
#: Pseudo-count of a bucket, in a language of mean size.
PSEUDO = 1.0
#: Share of a language's letters that makes a script one of its scripts.
USED = 0.01
EXCLUDED = 1000.0
BLOCK_BYTES = 1 << 20

# First and last code points of scripts (Unicode blocks of letters).
SCRIPTS = {
    "Latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "Devanagari": [(0x900, 0x97F)],
    "Bengali": [(0x980, 0x9FF)],
    "Gurmukhi": [(0xA00, 0xA7F)],
    "Gujarati": [(0xA80, 0xAFF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Telugu": [(0xC00, 0xC7F)],
    "Kannada": [(0xC80, 0xCFF)],
    "Malayalam": [(0xD00, 0xD7F)],
    "Thai": [(0xE00, 0xE7F)],
    "Georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "Ethiopic": [(0x1200, 0x137F)],
    "Kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
N_SCRIPTS = len(SCRIPTS) + 1  # 0: any other


@functools.cache
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every code point: 1 for letters and 2 for marks, its script, its lower case."""
    kind, lower = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        category = unicodedata.category(chr(c))
        if category[0] in "LM":
            kind[c] = 1 if category[0] == "L" else 2
            if category in ("Lu", "Lt") and len(small := chr(c).lower()) == 1:
                lower[c] = ord(small)
    script = np.zeros(0x110000, np.uint8)
    for i, ranges in enumerate(SCRIPTS.values(), start=1):
        for first, last in ranges:
            script[first : last + 1] = i
    return kind, np.where(kind > 0, script, 0).astype(np.uint8), lower


@dataclass
class Spelled:
    """Words of the rows ``first .. first+rows-1`` of a batch; places are code points from the row's start."""

    first: int
    rows: int
    begin: np.ndarray  # index of each row's first word, rows + 1 of them
    start: np.ndarray
    end: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    whole: np.ndarray  # bucket of the word
    triples: np.ndarray  # buckets of the triples of all words, one for each character
    of: np.ndarray  # word of each triple
    first_triple: np.ndarray


def spelled(text: pa.Array, block: int = BLOCK_BYTES) -> Iterator[Spelled]:
    """The words of a string column, in blocks of whole texts."""
    kind, scripts, lower = _characters()
    data, offsets = text_buffer(text)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = min(n, max(first + 1, int(np.searchsorted(offsets, offsets[first] + block, side="right")) - 1))
        raw = data[offsets[first] : offsets[last]]
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        before = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        own = before[offsets[first : last + 1] - offsets[first]]
        yield _spelled(first, last - first, points, own, kind, scripts, lower)
        first = last


def _spelled(first: int, rows: int, points: np.ndarray, own: np.ndarray, kind: np.ndarray, scripts: np.ndarray, lower: np.ndarray) -> Spelled:
    what, script = kind[points], scripts[points]
    at = np.flatnonzero(what)
    row = np.searchsorted(own, at, side="right") - 1
    what, script = what[at], script[at]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1]) | ((script[1:] != script[:-1]) & (script[1:] > 0) & (script[:-1] > 0))
    start = np.flatnonzero(new)
    if len(start):
        # Runs of marks alone are no words.
        real = np.add.reduceat((what == 1).astype(np.int64), start) > 0
        inside = np.repeat(real, np.diff(np.append(start, len(at))))
        at, row, what, script, new = at[inside], row[inside], what[inside], script[inside], new[inside]
        start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(at)))
    of = np.repeat(np.arange(len(start)), size)
    c = lower[points[at]].astype(np.uint64)
    edge = np.append(new, True)
    previous = np.where(new, np.uint64(0), np.concatenate((c[:1], c[:-1])))
    following = np.where(edge[1:], np.uint64(0), np.concatenate((c[1:], c[:1])))
    triples = mix(c | (previous << np.uint64(21)) | (following << np.uint64(42)))
    place = (np.arange(len(at)) - start[of]).astype(np.uint64) if len(start) else np.zeros(0, np.uint64)
    spelt = mix((c << np.uint64(32)) + place + np.uint64(1))
    whole = mix(np.add.reduceat(spelt, start)) if len(start) else np.zeros(0, np.uint64)
    modulus = np.uint64(BUCKETS - 1)
    begin = np.searchsorted(row[start], np.arange(rows + 1))
    shift = own[row[start]]
    return Spelled(
        first, rows, begin, at[start] - shift, (at[start + size - 1] + 1 if len(start) else at[:0]) - shift,
        np.add.reduceat((what == 1).astype(np.int64), start) if len(start) else np.zeros(0, np.int64),
        np.maximum.reduceat(script, start) if len(start) else np.zeros(0, np.uint8),
        (whole & modulus).astype(np.int64) + BUCKETS, (triples & modulus).astype(np.int64), of, start,
    )


@dataclass
class Model:
    languages: list[str]
    rates: np.ndarray  # (2 * BUCKETS, languages): log rates
    allowed: np.ndarray  # (scripts, languages): candidates of a script
    prior: np.ndarray

    def scores(self, s: Spelled) -> np.ndarray:
        """Score of each word for each language: 0 for the best, at least -CLIP for other candidates."""
        known = self.allowed.any(axis=1)
        if not len(s.whole):
            return np.zeros((0, len(self.languages)), np.float32)
        candidate = (self.allowed | ~known[:, None])[s.script]
        out = WHOLE * self.rates[s.whole] + TRIPLES * np.add.reduceat(self.rates[s.triples], s.first_triple, axis=0)
        out = np.where(candidate, out, -np.inf)
        out = np.maximum(out - out.max(axis=1, keepdims=True), -CLIP)
        return np.where(known[s.script][:, None], np.where(candidate, out, -EXCLUDED), 0).astype(np.float32)


def best_paths(scores: np.ndarray, begin: np.ndarray, prior: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of each word on the best path of its row; all rows advance together, word by word.

    Of equal paths the one that stays longer in a language, then the language first in order, is taken.
    """
    n = np.diff(begin)
    rows = np.argsort(-n, kind="stable")
    rows = rows[: int((n > 0).sum())]
    first, size = begin[:-1][rows], n[rows]
    out = np.zeros(len(scores), np.int64)
    if not len(rows):
        return out
    longest = int(size[0])
    active = np.searchsorted(-size, -np.arange(longest), side="left")  # rows with more than t words
    own = np.arange(scores.shape[1], dtype=np.int16)
    came = np.zeros(scores.shape, np.int16)
    value = scores[first].astype(np.float64) + prior
    for t in range(1, longest):
        a = active[t]
        now, at = value[:a], first[:a] + t
        best = now.argmax(axis=1)
        moved = now[np.arange(a), best][:, None] - switch
        stays = now >= moved
        came[at] = np.where(stays, own, best[:, None])
        value[:a] = np.where(stays, now, moved) + scores[at]
    state = value.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        a = active[t]
        at = first[:a] + t
        out[at] = state[:a]
        state[:a] = came[at, state[:a]]
    return out


def _counts(docs: DataFrame, languages: list[str], text: str, language: str) -> DataFrame:
    """``slot, lang, n``: uses of every bucket and letters of every script, by the number of the language."""
    schema = pa.schema([("slot", pa.int32()), ("lang", pa.int32()), ("n", pa.int64())])
    slots, width = 2 * BUCKETS + N_SCRIPTS, len(languages)
    number = {name: i for i, name in enumerate(languages)}

    def run(batches):
        total = np.zeros(slots * width, np.int64)
        for b in batches:
            lang = np.array([number[x] for x in b.column(1).to_pylist()], np.int64)
            for s in spelled(b.column(0)):
                of = np.repeat(lang[s.first : s.first + s.rows], np.diff(s.begin))
                total += np.bincount(np.concatenate([s.triples * width + of[s.of], s.whole * width + of]), minlength=slots * width)
                total += np.bincount((2 * BUCKETS + s.script.astype(np.int64)) * width + of, weights=s.letters, minlength=slots * width).astype(np.int64)
        used = np.flatnonzero(total)
        for low in range(0, len(used), 1 << 16):
            some = used[low : low + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some // width, pa.int32()), pa.array(some % width, pa.int32()), pa.array(total[some])], schema=schema)

    rows = docs.select(F.col(text).cast("string"), F.col(language).cast("string")).mapInArrow(run, "slot int, lang int, n long")
    return rows.groupBy("slot", "lang").agg(F.sum("n").alias("n"))


def model_of(languages: list[str], counts: np.ndarray, texts: np.ndarray) -> Model:
    """Rates from counts (slot, language); languages without a letter in their texts are left out."""
    letters = counts[2 * BUCKETS :]
    has = letters.sum(axis=0) > 0
    languages, counts, letters, texts = [x for x, h in zip(languages, has, strict=True) if h], counts[:, has], letters[:, has], texts[has]
    if not languages:
        return Model([], np.zeros((2 * BUCKETS, 0), np.float32), np.zeros((N_SCRIPTS, 0), bool), np.zeros(0))
    rates = np.empty((2 * BUCKETS, len(languages)), np.float32)
    for part in (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
        size = counts[part].sum(axis=0, dtype=np.float64)
        rates[part] = np.log(counts[part] / size + PSEUDO / size.mean())
    allowed = letters >= USED * letters.sum(axis=0)
    allowed[0] = False  # letters of no listed script narrow nothing
    return Model(languages, rates, allowed, np.log((texts + 1.0) / (texts.sum() + len(texts))))


def fit(docs: DataFrame, learnable: Column, text: str = "text", language: str = "lang") -> Model:
    """A model of the languages of the rows that ``learnable`` admits; rows without text or language are left out."""
    prepare(docs.sparkSession)
    known = docs.filter(learnable & F.col(text).isNotNull() & F.col(language).isNotNull())
    found = known.groupBy(F.col(language).cast("string").alias("name")).agg(F.count("*").alias("n")).limit(MOST + 1).collect()
    if len(found) > MOST:
        raise ValueError(f"more than {MOST} languages")
    found.sort(key=lambda r: r["name"])
    languages = [r["name"] for r in found]
    counts = np.zeros((2 * BUCKETS + N_SCRIPTS, len(languages)), np.int64)
    if languages:
        rows = _counts(known, languages, text, language).toArrow()
        counts[np.asarray(rows["slot"]), np.asarray(rows["lang"])] = np.asarray(rows["n"])
    return model_of(languages, counts, np.array([r["n"] for r in found], float))


SPANS = "array<struct<start: int, end: int, lang: string>>"


def _labelled(text: pa.Array, model: Model) -> list[pa.Array]:
    """Language, score and spans of some texts."""
    names = pa.array(model.languages, pa.string())
    langs, shares, sizes, parts = [], [], [], []
    for s in spelled(text, max(1 << 16, 4 * BLOCK_BYTES // max(4, len(model.languages)))):
        if not model.languages:
            langs += [UNKNOWN] * s.rows
            shares.append(np.zeros(s.rows))
            sizes.append(np.zeros(s.rows, np.int64))
            continue
        path = best_paths(model.scores(s), s.begin, model.prior)
        row = np.repeat(np.arange(s.rows), np.diff(s.begin))
        width = len(model.languages)
        held = np.bincount(row * width + path, weights=s.letters, minlength=s.rows * width).reshape(s.rows, width)
        total, best = held.sum(axis=1), held.argmax(axis=1)
        langs += [model.languages[b] if t else UNKNOWN for b, t in zip(best, total, strict=True)]
        shares.append(held.max(axis=1) / np.maximum(total, 1))
        new = np.ones(len(path), bool)
        new[1:] = (path[1:] != path[:-1]) | (row[1:] != row[:-1])
        start = np.flatnonzero(new)
        sizes.append(np.bincount(row[start], minlength=s.rows))
        last = np.append(start[1:], len(path))[: len(start)] - 1
        parts.append((s.start[start], s.end[last], path[start]))
    begin, end, lang = (np.concatenate([p[i] for p in parts] or [np.zeros(0, np.int64)]) for i in range(3))
    structs = pa.StructArray.from_arrays([pa.array(begin, pa.int32()), pa.array(end, pa.int32()), names.take(pa.array(lang))], names=["start", "end", "lang"])
    offsets = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))) if sizes else np.zeros(1, np.int64)
    return [pa.array(langs, pa.string()), pa.array(np.concatenate(shares) if shares else [], pa.float64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)]


def label(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score, spans`` of every whole text; a span's places are code points."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), *_labelled(b.column(1), shared.value)], names=[key, "lang_pred", "score", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string").alias("text")).mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double, spans {SPANS}")


def languages(docs: DataFrame, modulus: int = 3, held: int = 1, key: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, spans``; held-out ids and rows without an id are not learnt from."""
    fold = remainder(F.col(key), modulus)
    return label(docs, fit(docs, fold != held), key).withColumn("held_out", F.coalesce(fold == held, F.lit(False)))
