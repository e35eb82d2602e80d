"""Toxic passages as maximum-scoring segments of token log-odds.

Model. Words, and word beginnings, are hashed to a fixed number of buckets. A bucket's weight is the
log-odds of toxic over clean labelled text under an informative Dirichlet prior: the word counts of
*all* documents, worth a share of each class. Weights that the counts don't support
(in standard errors) shrink towards zero, and every word pays a small drift, so clean text scores below
zero on average. A word that the labelled texts hardly show has the weight of its beginning.

Scoring. One scan in linear time finds every maximal segment of a text, that is, every passage whose
score no prefix or suffix lowers. Under the clean model, scores of best segments follow an
extreme-value law whose place grows with the logarithm of the length; its two parameters are
estimated on clean labelled texts. A text's evidence is the sum of its significant segments, calibrated the
same way, and a logistic curve turns it into a score. Law and curve are fitted on the labelled sample in
two halves, each scored by weights learnt from the other, so they know how unseen texts score.

Null, empty and wordless texts have no segment and get the score of no evidence. Repeated rows are scored
alike; other columns are not looked at. Without labelled rows of both classes the score is 0 for
every text. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import labelled
from ledgerlake.llm.common import Words, batch, mix, prepare, words

#: Buckets of hashed words, and as many of word beginnings; the broadcast table has 4 bytes for each.
BUCKETS = 1 << 20
#: Bytes of a word's beginning.
BEGINNING = 4
#: Worth of the prior, as a share of a class.
PRIOR = 0.1
#: Occurrences in labelled texts from which a word has a weight of its own.
SHOWN = 3
#: The cost of each word of a segment.
DRIFT = 0.3
#: Standard errors a weight must stand from zero to count in full.
SUPPORT = 3.0
#: Words of the stretches in which a word that is used again counts less.
STRETCH = 256
#: Standardised score of a text without any segment.
LOWEST = -5.0
#: A segment is significant if as good a one is expected in fewer clean texts than this.
SIGNIFICANCE = 0.05


def _buckets(text: pa.Array) -> Iterator[tuple[Words, np.ndarray, np.ndarray]]:
    """Word tables with the buckets of the words and of their beginnings."""
    folded = pc.utf8_lower(text.fill_null("") if text.null_count else text)
    for w in words(folded, plain=True):
        begin = np.zeros(len(w.start), np.uint64)
        for i in range(BEGINNING):
            inside = w.start + i < w.end
            begin = begin << np.uint64(8) | np.where(inside, w.buffer[np.minimum(w.start + i, len(w.buffer) - 1)], 0).astype(np.uint64)
        yield w, (w.hash >> np.uint64(44)).astype(np.int64), BUCKETS + (mix(begin) >> np.uint64(44)).astype(np.int64)


@dataclass
class Model:
    """Weights by bucket, the extreme-value law of clean texts, and the curve from evidence to score."""

    weight: np.ndarray
    shown: np.ndarray
    place: float = 0.0
    slope: float = 1.0
    spread: float = 1.0
    bias: float = 0.0
    gain: tuple[float, float] = (0.0, 0.0)
    known: bool = False

    def weights(self, w: Words, word: np.ndarray, beginning: np.ndarray) -> np.ndarray:
        """Weights of the words of some texts; a word's n-th use in a stretch of a text counts n * n times less."""
        weights = self.weight[np.where(self.shown[word], word, beginning)]
        at = np.flatnonzero(weights > 0)
        stretch = (at - w.begin[w.row[at]]) // STRETCH
        key = (w.row[at] * (stretch.max(initial=0) + 1) + stretch) * BUCKETS + word[at]
        order = np.argsort(key, kind="stable")
        first = np.searchsorted(key[order], key[order], side="left")
        weights[at[order]] /= (np.arange(len(at)) - first + 1) ** 2
        return weights


def segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in one scan.

    Runs of weights below zero matter only by their sum, so the scan goes over the positive words. A
    stack of candidates with the cumulative score before and after each one is kept: a new candidate
    is joined to the last one that began lower, unless a later one ended higher.
    """
    total = np.concatenate(([0.0], np.cumsum(weights)))
    stack: list[list] = []  # [start, end, total before, total after, place of the last lower start or -1]
    for i in np.flatnonzero(weights > 0).tolist():
        start, end, low, high = i, i + 1, float(total[i]), float(total[i + 1])
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                stack.append([start, end, low, high, j])
                break
            start, low = stack[j][0], stack[j][2]
            del stack[j:]
            j = len(stack) - 1
    return [(s, e, high - low) for s, e, low, high, _ in stack]


def _shift(model: Model, n: int) -> float:
    return model.place + model.slope * np.log(max(n, 1))


def tail(z: float) -> float:
    """Chance that the best segment of a clean text stands at ``z`` or higher."""
    return float(-np.expm1(-np.exp(-min(max(z, -30.0), 700.0))))


def evidence(found: list[tuple[int, int, float]], n: int, model: Model) -> tuple[float, float, list[tuple[int, int, float]]]:
    """(standardised best segment, standardised sum of significant ones, those segments) of a text of ``n`` words."""
    if not found:
        return LOWEST, 0.0, []
    shift = _shift(model, n)
    scored = [(s, e, (score - shift) / model.spread) for s, e, score in found]
    significant = [x for x in scored if tail(x[2]) <= SIGNIFICANCE]
    return max(LOWEST, max(x[2] for x in scored)), sum(x[2] for x in significant), significant


#: Columns of the counts: labelled texts by half and label, and all uses of a word.
_GROUPS = ("n00", "n01", "n10", "n11")


def _counts(docs: DataFrame, chosen: DataFrame, key: str, text: str) -> DataFrame:
    """``bucket``, labelled texts with the word by half of the sample and label, and its uses ``n`` in all documents."""
    schema = pa.schema([("bucket", pa.int32()), *((c, pa.int64()) for c in (*_GROUPS, "n"))])

    def run(batches):
        total = np.zeros((5, 2 * BUCKETS), np.int64)
        for b in batches:
            group = np.asarray(pc.add(pc.multiply(b.column(2), 2), b.column(1)).fill_null(4))
            for w, word, beginning in _buckets(b.column(0)):
                of = group[w.first + w.row]
                for bucket in (word, beginning):
                    np.add.at(total[4], bucket, 1)
                    for g in range(4):
                        own = of == g
                        if own.any():
                            # A text counts once for a word, however often it repeats it.
                            np.add.at(total[g], np.unique(w.row[own] * (2 * BUCKETS) + bucket[own]) % (2 * BUCKETS), 1)
        used = np.flatnonzero(total[4])
        for low in range(0, len(used), 1 << 16):
            some = used[low : low + (1 << 16)]
            yield batch(schema, some, *total[:, some])

    marked = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).join(F.broadcast(chosen), "id", "left")
    rows = marked.select("text", "label", "half").mapInArrow(run, "bucket int, " + ", ".join(f"{c} long" for c in (*_GROUPS, "n")))
    return rows.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in (*_GROUPS, "n")))


def weights_of(clean: np.ndarray, toxic: np.ndarray, every: np.ndarray) -> np.ndarray:
    """Log-odds with a Dirichlet prior in proportion to ``every``, shrunk by its standard error, less the drift.

    Each class gets the prior in proportion to its own size, so a word that neither shows weighs nothing.
    """
    share = (every + 0.5) / (every.sum() + 0.5 * len(every))
    p, q = (counts + PRIOR * counts.sum() * share + 1e-9 for counts in (toxic, clean))
    odds = np.log(p / (p.sum() - p)) - np.log(q / (q.sum() - q))
    support = np.abs(odds) / np.sqrt(1 / p + 1 / q)
    return (odds * np.minimum(1.0, (support / SUPPORT) ** 2) - DRIFT).astype(np.float32)


def _evidence_of(texts: DataFrame, shared) -> DataFrame:
    """``label, n, raw, best, total``: words, best segment's score, and evidence of every labelled text.

    Each text is scored by the model of the half that it is not in.
    """

    def run(batches):
        for b in batches:
            labels, half = b.column(1).to_pylist(), np.asarray(b.column(2))
            out = []
            for w, word, beginning in _buckets(b.column(0)):
                both = [m.weights(w, word, beginning) for m in shared.value]
                weights = np.where(half[w.first + w.row] == 0, both[1], both[0])
                for i in range(w.rows):
                    own = weights[w.of_row(i)]
                    found = segments(own)
                    best, total, _ = evidence(found, len(own), shared.value[0])
                    out.append((labels[w.first + i], len(own), max((x[2] for x in found), default=0.0), best, total))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 5, _EVIDENCE.types, strict=True)], schema=_EVIDENCE)

    return texts.mapInArrow(run, "label int, n long, raw double, best double, total double")


_EVIDENCE = pa.schema([("label", pa.int32()), ("n", pa.int64()), ("raw", pa.float64()), ("best", pa.float64()), ("total", pa.float64())])


def fit_law(n: np.ndarray, best: np.ndarray) -> tuple[float, float, float]:
    """Place, slope by log length, and spread of the extreme-value law of clean texts' best segments."""
    if len(n) < 20:
        return 1.0, 1.0, 1.0
    x = np.log(np.maximum(n, 1))
    slope = max(0.0, float(np.cov(x, best)[0, 1] / max(x.var(), 1e-9)))
    rest = best - slope * x
    spread = max(0.25, float(rest.std()) * np.sqrt(6) / np.pi)
    return float(rest.mean()) - np.euler_gamma * spread, slope, spread


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients of a logistic curve (constant first), lightly held towards zero; every step lowers the loss."""
    a = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(a.shape[1])
    hold = np.diag([1e-6] + [1e-2] * x.shape[1])

    def loss(b: np.ndarray) -> float:
        margin = a @ b
        return float(np.logaddexp(0, margin).sum() - y @ margin + b @ hold @ b / 2)

    now = loss(beta)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + hold, a.T @ (y - p) - hold @ beta)
        size = 1.0
        while size > 1e-6 and loss(beta + size * step) > now:
            size /= 2
        beta = beta + size * step
        before, now = now, loss(beta)
        if size <= 1e-6 or before - now < 1e-9 * max(1.0, abs(now)):
            break
    return beta


def _weighted(clean: np.ndarray, toxic: np.ndarray, every: np.ndarray) -> Model:
    halves = (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS))
    return Model(np.concatenate([weights_of(clean[h], toxic[h], every[h]) for h in halves]), clean + toxic >= SHOWN)


def _squeezed(best, total) -> np.ndarray:
    return np.column_stack([np.arcsinh(best), np.log1p(total)])


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, label: str = "toxic", key: str = "doc_id", text: str = "text", rows: int = labelled.SAMPLE) -> Model:
    """A model from a bounded sample of the labelled rows that ``learnable`` admits."""
    prepare(docs.sparkSession)
    chosen = labelled.sample(labels, label, learnable, key, rows)
    counts = _counts(docs, chosen, key, text).toArrow()  # at most 2 * BUCKETS rows
    n = np.zeros((5, 2 * BUCKETS), np.int64)  # a common word of a large corpus is used more than 2**31 times
    at = np.asarray(counts["bucket"])
    for i, c in enumerate((*_GROUPS, "n")):
        n[i, at] = np.asarray(counts[c])
    del counts, at
    pa.default_memory_pool().release_unused()
    model = _weighted(n[0] + n[2], n[1] + n[3], n[4])
    if not ((n[0] + n[2]).any() and (n[1] + n[3]).any()):
        return model
    # What the law and the curve are fitted on was scored by weights that had not seen it; first the law, then, by
    # that law, the evidence for the curve: all segments of a text count in both, as they do in scoring.
    texts = labelled.labelled_texts(docs, chosen, key, text)
    halves = [_weighted(n[0], n[1], n[4]), _weighted(n[2], n[3], n[4])]
    del n
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(halves)
    seen = _evidence_of(texts, shared).select("label", "n", "raw").toArrow()  # at most ``rows`` rows
    shared.destroy()
    y, size, top = (np.asarray(seen[c]) for c in ("label", "n", "raw"))
    clean = (y == 0) & (size > 0)
    law = fit_law(size[clean], top[clean])
    for m in (model, *halves):
        m.place, m.slope, m.spread = law
    shared = spark.sparkContext.broadcast(halves)
    seen = _evidence_of(texts, shared).select("label", "best", "total").toArrow()  # at most ``rows`` rows
    shared.destroy()
    curve = fit_curve(_squeezed(np.asarray(seen["best"]), np.asarray(seen["total"])), np.asarray(seen["label"]))
    model.bias, model.gain, model.known = float(curve[0]), (float(curve[1]), float(curve[2])), True
    return model


PASSAGES = "array<struct<start: int, end: int, z: double>>"
_PASSAGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("z", pa.float64())]))


def _scored(text: pa.Array, model: Model) -> tuple[np.ndarray, list[list[dict]]]:
    """Scores and significant passages of some texts."""
    xs, passages = [], []
    for w, word, beginning in _buckets(text):
        weights = model.weights(w, word, beginning)
        for i in range(w.rows):
            own = weights[w.of_row(i)]
            best, total, found = evidence(segments(own), len(own), model)
            xs.append((best, total))
            passages.append([{"start": s, "end": e, "z": z} for s, e, z in found])
    x = _squeezed(*np.array(xs, float).reshape(-1, 2).T)
    scores = 1 / (1 + np.exp(-np.clip(model.bias + x @ np.array(model.gain), -30, 30))) if model.known else np.zeros(len(x))
    return scores, passages


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``score`` and the significant ``passages`` (word ranges) of every whole text."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            scores, passages = _scored(b.column(1), shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(passages, _PASSAGES)], names=[key, "score", "passages"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string").alias("text")).mapInArrow(run, f"`{key}` {kind}, score double, passages {PASSAGES}")


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.7, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores below ``limit``."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(_scored(pa.array(texts, pa.string(), from_pandas=True), shared.value)[0])

    return docs.filter(scored(F.col(text).cast("string")) < limit)


def toxic_scores(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, rows: int = labelled.SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, passages``; labels of held-out ids are not learnt from."""
    fold = labelled.remainder(F.col("doc_id"), modulus)
    model = fit(docs, labels, fold != held, rows=rows)
    return score(docs, model).withColumn("held_out", F.coalesce(fold == held, F.lit(False)))
