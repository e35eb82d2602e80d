"""Quality scores from a generalised additive model with pairwise interactions.

Every text becomes a row of numeric features (shares of character classes, word lengths, repetition, line
shape), each cut into bins at quantiles of the labelled sample. Boosting goes round the features: a
shallow tree on one feature's gradient histogram adds its leaves to that feature's lookup table. Then
the feature pairs with the strongest remaining interaction get two-way tables, boosted round in the
same way. A score is a sum of table cells, found for a whole batch by a few vectorised additions.

Null, empty and wordless texts have features too (all shares 0) and are scored like others. Repeated rows
are scored alike; other columns are not looked at. Without labelled rows of both classes every score
is the share of class 1 seen, or 0.5. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import labelled
from ledgerlake.llm.common import prepare, words

BINS = 32
PAIR_BINS = 8
ROUNDS = 120
PAIR_ROUNDS = 40
PAIRS = 10
RATE = 0.15
LEAST_WEIGHT = 2.0

_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_LOWER = np.array([97 <= b <= 122 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_HIGH = np.array([b >= 128 for b in range(256)])
_STOP = np.array([chr(b) in ".,;:" for b in range(256)])
_LOUD = np.array([chr(b) in "!?" for b in range(256)])
_MARK = np.array([33 <= b <= 126 and not chr(b).isalnum() and chr(b) not in ".,;:!?'\"-()" for b in range(256)])
_LINE = np.array([b == 10 for b in range(256)])
_CLASSES = (_UPPER, _LOWER, _DIGIT, _SPACE, _HIGH, _STOP, _LOUD, _MARK, _LINE)

FEATURES = (
    "log_words", "log_bytes", "bytes_per_word", "word_spread", "longest_word", "upper", "lower", "digit", "space", "high",
    "stop", "loud", "mark", "line", "distinct", "repeated_next", "repeated_second", "commonest", "marked_words", "short_words",
    "capital_words", "same_pairs", "bare_marks",
)


def _per_row(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive edges."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[edges[1:]] - total[edges[:-1]]


def _distinct(row: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, and how often the commonest one occurs."""
    distinct, most = np.zeros(rows), np.zeros(rows)
    if len(value):
        order = np.lexsort((value, row))
        r, v = row[order], value[order]
        new = np.concatenate(([True], (r[1:] != r[:-1]) | (v[1:] != v[:-1])))
        at = np.flatnonzero(new)
        distinct = np.bincount(r[at], minlength=rows).astype(float)
        np.maximum.at(most, r[at], np.diff(np.append(at, len(r))))
    return distinct, most


def features(text: pa.Array) -> np.ndarray:
    """One row of :data:`FEATURES` for each text."""
    out = [np.zeros((0, len(FEATURES)))]
    for w in words(text):
        raw, n = w.buffer, np.diff(w.begin).astype(float)
        size = np.diff(w.offsets).astype(float)
        some, bytes_ = np.maximum(n, 1), np.maximum(size, 1)
        shares = [_per_row(c[raw], w.offsets) / bytes_ for c in _CLASSES]
        length = (w.end - w.start).astype(float)
        mean = _per_row(length, w.begin) / some
        spread = np.sqrt(np.maximum(_per_row(length**2, w.begin) / some - mean**2, 0))
        longest = np.zeros(w.rows)
        np.maximum.at(longest, w.row, length)
        same = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1]) if len(w.hash) else np.zeros(0, bool)
        second = (w.hash[2:] == w.hash[:-2]) & (w.row[2:] == w.row[:-2]) if len(w.hash) > 1 else np.zeros(0, bool)
        distinct, most = _distinct(w.row, w.hash, w.rows)
        pair = w.hash[:-1] * np.uint64(3) + w.hash[1:] if len(w.hash) else w.hash
        inside = w.row[1:] == w.row[:-1] if len(w.hash) else np.zeros(0, bool)
        pairs, _ = _distinct(w.row[:-1][inside], pair[inside], w.rows)
        marks = np.concatenate(([0], np.cumsum(_MARK[raw] | _LOUD[raw])))
        marked = marks[w.end] - marks[w.start]
        capital = _UPPER[raw[w.start]] if len(w.start) else np.zeros(0, bool)
        count = lambda x: np.bincount(w.row[: len(x)][x], minlength=w.rows) / some  # noqa: E731, B023
        out.append(
            np.column_stack([
                np.log1p(n), np.log1p(size), mean, spread, np.log1p(longest), *shares, distinct / some, count(same), count(second),
                most / some, count(marked >= 2), count(length <= 3), count(capital), pairs / some, count((marked > 0) & (marked == length)),
            ])
        )
    return np.concatenate(out)


@dataclass
class Model:
    """Bin edges by feature, one table by feature, two-way tables by pair, and the constant."""

    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    constant: float = 0.0

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.constant)
        for j, table in enumerate(self.tables):
            total += table[_binned(self.edges[j], x[:, j])]
        for a, b, table in self.pairs:
            total += table[_binned(self.coarse[a], x[:, a]), _binned(self.coarse[b], x[:, b])]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def _binned(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges, values, side="right")


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Upper borders between bins: quantiles, each half way to the next value."""
    known = np.unique(values)
    if len(known) <= bins:
        return (known[1:] + known[:-1]) / 2
    at = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))
    return at


def _leaves(gradient: np.ndarray, weight: np.ndarray, depth: int) -> np.ndarray:
    """A regression tree on ordered bins: the step of every bin."""
    out = np.empty(len(gradient))

    def grow(low: int, high: int, left: int) -> None:
        g, h = gradient[low:high].sum(), weight[low:high].sum()
        if left and high - low > 1:
            gs, hs = np.cumsum(gradient[low : high - 1]), np.cumsum(weight[low : high - 1])
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1)
            gain[(hs < LEAST_WEIGHT) | (h - hs < LEAST_WEIGHT)] = -1
            cut = int(gain.argmax())
            if gain[cut] > g**2 / (h + 1) + 1e-9:
                grow(low, low + cut + 1, left - 1)
                grow(low + cut + 1, high, left - 1)
                return
        out[low:high] = g / (h + 1)

    grow(0, len(gradient), depth)
    return out


def _plane(gradient: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Best split of a two-way histogram by one border on each side: steps of the cells, and the gain."""
    def corners(m):
        return np.pad(m.cumsum(0).cumsum(1), ((1, 0), (1, 0)))

    g, h = corners(gradient), corners(weight)
    best, step = 0.0, np.zeros_like(gradient)
    base = g[-1, -1] ** 2 / (h[-1, -1] + 1)
    a, b = gradient.shape
    gi, hi = g[1:a, 1:b], h[1:a, 1:b]
    top, wide = g[1:a, b][:, None], g[a, 1:b][None, :]
    htop, hwide = h[1:a, b][:, None], h[a, 1:b][None, :]
    parts = [(gi, hi), (top - gi, htop - hi), (wide - gi, hwide - hi), (g[a, b] - top - wide + gi, h[a, b] - htop - hwide + hi)]
    if gi.size:
        gain = sum(x**2 / (y + 1) for x, y in parts) - base
        i, j = np.unravel_index(int(gain.argmax()), gain.shape)
        best = float(gain[i, j])
        step[: i + 1, : j + 1], step[: i + 1, j + 1 :], step[i + 1 :, : j + 1], step[i + 1 :, j + 1 :] = (x[i, j] / (y[i, j] + 1) for x, y in parts)
    return step, best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of single features, then of the pairs with the strongest interaction."""
    model = Model()
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        model.constant = float(np.log(share / (1 - share)))
        return model
    k = x.shape[1]
    model.edges = [_edges(x[:, j], BINS) for j in range(k)]
    model.coarse = [_edges(x[:, j], PAIR_BINS) for j in range(k)]
    model.constant = float(np.log(y.mean() / (1 - y.mean())))
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [_binned(model.edges[j], x[:, j]) for j in range(k)]
    margin = np.full(len(y), model.constant)

    def slopes():
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(k):
            size = len(model.tables[j])
            if size > 1:
                g, h = slopes()
                step = RATE * _leaves(np.bincount(bins[j], g, size), np.bincount(bins[j], h, size), 2)
                model.tables[j] += step
                margin += step[bins[j]]
    coarse = [_binned(model.coarse[j], x[:, j]) for j in range(k)]

    def cells(a, b, values):
        shape = (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)
        return np.bincount(coarse[a] * shape[1] + coarse[b], values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    gains = sorted(((-_plane(cells(a, b, g), cells(a, b, h))[1], a, b) for a in range(k) for b in range(a)))
    model.pairs = [(a, b, np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1))) for gain, a, b in gains[:PAIRS] if gain < -1e-6]
    for _ in range(PAIR_ROUNDS):
        for a, b, table in model.pairs:
            g, h = slopes()
            step = RATE * _plane(cells(a, b, g), cells(a, b, h))[0]
            table += step
            margin += step[coarse[a], coarse[b]]
    return model


def _feature_rows(texts: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            x = features(b.column(0))
            yield pa.RecordBatch.from_arrays([b.column(1).cast(pa.int32()), pa.array(list(x), pa.list_(pa.float64()))], names=["label", "x"])

    return texts.mapInArrow(run, "label int, x array<double>")


def fit_labelled(docs: DataFrame, labels: DataFrame, learnable: Column, label: str = "quality", key: str = "doc_id", text: str = "text", rows: int = labelled.SAMPLE) -> Model:
    """A model from the features of at most ``rows`` labelled texts that ``learnable`` admits."""
    prepare(docs.sparkSession)
    chosen = labelled.sample(labels, label, learnable, key, rows)
    seen = _feature_rows(labelled.labelled_texts(docs, chosen, key, text)).toArrow()
    x = np.array(seen["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    y = np.asarray(seen["label"], float)
    # The order of the rows must not matter for the last bit of a sum.
    order = np.lexsort((*x.T, y))
    return fit(x[order], y[order])


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``score`` of every whole text."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.scores(features(b.column(1))), pa.float64())], names=[key, "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string").alias("text")).mapInArrow(run, f"`{key}` {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2, rows: int = labelled.SAMPLE) -> DataFrame:
    """``doc_id, held_out, score``; labels of held-out ids are not learnt from."""
    fold = labelled.remainder(F.col("doc_id"), modulus)
    model = fit_labelled(docs, labels, fold != held, rows=rows)
    return score(docs, model).withColumn("held_out", F.coalesce(fold == held, F.lit(False)))
