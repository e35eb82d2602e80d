"""Toxicity and quality: the segment scan against its definition, held-out accuracy, edge rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import EDGE, edge_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.llm import labelled, quality, toxicity


def by_definition(w, low=0, high=None):
    """The best segment, then the same on its left and on its right."""
    high = len(w) if high is None else high
    best = max(((sum(w[i:j]), -i, -j) for i in range(low, high) for j in range(i + 1, high + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    i, j = -best[1], -best[2]
    return [*by_definition(w, low, i), (i, j, best[0]), *by_definition(w, j, high)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([-5, -3, -2, -1, 1, 2, 4]), max_size=14))
def test_segments(values):
    w = np.array([v + np.sqrt(i + 2) / 1000 for i, v in enumerate(values)])  # no two sums are equal
    assert [(s, e, round(x, 6)) for s, e, x in toxicity.segments(w)] == [(s, e, round(x, 6)) for s, e, x in by_definition(list(w))]


def corpus(n=900, seed=3):
    """Texts over shared words; toxic ones hold a passage of marked words, bad ones repeat themselves."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 150))]
        toxic, good = int(rng.random() < 0.2), int(rng.random() < 0.7)
        if toxic:
            for _ in range(rng.randint(2, 5)):
                text.insert(rng.randrange(len(text)), f"vile{rng.randint(0, 9)}!")
        if not good:
            text = [w + "%%" for w in text] if rng.random() < 0.5 else text[:3] * 20
        docs.append((i, " ".join(text)))
        labels.append((i, good, toxic))
    return docs, labels


def scored(spark, operator, column):
    docs, labels = corpus()
    frame = edge_docs(spark, docs + [(i + 5000 if i is not None else None, t) for i, t in EDGE])
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None), (10_000, 1, 1)], "doc_id long, quality int, toxic int")
    rows = operator(frame, marks).collect()
    assert len(rows) == len(docs) + len(EDGE) and all(0 <= r.score <= 1 for r in rows)
    truth = {i: (q, t) for i, q, t in labels}
    held = [(r.score, truth[r.doc_id][column]) for r in rows if r.doc_id in truth and r.held_out]
    return rows, held


def test_toxicity(spark):
    rows, held = scored(spark, toxicity.toxic_scores, 1)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([(s >= 0.7) == t for s, t in held]) > 0.95
    assert all(r.score < 0.7 for r in rows if r.doc_id is None or r.doc_id >= 5000)
    marked = [r for r in rows if r.score >= 0.7]
    assert marked and all(r.passages for r in marked)


def test_counts_beyond_32_bits(spark, monkeypatch):
    few, many = np.array([3, 0, 5]), np.array([2**31 + 7, 2**33, 9])
    assert np.isfinite(toxicity.weights_of(few, few[::-1], many)).all()
    docs, labels = corpus()
    frame = edge_docs(spark, docs)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    counts = toxicity._counts
    monkeypatch.setattr(toxicity, "_counts", lambda *a: counts(*a).withColumn("n", F.col("n") * (2**31 + 1)))
    model = toxicity.fit(frame, marks, F.lit(True))
    assert np.isfinite(model.weight).all() and np.isfinite([model.place, model.slope, model.spread, model.bias, *model.gain]).all()
    truth = {i: t for i, _, t in labels}
    rows = toxicity.score(frame, model).collect()
    assert np.mean([(r.score >= 0.7) == truth[r.doc_id] for r in rows]) > 0.95


def test_a_passage_that_comes_again_is_listed_again(spark):
    """Toxic, clean, toxic: both passages are found, each with the weight that one alone has."""
    docs, labels = corpus()
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), F.lit(True))
    rng = random.Random(1)
    clean = [t.split() for (i, t), (_, _, toxic) in zip(docs, labels, strict=True) if not toxic]
    for n in range(20):
        between = [w for t in rng.sample(clean, 12) for w in t][: 4 * toxicity.STRETCH]
        passage = [f"vile{(n + k) % 10}!" for k in range(5)]
        texts = [" ".join(passage + between), " ".join(passage + between + passage)]
        scores, passages = toxicity._scored(pa.array(texts), model)
        assert len(passages[0]) == 1 and len(passages[1]) == 2 and scores[1] >= scores[0] >= 0.7
        assert passages[1][1]["z"] == pytest.approx(passages[1][0]["z"], abs=1.0)


def test_quality(spark):
    rows, held = scored(spark, quality.quality_scores, 0)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([(s >= 0.7) == t for s, t in held]) > 0.95


def test_held_out_labels_are_not_learnt_from(spark):
    docs, labels = corpus(300)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    flipped = [(i, 1 - q, 1 - t) if zlib.crc32(str(i).encode()) % 3 == 1 else (i, q, t) for i, q, t in labels]
    one, two = (
        {r.doc_id: r.score for r in toxicity.toxic_scores(frame, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()} for x in (labels, flipped)
    )
    assert one == two


def test_sample_is_bounded_and_repeatable(spark):
    marks = spark.createDataFrame([(i, i % 2) for i in range(500)] + [(7, 1), (8, 1), (9, None)], "doc_id long, toxic int")
    some = labelled.sample(marks, "toxic", F.lit(True), rows=100).collect()
    assert len(some) == 100 and sorted(some) == sorted(labelled.sample(marks.repartition(5), "toxic", F.lit(True), rows=100).collect())
    every = {r.id: r.label for r in labelled.sample(marks, "toxic", F.lit(True)).collect()}
    assert every[7] == 1 and 8 not in every and every[9] == 1


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.toxic_scores(edge_docs(spark), none).collect()} == {0.0}
    assert {r.score for r in quality.quality_scores(edge_docs(spark), none).collect()} == {0.5}
    marks = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.toxic_scores(edge_docs(spark, []), marks).collect() == [] == quality.quality_scores(edge_docs(spark, []), marks).collect()


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:2000], y[:2000])
    assert ((model.scores(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9 and (0 in model.pairs[0][:2] and 1 in model.pairs[0][:2])
