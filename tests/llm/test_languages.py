"""Languages: the best path against all paths, learnt scripts, spans, accuracy on held-out texts."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import EDGE, edge_docs
from pyspark.sql import functions as F

from ledgerlake.llm import languages, queries

WORDS = {
    "en": "the thing with weather should rather this that which whither through".split(),
    "es": "ciudad niño corazón llamar quiero señor mañana ayer también razón".split(),
    "el": "και θάλασσα ουρανός γλώσσα λόγος καρδιά μήτηρ".split(),
    "ru": "это слово город сердце море язык небо".split(),
}


def text_of(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(i, text_of(rng, lang, rng.randrange(3, 40)), lang) for i, lang in enumerate(["en", "en", "es", "el", "ru"] * 40)]
    return languages.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))


def test_best_paths():
    rng = np.random.default_rng(3)
    sizes = [0, 1, 5, 3, 0, 6, 2]
    begin = np.concatenate(([0], np.cumsum(sizes)))
    scores = rng.integers(-4, 1, (begin[-1], 3)).astype(np.float32)
    prior = np.array([-1.0, -0.5, -2.0])
    path = languages.best_paths(scores, begin, prior, switch=2.5)

    def value(p, s):
        return prior[p[0]] + sum(s[i, x] for i, x in enumerate(p)) - 2.5 * sum(a != b for a, b in itertools.pairwise(p))

    for low, high in itertools.pairwise(begin):
        if high > low:
            most = max(value(p, scores[low:high]) for p in itertools.product(range(3), repeat=int(high - low)))
            assert value(path[low:high], scores[low:high]) == pytest.approx(most)
    assert len(languages.best_paths(np.zeros((0, 3)), np.zeros(4, int), prior)) == 0


def test_words_are_letters_of_one_script():
    texts = ["Don't  12ab́c—été", "", None, "日本語テキスト и the", "́ 123 !!", "ÉTÉ"]
    got = {}
    for s in languages.spelled(pa.array(texts), block=8):
        for i in range(s.rows):
            own = slice(s.begin[i], s.begin[i + 1])
            t = texts[s.first + i] or ""
            got[s.first + i] = [(t[a:b], n) for a, b, n in zip(s.start[own], s.end[own], s.letters[own], strict=True)]
    assert got == {
        0: [("Don", 3), ("t", 1), ("ab́c", 3), ("été", 3)], 1: [], 2: [], 3: [("日本語", 3), ("テキスト", 4), ("и", 1), ("the", 3)], 4: [], 5: [("ÉTÉ", 3)],
    }
    low, up = (next(languages.spelled(pa.array([x]))) for x in ("été", "ÉTÉ"))
    assert low.triples.tolist() == up.triples.tolist() and low.whole.tolist() == up.whole.tolist()


def test_scripts_narrow_the_languages(model):
    assert model.languages == ["el", "en", "es", "ru"]
    names = [None, *languages.SCRIPTS]
    allowed = {names[i]: [x for x, a in zip(model.languages, row, strict=True) if a] for i, row in enumerate(model.allowed) if row.any()}
    assert allowed == {"Latin": ["en", "es"], "Greek": ["el"], "Cyrillic": ["ru"]}
    s = next(languages.spelled(pa.array(["unseen άγνωστο зима 漢字"])))
    scores = model.scores(s)
    assert (scores[0, [0, 3]] < -100).all() and scores[1].argmax() == 0 and scores[2].argmax() == 3 and not scores[3].any()


def test_spans_of_mixed_texts(spark, model):
    rng = random.Random(7)
    parts = [text_of(rng, "en", 30), text_of(rng, "es", 12), text_of(rng, "ru", 8)]
    text = ". ".join(parts)
    stray = parts[0] + " niño " + parts[0]  # one word does not force a change
    docs = spark.createDataFrame([(1, text), (2, stray), (3, None), (4, "12 -- !"), (5, ""), (6, "ш"), (7, "漢字")], "doc_id long, text string")
    rows = {r.doc_id: r for r in languages.label(docs, model).collect()}
    cut = [0, len(parts[0]) + 2, len(parts[0]) + len(parts[1]) + 4]
    assert [(s.start, s.end, s.lang) for s in rows[1].spans] == [(c, c + len(p), x) for c, p, x in zip(cut, parts, ["en", "es", "ru"], strict=True)]
    assert rows[1].lang_pred == "en" and 0.4 < rows[1].score < 0.9
    assert [s.lang for s in rows[2].spans] == ["en"] and rows[2].score == 1.0
    assert [(rows[i].lang_pred, rows[i].score, rows[i].spans) for i in (3, 4, 5)] == [("und", 0.0, [])] * 3
    assert rows[6].lang_pred == "ru" and rows[7].lang_pred in model.languages


def test_edge_rows(spark):
    docs = edge_docs(spark)
    out = languages.languages(docs).collect()
    assert len(out) == len(EDGE) and all(0 <= r.score <= 1 for r in out)
    assert all((r.lang_pred == "und") == (not r.spans) for r in out)
    assert {r.held_out for r in out if r.doc_id is None} == {False}
    assert {(r.doc_id, r.held_out) for r in out if r.doc_id is not None} == {(i, zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in EDGE if i is not None}
    assert languages.languages(edge_docs(spark, [])).collect() == []
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in languages.languages(unlabelled).collect()} == {("und", 0.0)}


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1
    wrong = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    pick = lambda df: sorted((r.doc_id, r.lang_pred, r.score) for r in languages.languages(df).collect())
    assert pick(docs) == pick(wrong.withColumn("source", F.lit("other")))


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(languages, "MOST", 2)
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        languages.fit(rows, F.lit(True))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text")
    got = queries.QUERIES["op13_languages"](spark, folder).select("doc_id", "held_out", "lang_pred")
    seen = docs.join(got, "doc_id").filter("held_out AND text RLIKE '\\\\p{L}'").agg(F.count("*").alias("n"), F.count_if(F.col("lang") == F.col("lang_pred")).alias("right")).first()
    assert seen.n > 250 and seen.right / seen.n > 0.98
