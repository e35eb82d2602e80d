"""Token counts and packing against the tokenizers library."""

import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from cases import EDGE, edge_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import packing, token_counts

BYTES, WORDS = public_tokenizers.path(token_counts.TOKENIZER), public_tokenizers.path(packing.TOKENIZER)
ALPHABET = st.sampled_from("abcXYZ \n\t'sdtmrevl.,!?0123é²ªµßÀÿ\xa0\x85\x1cΣİ漢<|>-$ǅłŒ")
TEXT = st.one_of(st.text(ALPHABET, max_size=40), st.text(max_size=20), st.just("a <|endoftext|> b"))


def ids(path, text):
    return token_counts.tokenizer(path).encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_same_tokens_as_the_library(text):
    cache = token_counts._Cache(BYTES, {"the": 1})
    assert token_counts._count(text, cache, token_counts.special_strings(BYTES)) == len(ids(BYTES, text))
    assert packing.token_bytes(text, WORDS) == np.array(ids(WORDS, text), "<u4").tobytes()


def test_counts(spark):
    rows = token_counts.count_tokens(edge_docs(spark)).collect()
    want = sorted(((i, len((t or "").encode()), len(ids(BYTES, t))) for i, t in EDGE), key=str)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in rows), key=str) == want
    assert token_counts.count_tokens(edge_docs(spark, [])).collect() == []


def test_other_scripts_go_through_the_table_and_the_cache(spark):
    texts = ["“Привет” — мир, привет мир", "漢字 かな 漢字", "naïve “quotes” and 𝔘nicode … don’t", "a <|endoftext|> “b”"]
    cache = token_counts._Cache(BYTES, {" мир": len(ids(BYTES, " мир"))})
    before = len(cache)
    for t in texts:
        assert token_counts._count(t, cache, token_counts.special_strings(BYTES)) == len(ids(BYTES, t))
    assert len(cache) > before and " привет" in cache
    docs = spark.createDataFrame([(i, t * 3) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs).collect()} == {i: len(ids(BYTES, t * 3)) for i, t in enumerate(texts)}


def test_frequent_table_keeps_the_heaviest(spark):
    docs = spark.createDataFrame([(i, "common common rare%d" % i) for i in range(60)], "doc_id long, text string").repartition(20)
    top = token_counts.frequent_pretokens(docs, size=2)
    assert " common" in top and len(top) == 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120), st.integers(1, 6))
def test_best_fit(sizes, open_bins):
    fit, free = packing.BestFit(64, open_bins), {}
    for size in sizes:
        able = [(f, b) for b, f in free.items() if f >= size]
        chosen, offset, closed = fit.place(size)
        if able:
            assert free[chosen] == min(able)[0]
        assert offset == 64 - free.get(chosen, 64)
        free[chosen] = 64 - offset - size
        if closed is not None:
            assert free[closed] == min(free.values())
            del free[closed]
        free = {b: f for b, f in free.items() if f}
        assert fit.still_open() == free and len(free) <= open_bins


def check_packed(rows, docs, length):
    bins, per = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        per[r.doc_id].append(r)
    for pieces in bins.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length
    left = defaultdict(list)
    for i, t in docs:
        left[i].append(ids(WORDS, t) + [packing.END])
    for i, texts in left.items():
        want = sorted((p, s, min(length, len(x) - s), zlib.crc32(np.array(x[s : s + length], "<u4").tobytes())) for x in texts for p, s in enumerate(range(0, len(x), length)))
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in per.pop(i)) == want
    assert not per
    return len(bins), sum(r.length for r in rows)


@pytest.mark.parametrize("parts", [1, 7])
def test_packing(spark, parts):
    docs = EDGE + [(100 + i, "word " * (i % 60)) for i in range(200)]
    frame = edge_docs(spark, docs).repartition(parts)
    bins, tokens = check_packed(packing.pack(frame, length=128, open_bins=4).collect(), docs, 128)
    assert bins <= 1.02 * tokens / 128 + 2


def test_packing_levels(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 2)
    docs = [(i, "word " * (i % 50)) for i in range(120)]
    bins, tokens = check_packed(packing.pack(edge_docs(spark, docs).repartition(9), length=64).collect(), docs, 64)
    assert bins <= 1.1 * tokens / 64 + 2
    assert packing.pack(edge_docs(spark, [])).collect() == []


def test_merged_bins_stay_few():
    rng = np.random.default_rng(2)
    bins = pd.DataFrame({"bin": np.arange(600), "used": rng.integers(1, 64, 600)})
    out = packing._join_bins((3,), bins, 64, 8)
    assert set(out.bin) == set(range(600)) and set(out.task) == {3}
    assert out[out.open].into.nunique() <= 8
    per = out.groupby("into").used.sum()
    assert per.max() <= 64 and per.size <= 1.1 * bins.used.sum() / 64 + 8
