"""Decontamination and repeated passages against their definitions."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest
from cases import EDGE, edge_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import decontamination, queries, substrings

FOLDER = "/root/testdata/sf0.001"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=16), st.lists(st.integers(1, 3), max_size=16), st.integers(1, 3))
def test_tiles(a, b, shortest):
    found = decontamination.tiles(np.array(a, np.uint64), np.array(b, np.uint64), shortest)
    used_a, used_b = set(), set()
    for i, j, n in found:
        assert n >= shortest and a[i : i + n] == b[j : j + n]
        own_a, own_b = set(range(i, i + n)), set(range(j, j + n))
        assert not used_a & own_a and not used_b & own_b
        used_a |= own_a
        used_b |= own_b
    # Nothing is left to mark.
    for i in range(len(a) - shortest + 1):
        for j in range(len(b) - shortest + 1):
            free = not used_a & set(range(i, i + shortest)) and not used_b & set(range(j, j + shortest))
            assert not (free and a[i : i + shortest] == b[j : j + shortest])
    # The longest common run is a tile.
    longest = max((n for i in range(len(a)) for j in range(len(b)) for n in range(min(len(a) - i, len(b) - j) + 1) if a[i : i + n] == b[j : j + n]), default=0)
    assert (found[0][2] if found else 0) == (longest if longest >= shortest else 0)


ITEM = "The first part of it stands here. Then comes a second part of some words. The third part ends the whole item."


def contaminated(spark, docs, items, **how):
    bench = spark.createDataFrame(items, "item_id long, text string, doc_id long") if items and len(items[0]) == 3 else spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontamination.contaminated(edge_docs(spark, docs), bench, **how).collect()}


def test_contaminated(spark):
    one, two, three = ITEM.split(". ")
    docs = EDGE + [
        (20, f"before it {ITEM} after it"), (21, f"{three} and in between {one.upper()}!! more of it: {two}"), (22, "words that stand alone, here and there, the first of it"),
        (23, f"only {one}"), (24, ITEM), (24, ITEM), (25, "tiny item"),
    ]
    items = [(1, ITEM, 0), (2, None, 0), (3, "", 0), (4, "tiny item", 0), (5, "quite another item that no document of these holds at all", 0), (1, ITEM, 0)]
    found = contaminated(spark, docs, items)
    assert set(found) == {(20, 1), (21, 1), (24, 1), (25, 4)}
    assert found[21, 1].coverage > 0.8 and len(found[21, 1].tiles) == 3
    assert found[20, 1].covered == found[20, 1].item_words
    small = contaminated(spark, docs, items, block=64)
    assert {k: v.covered for k, v in small.items()} == {k: v.covered for k, v in found.items()}
    clean = decontamination.without_contaminated(edge_docs(spark, docs), spark.createDataFrame(items, "item_id long, text string, doc_id long"))
    assert sorted((str(r.doc_id) for r in clean.collect())) == sorted(str(i) for i, _ in docs if i not in (20, 21, 24, 25)) and clean.columns == edge_docs(spark, []).columns


def test_empty_sides(spark):
    assert contaminated(spark, [], [(1, ITEM, 0)]) == {} == contaminated(spark, [(1, ITEM)], [])


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are absent")
def test_benchmark_passages_in_given_documents(spark):
    rows = queries.QUERIES["op7_decontamination"](spark, FOLDER).collect()
    items = {r.item_id: r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    holding = {(r.doc_id, i) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect() for i, t in items.items() if t in (r.text or "")}
    assert holding and holding <= {(r.doc_id, r.item_id) for r in rows}


def without_repeats(docs, window):
    words = [(i, (t or "").encode().split()) for i, t in docs]
    seen = Counter(b" ".join(w[i : i + window]) for _, w in words for i in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = set()
        for at in range(len(w) - window + 1):
            if seen[b" ".join(w[at : at + window])] > 1:
                gone |= set(range(at, at + window))
        out.append((i, len(w), len(gone), b" ".join(x for n, x in enumerate(w) if n not in gone).decode()))
    return sorted(out, key=str)


def removed(frame, **how):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(frame, **how).collect()), key=str)


@pytest.mark.parametrize("window, m", [(35, 5), (6, 2)])
def test_repeated_windows(spark, window, m, monkeypatch):
    monkeypatch.setattr(substrings, "HELD_BYTES", 3000)
    rng = random.Random(window)
    word = lambda: rng.choice("ab cd ef gh ij kl mn op qr st".split()) + rng.choice("12345678")
    passage, line = [word() for _ in range(60)], [word() for _ in range(9)]
    docs = list(EDGE)
    for i in range(40):
        text = [word() for _ in range(rng.randrange(70))]
        if i % 3 == 0:
            text += passage[rng.randrange(12) :]
        if i % 2:
            text += line + [word() for _ in range(30)]
        docs.append((100 + i, (" " if i % 5 else "\n").join(text)))
    assert removed(edge_docs(spark, docs).repartition(3), window=window, m=m) == without_repeats(docs, window)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are absent")
def test_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    want = sorted((i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in without_repeats(docs, 35))
    assert sorted(tuple(r) for r in queries.QUERIES["op8_substring_dedup"](spark, FOLDER).collect()) == want
    assert removed(edge_docs(spark, [])) == []
