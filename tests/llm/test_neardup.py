"""Near duplicates against all pairs of small corpora; components against union-find."""

import os
import random
from collections import defaultdict

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from cases import EDGE, edge_docs

from ledgerlake.llm import neardup

FOLDER = "/root/testdata/sf0.001"


def plain_set(text, k=5):
    """The shingles themselves: words in ASCII lower case, split at ASCII white space."""
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, percent):
    sets = [(i, plain_set(t)) for i, t in docs]
    root = {i: i for i, _ in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def got(frame, percent, **how):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(frame, percent, **how).collect()), key=str)


def planted(seed=5):
    """Copies of a text, each with some words changed, chains of copies, texts with a shared passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    docs = []
    for size, changes, copies in ((200, 2, 25), (200, 4, 25), (60, 1, 10), (8, 1, 6), (6, 0, 4)):
        base = [word() for _ in range(size)]
        docs.append(" ".join(base))
        for _ in range(copies):
            some = list(base)
            for _ in range(changes):
                some[rng.randrange(size)] = word()
            docs.append("  ".join(some).upper() if rng.random() < 0.2 else " ".join(some))
    chain = [word() for _ in range(120)]
    for _ in range(12):
        docs.append(" ".join(chain))
        chain[rng.randrange(120)] = word()
    passage = [word() for _ in range(40)]
    docs += [" ".join(passage + [word() for _ in range(40)]) for _ in range(20)]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("percent, cell", [(85, neardup.CELL), (80, 3)])
def test_planted(spark, percent, cell):
    docs = planted() + [(i + 1000 if i is not None else None, t) for i, t in EDGE]
    assert got(edge_docs(spark, docs), percent, cell=cell) == brute(docs, percent)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are absent")
def test_given_documents(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    assert got(frame, 85) == brute(docs, 85)


def crowd(seed=9, n=120, size=150):
    """Texts around a base that is not among them: alike, most of them not linked, some linked over others."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(size)]
    docs = []
    for i in range(n):
        some = list(base)
        for _ in range(rng.choice([1, 3, 3, 4, 6])):
            some[rng.randrange(size)] = word()
        docs.append((i, " ".join(some)))
    return docs


@pytest.mark.parametrize("percent, cell", [(85, 16), (80, 7)])
def test_crowd_of_alike_texts(spark, percent, cell):
    docs = crowd()
    want = brute(docs, percent)
    assert 1 < len({c for _, _, c in want})
    assert got(edge_docs(spark, docs), percent, cell=cell) == want


def test_forests_are_small_and_join_what_all_pairs_join(spark):
    """Of a crowd every cell puts out at most one pair a member, and together they connect what all pairs connect."""
    docs = crowd(n=90)
    sets = neardup.shingle_sets(pa.array([t for _, t in docs]), 5)
    rows = [(1, i, i if i % 3 else 0, len(s), bytearray(neardup.odd_sketch(neardup.samples(s, neardup.FOLDED))), bytearray(s.tobytes())) for (i, _), s in zip(docs, sets, strict=True)]
    frame = spark.createDataFrame(rows, "bucket long, node long, component long, size_of long, odd binary, shingles binary")
    cells = neardup._cells(frame, "bucket", 16)
    tables = {}
    for r in cells.collect():
        tables.setdefault((r.low, r.high), []).append(r)
    seen = set()
    for own in tables.values():
        table = pa.Table.from_pylist([r.asDict() for r in own], schema=pa.schema([("bucket", pa.int64()), ("node", pa.int64()), ("component", pa.int64()), ("size_of", pa.int64()), ("odd", pa.binary()), ("shingles", pa.binary()), ("own", pa.string()), ("low", pa.string()), ("high", pa.string())]))
        for found in (neardup._alike(table, 0.85, neardup.differing_at_most(0.85)), neardup._linked(table, 85)):
            assert len(found) < max(1, len(own))
        for i in range(len(own)):
            seen |= {frozenset((own[i].node, x.node)) for x in own[:i] if own[i].own != x.own or own[i].low == own[i].high}
    owner = {r[1]: r[2] for r in rows}
    assert {frozenset((i, j)) for i in owner for j in owner if i < j and owner[i] != owner[j]} <= seen
    # The large component's 30 members are not repeated for each other.
    assert pc.sum(pa.array([len(x) for x in tables.values()])).as_py() < 8 * len(rows)


def test_hot_classes_are_placed_like_others(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CLASS_ROWS", 3)
    docs = [(i, "one two three four five six") for i in range(8)] + [(20, "a b c d e f"), (21, "a b c d e f"), (22, None)]
    assert got(edge_docs(spark, docs), 85) == brute(docs, 85)


def test_one_id_with_two_texts(spark):
    a, b = "a b c d e f g h", "k l m n o p q r"
    assert got(edge_docs(spark, [(1, a), (2, a), (2, b), (3, b), (4, "z")]), 85) == [(1, 4, 1), (2, 4, 1), (2, 4, 1), (3, 4, 1), (4, 1, 4)]
    assert got(edge_docs(spark, []), 85) == []


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + rng.randrange(1, 60)) for _ in range(80)] + [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(40)]
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b), near[b].add(a)
    want, seen = {}, set()
    for a in sorted(near):
        todo = [] if a in seen or near[a] == {a} else [a]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                want[x] = a
                todo += near[x]
    rows = neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == want and len(rows) == len(want)


def test_one_of_each_keeps_columns_and_one_row(spark):
    frame = edge_docs(spark, [(1, "p q r s t u v w"), (2, "P q r s t u v w"), (3, "other words of this text"), (3, "other words of this text"), (None, "p q r s t u v w"), (4, None)])
    kept = neardup.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 3, 4, None], key=str)
