"""Periodic runs against a search over all periods."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from cases import EDGE, edge_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import periodic, queries
from ledgerlake.llm.common import words


def brute(v, least=12):
    """All runs as (start, length, period), by comparing words every distance apart."""
    best = {}
    for q in range(1, len(v)):
        i = 0
        while i + q < len(v):
            j = i
            while j + q < len(v) and v[j] == v[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q):
                best.setdefault((i, length), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in best.items())


def found(texts, least=12):
    out = {}
    for w in words(pa.array(texts)):
        for row, *run in periodic.runs_of(w, least).tolist():
            out.setdefault(w.first + row, []).append(tuple(run))
    return [sorted(out.get(i, []), key=lambda r: (r[0], r[2])) for i in range(len(texts))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=4), st.integers(2, 13))
def test_small_alphabets(rows, least):
    assert found([" ".join(r) for r in rows], least) == [sorted(brute(r, least), key=lambda r: (r[0], r[2])) for r in rows]


def test_strings_full_of_runs():
    fib = ["b", "a"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    rng = random.Random(5)
    rows = [list(fib[-1]), ["x"] * 300, list("ab" * 100 + "c" + "ab" * 100), list("abcabcabd" * 30), [rng.choice("ab") for _ in range(500)]]
    rows.append(rng.choices("abcdefgh", k=60) * 5 + ["z"] + rng.choices("abcdefgh", k=30) * 2)
    assert found([" ".join(r) for r in rows]) == [brute(r) for r in rows]


def test_suffix_order_and_common_lengths():
    rng = random.Random(2)
    rows = [[rng.randrange(3) for _ in range(rng.randrange(1, 30))] for _ in range(12)]
    word = np.array([x for r in rows for x in r])
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    order, common = periodic.suffixes(word, row)
    tails = [(row[i], tuple(word[i : np.searchsorted(row, row[i], side="right")])) for i in range(len(word))]
    assert [tails[i] for i in order] == sorted(tails)
    for k in range(1, len(word)):
        (a, x), (b, y) = tails[order[k - 1]], tails[order[k]]
        shared = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y))) if a == b else 0
        assert common[k] == shared


def test_one_word_a_hundred_thousand_times():
    many = found([" ".join(["x"] * 100_000), " ".join(f"w{i % 50_000}" for i in range(100_001))])
    assert many == [[(0, 100_000, 1)], [(0, 100_001, 50_000)]]


def repeated(i, v):
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    g, n = h // 10, len(v)
    if h % 10 or not n:
        return v
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if k < a else v[a + (k - a) % p] for k, x in enumerate(v)]


def expected(i, text):
    v = repeated(i, (text or "").encode().split())
    runs = brute(v)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    return i, len(runs), s, n, q, 1000 * n // q if runs else None, sha(lines.encode()), sha(b" ".join(x for k, x in enumerate(v) if k not in gone))


def test_query_on_edge_rows(spark, tmp_path):
    rows = [(i, t) for i, t in EDGE if not (t and len(t) > 10_000)]
    rows += [(i, " ".join(random.Random(i).choices(["a", "b", "c\x0bd", "é"], k=i % 70))) for i in range(100, 300)]
    edge_docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted((expected(i, t) for i, t in rows), key=key)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_against_its_twin(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = con.execute(queries.ORACLES["op12_periodic_runs"]).fetchall()
    got = queries.QUERIES["op12_periodic_runs"](spark, folder)
    assert got.columns == [d[0] for d in con.description]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and any(r[1] for r in want)


def test_operator_keeps_rows_and_types(spark):
    out = periodic.find_runs(edge_docs(spark))
    assert out.schema["runs"].dataType.simpleString() == "array<struct<start:bigint,length:bigint,period:bigint>>"
    rows = out.collect()
    assert len(rows) == len(EDGE)
    assert {r.collapsed for r in rows if r.doc_id in (0, 1, 2)} == {""} and {r.collapsed for r in rows if r.doc_id == 7} == {"same words here again"}
    assert periodic.find_runs(edge_docs(spark, [])).collect() == []
    with pytest.raises(ValueError):
        periodic.find_runs(edge_docs(spark), least=1)
