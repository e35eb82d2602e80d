"""Hard negatives against plain integers."""

import math
import random
import struct

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import negatives, queries

SHAPE = "vec_id long, embedding array<float>, label int, score long, rank int, id long, v string, place int, slot int"


def single(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, n, 1, 1, 1, "x", 1, 1) for i, v, n in rows], SHAPE)


def brute(rows, asked, k=5, m=5, low=80, high=100):
    fine = [(i, n, tuple(math.floor(256 * x) for x in v)) for i, v, n in rows if i is not None and n is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = {}
    for i, v, n in rows:
        if i in asked and n is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            first[i] = min(first.get(i, (n, v)), (n, v))
    out = []
    for a, (own, v) in first.items():
        q = [math.floor(256 * x) for x in v]
        score = lambda w: max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(q, w, strict=True))))  # noqa: E731, B023
        others = sorted((-score(w), i, n) for i, n, w in fine if i != a and len(w) == len(q))
        for s, p, _ in [x for x in others if x[2] == own][:k]:
            window = [x for x in others if x[2] != own and low * -s <= 100 * -x[0] <= high * -s][:m]
            out += [(a, p, r + 1, i, -s, -t) for r, (t, i, _) in enumerate(window)]
    return sorted(out)


def same(found, want):
    return sorted(tuple(r) for r in found.collect()) == want


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.sampled_from([1, 255, 10**4, 2**26, 2**30, 2**31, 10**12, 10**38]), st.integers(0, 10**6))
def test_products_are_exact(dim, most, seed):
    rng = random.Random(seed)
    q, c = (np.array([[float(rng.choice([-most, most, rng.randint(-most, most), 0])) for _ in range(dim)] for _ in range(3)]) for _ in range(2))
    want = [[max(-(2**63), min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(a, b, strict=True)))) for b in c] for a in q]
    assert negatives.inner_products(q, c).tolist() == want


def test_primes_and_pieces():
    assert negatives.moduli(256 * 256 * 64) == [1021, 1019, 1013]
    assert all((negatives._EXACT - 1) // ((p - 1) // 2) ** 2 >= 1 for p in negatives.primes())
    x = np.array([-1021.0, -511.0, -510.0, 0.0, 510.0, 511.0, 3e38])
    r = negatives.residues(x, 1021)
    assert np.abs(r).max() <= 510 and all((int(a) - int(b)) % 1021 == 0 for a, b in zip(x, r, strict=True))


def test_windows_do_not_overflow():
    low, high = negatives.bounds(np.array([100, -100, 0, 7, 2**63 - 1, -(2**63)]), 80, 100)
    assert low.tolist() == [80, -80, 0, 6, -(-80 * (2**63 - 1) // 100), -(80 * 2**63 // 100)] and high.tolist() == [100, -100, 0, 7, 2**63 - 1, -(2**63)]


@pytest.mark.parametrize("tile", [3, negatives.TILE])
def test_negatives(spark, tile, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 16)
    rng = random.Random(4)
    rows = [(i, [single(round(rng.uniform(-1, 1), 2)) for _ in range(3)], rng.randrange(3)) for i in range(120)]
    rows += [(200 + i, [0.5, 0.5, 0.5], i % 2) for i in range(60)]  # copies: ties by id
    rows += [(300, None, 1), (301, [1.0, None, 0.0], 1), (302, [float("nan")] * 3, 1), (303, [float("inf"), 0.0, 0.0], 1), (304, [1.0, 2.0], 1), (305, [1.0, 2.0], 0), (306, [1.5, 2.0], 1), (307, [], 1), (308, [], 1), (309, [], 0)]
    rows += [(None, [1.0] * 3, 1), (310, [1.0] * 3, None), (7, rows[7][1], rows[7][2]), (8, [0.25, 0.0, 0.0], 2)]
    asked = {0, 7, 8, 10, 50, 200, 201, 300, 304, 307, 310}
    source = frame(spark, rows).repartition(3)
    anchors = source.filter(source.vec_id.isin(*asked))
    assert same(negatives.hard_negatives(source, anchors, tile=tile), brute(rows, asked))
    assert same(negatives.hard_negatives(source, anchors, 2, 3, 10, 90, tile=tile), brute(rows, asked, 2, 3, 10, 90))


def test_large_components_and_empty_tables(spark):
    rows = [(i, [single(x) for x in v], n) for i, v, n in [(0, [3e18, 1.0], 0), (1, [3e18, 5.0], 0), (2, [2.9e18, 1.0], 1), (3, [1e5, 2.0], 1), (4, [-3e38, 3e38], 1), (5, [1.0, 1.0], 0)]]
    source = frame(spark, rows)
    assert same(negatives.hard_negatives(source, source), brute(rows, set(range(6))))
    nothing = frame(spark, [])
    assert negatives.hard_negatives(nothing, nothing).collect() == [] == negatives.hard_negatives(source, nothing).collect()
    assert negatives.hard_negatives(nothing, source).collect() == []


def test_query_against_its_twin(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = con.execute(queries.ORACLES["op11_hard_negatives"]).fetchall()
    got = queries.QUERIES["op11_hard_negatives"](spark, folder)
    assert got.columns == [d[0] for d in con.description] and same(got, sorted(want)) and want
