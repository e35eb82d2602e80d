"""Chunked scans, exact ranks and id ranges against plain Python."""

import random
import re
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.operators import metrics, ordered
from ledgerlake.operators.ordered import CHUNK


def test_plain_and_chunked_scans_agree(spark):
    rng = random.Random(5)
    rows = [(0 if rng.random() < 0.4 else rng.randrange(1, 9), i, rng.choice([None, rng.randrange(50)])) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, t long, v int")
    hot = ordered.hot_keys(df, ["k"], 60)
    assert [r.k for r in hot.collect()] == [0]
    cut = ordered.with_chunks(df, ["k"], hot, F.floor(F.col("t") / 20))
    for step in (
        lambda d, h: ordered.carry_last(d, ["k"], ["t"], {"o": "v"}, h),
        lambda d, h: ordered.neighbour(d, ["k"], ["t"], {"o": "v"}, -1, h),
        lambda d, h: ordered.neighbour(d, ["k"], ["t"], {"o": "v"}, 1, h),
        lambda d, h: ordered.running_max(d, ["k"], ["t"], {"o": "v"}, h),
        lambda d, h: ordered.running_sum(d, ["k"], ["t"], {"o": "v"}, h),
    ):
        plain = {(r.k, r.t): r.o for r in step(df, False).collect()}
        assert {(r.k, r.t): r.o for r in step(cut, True).collect()} == plain


def test_no_hot_key_means_no_chunk(spark):
    df = spark.range(10).withColumn("k", F.col("id") % 5)
    assert ordered.hot_keys(df, ["k"], 2) is None
    assert CHUNK not in ordered.with_chunks(df, ["k"], None, F.col("id")).columns


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 300), max_size=120))
def test_id_ranges_round_trip(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    ranges = ordered.id_ranges(df, [], "id", width=16)
    got = sorted((r.lo, r.hi) for r in ranges.collect())
    assert all(b[0] > a[1] + 1 for a, b in zip(got, got[1:]))
    back = ordered.expand_ranges(ranges, [], "id", piece=7).collect()
    assert sorted(r.id for r in back) == sorted(set(ids))


@pytest.mark.parametrize("ids,n", [([], 0), ([5], 1), (list(range(1, 181066)), 1), ([1, 2, 3, 10, 11, 40], 3)])
def test_id_ranges_compress(spark, ids, n):
    df = spark.createDataFrame([(i,) for i in ids], "id long") if len(ids) < 100 else spark.range(1, 181066)
    ranges = ordered.id_ranges(df, [], "id", width=1000).cache()
    assert ranges.count() == n
    assert ordered.expand_ranges(ranges, [], "id").count() == len(ids)


def test_percent_rank_with_a_hot_value(spark):
    rng = random.Random(7)
    rows = [("a", i, 5.5 if i % 3 == 0 else round(rng.random() * 10, 2)) for i in range(300)] + [("b", 999, 1.0)]
    df = spark.createDataFrame(rows, "g string, id int, v double")
    got = {r.id: (r.percentil, r.n_grupo) for r in metrics.percent_ranks(df, ["g"], "v").collect()}
    values = [v for g, _, v in rows if g == "a"]
    for g, id, v in rows[:-1]:
        assert got[id] == (pytest.approx(sum(x < v for x in values) / 299), 300)
    assert got[999] == (0.0, 1)


def test_quantiles(spark):
    values = [random.Random(9).random() * 20 for _ in range(97)] + [3.0] * 50
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = ordered.exact_quantiles(df, [], "v", {"med": 0.5, "p95": 0.95}, F.floor).first()
    assert row.med == pytest.approx(statistics.median(values))
    assert row.p95 == pytest.approx(statistics.quantiles(values, n=100, method="inclusive")[94])
    near = ordered.nearest_rank(df, [], "v", 0.95, "p", F.floor).first().p
    assert near == sorted(values)[int(len(values) * 0.95) - 1]


def test_global_index(spark):
    df = spark.createDataFrame([(30,), (10,), (20,), (100,)], "id long")
    got = {r.id: r.pos for r in ordered.global_index(df, "id", lambda c: F.floor(c / 25), "pos").collect()}
    assert got == {10: 0, 20: 1, 30: 2, 100: 3}


def test_one_stream_and_one_day_is_cut_by_rows(spark):
    """Five limits' rows of one key in one pass: no chunk has more than twice the limit, and scans agree."""
    limit = 400
    df = spark.range(5 * limit).selectExpr("'a' AS k", "cast('2031-01-01' as timestamp_ntz) AS at", "id AS place", "(id * 7919) % 1000 AS v")
    df = df.unionByName(spark.range(50).selectExpr("'b' AS k", "cast('2031-01-01' as timestamp_ntz) AS at", "id AS place", "id AS v"))
    hot = ordered.hot_keys(df, ["k"], limit)
    unit = {"_pass": F.col("at"), "_piece": F.floor(F.col("place") / 100)}
    cut = ordered.with_counted_chunks(df, ["k"], hot, unit, limit)
    sizes = {(r.k, r[CHUNK]): r["count"] for r in cut.groupBy("k", CHUNK).count().collect()}
    assert sizes.pop(("b", None)) == 50 and len(sizes) == 5 and max(sizes.values()) <= 2 * limit
    assert set(cut.columns) == {*df.columns, CHUNK}
    for step in (ordered.running_max, ordered.running_sum):
        plain, parts = (step(d, ["k"], ["at", "place"], {"o": "v"}, h) for d, h in ((df, False), (cut, True)))
        rows = lambda d: sorted((r.k, r.place, r.o) for r in d.collect())
        assert [(k, p) for k, p, _ in rows(plain)] == [(k, p) for k, p, _ in rows(parts)]
        assert {(k, p): o for k, p, o in rows(plain)} == {(k, p): o for k, p, o in rows(parts)}
    assert ordered.with_counted_chunks(df, ["k"], None, unit) is df


def test_runs_of_a_hot_school_are_numbered_like_others(spark, events):
    from ledgerlake.operators import history
    from tests.conftest import event

    rng = random.Random(6)
    rows = [event(i, rng.choice(["lab", "bib"]), f"2031-{1 + i // 28 % 12:02d}-{1 + i % 28:02d}", rng.choice(["existente", "inexistente", "nao_informado"]), school=1 if i % 3 else 2 + i % 5) for i in range(200)]
    df = events(rows)
    hot = ordered.hot_keys(df, ["co_entidade"], 80)
    assert hot is not None
    number = lambda h: {(r.co_entidade, r.item_codigo, r.vistoria_id): r.trecho for r in history.numbered_runs(history.state_runs(history.known_states(df, h), h is not None), h is not None).collect()}
    assert number(hot) == number(None)


@pytest.mark.parametrize("block", [4, 1 << 20])
def test_ranks_over_many_buckets(spark, monkeypatch, block):
    """Prefix sums over blocks of buckets; no window holds all buckets of a group."""
    monkeypatch.setattr(ordered, "BLOCK", block)
    df = spark.range(300).selectExpr("if(id % 2 = 0, 'a', null) AS g", "cast((id * id) % 97 - 40 AS double) AS v")
    want = {}
    for r in df.collect():
        want.setdefault(r.g, []).append(r.v)
    for r in ordered.value_ranks(df, ["g"], "v", metrics.unit_bucket).collect():
        own = want[r.g]
        assert (r.n, r.before, r.total) == (own.count(r.v), sum(x < r.v for x in own), len(own))
    every = [v for own in want.values() for v in own]
    assert all(r.before == sum(x < r.v for x in every) for r in ordered.value_ranks(df, [], "v", metrics.unit_bucket).collect())
    plan = ordered.value_ranks(df, [], "v", metrics.unit_bucket)._jdf.queryExecution().optimizedPlan().toString()
    by_bucket = [w for w in re.findall(r"windowspecdefinition\((.*?) ASC", plan) if re.search(r"_bucket#\d+L$", w)]
    assert by_bucket and all(w.startswith("_block") for w in by_bucket)


def test_millions_of_buckets(spark):
    """Every value is a bucket of its own: two million buckets, in blocks of about a million."""
    df = spark.range(2_000_000).selectExpr("id * 3 AS v")
    ranks = ordered.value_ranks(df, [], "v", lambda v: v)
    assert ranks.where("before * 3 <> v OR total <> 2000000 OR n <> 1").isEmpty() and ranks.count() == 2_000_000
