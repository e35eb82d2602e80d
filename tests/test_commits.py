"""Commits that name what they read: several writers, file choice, kept fingerprints, retention."""

import random
import threading
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.contracts import EVENT_CONTENT, EVENT_KEY, EVENT_SCHEMA
from ledgerlake.operators import ordered, quality
from ledgerlake.sources.log import SNAPSHOT, CommitLog, Conflict
from ledgerlake.sources.tables import APPEND, Made, VersionedTable, live_commits
from ledgerlake.streaming import windows
from tests.conftest import event


def open_table(spark, root):
    return VersionedTable(spark, root, EVENT_SCHEMA, EVENT_KEY, "mes_ocorrencia", ["lsn_origem"], ["co_entidade"], EVENT_CONTENT)


@pytest.fixture
def table(spark, folder):
    return open_table(spark, folder)


def rows(ids, month="2024-05", lsn=None, school=None):
    return [event(k, "lab", f"{month}-{1 + k % 28:02d}", "existente", k % 5, school=school or k, lsn=lsn) for k in ids]


def ids(df):
    return sorted(r.vistoria_id for r in df.collect())


SMALL = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def small(spark, root):
    return VersionedTable(spark, root, SMALL, ["k"], summed=["k", "v"])


def test_one_version_is_one_commit(spark, folder):
    """Of many writers that want one version number exactly one gets it."""
    def log():
        return CommitLog(spark, folder, live_commits, [])

    entry = lambda c: {"commit": c, "removes": [], "files": []}
    for version in range(1, 51):
        with ThreadPoolExecutor(2) as pool:
            won = list(pool.map(lambda w, v=version: log().add(v, entry(f"{v}-{w}")), range(2)))
        assert sorted(won) == [False, True]
    assert log().version() == 50 and len(log().current()[1]) == 50 and len(log().current(33)[1]) == 33
    assert [e["version"] for e in log().history(10, 13)] == [11, 12, 13]


def test_two_writers_lose_and_double_nothing(spark, events, table):
    """Both insert overlapping keys; every version number is taken once and every key is stored once."""
    def writer(n):
        mine = open_table(spark, table.root)
        return [mine.insert_if_absent(events(rows(range(i, i + 4), lsn=n))) for i in range(0, 8, 2)]

    with ThreadPoolExecutor(2) as pool:
        done = [w for part in pool.map(writer, (1, 2)) for w in part]
    assert ids(table.read()) == list(range(10))
    assert sum(w.inserted for w in done) == 10
    assert [e["version"] for e in table.commits.history()] == list(range(1, table.version() + 1))


def test_writers_of_other_keys_do_not_disturb_each_other(spark, events, table, monkeypatch):
    """A commit of other keys, or a rewrite, between look-up and commit does not make a batch be written again."""
    table.append(events(rows([1, 2])))
    other, made = open_table(spark, table.root), []
    write = VersionedTable._write

    def between(self, df):
        out = write(self, df)
        if self is table:
            made.append(out)
            if len(made) == 1:
                other.insert_if_absent(events(rows(range(50, 60))))
                other.compact()
        return out

    monkeypatch.setattr(VersionedTable, "_write", between)
    assert table.insert_if_absent(events(rows(range(1, 9)))).inserted == 6
    assert len(made) == 1 and ids(table.read()) == [*range(1, 9), *range(50, 60)]
    made.clear()

    def same_keys(self, df):
        out = write(self, df)
        if self is table:
            made.append(out)
            if len(made) == 1:
                other.insert_if_absent(events(rows(range(15, 25), lsn=7)))
        return out

    monkeypatch.setattr(VersionedTable, "_write", same_keys)
    assert table.insert_if_absent(events(rows(range(10, 20)))).inserted == 5
    assert len(made) == 2 and table.read().where("lsn_origem = 7").count() == 10


def test_compaction_keeps_what_comes_between(spark, events, table, monkeypatch):
    for i in range(3):
        table.append(events(rows([i])))
    other, write = open_table(spark, table.root), VersionedTable._write

    def between(self, df):
        out = write(self, df)
        if self is table and other.version() == 3:
            other.insert_if_absent(events(rows([7])))
        return out

    monkeypatch.setattr(VersionedTable, "_write", between)
    table.compact()
    assert ids(table.read()) == [0, 1, 2, 7] and len(table.commits.current()[1]) == 2
    table.vacuum(0)
    assert ids(table.read()) == [0, 1, 2, 7]
    entry = table.commits.history()[-1]
    assert (entry["kind"], entry["read"], len(entry["removes"])) == ("rewrite", 3, 3)


def test_two_compactions_do_not_double(spark, events, table, monkeypatch):
    for i in range(3):
        table.append(events(rows([i])))
    other, write, tries = open_table(spark, table.root), VersionedTable._write, []

    def between(self, df):
        out = write(self, df)
        if self is table:
            tries.append(1)
            if len(tries) == 1:
                other.compact()
        return out

    monkeypatch.setattr(VersionedTable, "_write", between)
    table.compact()
    assert ids(table.read()) == [0, 1, 2] and len(tries) == 2


def test_replacements(spark, folder):
    table = small(spark, folder)
    frame = lambda *ks: spark.createDataFrame([(k, "x") for k in ks], SMALL)
    table.append(frame(1, 2))
    seen = table.version()
    table.append(frame(3))
    with pytest.raises(Conflict):
        table.replace(frame(9), read=seen)
    assert sorted(r.k for r in table.read().collect()) == [1, 2, 3]
    table.replace(frame(9), read=table.version())
    assert [r.k for r in table.read().collect()] == [9] and table.read(2).count() == 3
    assert table.vacuum(0) > 0 and [r.k for r in table.read().collect()] == [9]


def test_fifty_races_of_compaction_and_insertion(spark, folder):
    """Whatever the order in which they come, no row is lost and none is doubled."""
    table = small(spark, folder)
    table.append(spark.createDataFrame([(0, "x")], SMALL))
    start = threading.Barrier(2)

    def insert(n):
        start.wait()
        small(spark, folder).insert_if_absent(spark.createDataFrame([(n, "y"), (0, "z")], SMALL))

    def compact(_):
        start.wait()
        small(spark, folder).compact()

    for n in range(1, 51):
        with ThreadPoolExecutor(2) as pool:
            for job in [pool.submit(insert, n), pool.submit(compact, n)]:
                job.result()
    assert sorted(r.k for r in table.read().collect()) == list(range(51))
    assert table.version() == 101 and table.read().where("v = 'z'").isEmpty()
    assert quality.fingerprint(table.read(), ["k", "v"]).first().asDict() == table.fingerprint().first().asDict()


def test_two_control_writers_lose_no_row(spark, events, folder):
    """Runs and reprocessing at the same time: every month's window and the mark are there afterwards."""
    HEAD = "vistoria_id long, co_entidade long, ocorrido_em timestamp_ntz, registrado_em timestamp_ntz, origem string"
    months = [f"2024-{m:02d}" for m in range(1, 5)]
    origin = [r for i, m in enumerate(months) for r in rows([10 * i + 1, 10 * i + 2], m)]
    heads = spark.createDataFrame([(r[0], 1, r[5], r[5], "x") for r in origin], HEAD)
    stored = open_table(spark, f"{folder}-events")
    monthly = lambda: windows.MonthlyWindows(spark, open_table(spark, stored.root), f"{folder}-control")
    items = events(origin).select("vistoria_id", "item_codigo", "situacao", "quantidade")
    with ThreadPoolExecutor(3) as pool:
        jobs = [pool.submit(monthly().run, heads, items, events(origin))]
        jobs += [pool.submit(monthly().reprocess, events(origin), [m]) for m in months[:2]]
        for job in jobs:
            job.result()
    done = monthly()
    assert sorted(r.mes for r in done.windows().collect()) == months and all(r.confere_com_a_origem for r in done.windows().collect())
    assert done.mark() is not None and ids(stored.read()) == sorted(r[0] for r in origin)


def test_random_histories_keep_sums_and_rows(spark, folder):
    """Appends, inserts, rewrites and replacements against a plain list; sums equal a full scan at every version."""
    rng = random.Random(3)
    table, want, versions = small(spark, folder), [], {}
    for step in range(24):
        some = [(rng.randrange(12), f"s{step}") for _ in range(rng.randrange(1, 4))]
        frame = spark.createDataFrame(some, SMALL)
        kind = rng.choice(["append", "insert", "compact", "replace"])
        if kind == "append":
            table.append(frame)
            want = want + some
        elif kind == "insert":
            table.insert_if_absent(frame)
            held = {k for k, _ in want}
            want = want + [(k, f"s{step}") for k in {k for k, _ in some} - held]
        elif kind == "compact":
            table.compact()
        else:
            table.replace(frame)
            want = some
        versions[table.version()] = sorted(want)
        assert sorted(tuple(r) for r in table.read().collect()) == sorted(want)
        assert table.fingerprint().first() == quality.fingerprint(table.read(), ["k", "v"]).first()
    for v in list(versions)[::5]:
        assert sorted(tuple(r) for r in table.read(v).collect()) == versions[v]


def test_sums_that_were_not_kept_are_scanned(spark, events, table):
    plain = VersionedTable(spark, table.root, EVENT_SCHEMA, EVENT_KEY, "mes_ocorrencia", ["lsn_origem"])
    plain.append(events(rows([1, 2]) + rows([3], "2024-06")))
    table.append(events(rows([4], "2024-06")))
    with pytest.raises(ValueError):
        plain.fingerprint()
    want = {r.mes_ocorrencia: r for r in quality.fingerprint(table.read(), by=["mes_ocorrencia"]).collect()}
    assert {r.mes_ocorrencia: r for r in table.fingerprint(True).collect()} == want
    assert [tuple(r) for r in table.fingerprint(True, values=["2024-06"]).collect()] == [tuple(want["2024-06"])]
    assert open_table(spark, f"{table.root}-empty").fingerprint().first().linhas == 0


def test_no_scan_for_kept_sums(spark, events, table):
    table.append(events(rows([1, 2])))
    assert "FileScan" not in table.fingerprint(True)._jdf.queryExecution().executedPlan().toString()


def test_long_texts_are_no_statistics(spark, folder):
    table = small(spark, folder)
    texts = VersionedTable(spark, folder, SMALL, ["v"])
    texts.append(spark.createDataFrame([(1, "x" * 200), (2, None)], SMALL))
    assert "v" not in texts.commits.current()[1][0]["files"][0]["ranges"]
    assert texts.insert_if_absent(spark.createDataFrame([(3, "x" * 200)], SMALL)).inserted == 0
    assert table.read().count() == 2


def test_files_read_for_one_school_do_not_grow(spark, folder):
    """Five hundred commits of one school each: a read of one school lists the files that can hold it."""
    table = VersionedTable(spark, folder, T.StructType([T.StructField("k", T.LongType()), T.StructField("school", T.LongType())]), ["k"], statistics=["school"])
    root = folder.removeprefix("file:")
    import os

    for n in range(500):
        commit = f"c{n:032d}"
        os.makedirs(f"{root}/data/commit={commit}")
        pq.write_table(pa.table({"k": [n], "school": [n % 100]}), f"{root}/data/commit={commit}/part.parquet")
        file = {"name": "part.parquet", "rows": 1, "value": None, "ranges": {"k": [n, n], "school": [n % 100, n % 100]}}
        assert table.commits.add(n + 1, Made(commit, [file]).entry(APPEND))
    one = table.read(only={"school": (7, 7)})
    assert len(one.inputFiles()) == 5 and sorted(r.k for r in one.collect()) == [7, 107, 207, 307, 407]
    assert len(table.read(only={"k": (3, 4)}).inputFiles()) == 2 and table.read(only={"k": (999, 999)}).isEmpty()
    assert table.read().count() == 500
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryFileIndex(1 paths)") >= 1
    # An insert of new keys looks into no file at all, one of known keys into those that hold them.
    assert table.insert_if_absent(spark.createDataFrame([(1000, 1)], table.schema)).inserted == 1
    assert table.insert_if_absent(spark.createDataFrame([(3, 1), (1001, 2)], table.schema)).inserted == 1


def test_states_are_written_and_old_entries_dropped(spark, folder):
    table = small(spark, folder)
    for n in range(SNAPSHOT + 3):
        table.commits.add(n + 1, Made(f"c{n}", []).entry(APPEND))
    entries, states = table.commits._files()
    assert sorted(states) == [SNAPSHOT] and len(entries) == SNAPSHOT + 3
    table.commits.forget(0)
    entries, states = table.commits._files()
    assert sorted(entries) == [SNAPSHOT + 3] and len(table.commits.current()[1]) == SNAPSHOT + 3


def test_vacuum_spares_commits_in_flight_and_retained_versions(events, table):
    table.append(events(rows([1, 2])))
    flight = table._write(events(rows([1])))
    assert table.vacuum() == 0 and flight.rows == 1
    table.replace(events(rows([1])))
    assert table.vacuum() == 0 and table.read(1).count() == 2
    assert table.vacuum(0) == 2 and table.read().count() == 1 and [e["version"] for e in table.commits.history()] == [2]


# -- ids in ranges ---------------------------------------------------------------------------------

def test_ids_in_ranges(spark):
    rng = random.Random(8)
    ranges = [(0, 0), (5, 9), (100, 100_000_000_000), (-40, -33), (7, 8), (2**62, 2**62 + 5), (-(2**62), -(2**62) + 1)]
    ids_ = sorted({rng.choice([lo, hi, lo - 1, hi + 1, rng.randint(-60, 200), rng.randint(lo, hi)]) for lo, hi in ranges for _ in range(30)})
    frame = spark.createDataFrame([(i,) for i in [*ids_, *ids_, None]], "i long")
    found = ordered.ids_in_ranges(frame, "i", spark.createDataFrame(ranges, "lo long, hi long"))
    assert sorted(r.i for r in found.collect()) == [i for i in ids_ if any(lo <= i <= hi for lo, hi in ranges)]
    assert ordered.ids_in_ranges(frame, "i", spark.createDataFrame([], "lo long, hi long")).isEmpty()
    assert ordered.range_blocks(spark.createDataFrame([(1, 2**60)], "lo long, hi long")).count() <= 126


def test_a_monthly_plan_looks_up_items_by_the_ids_of_the_run(spark, folder):
    spark.range(1000).selectExpr("id AS vistoria_id", "'a' AS item_codigo").write.parquet(f"{folder}/items")
    heads = spark.range(100).selectExpr("id AS vistoria_id", "cast('2024-01-01' as timestamp_ntz) AS ocorrido_em", "cast('2024-01-02' as timestamp_ntz) + make_dt_interval(0, 0, cast(id as int)) AS registrado_em")
    none = spark.createDataFrame([], "lo long, hi long")
    todo = windows.plan(heads, spark.read.parquet(f"{folder}/items"), none, none, "2024-01-02 01:00:00", "2024-01-02 01:30:00")
    lines = todo.new._jdf.queryExecution().executedPlan().toString().splitlines()
    for scan in (i for i, line in enumerate(lines) if "FileScan" in line):
        above = next(x for x in reversed(lines[:scan]) if "Exchange" in x or "HashAggregate" in x or "Join" in x)
        assert "BroadcastHashJoin" in above and "LeftSemi" in above  # only the run's ids go on to be made distinct
    assert ids(todo.new) == list(range(51, 91))
