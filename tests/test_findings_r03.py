"""Findings of round 3: whole results, and tasks that stay apart however well their rows compress."""

import random

import duckdb
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.contracts import EVENT_SCHEMA
from ledgerlake.operators import dashboard, history, ordered, reconcile
from ledgerlake.plans import registry, streams
from ledgerlake.plans.adapter import Lake
from ledgerlake.sources import tables as stored_tables
from ledgerlake.streaming import drift, recovery, run
from tests.conftest import event

DRIFT = "anuncio long, tabela string, coluna string, tipo string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def orders(folder, n=30):
    """Small driver tables: one inspection with two items an order."""
    con = duckdb.connect()
    for name, sql in {
        "region": "SELECT 0 AS r_regionkey, 'R' AS r_name", "nation": "SELECT 0 AS n_nationkey, 'N' AS n_name, 0 AS n_regionkey",
        "customer": "SELECT i AS c_custkey, 'C' AS c_name, 0 AS c_nationkey, 0.0::DOUBLE AS c_acctbal, 'S' AS c_mktsegment FROM range(5) r(i)",
        "orders": f"SELECT i AS o_orderkey, i % 5 AS o_custkey, 'F' AS o_orderstatus, 1.0::DOUBLE AS o_totalprice, TIMESTAMP '2000-01-01' AS o_orderdate, 'L' AS o_orderpriority FROM range({n}) r(i)",
        "lineitem": f"SELECT i AS l_orderkey, i AS l_partkey, i AS l_suppkey, l::INT AS l_linenumber, 5.0::DOUBLE AS l_quantity, 1.0::DOUBLE AS l_extendedprice, 0.05::DOUBLE AS l_discount, 0.0::DOUBLE AS l_tax, 'A' AS l_returnflag, 'F' AS l_linestatus, TIMESTAMP '2000-01-01' AS l_shipdate FROM range({n}) r(i), range(1, 3) q(l)",
    }.items():
        con.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet'")
    return str(folder)


def test_rate_limited_passes_are_counted(spark, tmp_path, monkeypatch):
    """the passes are told, and are four also where each takes several files."""
    monkeypatch.setattr(streams, "FILE_CHANGES", 1000)
    duckdb.connect().execute(f"""COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_seconds(i) AS ts, i % 97 AS user_id,
        ['view', 'click', 'error'][1 + i % 3] AS event_type, 1.0::DOUBLE AS value, '{{"k": ' || (i % 100) || '}}' AS props
        FROM range(8400) r(i)) TO '{tmp_path}/events.parquet'""")
    lake = Lake(spark, str(tmp_path))
    assert streams._files_of_a_pass(lake) == 2
    row = registry.QUERIES["STR-04_rate_limited_passes"](spark, str(tmp_path)).first()
    assert (row.passadas, row.transacoes) == (4, 8400) and row.eventos == registry.QUERIES["STR-01_streamed_events"](spark, str(tmp_path)).count()
    assert "4::BIGINT AS passadas" in registry.ORACLES["STR-04_rate_limited_passes"]


def by_full_join(expected, announced):
    known = announced.join(expected.select("tabela").distinct(), "tabela", "left_semi")
    wanted = known.select("anuncio", "tabela").distinct().join(expected, "tabela")
    both = known.join(wanted, ["anuncio", "tabela", "coluna"], "full_outer")
    kind = F.when(F.col("esperado").isNull(), "coluna_nova").when(F.col("tipo").isNull(), "coluna_ausente").when(
        (F.col("esperado") != "any") & (F.col("esperado") != F.col("tipo")), "tipo_alterado")
    return both.withColumn("desvio", kind).where("desvio IS NOT NULL").select("anuncio", "tabela", "coluna", "desvio")


def test_drift_sends_bits(spark):
    """the same drifts as by a full join, of wide contracts, repeated rows and nulls; only bits are dealt by announcement."""
    expected = spark.createDataFrame(
        [("wide", f"c{i}", "any" if i % 3 else "int") for i in range(130)] + [("t", "a", "int"), ("t", "b", "any")],
        "tabela string, coluna string, esperado string")
    rows = [(i, "wide", f"c{j}", "int" if j % 2 else "text") for i in range(3) for j in range(0, 130, 2 + i)]
    rows += [(7, "t", "a", "int"), (7, "t", "a", "int"), (7, "t", "x", "int"), (7, "t", "x", "int"), (8, "t", "a", None), (8, "t", None, "int")]
    rows += [(None, "t", "a", "int"), (None, "t", "a", "int"), (9, "else", "a", "int"), (9, None, "a", "int"), (10, "t", "y", None)]
    announced = spark.createDataFrame(rows, DRIFT)
    got = drift.drift(expected, announced)
    order = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert order(got) == order(by_full_join(expected, announced)) and len(order(got)) > 100
    plan = plan_of(got)
    assert "FullOuter" not in plan and "REPARTITION_BY_NUM" in plan


def test_reconciliation_stays_apart(spark, events):
    """Keys that compress well are not merged into a few tasks, and no side is sent to all of them."""
    origin = events([event(i, "lab", "2026-01-01", "existente", i) for i in range(1, 30)])
    target = events([event(i, "lab", "2026-01-01", "existente", i + i % 2) for i in range(5, 34)])
    assert tuple(reconcile.missing_and_unknown(target, origin).first()) == (4, 4)
    compared = reconcile.compare(origin, target)
    assert {r["situacao"]: r["count"] for r in compared.groupBy("situacao").count().collect()} == {"so_na_origem": 4, "so_no_destino": 4, "iguais": 12, "diferentes": 13}
    assert reconcile.confirm_extras(compared, origin).count() == 4
    for df in (reconcile.missing_and_unknown(target, origin), compared, reconcile.confirm_extras(compared, origin)):
        assert "REPARTITION_BY_NUM" in plan_of(df) and "BroadcastHashJoin" not in plan_of(df)


def test_reviewed_keys_are_not_broadcast(spark, events):
    """a receipt for a truncate reviews a whole table, which is neither sent to every task nor dealt by receipt."""
    side = events([event(i, "lab", "2026-01-01", "existente", i) for i in range(1, 30)])
    entry = {"lsn_origem": 1, "chave": "t", "tabela": "vistoria_item", "operacao": "truncate", "vistoria_id": None, "item_codigo": None}
    receipts = recovery.acceptance(entry, side, side, "operador-01", "aceito", "2026-01-01")
    reviewed, letters = recovery.reviewed_keys(entry, side, side), spark.createDataFrame([(1, "t")], "lsn_origem long, chave string")
    live = recovery.accepted_keys(letters, receipts, reviewed, side, side)
    assert live.count() == 29
    assert recovery.accepted_keys(letters, receipts, reviewed, side.where("vistoria_id > 1"), side).isEmpty()
    plan = plan_of(live)
    assert "BroadcastHashJoin [vistoria_id" not in plan and "REPARTITION_BY_NUM" in plan


def test_target_is_read_off_the_stored_events(spark, tmp_path):
    """the events are built once for both tables, and the target has the same rows."""
    lake = Lake(spark, orders(tmp_path))
    got = lake.stored("target")
    assert "event" in lake._stored
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, Lake(spark, str(tmp_path)).target.collect()), key=repr)


def test_replay_reads_the_origin_once(spark, events, folder, monkeypatch):
    """with few keys and with many, the same receipts; few are sent to the stored rows."""

    origin = events([event(i, "lab", "2026-01-01", "existente", i) for i in range(1, 30)])
    letters = spark.createDataFrame([(i, f"k{i}", None, "vistoria_item", "insert", i, "lab", "m") for i in range(20, 40)],
        "lsn_origem long, chave string, confirmada_em timestamp_ntz, tabela string, operacao string, vistoria_id long, item_codigo string, motivo string")
    for n, most in enumerate((0, 1000)):
        monkeypatch.setattr(recovery, "FEW_KEYS", most)
        tables = run.Tables.under(spark, f"{folder}/{n}")
        tables.events.append(origin.where("vistoria_id < 25"))
        done = recovery.replay(letters, tables.receipts, origin, tables.events, "operador-01", "m", "2026-01-01")
        assert done == recovery.ReplayCounts(recovered=10, already_treated=0, pending=10, read=10)
        assert tables.events.read().count() == 29
    wanted = origin.where("vistoria_id < 3")
    assert "BroadcastExchange" in plan_of(recovery._among(origin.repartition(3), wanted, True))


def test_lines_are_dealt_before_they_are_sorted(spark, tmp_path):
    """One sort of the lines, after the exchange; none of a whole file before it."""
    lines = Lake(spark, orders(tmp_path)).lines
    assert lines.count() == 60
    plan = plan_of(lines)
    assert "partial_min" not in plan.split("Exchange", 1)[1]


def test_file_statistics_sort_no_rows(spark):
    """least and greatest texts of few groups are kept in a hash map."""
    rows = spark.createDataFrame([(i % 3, f"t{i}") for i in range(50)], "f int, t string")
    wanted = [F.min("t").alias("low"), F.max("t").alias("high")]
    assert "Sort" in plan_of(rows.groupBy("f").agg(*wanted))
    got = rows.groupBy("f").agg(*wanted, *stored_tables._by_hash(["t"]))
    assert "Sort" not in plan_of(got).replace("SortAggregateFallback", "") and got.drop("_copies_held").count() == 3


def test_hot_history_is_one_scan(spark, events):
    """the steps one by one and the one scan give the same changes, with NULLs, repeated rows and chunks that hand on state."""
    rnd = random.Random(7)
    states, rows = ["existente", "existente", "inexistente", "em_obra", "nao_informado"], []
    for i in range(400):
        day = f"2026-01-{rnd.randint(1, 9):02d} {rnd.randint(0, 3):02d}:00:00"
        rows.append(event(i, rnd.choice(["lab", "gym"]), day, rnd.choice(states), rnd.choice([None, None, 1, 2]), school=rnd.choice([1, 1, 1, 2, 3])))
    rows += rows[:20]
    # Without an instant, an item or a school.
    for i, column in enumerate((5, 1, 2, 5, 5)):
        row = list(event(900 + i, "lab", f"2026-01-0{i + 1}", "existente", i))
        row[column] = None
        rows.append(tuple(row))
    df = spark.createDataFrame(rows, T.StructType([T.StructField(f.name, f.dataType) for f in EVENT_SCHEMA]))
    hot = history.hot_entities(df, 120)
    assert hot.count() == 1
    known = history.known_states(df, hot)
    runs = history.state_runs(known, True)
    by_step = history.validity(history.changes_only(history.quantity_in_force(runs, True), True), True)
    got = history.item_change(df, hot)
    in_order = lambda x: sorted((tuple(r) for r in x.select(by_step.columns).collect()), key=repr)
    assert in_order(got) == in_order(by_step) and got.count() > 100
    # A step dealt out its rows once for the scan and once more for the borders, and the plain path sees the same history.
    dated = df.where("ocorrido_em IS NOT NULL")
    split, plain = history.item_change(dated, hot), history.item_change(dated)
    shown = lambda x, is_hot: sorted(map(repr, history.dim_profile(x, ["lab", "gym"], is_hot).collect()))
    assert shown(split, True) == shown(plain, False)
    scan = plan_of(history.changes_by_chunk(ordered.apart(known, ["co_entidade", "item_codigo"])[0]))
    assert "SortAggregate" not in scan and scan.count("REPARTITION_BY_COL") == scan.count("Scan ExistingRDD")


def test_hot_steps_write_two_checkpoints(spark, events, monkeypatch):
    """rows of hot entities are fixed when they are known and when their changes are; not after each step."""
    df = events([event(i, "lab", f"2026-01-{i % 9 + 1:02d}", "existente", i % 3) for i in range(90)])
    hot, settled, settle = history.hot_entities(df, 30), [], ordered.settle
    monkeypatch.setattr(ordered, "settle", lambda rows, is_hot: settled.append(is_hot) or settle(rows, is_hot))
    history.dim_profile(history.item_change(df, hot), ["lab"], True)
    assert settled.count(True) == 2


def test_exam_builds_profiles_once(spark, tmp_path):
    """the exam reads stored profiles for its lookup, its join and its schools, and finds what all of them would give."""
    lake, whole = Lake(spark, orders(tmp_path, 300)), Lake(spark, str(tmp_path))
    assert "l_discount" not in plan_of(lake.census_beside_exam) and "profile_of_exam" in lake._stored
    exam = dashboard.exam_base(whole.performance, whole.dim_school, whole.profile)
    as_text = lambda df: sorted(map(repr, df.select(sorted(df.columns)).collect()))
    assert as_text(lake.exam_at) == as_text(exam) and lake.exam_at.where("perfil IS NOT NULL").count() > 0
    assert as_text(lake.exam_slice) == as_text(dashboard.exam_slice(exam, whole.census_at))
    assert as_text(lake.census_beside_exam) == as_text(whole.census_at)


def test_undated_versions_stay_with_the_exam(spark, tmp_path):
    """a version without a start is found by the lookup where no later one begins before the reference."""
    folder = orders(tmp_path, 300)
    duckdb.connect().execute(f"""COPY (SELECT * REPLACE (CASE WHEN o_custkey < 2 THEN NULL WHEN o_custkey = 2 THEN TIMESTAMP '2001-07-01' ELSE o_orderdate END AS o_orderdate)
        FROM '{folder}/orders.parquet') TO '{folder}/dated.parquet'""")
    lake, whole = Lake(spark, folder), Lake(spark, folder)
    for x in (lake, whole):
        x.table = lambda name, read=x.table: read("dated" if name == "orders" else name)
    as_text = lambda df: sorted(map(repr, df.select(sorted(df.columns)).collect()))
    wanted = dashboard.exam_base(whole.performance, whole.dim_school, whole.profile)
    assert as_text(lake.exam_at) == as_text(wanted) and wanted.where("co_entidade < 2 AND perfil IS NOT NULL").count() > 0


def test_kpis_read_the_exam_once(spark):
    """one subquery gives all figures of the exam."""
    census = spark.createDataFrame([(1, 5), (2, None)], "co_entidade long, perfil long")
    exam = spark.createDataFrame([(1, 7, 3.0), (None, 2, None)], "perfil long, n_participantes long, media_geral double")
    got = dashboard.kpis(census, exam)
    assert tuple(got.first()) == (2, 1, 2, 9, 1, 1) and got.columns == ["censo", "perfis_censo", "enem", "participantes", "perfis_enem", "escolas_sem_nota"]
    assert got._jdf.queryExecution().analyzed().toString().count("scalar-subquery") == 1
    assert tuple(dashboard.kpis(census.limit(0), exam.limit(0)).first()) == (0, 0, 0, 0, 0, 0)
