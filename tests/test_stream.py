"""Change stream: conversion, quarantine, delivery, telemetry, audit and recovery."""

import datetime as dt
import os
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ledgerlake.contracts import INSERT_ONLY_REASON
from ledgerlake.operators import privacy, quality, reconcile
from ledgerlake.streaming import audit, drift, envelope, freshness, recovery, run, telemetry
from ledgerlake.streaming.live import LiveWindows
from tests.conftest import at, event

HEADERS = "vistoria_id long, co_entidade long, sg_uf string, origem string, ocorrido_em timestamp_ntz, registrado_em timestamp_ntz"


@pytest.fixture
def headers(spark):
    return spark.createDataFrame(
        [(9, 1, "DF", "vistoria_presencial", at("2026-01-10"), at("2026-01-11")),
         (10, 1, "DF", "vistoria_presencial", None, at("2026-01-11"))], HEADERS)


def change(lsn, values, op="insert", table="vistoria_item", seq=None):
    return (lsn, lsn if seq is None else seq, at("2026-01-12"), table, op, values)


def item(id="9", code="lab", state="existente", quantity=None):
    return {"vistoria_id": id, "item_codigo": code, "situacao": state, "quantidade": quantity}


BAD = [
    (item(quantity="muitos"), "ValueError"), (item(state=None), "ValueError"), (item(id="77"), "KeyError"),
    (item(quantity=str(2**40)), "OverflowError"), ({"vistoria_id": "9", "item_codigo": "lab", "situacao": "existente"}, "KeyError"),
    (item(id="10"), "ValueError"), (item(id="nove"), "ValueError"), ({"item_codigo": "lab"}, "KeyError"),
]


def test_bad_rows_are_quarantined_and_neighbours_survive(spark, headers):
    rows = [change(1, item(quantity="3"))] + [change(2 + i, v) for i, (v, _) in enumerate(BAD)] + [change(50, item(code="bib"))]
    enriched = envelope.enrich(spark.createDataFrame(rows, envelope.ENVELOPE_SCHEMA), headers)
    good = envelope.events_of(enriched).orderBy("lsn_origem").collect()
    assert [(r.lsn_origem, r.item_codigo, r.quantidade, r.mes_ocorrencia) for r in good] == [
        (1, "lab", 3, "2026-01"), (50, "bib", None, "2026-01")]
    bad = envelope.rejections(enriched).orderBy("lsn_origem").collect()
    assert [r.motivo.split(":")[0] for r in bad] == [kind for _, kind in BAD]
    assert bad[2].chave == "vistoria_item/insert/77/lab" and bad[6].vistoria_id is None
    assert all(len(r.motivo) <= 200 for r in bad)


def test_violations_carry_keys_and_nothing_else(spark):
    rows = [
        change(1, item(code="quadra"), "update"),
        change(2, {"id": "7", "observacao": "private text"}, "delete", "vistoria"), change(3, None, "truncate"),
    ]
    got = envelope.insert_only_violations(spark.createDataFrame(rows, envelope.ENVELOPE_SCHEMA)).orderBy("lsn_origem").collect()
    assert [r.chave for r in got] == ["vistoria_item/update/9/quadra", "vistoria/delete/7/None", "vistoria_item/truncate/None/None"]
    assert {r.motivo for r in got} == {INSERT_ONLY_REASON}
    assert "private" not in str(got)


def test_streamed_delivery_survives_a_crash(spark, headers, folder):
    rows = [change(1, item()), change(2, item()), change(3, item(id="77")), change(4, item(), "update")]
    spark.createDataFrame(rows, envelope.ENVELOPE_SCHEMA).write.parquet(f"{folder}/in")
    tables = run.Tables.under(spark, f"{folder}/lake")
    args = (spark, f"{folder}/in", lambda: headers, tables, f"{folder}/ck")
    with pytest.raises(Exception):
        run.run_once(*args, fail_after_write=True)
    assert tables.events.read().count() == 1 and tables.freshness.is_empty()
    run.run_once(*args)
    assert [(r.vistoria_id, r.lsn_origem) for r in tables.events.read().collect()] == [(9, 1)]
    assert tables.queue.read().count() == 2
    # The pass was logged twice; reports read the last row of a position.
    assert tables.telemetry.read().select("lsn_fim").distinct().count() == 4
    assert run.drained_at(tables).count() == 1
    # A new file arrives: only it is delivered.
    spark.createDataFrame([change(9, item(code="bib"))], envelope.ENVELOPE_SCHEMA).write.mode("append").parquet(f"{folder}/in")
    run.run_once(*args, max_files=1)
    assert tables.events.read().count() == 2


def test_passes_are_bounded_by_bytes(spark, headers, folder):
    """A thousand small files and one large one: no pass takes much more than the limit, nothing is lost."""
    import pyarrow.parquet as pq

    path = folder.removeprefix("file:")
    one = spark.createDataFrame([change(1, item())], envelope.ENVELOPE_SCHEMA).coalesce(1)
    one.write.parquet(f"{folder}/one")
    table = pq.read_table(f"{path}/one")
    os.makedirs(f"{path}/in")
    for n in range(1000):
        lsn = table.schema.get_field_index("lsn")
        pq.write_table(table.set_column(lsn, table.schema.field("lsn"), [[n]]), f"{path}/in/small{n:04d}.parquet")
    small = os.path.getsize(f"{path}/in/small0000.parquet")
    spark.range(20_000).selectExpr("id + 1000 AS lsn").createOrReplaceTempView("_many")
    big = spark.sql("SELECT lsn, 0L AS seq, timestamp_ntz'2026-01-01' AS commit_ts, 'vistoria' AS tabela, 'update' AS op, map('id', uuid()) AS valores FROM _many")
    big.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    sizes = []
    query = run.source(spark, f"{folder}/in", max_bytes=250 * small).writeStream.foreachBatch(lambda df, _: sizes.append(df.count()))
    query.option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start().awaitTermination()
    assert sum(sizes) == 21_000 and len(sizes) >= 5
    assert sorted(x for x in sizes if x < 20_000)[-1] <= 251 and sum(x >= 20_000 for x in sizes) == 1
    with pytest.raises(ValueError):
        run.source(spark, folder, 1, 1)


def test_nothing_stays_cached_after_many_batches(spark, headers, folder, monkeypatch):
    """Twenty batches, one of them failing while it writes: every frame that a batch held is released."""
    held = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    tables, before = run.Tables.under(spark, folder), held()
    cached = lambda: spark._jsparkSession.sharedState().cacheManager().isEmpty()
    was = cached()
    for n in range(20):
        changes = spark.createDataFrame([change(n, item())], envelope.ENVELOPE_SCHEMA)
        if n == 7:
            with monkeypatch.context() as m:
                m.setattr(type(tables.events), "_write", lambda *a: (_ for _ in ()).throw(OSError("disk")))
                with pytest.raises(OSError):
                    run.deliver(changes, headers, tables)
        else:
            run.deliver(changes, headers, tables)
    assert held() <= before and cached() == was


def test_live_windows_over_crashes_late_rows_and_repeats(spark, folder):
    """A crash before the windows moved, a late row, a repeated file and a compaction, each followed by a restart."""
    headers = spark.createDataFrame(
        [(9, 1, "DF", "vistoria_presencial", at("2026-01-10"), at("2026-01-11")), (10, 1, "DF", "vistoria_presencial", at("2026-01-20"), at("2026-01-21")),
         (11, 1, "DF", "vistoria_presencial", at("2026-01-05"), at("2026-04-05"))], HEADERS)
    tables = run.Tables.under(spark, f"{folder}/lake")

    def drop(*changes):
        spark.createDataFrame(list(changes), envelope.ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def go(**how):
        live = LiveWindows(spark, run.Tables.under(spark, f"{folder}/lake").events, f"{folder}/live")
        run.run_once(spark, f"{folder}/in", lambda: headers, tables, f"{folder}/ck", live=live, **how)
        return live

    drop(change(1, item()))
    with pytest.raises(Exception):
        go(fail_after_write=True)
    assert LiveWindows(spark, tables.events, f"{folder}/live").mark() == 0 and tables.events.read().count() == 1
    live = go()
    assert [tuple(r) for r in live.windows().collect()] == [("2026-01", 1, 0, None)] and live.reopenings().isEmpty()
    drop(change(2, item(id="10")), change(3, item(id="11")))
    live = go()
    assert [tuple(r) for r in live.windows().collect()] == [("2026-01", 3, 1, 90.0)]
    again = [("2026-01", 1, 90.0, at("2026-04-05"))]
    assert [tuple(r)[1:] for r in live.reopenings().collect()] == again
    drop(change(2, item(id="10")), change(3, item(id="11")))  # delivered again: nothing is written, nothing moves
    before = tables.events.version()
    live = go()
    assert tables.events.version() == before and [tuple(r) for r in live.windows().collect()] == [("2026-01", 3, 1, 90.0)]
    tables.events.compact()
    assert live.catch_up().after == before + 1 and live.catch_up().before == before + 1
    assert [tuple(r) for r in live.windows().collect()] == [("2026-01", 3, 1, 90.0)] and [tuple(r)[1:] for r in live.reopenings().collect()] == again
    # A replaced content, or entries that retention dropped, are counted anew.
    tables.events.replace(tables.events.read().where("vistoria_id < 11"))
    assert live.catch_up().rebuilt and [r.linhas for r in live.windows().collect()] == [2]


def test_two_processes_take_in_each_commit_once(spark, events, folder):
    tables = run.Tables.under(spark, f"{folder}/lake")
    for n in range(3):
        tables.events.append(events([event(n, "lab", f"2026-0{n + 1}-10", "existente")]))
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda _: LiveWindows(spark, tables.events, f"{folder}/live").catch_up(), range(2)))
    live = LiveWindows(spark, tables.events, f"{folder}/live")
    assert sorted((r.mes, r.linhas) for r in live.windows().collect()) == [(f"2026-0{n}", 1) for n in (1, 2, 3)] and live.mark() == 3


def test_the_drain_instant_never_goes_back(spark, folder):
    tables = run.Tables.under(spark, folder)
    for instant in ("2026-01-02 00:00:00", "2026-01-01 00:00:00"):
        run.drained(tables, instant)
    assert run.drained_at(tables).collect() == [(at("2026-01-02"),)]


def test_telemetry_failure_does_not_block(spark, headers, folder, monkeypatch):
    tables = run.Tables.under(spark, folder)
    monkeypatch.setattr(telemetry, "transaction_rows", lambda *a: (_ for _ in ()).throw(OSError("disk")))
    done = run.deliver(spark.createDataFrame([change(1, item())], envelope.ENVELOPE_SCHEMA), headers, tables)
    assert done.inserted == 1


def test_baseline_is_loaded_once(spark, events, folder):
    tables = run.Tables.under(spark, folder)
    rows = events([event(1, "lab", "2026-01-01", "existente")])
    assert run.publish_baseline(tables, rows).inserted == 1
    assert run.publish_baseline(tables, rows).received == 0
    assert run.publish_baseline(tables, rows, force=True).discarded == 1


def order_fold(rows, tolerance):
    """Delivery order read one arrival at a time; rows are (lsn, recorded, occurred)."""
    firsts, out = {}, {"again": 0, "lsn": 0, "recorded": 0, "widest": 0.0, "occurred": 0, "late": 0}
    for lsn, recorded, occurred in rows:
        if lsn in firsts:
            out["again"] += 1
        else:
            firsts[lsn] = (recorded, occurred if recorded else None)
    top_lsn = top_recorded = top_occurred = None
    for lsn, (recorded, occurred) in firsts.items():
        out["lsn"] += top_lsn is not None and lsn < top_lsn
        if recorded:
            if top_recorded and recorded < top_recorded:
                out["recorded"] += 1
                out["widest"] = max(out["widest"], (top_recorded - recorded).total_seconds())
            out["occurred"] += bool(top_occurred and occurred < top_occurred)
            out["late"] += recorded > occurred + tolerance
            top_recorded, top_occurred = max(top_recorded or recorded, recorded), max(top_occurred or occurred, occurred)
        top_lsn = lsn if top_lsn is None else max(top_lsn, lsn)
    return {"n": len(firsts), **out}


@pytest.mark.parametrize("limit", [10**6, 1, 7])
@pytest.mark.parametrize("seed", [1, 2])
def test_order_quality_equals_the_fold(spark, limit, seed):
    rng = random.Random(seed)
    begin, rows = at("2031-07-01"), []
    for n in range(40):
        lsn = rng.choice([n, n, n - 3, n // 2])
        recorded = begin + dt.timedelta(seconds=n * 60 + rng.randrange(-200, 200)) if lsn % 5 else None
        rows.append((lsn, recorded, recorded and recorded - dt.timedelta(days=rng.choice([0, 0, 1, 30]), seconds=rng.randrange(90))))
    data = [("f", begin, i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "fluxo string, passada_em timestamp_ntz, posicao_na_passada long, lsn_fim long, "
                                     "registrado_em timestamp_ntz, ocorrido_em timestamp_ntz")
    r = telemetry.order_quality(df, limit=limit, tolerance_days=7).first()
    got = {"n": r.transacoes, "again": r.reentregas, "lsn": r.inversoes_de_lsn, "recorded": r.inversoes_de_registro,
           "widest": r.maior_inversao_de_registro_s, "occurred": r.fora_de_ordem_no_evento, "late": r.alem_da_tolerancia}
    assert got == order_fold(rows, dt.timedelta(days=7))


def _losses(spark, pairs, period, margin):
    base = F.lit("2026-01-01").cast("timestamp_ntz")
    sec = lambda c: base + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col(c).cast("decimal(18,6)"))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "r double, c double").select(
        sec("r").alias("registrado_em"), sec("c").alias("confirmada_em"))
    return telemetry.reload_losses(df, period, margin).first().perdidas


@pytest.mark.parametrize("seed", [4, 5])
def test_reload_losses_equal_the_fold(spark, seed):
    rng = random.Random(seed)
    pairs = [(max(0.0, t - rng.random() * 9), t) for t in (rng.randrange(200) / 2 for _ in range(80))]
    mark, lost, start = None, 0, min(c for _, c in pairs)
    for cycle in sorted({int((c - start) // 3) for _, c in pairs}):
        here = [r for r, c in pairs if int((c - start) // 3) == cycle]
        seen = [r for r in here if mark is None or r > mark - 1]
        lost += len(here) - len(seen)
        mark = max([*seen, *([] if mark is None else [mark])], default=mark)
    assert _losses(spark, pairs, 3, 1) == lost > 0


def test_latency_summary(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "s double")
    row = telemetry.latency_summary(df, [], "s").first()
    assert (row.amostras, row.mediana_s, round(row.p95_s, 6), row.minimo_s, row.maximo_s) == (3, 2.0, 2.9, 1.0, 3.0)
    assert telemetry.latency_summary(df.limit(1), [], "s").isEmpty()


def test_balance_equals_the_fold(spark):
    """Read = last row of each position; queued, pending and treated as given; the rest was there already."""
    rng = random.Random(21)
    ops = ("insert", "update", "delete", "truncate")
    passes = [(lsn, [rng.randrange(6) for _ in ops]) for lsn in range(100, 112) for _ in range(rng.choice([1, 1, 2]))]
    full = [(at("2031-07-01"), i, lsn, *counts) for i, (lsn, counts) in enumerate(passes)]
    seen = spark.createDataFrame(full, "passada_em timestamp_ntz, posicao_na_passada long, lsn_fim long, itens long, "
                                       "atualizacoes long, exclusoes long, truncamentos long")
    last = {lsn: dict(zip(ops, counts, strict=True)) for lsn, counts in passes}
    letters = [(rng.randrange(100, 112), rng.choice(ops)) for _ in range(30)]
    queued, treated = letters[:18], letters[18:]
    waiting = [rng.choice(ops) for _ in range(9)]
    entry = "lsn_origem long, operacao string"
    out = audit.operation_balance(
        seen, spark.range(1).selectExpr("cast(11 as bigint) aplicadas"), spark.createDataFrame(queued, entry),
        spark.createDataFrame([(o,) for o in waiting], "operacao string"), spark.createDataFrame(treated, entry))
    for r in out.collect():
        op = r.operacao
        read, applied = sum(c[op] for c in last.values()), 11 if op == "insert" else 0
        done = 0
        for lsn in {n for n, o in treated if o == op}:
            n = treated.count((lsn, op))
            # Several changes of one key share an entry: with nothing left in the queue, all of them are treated.
            done += n if op == "insert" else last[lsn][op] if (lsn, op) not in queued else min(n, last[lsn][op])
        in_queue = sum(o == op for _, o in queued)
        rest = read - applied - in_queue - (0 if op == "insert" else done)
        assert tuple(r)[1:] == (read, applied, in_queue, waiting.count(op), done, rest), op


def test_drift(spark):
    def kinds(columns, table="vistoria_item"):
        df = spark.createDataFrame([(1, table, c, t) for c, t in columns.items()], "anuncio long, tabela string, coluna string, tipo string")
        return {(r.coluna, r.desvio) for r in drift.drift(drift.contract(spark), df).collect()}

    good = {"vistoria_id": "bigint", "item_codigo": "text", "situacao": "enum_7", "quantidade": "int"}
    assert kinds(good) == set()
    assert kinds({**good, "extra": "int"}) == {("extra", "coluna_nova")}
    assert kinds({k: v for k, v in good.items() if k != "quantidade"} | {"qtd": "int"}) == {("qtd", "coluna_nova"), ("quantidade", "coluna_ausente")}
    assert kinds({**good, "quantidade": "text"}) == {("quantidade", "tipo_alterado")}
    assert kinds({"x": "int"}, "other") == set()


def test_freshness(spark):
    def measure(rows, **kw):
        df = spark.createDataFrame([(i, at(t)) for i, t in enumerate(rows)], "vistoria_id long, registrado_em timestamp_ntz")
        r = freshness.measure(df, "2026-01-02 12:00:00", **kw).first()
        return r.vistorias_pendentes, r.frescor_s, r.dentro_do_sla

    assert measure([]) == (0, 0.0, True)
    assert measure(["2026-01-02 10:00:00", "2026-01-02 11:00:00"]) == (2, 7200.0, True)
    assert measure(["2026-01-01 11:00:00"]) == (1, 90000.0, True)
    assert measure(["2026-01-01 10:59:59"]) == (1, 90001.0, False)
    assert measure([], built=False) == (None, None, False)
    assert measure(["2026-01-02 13:00:00"]) == (1, 0.0, True)


def test_replay_and_acceptance(spark, events, folder):
    tables = run.Tables.under(spark, folder)
    origin = events([event(1, "lab", "2026-01-01", "existente", 2), event(2, "lab", "2026-02-01", "existente"), event(3, "lab", "2026-02-01", "existente")])
    # Key 2 is stored with other content; key 3 is stored under another month.
    tables.events.append(events([event(2, "lab", "2026-02-01", "inexistente"), event(3, "lab", "2026-02-01", "existente")]))
    queue = spark.createDataFrame(
        [(10 + i, f"vistoria_item/insert/{i}/lab", at("2026-03-01"), "vistoria_item", "insert", i, "lab", "KeyError: x") for i in (1, 2, 3, 4)] * 2,
        envelope.DLQ_SCHEMA)
    args = (queue, tables.receipts, origin, tables.events, "operador-01", "origem_corrigida", "2026-03-02 00:00:00")
    assert recovery.replay(*args) == recovery.ReplayCounts(recovered=2, already_treated=0, pending=2, read=3)
    assert recovery.replay(*args) == recovery.ReplayCounts(recovered=0, already_treated=2, pending=2, read=1)
    assert tables.events.read().where("vistoria_id = 1").first().lsn_origem == 11

    entry = {"lsn_origem": 50, "chave": "vistoria/update/2/None", "tabela": "vistoria", "operacao": "update", "vistoria_id": 2, "item_codigo": None}
    letters = spark.createDataFrame([(50, entry["chave"])], "lsn_origem long, chave string")
    take = lambda: recovery.accept(entry, tables.receipts, tables.reviewed, origin, tables.events.read(), "operador-01", "aceito", "2026-03-03 00:00:00")
    assert take() is True and take() is False
    live = lambda o: recovery.accepted_keys(letters, tables.receipts.read(), tables.reviewed.read(), o, tables.events.read())
    assert [r.vistoria_id for r in live(origin).collect()] == [2]
    moved = origin.withColumn("quantidade", F.lit(9))
    assert live(moved).isEmpty()
    compared = reconcile.compare(origin, tables.events.read())
    assert {r.situacao for r in compared.collect()} == {"iguais", "diferentes"}
    assert {r.situacao for r in reconcile.without_accepted(compared, live(origin)).collect()} == {"iguais"}
    with pytest.raises(ValueError):
        recovery.acceptance({**entry, "operacao": "insert"}, origin, origin, "operador-01", "m", "2026-01-01")
    for operator, reason in (("Ana", "m"), ("operador-1", "m"), ("operador-01", " ")):
        with pytest.raises(ValueError):
            recovery.acceptance(entry, origin, origin, operator, reason, "2026-01-01")


def test_pseudonymization(spark):
    staff = spark.createDataFrame([(1, "Ana", "M1", True), (2, "Bia", "M2", True)], "id long, nome string, matricula string, ativo boolean")
    asked = spark.createDataFrame([("M1",), ("M9",)], "matricula string")
    visits = spark.createDataFrame([(1,), (1,), (2,)], "tecnico_id long")
    after = privacy.pseudonymize(staff, asked)
    assert {tuple(r) for r in after.collect()} == {(1, "Técnico anonimizado", "anonimizado-1", False), (2, "Bia", "M2", True)}
    assert [tuple(r) for r in privacy.pseudonymized(staff, asked, visits).collect()] == [(1, 2)]
    assert privacy.pseudonymized(after, asked, visits).isEmpty()
    assert privacy.check_requests(spark.createDataFrame([("anonimizado-1",), ("",), ("M1",)], "matricula string")).count() == 2


def test_private_columns_never_pass(spark, events):
    df = events([event(1, "lab", "2026-01-01", "existente")]).withColumn("tecnico_id", F.lit(5))
    from ledgerlake.contracts import EVENT_CONTENT

    assert quality.leaked_columns(df, [*EVENT_CONTENT, "lsn_origem"]) == ["tecnico_id"]
    assert "tecnico_id" not in quality.allowed_columns(df, EVENT_CONTENT).columns


def test_invalid_instants_stop_a_publication(spark):
    bad = spark.createDataFrame([(i, t) for i, t in enumerate(["-infinity", "infinity", "2024-01-01", "12024-01-01", None])], "id long, t string")
    with pytest.raises(ValueError, match="4 inspections"):
        quality.guard_instants(bad, "id", "t")
    quality.guard_instants(bad.where("id = 2"), "id", "t")
