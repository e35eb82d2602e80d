"""Queries: change stream, late data, audit and recovery."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.contracts import EVENT_KEY
from ledgerlake.operators import ordered, reconcile
from ledgerlake.plans.adapter import CONTENT_TEXT, HASH64
from ledgerlake.plans.registry import query
from ledgerlake.session import work_dir
from ledgerlake.streaming import audit, drift, envelope, recovery, run, telemetry, windows
from ledgerlake.streaming.live import LiveWindows

_MARK = "2000-12-31 00:00:00"
_CLOCK = telemetry.Clock("2024-02-01 00:00:00", "2024-02-01 00:00:01.5", "2024-02-01 00:00:03", "2024-02-01 00:00:07.25")


def _enriched(lake):
    return envelope.enrich(lake.changes, lake.stream_headers)


@query("STR-05_converted_events", "SELECT * FROM delivered")
def converted_events(lake):
    return envelope.events_of(_enriched(lake))


@query("STR-05_rejected_items", "SELECT * FROM queue WHERE operacao = 'insert'")
def rejected_items(lake):
    return envelope.rejections(_enriched(lake))


@query("STR-06_insert_only_violations", "SELECT * FROM queue WHERE operacao <> 'insert'")
def insert_only_violations(lake):
    return envelope.insert_only_violations(lake.changes)


@query("JOIN-12_header_enrichment", "SELECT lsn, vistoria_id::BIGINT AS vistoria_id, co_entidade, sg_uf, ocorrido_em, registrado_em, co_entidade IS NULL AS sem_cabecalho FROM checked")
def header_enrichment(lake):
    return _enriched(lake).select(
        "lsn", "vistoria_id", "co_entidade", "sg_uf", "ocorrido_em", "registrado_em",
        F.col("_header").isNull().alias("sem_cabecalho"),
    )


@query("AGG-28_queue_reasons", "SELECT operacao, split_part(motivo, ':', 1) AS classe, count(*) AS linhas FROM queue GROUP BY ALL")
def queue_reasons(lake):
    bad = envelope.rejections(_enriched(lake)).unionByName(envelope.insert_only_violations(lake.changes))
    return envelope.reasons(bad)


_SECS = "epoch_us(TIMESTAMP '{0}')"


def _between(a: str, b: str) -> str:
    return f"({b} - {a}) / 1e6"


_RS, _RE, _CV, _WR = (f"epoch_us(TIMESTAMP '{t}')" for t in (_CLOCK.read_start, _CLOCK.read_end, _CLOCK.converted, _CLOCK.written))
_CM = "epoch_us(confirmada_em)"


@query("AGG-23_transaction_telemetry", f"""SELECT TIMESTAMP '{_CLOCK.read_start}' AS passada_em, lsn AS posicao_na_passada, lsn AS lsn_fim, confirmada_em,
    greatest({_between(_CM, _RS)}, 0) AS espera_s, {_between(_RS, _RE)} AS leitura_s, {_between(_CM, _RE)} AS atraso_de_captura_s,
    {_between(_RE, _CV)} AS conversao_s, {_between(_CV, _WR)} AS gravacao_s, {_between(_RE, _WR)} AS atraso_de_carga_s, {_between(_CM, _WR)} AS ponta_a_ponta_s,
    0::BIGINT AS vistorias, itens, atualizacoes, exclusoes, truncamentos, coalesce(rejeitados, 0) AS itens_rejeitados, d.registrado_em, d.ocorrido_em,
    NULL::VARCHAR AS desvios_de_esquema FROM
    (SELECT lsn, max(commit_ts) AS confirmada_em, count(*) FILTER (op = 'insert') AS itens, count(*) FILTER (op = 'update') AS atualizacoes,
      count(*) FILTER (op = 'delete') AS exclusoes, count(*) FILTER (op = 'truncate') AS truncamentos FROM stream GROUP BY lsn) t
    LEFT JOIN (SELECT lsn_origem AS lsn, max(registrado_em) AS registrado_em, min(ocorrido_em) AS ocorrido_em FROM delivered GROUP BY 1) d USING (lsn)
    LEFT JOIN (SELECT lsn_origem AS lsn, count(*) AS rejeitados FROM queue WHERE operacao = 'insert' GROUP BY 1) q USING (lsn)""")
def transaction_telemetry(lake):
    enriched = _enriched(lake)
    return telemetry.transaction_rows(lake.changes, envelope.events_of(enriched), envelope.rejections(enriched), _CLOCK)


@query("AGG-24_latency_summary", f"""SELECT 'espera_s' AS medida, count(*) AS amostras, round(median(x), 4) AS mediana_s, round(quantile_cont(x, 0.95), 4) AS p95_s,
    min(x) AS minimo_s, max(x) AS maximo_s FROM (SELECT greatest({_between('epoch_us(commit_ts)', _RS)}, 0) AS x FROM stream)""")
def latency_summary(lake):
    rows = lake.stream.select(F.greatest(
        F.lit(0.0), telemetry.seconds_between("commit_ts", F.lit(_CLOCK.read_start).cast("timestamp_ntz")).cast("double")
    ).alias("s"))
    out = telemetry.latency_summary(rows, [], "s").withColumn("medida", F.lit("espera_s"))
    return out.withColumns({c: F.round(c, 4) for c in ("mediana_s", "p95_s")})


_ORDER = """SELECT fluxo, count(*) AS transacoes, (SELECT count(*) FROM deliveries) - count(*) AS reentregas, count(*) FILTER (lsn_fim < l) AS inversoes_de_lsn,
    count(*) FILTER (registrado_em < r) AS inversoes_de_registro,
    coalesce(max((epoch_us(r) - epoch_us(registrado_em)) / 1e6) FILTER (registrado_em < r), 0) AS maior_inversao_de_registro_s,
    count(*) FILTER (ocorrido_em < o) AS fora_de_ordem_no_evento, count(*) FILTER (registrado_em > ocorrido_em + INTERVAL 7 DAY) AS alem_da_tolerancia
    FROM (SELECT *, max(lsn_fim) OVER w AS l, max(registrado_em) OVER w AS r, max(ocorrido_em) OVER w AS o FROM
      (SELECT * FROM deliveries QUALIFY row_number() OVER (PARTITION BY lsn_fim ORDER BY passada_em, posicao_na_passada) = 1)
      WINDOW w AS (ORDER BY passada_em, posicao_na_passada ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) GROUP BY fluxo"""


@query("WIN-11_delivery_order", _ORDER)
def delivery_order(lake):
    return telemetry.order_quality(lake.deliveries)


@query("WIN-11_delivery_order_hot_split", _ORDER)
def delivery_order_split(lake):
    """The one stream read in day chunks, as a stream over the row limit is."""
    return telemetry.order_quality(lake.deliveries, limit=100)


def _losses(period: int, margin: int) -> str:
    return f"""SELECT count(*) FILTER (record_ts <= marca - to_seconds({margin})) AS perdidas FROM
    (SELECT *, (epoch_us(commit_ts) - (SELECT min(epoch_us(commit_ts)) FROM stream)) // ({period} * 1000000) AS c FROM stream)
    JOIN (SELECT c, max(t) OVER (ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS marca FROM (
      SELECT (epoch_us(commit_ts) - (SELECT min(epoch_us(commit_ts)) FROM stream)) // ({period} * 1000000) AS c, max(record_ts) AS t FROM stream GROUP BY 1)) USING (c)"""


@query("WIN-12_reload_losses", _losses(20, 0))
def reload_losses(lake):
    return telemetry.reload_losses(lake.stream, 20, 0, "record_ts", "commit_ts")


@query("WIN-12_reload_losses_with_margin", _losses(20, 30))
def reload_losses_margin(lake):
    return telemetry.reload_losses(lake.stream, 20, 30, "record_ts", "commit_ts")


@query("STR-10_schema_drift", """SELECT anuncio, tabela, coluna, desvio FROM (SELECT event_id AS anuncio, 'vistoria_item' AS tabela,
    unnest(['quantidade', 'qtd', 'situacao', 'item_codigo']) AS coluna,
    unnest([CASE WHEN event_type = 'view' THEN 'tipo_alterado' WHEN event_type = 'error' THEN 'coluna_ausente' END,
      CASE WHEN event_type = 'error' THEN 'coluna_nova' END, NULL, CASE WHEN event_type = 'click' THEN 'coluna_ausente' END]) AS desvio FROM events) WHERE desvio IS NOT NULL""")
def schema_drift(lake):
    return drift.drift(drift.contract(lake.spark), _announced(lake))


def _announced(lake):
    """Schema announcements: retyped on views, renamed on errors, a column lost on clicks."""
    kind = F.col("event_type")
    columns = F.array(
        F.struct(F.lit("vistoria_id").alias("coluna"), F.lit("bigint").alias("tipo")),
        F.struct(F.when(kind == "click", F.lit(None)).otherwise("item_codigo").alias("coluna"), F.lit("text").alias("tipo")),
        F.struct(F.lit("situacao").alias("coluna"), F.concat(F.lit("enum_"), F.col("event_id") % 3).alias("tipo")),
        F.struct(F.when(kind == "error", "qtd").otherwise("quantidade").alias("coluna"), F.when(kind == "view", "text").otherwise("int").alias("tipo")),
    )
    table = F.when(kind != "", "vistoria_item").otherwise("fora_do_contrato").alias("tabela")
    rows = lake.table("events").select(F.col("event_id").alias("anuncio"), table, F.explode(columns).alias("c"))
    return rows.where(F.col("c.coluna").isNotNull()).select("anuncio", "tabela", "c.coluna", "c.tipo")


@query("STR-10_drift_seen", """SELECT desvio, count(*) AS vezes FROM (SELECT unnest(CASE event_type WHEN 'view' THEN ['vistoria_item.quantidade: tipo_alterado']
    WHEN 'error' THEN ['vistoria_item.quantidade: coluna_ausente', 'vistoria_item.qtd: coluna_nova']
    WHEN 'click' THEN ['vistoria_item.item_codigo: coluna_ausente'] ELSE [] END) AS desvio FROM events) GROUP BY desvio""")
def drift_seen(lake):
    found = drift.drift(drift.contract(lake.spark), _announced(lake))
    return drift.drift_seen(drift.drift_text(found))


# -- late data -----------------------------------------------------------------------------------

@query("STR-16_lateness", """SELECT vistoria_id, strftime(ocorrido_em, '%Y-%m') AS mes, round((epoch_us(registrado_em) - epoch_us(ocorrido_em)) / 86400e6, 1) AS atraso_dias,
    registrado_em <= date_trunc('month', ocorrido_em) + INTERVAL 1 MONTH + INTERVAL 7 DAY AS dentro_da_tolerancia FROM inspection""")
def lateness(lake):
    return windows.lateness(lake.inspection).select("vistoria_id", "mes", "atraso_dias", "dentro_da_tolerancia")


_NEW = f"""(SELECT * FROM inspection WHERE vistoria_id IN (SELECT vistoria_id FROM item) AND
    (registrado_em > TIMESTAMP '{_MARK}' OR (registrado_em > TIMESTAMP '{_MARK}' - INTERVAL 30 DAY AND vistoria_id % 2 <> 0) OR vistoria_id % 13 = 0))"""


def _plan(lake):
    """Mark set in the last year; half of the margin was seen, every 13th header was remembered as empty."""
    ids = lake.inspection.select("vistoria_id")
    return windows.plan(
        lake.inspection, lake.item, seen=ordered.id_ranges(ids.where(F.col("vistoria_id") % 2 == 0), [], "vistoria_id"),
        waiting=ordered.id_ranges(ids.where(F.col("vistoria_id") % 13 == 0), [], "vistoria_id"), mark=_MARK, limit="2001-12-31 00:00:00", margin_s=30 * 86400,
    )


@query("STR-12_new_since_mark", f"SELECT * FROM {_NEW}")
def new_since_mark(lake):
    return _plan(lake).new


@query("STR-13_headers_still_without_items", f"""SELECT vistoria_id FROM inspection WHERE vistoria_id NOT IN (SELECT vistoria_id FROM item)
    AND (vistoria_id % 13 = 0 OR registrado_em > TIMESTAMP '{_MARK}' - INTERVAL 30 DAY)""")
def still_without_items(lake):
    return _plan(lake).still_without_items


@query("STR-17_reopened_months", f"""SELECT strftime(ocorrido_em, '%Y-%m') AS mes, count(*) AS eventos,
    max(round((epoch_us(registrado_em) - epoch_us(ocorrido_em)) / 86400e6, 1)) AS maior_atraso_dias, TIMESTAMP '2001-12-31' AS reaberta_em FROM {_NEW}
    WHERE registrado_em > date_trunc('month', ocorrido_em) + INTERVAL 1 MONTH + INTERVAL 7 DAY GROUP BY 1""")
def reopened_months(lake):
    return windows.reopened(_plan(lake).new, "2001-12-31 00:00:00")


_MONTHS = f"""SELECT a.mes_ocorrencia AS mes, coalesce(t.n, 0) AS linhas, a.n AS linhas_na_origem, CAST(coalesce(t.h, 0) AS VARCHAR) AS impressao,
    a.h IS NOT DISTINCT FROM t.h AS confere_com_a_origem FROM
    (SELECT mes_ocorrencia, count(*) AS n, sum({HASH64.format(CONTENT_TEXT)}) AS h FROM event GROUP BY 1) a LEFT JOIN
    (SELECT mes_ocorrencia, count(*) AS n, sum({HASH64.format(CONTENT_TEXT)}) AS h FROM target GROUP BY 1) t USING (mes_ocorrencia)"""


@query("AGG-36_month_comparison", _MONTHS)
def month_comparison(lake):
    event = lake.stored("event")
    out = windows.compare_months(event, lake.planted(event))
    return out.withColumn("impressao", F.col("impressao").cast("string"))


_WHOLE = f"""SELECT mes_ocorrencia AS mes, count(*) AS linhas, count(*) AS linhas_na_origem,
    CAST(sum({HASH64.format(CONTENT_TEXT)}) AS VARCHAR) AS impressao, true AS confere_com_a_origem FROM event GROUP BY 1"""


def _table(lake, rows=None):
    tables = run.Tables.under(lake.spark, work_dir(lake.spark))
    if rows is not None:
        tables.events.insert_if_absent(rows)
    return tables


@query("STR-14_reconciled_months", _WHOLE)
def reconciled_months(lake):
    """A table that lost rows is completed month by month and agrees with the origin again."""
    stored = _table(lake, lake.stored("event").where(F.col("vistoria_id") % 101 != 0)).events
    months = [r[0] for r in lake.stored("event").select("mes_ocorrencia").distinct().collect()]
    repaired, _ = windows.reconcile(lake.stored("event"), stored, months)
    return repaired.withColumn("impressao", F.col("impressao").cast("string"))


@query("STR-15_reprocessed_months", _WHOLE + " HAVING mes_ocorrencia IN ('1999-03', '2000-11')")
def reprocessed_months(lake):
    stored = _table(lake, lake.stored("event").where(F.col("vistoria_id") % 5 != 0)).events
    windows.reprocess(lake.stored("event"), stored, ["1999-03", "2000-11"])
    again, _ = windows.reprocess(lake.stored("event"), stored, ["1999-03", "2000-11"])
    return again.withColumn("impressao", F.col("impressao").cast("string"))


@query("STR-18_control_state", """SELECT 'reopened' AS kind, count(DISTINCT strftime(ocorrido_em, '%Y-%m')) AS linhas FROM inspection
      WHERE vistoria_id IN (SELECT vistoria_id FROM item) AND registrado_em > TIMESTAMP '2001-01-01'
      AND registrado_em > date_trunc('month', ocorrido_em) + INTERVAL 1 MONTH + INTERVAL 7 DAY
    UNION ALL SELECT 'window', count(DISTINCT mes_ocorrencia) FROM event UNION ALL SELECT 'mark', 1::BIGINT
    UNION ALL SELECT 'waiting', count(*) FROM inspection WHERE vistoria_id NOT IN (SELECT vistoria_id FROM item)""")
def control_state(lake):
    """Two runs of the monthly windows: up to a mark, then the rest; what the control then holds."""
    stored = _table(lake)
    monthly = windows.MonthlyWindows(lake.spark, stored.events, work_dir(lake.spark))
    cut = F.col("registrado_em") <= F.lit("2001-01-01").cast("timestamp_ntz")
    monthly.run(lake.inspection.where(cut), lake.item, lake.stored("event").where(cut))
    monthly.run(lake.inspection, lake.item, lake.stored("event"))
    rows = monthly.control.read()
    ids = F.when(F.col("kind") == "waiting", F.col("hi") - F.col("lo") + 1).otherwise(F.lit(1).cast("bigint"))
    return rows.where(F.col("kind") != "seen").groupBy("kind").agg(F.sum(ids).alias("linhas"))


# -- delivery ------------------------------------------------------------------------------------

def _delivered(lake, tables):
    """Write the envelope as files and let one bounded streaming pass deliver them."""
    folder = work_dir(lake.spark)
    lake.changes.write.parquet(f"{folder}/envelope")
    headers = lake.stream_headers
    run.run_once(lake.spark, f"{folder}/envelope", lambda: headers, tables, f"{folder}/checkpoint")
    return folder


@query("STR-01_streamed_events", "SELECT * FROM stored")
def streamed_events(lake):
    tables = _table(lake)
    _delivered(lake, tables)
    return tables.events.read()


@query("STR-17_live_windows", """SELECT strftime(ocorrido_em, '%Y-%m') AS mes, count(*) AS linhas,
    count(*) FILTER (registrado_em > date_trunc('month', ocorrido_em) + INTERVAL 1 MONTH + INTERVAL 7 DAY) AS atrasadas FROM stored GROUP BY 1""")
def live_windows(lake):
    """Windows kept up while a stream delivers in several passes, the first of which stops before they are."""
    tables, headers, folder = _table(lake), lake.stream_headers, work_dir(lake.spark)
    live = LiveWindows(lake.spark, tables.events, f"{folder}/live")
    run.deliver(lake.changes.where(F.col("lsn") % 3 == 0), headers, tables)
    run.run_once(lake.spark, _files_by_position(lake), lambda: headers, tables, f"{folder}/checkpoint", live=live)
    return live.windows().drop("maior_atraso_dias")


def _files_by_position(lake, parts: int = 4, files: int | None = None) -> str:
    """The envelope as successive groups of files (exactly ``files`` each, if given) of rising position, as a capture would drop them."""
    path = f"{work_dir(lake.spark)}/envelope"
    top = lake.changes.agg(F.max("lsn")).first()[0] + 1
    for part in range(parts):
        low, high = part * top // parts, (part + 1) * top // parts
        group = lake.changes.where((F.col("lsn") >= low) & (F.col("lsn") < high))
        group = group.repartition(files) if files else group.repartitionByRange("lsn")
        group.write.mode("append").parquet(path)
    return path


#: Changes of a file where a pass takes a number of files.
FILE_CHANGES = 250_000


def _files_of_a_pass(lake, passes: int = 4) -> int:
    """Files that a pass takes: enough to be written in parallel, few enough that none is empty."""
    part = F.floor(F.col("lsn") * passes / lake.changes.select(F.max("lsn") + 1).scalar())
    sizes = [r["count"] for r in lake.changes.groupBy(part).count().collect()]  # one row a pass
    return max(1, min(-(-max(sizes, default=0) // FILE_CHANGES), min(sizes, default=0) // 1000))


@query("STR-02_continuous_follow", "SELECT * FROM stored")
def continuous_follow(lake):
    """A query that keeps polling, stopped once it has delivered everything that was there."""
    tables, headers = _table(lake), lake.stream_headers
    followed = run.start(
        run.source(lake.spark, _files_by_position(lake)), lambda: headers, tables, work_dir(lake.spark), every="1 second"
    )
    try:
        followed.processAllAvailable()
    finally:
        followed.stop()
    return tables.events.read()


@query("STR-04_rate_limited_passes", """SELECT 4::BIGINT AS passadas, (SELECT count(*) FROM stored) AS eventos,
    (SELECT count(*) FROM stream) AS transacoes""")
def rate_limited(lake):
    """One group of files per micro-batch: four passes, nothing lost and nothing doubled."""
    tables, headers = _table(lake), lake.stream_headers
    files = _files_of_a_pass(lake)
    run.run_once(lake.spark, _files_by_position(lake, files=files), lambda: headers, tables, work_dir(lake.spark), max_files=files)
    passes = tables.telemetry.read().agg(
        F.countDistinct("passada_em").alias("passadas"), F.countDistinct("lsn_fim").alias("transacoes")
    )
    return passes.withColumn("eventos", tables.events.read().agg(F.count("*")).scalar())


@query("STR-07_streamed_queue", "SELECT * FROM queue QUALIFY row_number() OVER (PARTITION BY lsn_origem, chave ORDER BY motivo) = 1")
def streamed_queue(lake):
    tables = _table(lake)
    _delivered(lake, tables)
    return tables.queue.read()


@query("STR-08_streamed_telemetry", """SELECT lsn AS lsn_fim, count(*) FILTER (op = 'insert') AS itens, count(*) FILTER (op = 'update') AS atualizacoes FROM stream GROUP BY lsn""")
def streamed_telemetry(lake):
    tables = _table(lake)
    _delivered(lake, tables)
    return telemetry.read_range(tables.telemetry.read()).select("lsn_fim", "itens", "atualizacoes")


@query("STR-09_drain_instants", "SELECT 1::BIGINT AS instantes, true AS depois_do_inicio, false AS no_futuro")
def drain_instants(lake):
    """The instant is the clock's: one is kept, not before the pass began and not after it was read."""
    tables = _table(lake)
    began = run.utc_now()
    _delivered(lake, tables)
    kept, ended = F.col("drenado_em"), run.utc_now()
    return run.drained_at(tables).agg(
        F.count("*").alias("instantes"), F.bool_and(kept >= F.lit(began).cast("timestamp_ntz")).alias("depois_do_inicio"),
        F.bool_or(kept > F.lit(ended).cast("timestamp_ntz")).alias("no_futuro"),
    )


@query("STR-03_redelivery", "SELECT * FROM stored")
def redelivery(lake):
    """A pass that fails after writing is delivered again and leaves one copy of everything."""
    tables = _table(lake)
    folder = work_dir(lake.spark)
    lake.changes.write.parquet(f"{folder}/envelope")
    headers = lake.stream_headers
    try:
        run.run_once(lake.spark, f"{folder}/envelope", lambda: headers, tables, f"{folder}/checkpoint", fail_after_write=True)
    except Exception:  # noqa: BLE001 - the planted failure
        pass
    run.run_once(lake.spark, f"{folder}/envelope", lambda: headers, tables, f"{folder}/checkpoint")
    return tables.events.read()


@query("STR-11_baseline_then_stream", """SELECT vistoria_id, item_codigo, CASE WHEN vistoria_id % 2 = 0 THEN NULL ELSE lsn_origem END AS lsn_origem FROM stored""")
def baseline_then_stream(lake):
    """Half of the keys come first with the baseline, so they keep its (absent) position."""
    tables = _table(lake)
    events = envelope.events_of(_enriched(lake)).where(F.col("vistoria_id") % 2 == 0)
    run.publish_baseline(tables, events.withColumn("lsn_origem", F.lit(None).cast("bigint")))
    run.publish_baseline(tables, events)
    run.deliver(lake.changes, lake.stream_headers, tables)
    return tables.events.read().select(*EVENT_KEY, "lsn_origem")


# -- audit and recovery --------------------------------------------------------------------------

def _balance_inputs(lake):
    enriched = _enriched(lake)
    events = envelope.events_of(enriched)
    rejected = envelope.rejections(enriched)
    queue = rejected.unionByName(envelope.insert_only_violations(lake.changes))
    treated = queue.where((F.col("lsn_origem") % 3 == 0) & (F.col("operacao") != "insert"))
    left = queue.where((F.col("lsn_origem") % 3 != 0) | (F.col("operacao") == "insert"))
    pending = lake.changes.where(F.col("lsn") % 500 == 0).select(F.col("op").alias("operacao"))
    return telemetry.transaction_rows(lake.changes, events, rejected, _CLOCK), events, left, pending, treated


_BALANCE = """SELECT *, lidas_do_wal - aplicadas - na_fila - tratadas AS ja_estavam FROM (SELECT o.op AS operacao, count(*) AS lidas_do_wal,
    CASE WHEN o.op = 'insert' THEN (SELECT count(*) FROM delivered) ELSE 0 END AS aplicadas,
    CASE WHEN o.op = 'insert' THEN (SELECT count(*) FROM queue WHERE operacao = 'insert') ELSE count(*) FILTER (lsn % 3 <> 0) END AS na_fila,
    count(*) FILTER (lsn % 500 = 0) AS pendentes, CASE WHEN o.op = 'insert' THEN 0 ELSE count(*) FILTER (lsn % 3 = 0) END AS tratadas
    FROM stream o GROUP BY o.op)"""


@query("AGG-27_operation_balance", _BALANCE)
def operation_balance(lake):
    rows, events, left, pending, treated = _balance_inputs(lake)
    return audit.operation_balance(rows, audit.applied_since(events, rows), left, pending, treated)


@query("STR-19_audit_report", """SELECT 'conteudo_diferente' AS violacao, count(*) AS quantidade FROM compared WHERE situacao = 'diferentes'
    UNION ALL SELECT 'sem_explicacao', count(*) FROM compared WHERE situacao = 'so_na_origem' AND vistoria_id % 2 <> 0
      AND (vistoria_id, item_codigo) NOT IN (SELECT vistoria_id, item_codigo FROM queue WHERE operacao = 'insert')
    UNION ALL SELECT 'so_no_destino', count(*) FROM compared WHERE situacao = 'so_no_destino'
    UNION ALL SELECT 'pendencias_na_fila', count(*) FROM queue WHERE lsn_origem % 3 <> 0 OR operacao = 'insert'
    UNION ALL SELECT 'desvios_do_insert_only', count(*) FILTER (lsn % 3 <> 0) + count(*) FILTER (lsn % 500 = 0) FROM stream WHERE op <> 'insert'
    UNION ALL SELECT 'lsn_invertido', inversoes_de_lsn FROM (""" + _ORDER + """)
    UNION ALL SELECT 'esquema_fora_do_contrato', 2 * count(*) FILTER (event_type = 'error') + count(*) FILTER (event_type IN ('view', 'click')) FROM events
    UNION ALL SELECT 'frescor_acima_do_sla', 1::BIGINT""")
def audit_report(lake):
    rows, events, left, pending, treated = _balance_inputs(lake)
    event = lake.stored("event")
    compared = reconcile.compare(event, lake.planted(event))
    waiting = lake.item.where(F.col("vistoria_id") % 2 == 0)
    return audit.report(
        reconcile.totals(compared), reconcile.explain_missing(compared, waiting, left),
        reconcile.confirm_extras(compared, event), left,
        audit.operation_balance(rows, audit.applied_since(events, rows), left, pending, treated),
        telemetry.order_quality(lake.deliveries), drift.drift(drift.contract(lake.spark), _announced(lake)), 61.0,
    )


def _lost_queue(lake):
    """Dead letters for every event the target lost, and for some it already holds."""
    k = F.col("vistoria_id")
    return lake.item.where((k % 101 == 0) | (k % 103 == 1)).select(
        k.alias("lsn_origem"), F.concat_ws("/", F.lit("vistoria_item"), F.lit("insert"), k, "item_codigo").alias("chave"),
        F.lit("2002-01-01").cast("timestamp_ntz").alias("confirmada_em"), F.lit("vistoria_item").alias("tabela"),
        F.lit("insert").alias("operacao"), "vistoria_id", "item_codigo", F.lit("KeyError: planted").alias("motivo"),
    )


@query("STR-21_selective_replay", """SELECT vistoria_id, item_codigo, situacao, quantidade FROM event WHERE vistoria_id % 103 <> 0 OR vistoria_id % 101 = 0
    UNION ALL SELECT vistoria_id, item_codigo, situacao, quantidade + 1 FROM event WHERE vistoria_id % 103 = 0 AND vistoria_id % 101 <> 0""")
def selective_replay(lake):
    tables = _table(lake, lake.stored("target").where(F.col("vistoria_id") >= 0))
    recovery.replay(_lost_queue(lake), tables.receipts, lake.stored("event"), tables.events, "operador-01", "origem_corrigida", "2002-02-01 00:00:00")
    recovery.replay(_lost_queue(lake), tables.receipts, lake.stored("event"), tables.events, "operador-02", "origem_corrigida", "2002-03-01 00:00:00")
    return tables.events.read().select("vistoria_id", "item_codigo", "situacao", "quantidade")


@query("STR-21_replay_receipts", """SELECT vistoria_id AS lsn_origem, 'vistoria_item/insert/'||vistoria_id||'/'||item_codigo AS chave, 'operador-01' AS responsavel
    FROM item WHERE vistoria_id % 101 = 0 OR (vistoria_id % 103 = 1)""")
def replay_receipts(lake):
    tables = _table(lake, lake.stored("target").where(F.col("vistoria_id") >= 0))
    recovery.replay(_lost_queue(lake), tables.receipts, lake.stored("event"), tables.events, "operador-01", "origem_corrigida", "2002-02-01 00:00:00")
    recovery.replay(_lost_queue(lake), tables.receipts, lake.stored("event"), tables.events, "operador-02", "origem_corrigida", "2002-03-01 00:00:00")
    return tables.receipts.read().select("lsn_origem", "chave", "responsavel")


def _accepted(lake):
    """A truncate accepted over the whole table, and a header deletion accepted on one inspection."""
    tables = _table(lake, lake.stored("target"))
    entries = [
        {"lsn_origem": 1, "chave": "vistoria_item/truncate/None/None", "tabela": "vistoria_item", "operacao": "truncate", "vistoria_id": None, "item_codigo": None},
        {"lsn_origem": 2, "chave": "vistoria/delete/103/None", "tabela": "vistoria", "operacao": "delete", "vistoria_id": 103, "item_codigo": None},
    ]
    for entry in entries:
        recovery.accept(entry, tables.receipts, tables.reviewed, lake.stored("event"), tables.events.read(), "operador-01", "desvio_aceito", "2002-02-01 00:00:00")
    queue = lake.spark.createDataFrame([
        (e["lsn_origem"], e["chave"], e["tabela"], e["operacao"]) for e in entries], "lsn_origem long, chave string, tabela string, operacao string")
    return tables, queue


@query("STR-22_accepted_deviation", f"""SELECT 1::BIGINT AS lsn_origem, CAST((SELECT sum({HASH64.format(CONTENT_TEXT)}) FROM event) AS VARCHAR) AS estado_origem,
    CAST((SELECT sum({HASH64.format(CONTENT_TEXT)}) FROM target) AS VARCHAR) AS estado_delta
    UNION ALL SELECT 2, CAST((SELECT coalesce(sum({HASH64.format(CONTENT_TEXT)}), 0) FROM event WHERE vistoria_id = 103) AS VARCHAR),
    CAST((SELECT coalesce(sum({HASH64.format(CONTENT_TEXT)}), 0) FROM target WHERE vistoria_id = 103) AS VARCHAR)""")
def accepted_deviation(lake):
    tables, _ = _accepted(lake)
    return tables.receipts.read().select(
        "lsn_origem", F.col("estado_origem").cast("string").alias("estado_origem"), F.col("estado_delta").cast("string").alias("estado_delta")
    )


@query("STR-23_active_treatments", "SELECT vistoria_id, item_codigo FROM item WHERE vistoria_id = 103")
def active_treatments(lake):
    """Both sides change after the review: only the untouched header keeps its exemption."""
    tables, queue = _accepted(lake)
    changed = lake.stored("event").withColumn("quantidade", F.when(F.col("vistoria_id") == 104, -1).otherwise(F.col("quantidade")))
    return recovery.accepted_keys(queue, tables.receipts.read(), tables.reviewed.read(), changed, tables.events.read())
