"""Queries: data checks, reconciliation, set comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.contracts import EVENT_CONTENT, EVENT_KEY
from ledgerlake.operators import privacy, quality, reconcile
from ledgerlake.plans.adapter import CONTENT_TEXT, HASH64, LAST_YEAR
from ledgerlake.plans.registry import query
from ledgerlake.streaming import freshness

_CONTENT = ("vistoria_id", "item_codigo", "situacao", "quantidade")


@query("DQ-01_unique_and_not_null", """SELECT 'unico_item' AS teste, count(*) AS falhas FROM (SELECT 1 FROM target GROUP BY vistoria_id, item_codigo HAVING count(*) > 1)
    UNION ALL SELECT 'unico_escola', count(*) FROM (SELECT co_entidade FROM event GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'quantidade_nula', count(*) FROM event WHERE quantidade IS NULL
    UNION ALL SELECT 'situacao_nula', count(*) FROM event WHERE situacao IS NULL""")
def unique_and_not_null(lake):
    return quality.run_checks({
        "unico_item": quality.unique(lake.target, EVENT_KEY),
        "unico_escola": quality.unique(lake.event, ["co_entidade"]),
        "quantidade_nula": quality.not_null(lake.event, "quantidade"),
        "situacao_nula": quality.not_null(lake.event, "situacao"),
    })


@query("DQ-02_accepted_values", "SELECT vistoria_id, item_codigo, situacao FROM event WHERE situacao NOT IN ('existente','inexistente','nao_informado')")
def accepted_values(lake):
    return quality.accepted_values(lake.event, "situacao", ["existente", "inexistente", "nao_informado"]).select(*EVENT_KEY, "situacao")


@query("DQ-03_relationships", "SELECT vistoria_id, item_codigo, co_entidade FROM event WHERE co_entidade NOT IN (SELECT co_entidade FROM census_for_exam)")
def relationships(lake):
    return quality.orphans(lake.event, "co_entidade", lake.census_for_exam, "co_entidade").select(*EVENT_KEY, "co_entidade")


@query("JOIN-14_referential_orphans", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)")
def referential_orphans(lake):
    parts = lake.table("part").where(F.col("p_size") > 5)
    return quality.orphans(lake.table("lineitem"), "l_partkey", parts, "p_partkey").select("l_orderkey", "l_linenumber")


@query("DQ-04_one_row_per_key", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def one_row_per_key(lake):
    return quality.unique(lake.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("DQ-05_accepted_range", "SELECT co_entidade, ano, pct_existentes FROM fact_year WHERE pct_existentes < 10 OR pct_existentes > 90")
def accepted_range(lake):
    return quality.in_range(lake.fact_year, "pct_existentes", 10, 90).select("co_entidade", "ano", "pct_existentes")


@query("DQ-06_versions_are_sound", """SELECT 'sobreposicao' AS teste, count(*) AS falhas FROM profile WHERE valid_from < TIMESTAMP '2000-01-01' AND co_entidade % 3 = 0
      AND (co_entidade, valid_from) NOT IN (SELECT co_entidade, max(valid_from) FROM profile GROUP BY 1)
    UNION ALL SELECT 'uma_atual', count(DISTINCT co_entidade) FROM profile WHERE co_entidade % 5 = 0""")
def versions_are_sound(lake):
    """Versions with planted faults: some end a moment after the next one starts, some schools have no current one."""
    closed = F.col("valid_to") < F.lit("9999-01-01").cast("timestamp_ntz")
    longer = (F.col("valid_from") < F.lit("2000-01-01").cast("timestamp_ntz")) & (F.col("co_entidade") % 3 == 0) & closed
    faulty = lake.profile.withColumns({
        "valid_to": F.when(longer, F.col("valid_to") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0.000001).cast("decimal(18,6)"))).otherwise(F.col("valid_to")),
        "is_current": F.col("is_current") & (F.col("co_entidade") % 5 != 0),
    })
    return quality.run_checks({
        "sobreposicao": quality.overlaps(faulty, "co_entidade", lake.hot), "uma_atual": quality.current_count(faulty, "co_entidade"),
    })


@query("DQ-07_volume", """SELECT 'colunas_e_volume' AS teste, CASE WHEN (SELECT count(*) FROM target) <> (SELECT count(*) FROM event) THEN 1 ELSE 0 END::BIGINT AS falhas
    UNION ALL SELECT 'volume_igual', CASE WHEN (SELECT count(*) FROM item) = (SELECT count(*) FROM event) THEN 0 ELSE 1 END::BIGINT
    UNION ALL SELECT 'sem_um_item', CASE WHEN (SELECT count(*) FROM item WHERE item_codigo <> 'item_1') = (SELECT count(*) FROM event) THEN 0 ELSE 1 END::BIGINT""")
def volume(lake):
    return quality.run_checks({
        "colunas_e_volume": quality.volume(lake.target, lake.event), "volume_igual": quality.volume(lake.event, lake.item),
        "sem_um_item": quality.volume(lake.event, lake.item.where(F.col("item_codigo") != "item_1")),
    })


@query("DQ-08_share_bounds", """SELECT co_municipio, round(count(*) FILTER (situacao = 'existente') / count(*), 6) AS share FROM event
    JOIN school USING (co_entidade) GROUP BY co_municipio HAVING NOT (share > 0.33 AND share < 0.95)""")
def share_bounds(lake):
    out = quality.share_out_of_bounds(lake.event, lake.school, "co_entidade", "co_municipio", 0.33)
    return out.withColumn("share", F.round("share", 6))


@query("DQ-09_rebuild_fingerprint", f"SELECT sg_uf, count(*) AS linhas, CAST(sum({HASH64.format(CONTENT_TEXT)}) AS VARCHAR) AS impressao FROM event GROUP BY sg_uf")
def rebuild_fingerprint(lake):
    return quality.fingerprint(lake.event, by=["sg_uf"]).withColumn("impressao", F.col("impressao").cast("string"))


@query("AGG-22_table_fingerprint", f"SELECT count(*) AS linhas, CAST(sum({HASH64.format(CONTENT_TEXT)}) AS VARCHAR) AS impressao FROM event")
def table_fingerprint(lake):
    return quality.fingerprint(lake.event).withColumn("impressao", F.col("impressao").cast("string"))


@query("AGG-22_month_xor_fingerprint", f"""SELECT mes_ocorrencia, count(*) AS linhas, bit_xor(('0x'||substr(d, 1, 15))::BIGINT) AS impressao_a,
    bit_xor(('0x'||substr(d, 16, 15))::BIGINT) AS impressao_b FROM (SELECT mes_ocorrencia, md5({CONTENT_TEXT}) AS d FROM event) GROUP BY 1""")
def month_xor_fingerprint(lake):
    return quality.xor_fingerprint(lake.event, EVENT_CONTENT, ["mes_ocorrencia"])


@query("DQ-10_insert_only_violations", """SELECT vistoria_id, item_codigo, CASE WHEN t.situacao IS NULL THEN 'removida' ELSE 'alterada' END AS tipo
    FROM event e LEFT JOIN target t USING (vistoria_id, item_codigo)
    WHERE t.situacao IS NULL OR t.quantidade IS DISTINCT FROM e.quantidade""")
def insert_only(lake):
    return quality.not_insert_only(lake.event, lake.target, EVENT_KEY, _CONTENT)


@query("DQ-12_closed_history_changes", f"""SELECT co_entidade, ano, n_existentes FROM fact_year WHERE ano <= {LAST_YEAR} AND co_entidade % 50 = 0""")
def closed_history(lake):
    """Yearly facts against a copy in which some schools' closed years were altered."""
    before = lake.fact_year.select("co_entidade", "ano", "n_existentes")
    after = before.withColumn("n_existentes", F.when(F.col("co_entidade") % 50 == 0, F.col("n_existentes") + 100).otherwise(F.col("n_existentes")))
    return quality.closed_history_changes(before, after, LAST_YEAR).where(F.col("excedente") > 0).drop("excedente")


_EXCEPT = f"""(SELECT {', '.join(_CONTENT)} FROM event EXCEPT ALL SELECT {', '.join(_CONTENT)} FROM target)
    UNION ALL (SELECT {', '.join(_CONTENT)} FROM target EXCEPT ALL SELECT {', '.join(_CONTENT)} FROM event)"""


@query("SET-02_table_difference", f"SELECT count(*) AS diferencas FROM ({_EXCEPT})")
def table_difference(lake):
    return quality.difference_count(lake.event.select(*_CONTENT), lake.target.select(*_CONTENT))


@query("SET-02_multiset_difference", """SELECT l_orderkey, count(*) - 1 AS excedente FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""")
def multiset_difference(lake):
    """Repeated rows count: all order keys of the lines against each key once."""
    keys = lake.table("lineitem").select("l_orderkey")
    return quality.table_difference(keys, keys.distinct())


@query("SET-01_distinct_rows", "SELECT DISTINCT co_entidade, origem, situacao FROM event")
def distinct_rows(lake):
    return lake.event.select("co_entidade", "origem", "situacao").distinct()


@query("SET-04_union_of_years", "SELECT * FROM school_files")
def union_of_years(lake):
    from ledgerlake.sources import readers

    both = lake.school_files
    return readers.union_years([both.where(F.col("ano_censo_referencia") == y) for y in (2000, 2001)])


@query("SET-05_pending_headers_algebra", """(SELECT o_orderkey AS vistoria_id FROM orders WHERE o_orderkey % 13 = 0
    EXCEPT SELECT vistoria_id FROM event) UNION SELECT vistoria_id FROM inspection WHERE vistoria_id % 17 = 0 AND vistoria_id NOT IN (SELECT vistoria_id FROM event)""")
def pending_algebra(lake):
    heads = lake.inspection.select("vistoria_id")
    done = lake.event.select("vistoria_id").distinct()
    pending = heads.where(F.col("vistoria_id") % 13 == 0)
    empty = heads.where(F.col("vistoria_id") % 17 == 0).join(done, "vistoria_id", "left_anti")
    return pending.join(done, "vistoria_id", "left_anti").unionByName(empty).distinct()


@query("AGG-20_year_counts", """SELECT coalesce(a.ano, b.ano) AS ano, coalesce(a.n, 0) AS no_lago, coalesce(b.n, 0) AS na_origem, a.n IS NOT DISTINCT FROM b.n AS iguais FROM
    (SELECT substr(mes_ocorrencia, 1, 4) AS ano, count(*) AS n FROM target WHERE ocorrido_em >= TIMESTAMP '1996-01-01' GROUP BY 1) a
    FULL JOIN (SELECT substr(mes_ocorrencia, 1, 4) AS ano, count(*) AS n FROM event GROUP BY 1) b ON a.ano = b.ano""")
def year_counts(lake):
    year = F.substring("mes_ocorrencia", 1, 4).alias("ano")
    lake_side = lake.target.where(F.col("ocorrido_em") >= F.lit("1996-01-01").cast("timestamp_ntz")).select(year)
    return reconcile.year_counts(lake_side, lake.event.select(year), "ano")


@query("AGG-21_rows_and_keys", "SELECT count(*) AS linhas, count(DISTINCT (l_orderkey, l_linenumber)) AS chaves FROM lineitem")
def rows_and_keys(lake):
    return quality.rows_and_keys(lake.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("PRJ-10_allowed_columns", "SELECT vistoria_id, co_entidade, origem FROM inspection")
def allowed_columns(lake):
    private = lake.inspection.withColumn("tecnico_id", F.col("vistoria_id") % 100).withColumn("observacao", F.lit("x"))
    return quality.allowed_columns(private, ["vistoria_id", "co_entidade", "origem"])


@query("PRJ-11_constraint_violations", """SELECT vistoria_id, item_codigo, concat_ws(',', CASE WHEN quantidade < 10 THEN 'quantidade_nao_negativa' END,
    CASE WHEN registrado_em < ocorrido_em + INTERVAL 5 DAY THEN 'registro_depois_do_evento' END) AS regras FROM event
    WHERE quantidade < 10 OR registrado_em < ocorrido_em + INTERVAL 5 DAY""")
def constraint_violations(lake):
    """The event rules on a copy with planted faults."""
    dirty = lake.event.withColumns({
        "quantidade": F.col("quantidade") - 10, "ocorrido_em": F.col("ocorrido_em") + F.make_dt_interval(F.lit(5)),
    })
    return quality.violations(dirty, quality.event_constraints()).select(*EVENT_KEY, "regras")


@query("PRJ-11_rule_counts", """SELECT 'rede_valida' AS regra, count(*) FILTER (tp_dependencia + 1 > 4) AS falhas FROM school
    UNION ALL SELECT 'localizacao_valida', 0 FROM school GROUP BY 1 UNION ALL SELECT 'ano_do_censo_valido', count(*) FROM school""")
def rule_counts(lake):
    shifted = lake.school.withColumn("tp_dependencia", F.col("tp_dependencia") + 1)
    return quality.rule_counts(shifted, quality.registration_constraints())


@query("PRJ-12_invalid_instants", """SELECT o_orderkey AS vistoria_id, CASE o_orderkey % 3 WHEN 0 THEN 'infinity' WHEN 1 THEN '12024-01-01 00:00:00'
    ELSE '2024-13-01 00:00:00' END AS texto, (SELECT count(*) FROM orders WHERE o_orderkey % 97 = 0) AS total FROM orders WHERE o_orderkey % 97 = 0 ORDER BY o_orderkey LIMIT 10""")
def invalid_instants(lake):
    k = F.col("vistoria_id")
    bad = F.when(k % 3 == 0, "infinity").when(k % 3 == 1, "12024-01-01 00:00:00").otherwise("2024-13-01 00:00:00")
    texts = lake.inspection.select("vistoria_id", F.when(k % 97 == 0, bad).otherwise(F.col("ocorrido_em").cast("string")).alias("texto"))
    return quality.invalid_instants(texts, "vistoria_id", "texto")


@query("SORT-06_first_invalid_rows", "SELECT vistoria_id, item_codigo FROM event WHERE quantidade IS NULL ORDER BY vistoria_id, item_codigo LIMIT 10")
def first_invalid(lake):
    return quality.not_null(lake.event, "quantidade").select(*EVENT_KEY).orderBy(*EVENT_KEY).limit(10)


@query("PRJ-14_catalog_code_guard", "SELECT codigo FROM catalog JOIN (SELECT DISTINCT 'item_'||l_linenumber AS codigo FROM lineitem) USING (codigo)")
def catalog_guard(lake):
    """Digits are outside the letters-and-underscore rule, so every used adapter code is reported."""
    from ledgerlake.operators import facts

    used = lake.item.select(F.col("item_codigo").alias("codigo")).distinct()
    return facts.bad_codes(lake.catalog.join(used, "codigo", "left_semi")).select("codigo")


_STAFF = "(SELECT s_suppkey AS id, s_name AS nome, 'M'||s_suppkey AS matricula, true AS ativo FROM supplier)"
_ASKED = "(SELECT DISTINCT 'M'||l_suppkey AS matricula FROM lineitem WHERE l_quantity = 1 AND l_discount = 0)"


@query("PRJ-15_pseudonymized_staff", f"""SELECT id, CASE WHEN r.matricula IS NOT NULL THEN 'Técnico anonimizado' ELSE nome END AS nome,
    CASE WHEN r.matricula IS NOT NULL THEN 'anonimizado-'||id ELSE s.matricula END AS matricula, r.matricula IS NULL AS ativo
    FROM {_STAFF} s LEFT JOIN {_ASKED} r ON r.matricula = s.matricula""")
def pseudonymized_staff(lake):
    return privacy.pseudonymize(_staff(lake), _requests(lake))


@query("PRJ-15_pseudonymized_links", f"""SELECT id AS tecnico_id, (SELECT count(*) FROM orders o WHERE o.o_orderkey % 100 = id) AS vistorias
    FROM {_STAFF} WHERE matricula IN (SELECT matricula FROM {_ASKED})""")
def pseudonymized_links(lake):
    linked = lake.table("orders").select((F.col("o_orderkey") % 100).alias("tecnico_id"))
    return privacy.pseudonymized(_staff(lake), _requests(lake), linked)


def _staff(lake):
    return lake.table("supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("nome"),
        F.concat(F.lit("M"), F.col("s_suppkey")).alias("matricula"), F.lit(True).alias("ativo"),
    )


def _requests(lake):
    rows = lake.table("lineitem").where((F.col("l_quantity") == 1) & (F.col("l_discount") == 0))
    return rows.select(F.concat(F.lit("M"), F.col("l_suppkey")).alias("matricula"))


# -- reconciliation ------------------------------------------------------------------------------

@query("JOIN-05_full_reconciliation", "SELECT * FROM compared")
def full_reconciliation(lake):
    return reconcile.compare(lake.event, lake.target)


@query("AGG-26_reconciliation_totals", """SELECT count(*) FILTER (situacao = 'iguais' AND NOT veio_do_cdc) AS iguais_sem_lsn,
    count(*) FILTER (situacao = 'iguais' AND veio_do_cdc) AS iguais_com_lsn, count(*) FILTER (situacao = 'diferentes' AND NOT veio_do_cdc) AS diferentes_sem_lsn,
    count(*) FILTER (situacao = 'diferentes' AND veio_do_cdc) AS diferentes_com_lsn, count(*) FILTER (situacao = 'so_na_origem') AS so_na_origem,
    count(*) FILTER (situacao = 'so_no_destino') AS so_no_destino FROM compared""")
def reconciliation_totals(lake):
    return reconcile.totals(reconcile.compare(lake.event, lake.target))


@query("AGG-26_differences_by_day", "SELECT dia, situacao, count(*) AS linhas FROM compared WHERE situacao <> 'iguais' GROUP BY ALL")
def differences_by_day(lake):
    return reconcile.by_day(reconcile.compare(lake.event, lake.target))


@query("JOIN-06_missing_and_unknown", """SELECT count(*) FILTER (situacao = 'so_na_origem') AS faltam,
    count(*) FILTER (situacao = 'so_no_destino') AS desconhecidos FROM compared""")
def missing_and_unknown(lake):
    return reconcile.missing_and_unknown(lake.target, lake.event)


@query("JOIN-07_pending_headers", """SELECT * FROM inspection WHERE vistoria_id IN (SELECT vistoria_id FROM item
    EXCEPT SELECT vistoria_id FROM event WHERE vistoria_id % 101 <> 0)""")
def pending_headers(lake):
    return reconcile.pending_headers(lake.inspection, lake.item, lake.target)


@query("JOIN-16_without_accepted", "SELECT * FROM compared WHERE (vistoria_id, item_codigo) NOT IN (SELECT (vistoria_id, item_codigo) FROM item WHERE vistoria_id % 103 = 0)".replace("(vistoria_id, item_codigo) NOT IN (SELECT (vistoria_id, item_codigo)", "(vistoria_id, item_codigo) NOT IN (SELECT vistoria_id, item_codigo"))
def without_accepted(lake):
    accepted = lake.item.where(F.col("vistoria_id") % 103 == 0)
    return reconcile.without_accepted(reconcile.compare(lake.event, lake.target), accepted)


@query("JOIN-17_explain_missing", """SELECT count(*) FILTER (vistoria_id % 2 = 0) AS pendentes, count(*) FILTER (vistoria_id % 2 <> 0 AND vistoria_id % 3 = 0) AS na_fila,
    count(*) FILTER (vistoria_id % 2 <> 0 AND vistoria_id % 3 <> 0) AS sem_explicacao FROM compared WHERE situacao = 'so_na_origem'""")
def explain_missing(lake):
    pending = lake.item.where(F.col("vistoria_id") % 2 == 0)
    queued = lake.item.where(F.col("vistoria_id") % 3 == 0).withColumn("operacao", F.lit("insert"))
    return reconcile.explain_missing(reconcile.compare(lake.event, lake.target), pending, queued)


@query("STR-20_confirmed_extras", "SELECT vistoria_id, item_codigo FROM compared WHERE situacao = 'so_no_destino' AND (vistoria_id + 1) % 2 <> 0")
def confirmed_extras(lake):
    """A later read of the origin knows half of the rows that looked extra."""
    late = lake.target.where((F.col("vistoria_id") < 0) & ((F.col("vistoria_id") + 1) % 2 == 0))
    later = lake.event.select(*EVENT_KEY).unionByName(late.select(*EVENT_KEY))
    return reconcile.confirm_extras(reconcile.compare(lake.event, lake.target), later)


@query("STR-25_gold_freshness", """SELECT TIMESTAMP '2001-08-25 12:00:00' AS medido_em, 'medir-frescor' AS comando, 'fato_infra_escola_ano' AS tabela,
    true AS gold_construida, count(*) AS vistorias_pendentes, min(registrado_em) AS pendente_desde,
    round(greatest(epoch_us(TIMESTAMP '2001-08-25 12:00:00') - epoch_us(min(registrado_em)), 0) / 1e6, 3) AS frescor_s, 90000.0::DOUBLE AS sla_s,
    epoch_us(TIMESTAMP '2001-08-25 12:00:00') - epoch_us(min(registrado_em)) <= 90000000000 AS dentro_do_sla
    FROM inspection WHERE vistoria_id IN (SELECT vistoria_id FROM item WHERE vistoria_id % 101 = 0)""")
def gold_freshness(lake):
    pending = reconcile.pending_headers(lake.inspection, lake.item, lake.target)
    return freshness.measure(pending, "2001-08-25 12:00:00")


@query("SORT-05_last_measurements", """SELECT * FROM (SELECT ts AS medido_em, value AS frescor_s FROM events ORDER BY ts DESC LIMIT 7) ORDER BY medido_em""")
def last_measurements(lake):
    log = lake.table("events").select(F.col("ts").alias("medido_em"), F.col("value").alias("frescor_s"))
    return freshness.last_measurements(log, 7)


