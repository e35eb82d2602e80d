"""Queries: windows over item history, point-in-time joins, facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import MAX_TS
from ledgerlake.functions.columns import encode_items, entries_text, month_of, pct
from ledgerlake.operators import facts, history, metrics, ordered, quality, workload
from ledgerlake.plans.adapter import AS_OF, CATALOG, EXAM_REFERENCE, EXAM_YEAR, LAST_YEAR
from ledgerlake.plans.registry import query


def _runs(lake) -> DataFrame:
    known = history.known_states(lake.event, lake.hot)
    return history.state_runs(known, lake.hot is not None).drop(ordered.CHUNK)


def show_profile(df: DataFrame) -> DataFrame:
    """Maps as text, open ends as text (pandas cannot hold year 9999)."""
    return df.withColumns({
        "valid_to": F.col("valid_to").cast("string"),
        "itens": entries_text("itens"), "quantidades": entries_text("quantidades"),
    })


PROFILE = "SELECT * EXCLUDE (m) REPLACE (CAST(valid_to AS VARCHAR) AS valid_to) FROM profile"


@query("WIN-01_run_detection", "SELECT co_entidade, item_codigo, situacao, desde, vistoria_id, inicia_trecho FROM runs")
def run_detection(lake):
    return _runs(lake).drop("quantidade")


@query("WIN-01_run_number", "SELECT co_entidade, item_codigo, desde, vistoria_id, trecho FROM runs")
def run_number(lake):
    hot = lake.hot is not None
    known = history.known_states(lake.event, lake.hot)
    return history.numbered_runs(history.state_runs(known, hot), hot).select(
        "co_entidade", "item_codigo", "desde", "vistoria_id", "trecho"
    )


@query("WIN-02_quantity_in_force", "SELECT co_entidade, item_codigo, desde, vistoria_id, quantidade, quantidade_vigente FROM in_force")
def in_force(lake):
    hot = lake.hot is not None
    known = history.known_states(lake.event, lake.hot)
    return history.quantity_in_force(history.state_runs(known, hot), hot).select(
        "co_entidade", "item_codigo", "desde", "vistoria_id", "quantidade", "quantidade_vigente"
    )


@query("WIN-03_change_compression", "SELECT * FROM change_rows")
def change_compression(lake):
    hot = lake.hot is not None
    known = history.known_states(lake.event, lake.hot)
    rows = history.quantity_in_force(history.state_runs(known, hot), hot)
    return history.changes_only(rows, hot).drop(ordered.CHUNK)


@query("WIN-04_validity_interval", "SELECT * REPLACE (CAST(ate AS VARCHAR) AS ate) FROM item_change")
def validity_interval(lake):
    return lake.item_change.drop(ordered.CHUNK).withColumn("ate", F.col("ate").cast("string"))


@query("WIN-05_scd2_profile", PROFILE)
def scd2_profile(lake):
    return show_profile(lake.profile)


@query("WIN-05_scd2_profile_hot_split", PROFILE)
def scd2_profile_split(lake):
    """The same profiles with every school over a few rows treated as hot: day chunks everywhere."""
    events = lake.event
    hot = history.hot_entities(events, 30)
    changes = history.item_change(events, hot)
    return show_profile(history.dim_profile(changes, CATALOG, hot is not None))


@query("WIN-06_latest_state", "SELECT * FROM latest")
def latest_state(lake):
    return lake.latest


@query("WIN-07_latest_in_year", f"""SELECT co_entidade, situacao FROM fact_item WHERE item_codigo = 'item_3'
    AND situacao <> 'nao_informado' AND year(ocorrido_em) = {LAST_YEAR}
    QUALIFY row_number() OVER (PARTITION BY co_entidade ORDER BY ocorrido_em DESC, vistoria_id DESC) = 1""")
def latest_in_year(lake):
    return history.latest_in_year(lake.event, "item_3", LAST_YEAR)


@query("WIN-08_latest_registration", """SELECT * FROM school_files
    QUALIFY row_number() OVER (PARTITION BY co_entidade ORDER BY ano_censo_referencia DESC, no_entidade) = 1""")
def latest_registration(lake):
    return history.latest_registration(lake.school_files)


@query("WIN-08_registration_conflicts", """SELECT co_entidade, ano_censo_referencia, count(*) AS n FROM (SELECT DISTINCT * FROM
    (SELECT * FROM school_files UNION ALL SELECT * REPLACE (no_entidade||'-C' AS no_entidade) FROM school WHERE co_entidade % 11 = 0))
    GROUP BY ALL HAVING count(*) > 1""")
def registration_conflicts(lake):
    clash = lake.school.where(F.col("co_entidade") % 11 == 0).withColumn("no_entidade", F.concat("no_entidade", F.lit("-C")))
    return history.registration_conflicts(lake.school_files.unionByName(clash))


# Percent rank by its definition: schools of the group with a lower score, over the others of the group.
_PLACED = """SELECT a.co_entidade, a.rede, a.sg_uf, a.media_geral, count(o.co_entidade) + 1 AS n_grupo,
    coalesce(count(*) FILTER (o.media_geral < a.media_geral) / nullif(count(o.co_entidade), 0)::DOUBLE, 0) AS percentil
    FROM priority_base a LEFT JOIN priority_base o ON o.rede = a.rede AND o.sg_uf = a.sg_uf AND o.co_entidade <> a.co_entidade
    GROUP BY a.co_entidade, a.rede, a.sg_uf, a.media_geral"""
_CHOSEN = f"""SELECT p.* FROM ({_PLACED}) p SEMI JOIN (SELECT co_entidade FROM profile WHERE is_current
      AND NOT coalesce(m['item_3'] = 'existente', false)) c USING (co_entidade)
    ANTI JOIN (SELECT co_entidade FROM event WHERE origem = 'vistoria_presencial' AND ocorrido_em + INTERVAL 365 DAY >= TIMESTAMP '{AS_OF}') v
    USING (co_entidade) WHERE p.n_grupo >= 10 AND p.percentil < 0.2"""


@query("WIN-09_inspection_priority", f"""SELECT c.co_entidade, c.rede, c.sg_uf, round(c.media_geral, 6) AS media_geral, round(c.percentil, 6) AS percentil,
    c.n_grupo, 1 + count(b.co_entidade) AS posicao_na_uf FROM ({_CHOSEN}) c LEFT JOIN ({_CHOSEN}) b
    ON b.sg_uf = c.sg_uf AND (b.media_geral, b.co_entidade) < (c.media_geral, c.co_entidade) GROUP BY ALL""")
def inspection_priority(lake):
    """Two years of results and registrations go in; only the asked year may count."""
    out = metrics.METRICS["prioridade_vistoria"](
        lake.performance_years, lake.school_years, lake.municipality, lake.profile, lake.event, item="item_3", year=EXAM_YEAR, as_of=AS_OF
    )
    return out.withColumns({"media_geral": F.round("media_geral", 6), "percentil": F.round("percentil", 6)})


@query("WIN-13_id_ranges", """SELECT min(vistoria_id) AS lo, max(vistoria_id) AS hi FROM (
    SELECT vistoria_id, vistoria_id - row_number() OVER (ORDER BY vistoria_id) AS g FROM (SELECT DISTINCT vistoria_id FROM item
    WHERE situacao = 'existente')) GROUP BY g""")
def id_ranges(lake):
    return ordered.id_ranges(lake.item.where(F.col("situacao") == "existente"), [], "vistoria_id", 1000)


@query("WIN-13_expand_ranges", "SELECT DISTINCT vistoria_id FROM item WHERE situacao = 'existente'")
def expand_ranges(lake):
    ranges = ordered.id_ranges(lake.item.where(F.col("situacao") == "existente"), [], "vistoria_id", 1000)
    return ordered.expand_ranges(ranges, [], "vistoria_id")


@query("WIN-14_total_with_examples", """SELECT vistoria_id, item_codigo, (SELECT count(*) FROM event WHERE situacao = 'nao_informado') AS total
    FROM event WHERE situacao = 'nao_informado' ORDER BY vistoria_id, item_codigo LIMIT 10""")
def total_with_examples(lake):
    unknown = lake.event.where(F.col("situacao") == "nao_informado")
    total = unknown.agg(F.count("*").alias("n")).scalar()
    return unknown.select("vistoria_id", "item_codigo").orderBy("vistoria_id", "item_codigo").limit(10).withColumn("total", total)


@query("WIN-15_overlapping_versions", f"""SELECT co_entidade, valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM (
    SELECT *, lag(valid_to) OVER (PARTITION BY co_entidade ORDER BY valid_from, valid_to) AS ends FROM (
      SELECT co_entidade, valid_from, CASE WHEN co_entidade % 5 = 0 AND valid_to < TIMESTAMP '{MAX_TS}' THEN valid_to + INTERVAL 3 DAY
      WHEN co_entidade % 7 = 0 THEN valid_from ELSE valid_to END AS valid_to FROM profile))
    WHERE ends > valid_from OR valid_from >= valid_to""")
def overlapping_versions(lake):
    """Planted faults: some intervals are stretched over the next one, some are emptied."""
    k = F.col("co_entidade")
    open_end = F.lit(MAX_TS).cast("timestamp_ntz")
    bent = (
        F.when((k % 5 == 0) & (F.col("valid_to") < open_end), F.col("valid_to") + F.make_dt_interval(F.lit(3)))
        .when(k % 7 == 0, F.col("valid_from")).otherwise(F.col("valid_to"))
    )
    faulty = lake.profile.select("co_entidade", "valid_from", bent.alias("valid_to"))
    return quality.overlaps(faulty, "co_entidade", lake.hot).withColumn("valid_to", F.col("valid_to").cast("string"))


@query("WIN-16_profile_as_of", PROFILE + " WHERE valid_from <= TIMESTAMP '2000-06-01' AND TIMESTAMP '2000-06-01' < profile.valid_to")
def profile_as_of(lake):
    return show_profile(history.profile_at(lake.profile, "2000-06-01 00:00:00"))


@query("JOIN-01_canonical_event", "SELECT * FROM event")
def canonical_event(lake):
    return lake.event


@query("JOIN-01_wide_table", "SELECT * FROM wide")
def wide_table(lake):
    return lake.wide


@query("JOIN-03_fact_item", "SELECT * FROM fact_item")
def fact_item(lake):
    return lake.fact_item


@query("JOIN-03_fact_performance", """SELECT co_escola AS co_entidade, ano, participantes AS n_participantes,
    round(media_geral, 6) AS media_geral, escola_infra_sk FROM performance""")
def fact_performance(lake):
    return lake.performance.select(
        "co_entidade", "ano", "n_participantes", F.round("media_geral", 6).alias("media_geral"), "escola_infra_sk"
    )


@query("JOIN-04_states_at_starts", """SELECT co_entidade, em AS valid_from, vistoria_origem_id, item_codigo, situacao, quantidade
    FROM folded JOIN version USING (co_entidade, em)""")
def states_at_starts(lake):
    held = history.profile_states(lake.item_change, CATALOG, lake.hot is not None)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("item_codigo"), F.col(f"_v{i}.situacao").alias("situacao"), F.col(f"_v{i}.quantidade").alias("quantidade"))
        for i, c in enumerate(CATALOG)
    ]))
    long = held.select("co_entidade", "valid_from", "vistoria_origem_id", pairs.alias("s"))
    return long.where(F.col("s.situacao").isNotNull()).select("co_entidade", "valid_from", "vistoria_origem_id", "s.*")


@query("JOIN-08_last_year_rows", """SELECT f.* FROM fact_year f WHERE NOT EXISTS
    (SELECT 1 FROM fact_year g WHERE g.co_entidade = f.co_entidade AND g.ano > f.ano)""")
def last_year_rows(lake):
    return facts.last_year_rows(lake.fact_year)


@query("JOIN-13_no_recent_inspection", f"""SELECT co_entidade FROM school WHERE co_entidade NOT IN (SELECT co_entidade FROM event
    WHERE origem = 'vistoria_presencial' AND ocorrido_em >= TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY)""")
def no_recent_inspection(lake):
    recent = metrics.recently_inspected(lake.event, AS_OF, 365)
    return lake.school.select("co_entidade").join(recent, "co_entidade", "left_anti")


@query("JOIN-15_profile_by_key_and_school", """SELECT f.co_escola AS co_entidade, f.escola_infra_sk, p.itens FROM performance f
    LEFT JOIN profile p ON p.escola_infra_sk = f.escola_infra_sk AND p.co_entidade = f.co_escola""")
def profile_by_key(lake):
    return facts.with_profile(lake.performance, lake.profile).select(
        "co_entidade", "escola_infra_sk", entries_text("itens").alias("itens")
    )


@query("AGG-04_profile_counters", """SELECT co_entidade, valid_from, n_itens_conhecidos, n_existentes, n_inexistentes, n_em_obra,
    n_inutilizaveis, itens, quantidades FROM profile""")
def profile_counters(lake):
    return show_profile(lake.profile).select(
        "co_entidade", "valid_from", "n_itens_conhecidos", *history.COUNTERS, "itens", "quantidades"
    )


@query("AGG-05_profile_starts", "SELECT co_entidade, em AS valid_from, vistoria_origem_id FROM version")
def profile_starts(lake):
    return history.profile_starts(lake.item_change)


@query("AGG-06_fact_year", "SELECT * FROM fact_year")
def fact_year(lake):
    return lake.fact_year


@query("PRJ-16_year_reference", f"""SELECT DISTINCT year(ocorrido_em)::INT AS ano,
    least(make_timestamp(year(ocorrido_em)::BIGINT,12,31,23,59,59.999), TIMESTAMP '{AS_OF}') AS em FROM event""")
def year_reference(lake):
    years = lake.event.select(F.year(F.col("ocorrido_em").cast("date")).alias("ano")).distinct()
    return years.withColumn("em", facts.year_reference("ano", AS_OF))


@query("PRJ-07_dim_item", "SELECT codigo AS item_codigo, descricao, categoria FROM catalog JOIN (SELECT DISTINCT 'item_'||l_linenumber AS codigo FROM lineitem) USING (codigo)")
def dim_item(lake):
    used = lake.item.select(F.col("item_codigo").alias("codigo")).distinct()
    return facts.dim_item(lake.catalog.join(used, "codigo", "left_semi"))


@query("PRJ-07_dim_municipality", "SELECT * FROM municipality")
def dim_municipality(lake):
    return facts.dim_municipality(lake.municipality)


@query("PRJ-08_dim_school", "SELECT * FROM dim_school")
def dim_school(lake):
    return lake.dim_school


@query("SC-15_surrogate_key", "SELECT escola_infra_sk, co_entidade, valid_from FROM profile")
def surrogate_keys(lake):
    return lake.profile.select("escola_infra_sk", "co_entidade", "valid_from")


@query("SC-19_encoded_items", "SELECT co_entidade, valid_from, " + "||".join(
    f"CASE m['{c}'] WHEN 'existente' THEN '1' WHEN 'inexistente' THEN '2' WHEN 'em_obra' THEN '3' WHEN 'inutilizavel' THEN '4' ELSE '0' END"
    for c in CATALOG) + " AS codigo FROM profile")
def encoded_items(lake):
    return lake.profile.select("co_entidade", "valid_from", encode_items("itens", CATALOG).alias("codigo"))


@query("SC-17_item_lookup", "SELECT co_entidade, valid_from, m['item_1'] AS item_1, m['item_9'] AS item_9 FROM profile")
def item_lookup(lake):
    return lake.profile.select(
        "co_entidade", "valid_from", F.try_element_at("itens", F.lit("item_1")).alias("item_1"),
        F.try_element_at("itens", F.lit("item_9")).alias("item_9"),
    )


@query("PRJ-18_school_history", """SELECT ocorrido_em, vistoria_id, situacao, quantidade FROM event
    WHERE co_entidade = 5 AND item_codigo = 'item_2'""")
def school_history(lake):
    return workload.school_history(lake.event, 5, "item_2")


@query("PRJ-18_current_state_of_school", "SELECT * FROM latest WHERE co_entidade = 5")
def current_state(lake):
    return history.latest_state(lake.event.where(F.col("co_entidade") == 5))


@query("PRJ-18_inspection_events", "SELECT * FROM event WHERE vistoria_id = 1000")
def inspection_events(lake):
    header = lake.inspection.where(F.col("vistoria_id") == 1000)
    month = header.select(month_of("ocorrido_em").alias("m")).scalar()
    return workload.inspection_events(lake.event, 1000, month)


@query("SNK-13_current_state_update", """SELECT co_entidade, item_codigo, CASE WHEN co_entidade % 3 = 0 AND item_codigo = 'item_4'
    THEN 'existente' ELSE situacao END AS situacao, quantidade, CASE WHEN co_entidade % 3 = 0 THEN TIMESTAMP '2002-01-01'
    ELSE vigente_desde END AS atualizado_em FROM latest""")
def current_state_update(lake):
    state = lake.latest.withColumnRenamed("vigente_desde", "atualizado_em")
    visited = state.where(F.col("co_entidade") % 3 == 0).withColumns({
        "situacao": F.when(F.col("item_codigo") == "item_4", "existente").otherwise(F.col("situacao")),
        "atualizado_em": F.lit("2002-01-01").cast("timestamp_ntz"),
    })
    return history.apply_revisit(state, visited).drop("vistoria_id")


_BY_PLACE = """SELECT sg_uf, rede, count(*) AS escolas, round(avg(CASE WHEN tem THEN 100.0::DOUBLE ELSE 0 END), 1) AS pct_com_item
    FROM ({0}) JOIN dim_school USING (co_entidade) JOIN municipality USING (co_municipio) GROUP BY sg_uf, rede"""


@query("AGG-14_fine_grain_share", _BY_PLACE.format(f"""SELECT co_entidade, arg_max(situacao, (ocorrido_em, vistoria_id)) = 'existente' AS tem
    FROM known_in_year WHERE item_codigo = 'item_3' AND ano = {LAST_YEAR} GROUP BY co_entidade"""))
def fine_grain_share(lake):
    return metrics.fine_grain_share(lake.fact_item, lake.dim_school, lake.municipality, "item_3", LAST_YEAR)


@query("AGG-14_wide_grain_share", _BY_PLACE.format(f"""SELECT y.co_entidade, arg_max(c.situacao, (c.desde, c.vistoria_id)) = 'existente' AS tem
    FROM year_end y JOIN change_rows c ON c.co_entidade = y.co_entidade AND c.item_codigo = 'item_3' AND c.desde <= y.em
    WHERE y.ano = {LAST_YEAR} GROUP BY y.co_entidade"""))
def wide_grain_share(lake):
    return metrics.wide_grain_share(lake.fact_year, lake.dim_school, lake.municipality, "item_3", LAST_YEAR)


@query("AGG-15_best_covered_year", "SELECT ano, count(*) AS escolas FROM fact_year GROUP BY ano ORDER BY count(*) DESC, ano DESC LIMIT 1")
def best_covered_year(lake):
    return metrics.best_covered_year(lake.fact_year)


@query("AGG-16_lacking_now", """SELECT tp_dependencia, count(*) AS escolas FROM latest JOIN school USING (co_entidade)
    WHERE item_codigo = 'item_2' AND situacao = 'inexistente' GROUP BY tp_dependencia""")
def lacking_now(lake):
    return metrics.lacking_now(lake.latest, lake.school, "item_2")


_LAST = "(SELECT * FROM fact_year QUALIFY ano = max(ano) OVER (PARTITION BY co_entidade))"


@query("AGG-16_lacking_last_year", f"SELECT tp_dependencia, count(*) AS escolas FROM {_LAST} JOIN school USING (co_entidade) WHERE item_2 = false GROUP BY tp_dependencia")
def lacking_last_year(lake):
    return metrics.lacking_last_year(facts.last_year_rows(lake.fact_year, ["item_2"]), lake.school, "item_2")


@query("AGG-16_lacking_fixed_year", f"SELECT tp_dependencia, count(*) AS escolas FROM fact_year JOIN school USING (co_entidade) WHERE ano = {LAST_YEAR} AND item_2 = false GROUP BY tp_dependencia")
def lacking_fixed_year(lake):
    return metrics.lacking_in_year(lake.fact_year, lake.school, "item_2", LAST_YEAR)


@query("AGG-16b_lacking_with_zero_groups", f"SELECT tp_dependencia, count(*) FILTER (item_2 = false) AS escolas FROM {_LAST} JOIN school USING (co_entidade) GROUP BY tp_dependencia")
def lacking_zero_groups(lake):
    return metrics.lacking_with_zero_groups(facts.last_year_rows(lake.fact_year, ["item_2"]), lake.school, "item_2")


@query("JOIN-11_scalar_reference", f"""SELECT d.co_entidade, r.em, d.itens FROM profile d,
    (SELECT max(TIMESTAMP '{EXAM_REFERENCE}') AS em FROM performance) r WHERE d.valid_from <= r.em AND r.em < d.valid_to""")
def scalar_reference(lake):
    reference = lake.performance.agg(F.max("data_referencia_infraestrutura").cast("timestamp_ntz").alias("em")).scalar()
    return lake.profile.withColumn("em", reference).where(
        (F.col("valid_from") <= F.col("em")) & (F.col("em") < F.col("valid_to"))
    ).select("co_entidade", "em", entries_text("itens").alias("itens"))


@query("JOIN-11_headers_by_catalog", "SELECT vistoria_id, codigo AS item_codigo, 'existente' AS situacao FROM inspection, catalog")
def headers_by_catalog(lake):
    return workload.inspect_whole_catalog(lake.inspection, CATALOG, "existente")


@query("WIN-10_ratio_to_total", """SELECT situacao, count(*) AS linhas, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 4) AS parte
    FROM event GROUP BY situacao""")
def ratio_to_total(lake):
    counted = lake.event.groupBy("situacao").agg(F.count("*").alias("linhas"))
    return metrics.ratio_to_total(counted, "linhas", "parte", 4)


@query("SC-14_rounding", """SELECT sg_uf, round(100.0::DOUBLE * count(*) FILTER (quantidade > 20) / count(quantidade), 3) AS parte,
    abs(min(quantidade) - max(quantidade)) AS amplitude, max(vistoria_id) % 7 AS resto FROM event GROUP BY sg_uf""")
def rounding(lake):
    return lake.event.groupBy("sg_uf").agg(
        pct(F.count_if(F.col("quantidade") > 20), F.count("quantidade"), 3).alias("parte"),
        F.abs(F.min("quantidade") - F.max("quantidade")).alias("amplitude"),
        F.pmod(F.max("vistoria_id"), F.lit(7)).alias("resto"),
    )
