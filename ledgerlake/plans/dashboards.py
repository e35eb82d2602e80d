"""Queries: dashboard extract and slice calculations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.contracts import STATES
from ledgerlake.operators import dashboard
from ledgerlake.plans.adapter import CATALOG
from ledgerlake.plans.registry import query

_SLICE = "sg_uf = 'ASIA' AND tp_dependencia IN (1, 2, 3)"
_STATE2 = "coalesce(m['item_2'], 'nao_informado')"
_SUMMARY = """CASE WHEN n >= 10 THEN round(media, 6) END AS media, CASE WHEN n >= 10 THEN round(desvio, 6) END AS desvio"""
_AGGS = """count(media_geral) AS n, avg(media_geral) AS media, coalesce(stddev_samp(media_geral), 0) AS desvio"""


def _slice(census):
    return census.where(dashboard.slice_filter(uf="ASIA", network="publica"))


def _round(df):
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c in ("media", "desvio", "media_com", "media_sem", "diferenca")})


@query("PRJ-13_slice_filter", f"SELECT co_entidade, tp_dependencia, localizacao, co_municipio, sg_uf FROM census_at WHERE {_SLICE} AND localizacao = 'rural'")
def slice_filter(lake):
    keep = dashboard.slice_filter(uf="ASIA", network="publica", location="rural")
    return lake.census_at.where(keep).select("co_entidade", "tp_dependencia", "localizacao", "co_municipio", "sg_uf")


@query("AGG-29_slice_kpis", f"""SELECT c.*, e.* FROM (SELECT count(*) AS censo, count(perfil) AS perfis_censo FROM census_at WHERE {_SLICE}) c,
    (SELECT count(*) AS enem, CAST(coalesce(sum(participantes), 0) AS BIGINT) AS participantes, count(perfil) AS perfis_enem,
      count(*) FILTER (media_geral IS NULL) AS escolas_sem_nota FROM exam_slice WHERE {_SLICE}) e""")
def slice_kpis(lake):
    here = _slice(lake.census_beside_exam)
    return dashboard.kpis(here, dashboard.exam_slice(lake.exam_at, here))


@query("AGG-30_item_state_matrix", "SELECT c.codigo AS item_codigo, " + ", ".join(
    f"count(*) FILTER (coalesce(m[c.codigo], 'nao_informado') = '{s}') AS {s}" for s in STATES)
    + f" FROM census_at, catalog c WHERE {_SLICE} GROUP BY c.codigo")
def item_state_matrix(lake):
    return dashboard.item_matrix(_slice(lake.census_at), CATALOG)


_REGION = "SELECT sg_uf, count(*) AS total, " + ", ".join(
    f"count(*) FILTER ({_STATE2} = '{s}') AS {s}" for s in STATES) + " FROM census_at GROUP BY sg_uf"


@query("AGG-31_region_states", _REGION)
def region_states(lake):
    return dashboard.by_region(lake.census_at, "item_2")


@query("AGG-31_schools_by_network", "SELECT ['Federal','Estadual','Municipal','Privada'][tp_dependencia] AS rede, count(*) AS escolas FROM census_at GROUP BY ALL")
def schools_by_network(lake):
    return dashboard.by_network(lake.census_at)


_BY_STATE = f"(SELECT rede, {_STATE2} AS estado, {_AGGS} FROM exam_slice GROUP BY ALL)"


@query("AGG-32_score_by_network_and_state", f"SELECT rede, estado, n, {_SUMMARY} FROM {_BY_STATE}")
def score_by_state(lake):
    return _round(dashboard.by_network_and_state(lake.exam_slice, "item_2"))


@query("AGG-32_score_by_network_and_location", f"SELECT rede, localizacao, n, {_SUMMARY} FROM (SELECT rede, localizacao, {_AGGS} FROM exam_slice GROUP BY ALL)")
def score_by_location(lake):
    return _round(dashboard.by_network_and_location(lake.exam_slice))


@query("AGG-32_score_by_area", " UNION ALL ".join(
    f"SELECT '{s}' AS area, count({s}) AS n, round(avg({s}), 6) AS media, round(stddev_samp({s}), 6) AS desvio FROM exam_slice"
    for s in dashboard.SCORES))
def score_by_area(lake):
    return _round(dashboard.by_area(lake.exam_slice))


@query("AGG-32_suppressed_groups", f"""SELECT count(*) FILTER (n < 25) AS grupos_pequenos FROM {_BY_STATE}""")
def suppressed_groups(lake):
    return dashboard.suppressed_groups(dashboard.by_network_and_state(lake.exam_slice, "item_2", minimum=25))


@query("AGG-33_pairs", f"""SELECT a.rede, round(a.media, 6) AS media_com, round(b.media, 6) AS media_sem, round(a.media - b.media, 6) AS diferenca
    FROM {_BY_STATE} a JOIN {_BY_STATE} b ON a.rede = b.rede AND a.estado = 'existente' AND b.estado = 'inexistente'
    WHERE a.n >= 10 AND b.n >= 10""")
def pairs(lake):
    return _round(dashboard.pairs(dashboard.by_network_and_state(lake.exam_slice, "item_2")))


@query("AGG-34_score_histogram", """SELECT CAST(least(greatest(floor(media_geral / (1000.0::DOUBLE / 24)), 0), 23) AS INT) AS faixa, count(*) AS escolas
    FROM exam_slice WHERE media_geral IS NOT NULL GROUP BY ALL""")
def score_histogram(lake):
    return dashboard.histogram(lake.exam_slice, "media_geral")


@query("SORT-03_top_absences", """SELECT c.codigo AS item_codigo, count(*) AS inexistente FROM census_at, catalog c
    WHERE m[c.codigo] = 'inexistente' GROUP BY c.codigo ORDER BY count(*) DESC, c.codigo LIMIT 3""")
def top_absences(lake):
    return dashboard.top_absences(dashboard.item_matrix(lake.census_at, CATALOG))


@query("SORT-04_region_ranking", f"SELECT sg_uf, round(existente / total, 6) AS parte FROM ({_REGION})")
def region_ranking(lake):
    return dashboard.share_order(dashboard.by_region(lake.census_at, "item_2"))


@query("SNK-12_municipality_rows", """SELECT co_municipio, no_municipio, sg_uf, row_number() OVER (ORDER BY co_municipio) - 1 AS posicao
    FROM (SELECT DISTINCT co_municipio, no_municipio, sg_uf FROM census_at)""")
def municipality_rows(lake):
    return dashboard.municipality_rows(lake.census_at)


_CODE = "||".join(
    f"CASE m['{c}'] WHEN 'existente' THEN '1' WHEN 'inexistente' THEN '2' WHEN 'em_obra' THEN '3' WHEN 'inutilizavel' THEN '4' ELSE '0' END"
    for c in CATALOG)
_PLACE = "(SELECT co_municipio, row_number() OVER (ORDER BY co_municipio) - 1 AS municipio FROM (SELECT DISTINCT co_municipio FROM census_at))"


@query("SNK-12_school_rows", f"""SELECT co_entidade, municipio, tp_dependencia AS rede, CASE localizacao WHEN 'urbana' THEN 1 ELSE 2 END AS local,
    coalesce({_CODE}, '0000000') AS itens, perfil IS NOT NULL AS tem_perfil, row_number() OVER (ORDER BY co_entidade) - 1 AS posicao
    FROM census_at JOIN {_PLACE} USING (co_municipio)""")
def school_rows(lake):
    return dashboard.school_rows(lake.census_at, dashboard.municipality_rows(lake.census_at), CATALOG)


@query("SNK-12_exam_rows", f"""SELECT s.posicao AS escola, coalesce({_CODE}, '0000000') AS itens,
    {', '.join(f'round({c}, 6) AS {c}' for c in dashboard.SCORES)}, participantes AS n_participantes, perfil IS NOT NULL AS tem_perfil
    FROM exam_at e JOIN (SELECT co_entidade, row_number() OVER (ORDER BY co_entidade) - 1 AS posicao FROM census_at) s ON s.co_entidade = e.co_escola""")
def exam_rows(lake):
    census = lake.census_beside_exam
    rows = dashboard.exam_rows(lake.exam_at, dashboard.school_rows(census, dashboard.municipality_rows(census), CATALOG), CATALOG)
    return rows.withColumns({c: F.round(c, 6) for c in dashboard.SCORES})


@query("SET-03_coverage_consistency", """(SELECT e.co_escola AS co_entidade, 'esquerda' AS lado FROM exam_school e JOIN census_at c ON c.co_entidade = e.co_escola
    EXCEPT SELECT co_escola, 'esquerda' FROM exam_at) UNION ALL (SELECT co_escola, 'direita' FROM exam_at EXCEPT
    SELECT e.co_escola, 'direita' FROM exam_school e JOIN census_at c ON c.co_entidade = e.co_escola)""")
def coverage_consistency(lake):
    """Keys on one side only: here the exam schools that the census given to the facts left out."""
    from ledgerlake.operators import reconcile

    covered = lake.exam_input.join(lake.census_beside_exam.select("co_entidade"), "co_entidade", "left_semi")
    return reconcile.key_set_difference(covered, lake.exam_at, "co_entidade")


@query("AGG-13_dashboard_coverage", """SELECT CAST(sum(n) AS BIGINT) AS entrada, CAST(sum(n * conhecida::INT) AS BIGINT) AS identificadas,
    CAST(sum(n * (NOT conhecida)::INT) AS BIGINT) AS sem_juncao, CAST(sum(n * (poucos AND NOT conhecida)::INT) AS BIGINT) AS mascaradas FROM
    (SELECT co_escola IN (SELECT co_entidade FROM school WHERE co_entidade % 7 <> 0) AS conhecida, poucos_participantes AS poucos, count(*) AS n FROM exam_school GROUP BY ALL)""")
def dashboard_coverage(lake):
    return dashboard.coverage(lake.exam_input, lake.census_for_exam)
