"""Queries: census and exam preparation, coverage, metrics, layer reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.contracts import AREAS
from ledgerlake.operators import census, exams, metrics, ordered, quality, workload
from ledgerlake.plans.adapter import CATALOG, EXAM_REFERENCE, EXAM_YEAR, census_column
from ledgerlake.plans.registry import query

_MEANS = [f"media_{a}" for a in AREAS] + ["media_geral"]
_ROUND = ", ".join(f"round({m}, 6) AS {m}" for m in _MEANS)


def rounded(df):
    return df.withColumns({m: F.round(m, 6) for m in _MEANS if m in df.columns})


# -- census --------------------------------------------------------------------------------------

def census_raw(lake):
    """Census file as text: flags from the current state, some schools closed or badly located."""
    k = F.col("co_entidade")
    flag = F.when(F.col("situacao") == "existente", "1").when(F.col("situacao") == "inexistente", "0")
    flags = lake.latest.groupBy("co_entidade").agg(*[
        F.max(F.when(F.col("item_codigo") == c, flag)).alias(census_column(c)) for c in CATALOG
    ])
    return (
        lake.school.join(lake.municipality, "co_municipio").join(flags, "co_entidade", "left").select(
            F.col("ano_censo_referencia").cast("string").alias("NU_ANO_CENSO"), k.cast("string").alias("CO_ENTIDADE"),
            F.col("no_entidade").alias("NO_ENTIDADE"),
            F.when(k % 31 != 0, F.col("co_municipio")).cast("string").alias("CO_MUNICIPIO"),
            F.col("no_municipio").alias("NO_MUNICIPIO"), F.col("sg_uf").alias("SG_UF"),
            F.col("co_uf").cast("string").alias("CO_UF"),
            F.when(k % 17 != 0, F.col("tp_dependencia")).cast("string").alias("TP_DEPENDENCIA"),
            F.col("tp_localizacao").cast("string").alias("TP_LOCALIZACAO"),
            F.when(k % 13 == 0, "2").otherwise("1").alias("TP_SITUACAO_FUNCIONAMENTO"),
            *[census_column(c) for c in CATALOG],
        )
    )


_ACTIVE = "co_entidade % 13 <> 0 AND co_entidade % 31 <> 0"
_LOCATED = f"{_ACTIVE} AND co_entidade % 17 <> 0"


@query("PRJ-01_active_schools", f"SELECT co_entidade FROM school WHERE {_ACTIVE}")
def active_schools(lake):
    return census.active_schools(census_raw(lake)).select(F.col("CO_ENTIDADE").cast("bigint").alias("co_entidade"))


@query("PRJ-02_municipalities", f"""SELECT DISTINCT co_municipio, no_municipio, sg_uf, CAST(co_uf AS SMALLINT) AS co_uf
    FROM school JOIN municipality USING (co_municipio) WHERE {_ACTIVE}""")
def municipalities(lake):
    return census.municipalities(census.active_schools(census_raw(lake)))


@query("PRJ-03_schools", f"""SELECT co_entidade, no_entidade, co_municipio, CAST(tp_dependencia AS SMALLINT) AS tp_dependencia,
    CAST(tp_localizacao AS SMALLINT) AS tp_localizacao, CAST(ano_censo_referencia AS SMALLINT) AS ano_censo_referencia
    FROM school WHERE {_LOCATED}""")
def schools(lake):
    return census.schools(census.active_schools(census_raw(lake)))


@query("PRJ-04_unpivot_items", f"""SELECT s.co_entidade, c.codigo AS item_codigo,
    CASE WHEN l.situacao IN ('existente','inexistente') THEN l.situacao ELSE 'nao_informado' END AS situacao
    FROM school s CROSS JOIN catalog c LEFT JOIN latest l ON l.co_entidade = s.co_entidade AND l.item_codigo = c.codigo
    WHERE {_LOCATED.replace('co_entidade', 's.co_entidade')}""")
def unpivot_items(lake):
    return census.item_states(census.active_schools(census_raw(lake)), {c: census_column(c) for c in CATALOG})


# -- exams ---------------------------------------------------------------------------------------

@query("PRJ-05_valid_scores", "SELECT * FROM participant")
def valid_scores(lake):
    return lake.participant


@query("PRJ-06_complete_and_empty", """SELECT count(*) FILTER (nota_cn IS NOT NULL AND nota_ch IS NOT NULL AND nota_lc IS NOT NULL
    AND nota_mt IS NOT NULL AND nota_redacao IS NOT NULL) AS completos, count(*) FILTER (coalesce(nota_cn, nota_ch, nota_lc,
    nota_mt, nota_redacao) IS NULL) AS vazios FROM participant""")
def complete_and_empty(lake):
    return lake.participant.agg(
        F.count_if(exams.has_all_scores()).alias("completos"), F.count_if(exams.has_no_score()).alias("vazios")
    )


@query("PRJ-09_prepared_exam", f"""SELECT co_escola AS co_entidade, ano, participantes AS n_participantes,
    participantes_com_todas_as_notas AS n_participantes_com_todas_as_notas, participantes_sem_nota_valida AS n_participantes_sem_nota,
    {_ROUND}, poucos_participantes, DATE '{EXAM_REFERENCE}' AS data_referencia_infraestrutura FROM exam_school""")
def prepared_exam(lake):
    return rounded(lake.exam_input).withColumn("data_referencia_infraestrutura", F.lit(EXAM_REFERENCE).cast("date"))


@query("AGG-01_exam_by_school", f"SELECT * REPLACE ({_ROUND}) FROM exam_school")
def exam_by_school(lake):
    return rounded(lake.exam_school)


@query("AGG-02_exam_summary", f"""SELECT {EXAM_YEAR}::SMALLINT AS ano, count(*) AS participantes, count(co_escola) AS participantes_com_escola,
    count(DISTINCT co_escola) AS escolas, count(*) FILTER (validas = 5) AS participantes_com_todas_as_notas,
    count(*) FILTER (validas = 0) AS participantes_sem_nota_valida, CAST(sum(faltantes) AS BIGINT) AS notas_objetivas_faltantes,
    CAST(sum(zeros) AS BIGINT) AS notas_objetivas_zero, CAST(sum(redacao_zero) AS BIGINT) AS redacoes_nota_zero FROM person""")
def exam_summary(lake):
    return exams.file_summary(lake.participant)


@query("AGG-03_mean_without_zero_essays", """SELECT co_escola, round(media_redacao * notas_validas_redacao
    / nullif(notas_validas_redacao - redacoes_nota_zero, 0), 6) AS media_redacao_sem_zeros FROM exam_school""")
def mean_without_zeros(lake):
    out = exams.mean_without_zero_essays(lake.exam_school)
    return out.select("co_escola", F.round("media_redacao_sem_zeros", 6).alias("media_redacao_sem_zeros"))


_MATCH = """(SELECT e.*, c.co_entidade IS NOT NULL AS no_censo FROM exam_school e
    LEFT JOIN census_for_exam c ON c.co_entidade = e.co_escola)"""


@query("JOIN-02_census_match", f"SELECT co_escola, participantes, poucos_participantes, no_censo FROM {_MATCH}")
def census_match(lake):
    return exams.census_match(lake.exam_school, lake.census_for_exam).select(
        "co_escola", "participantes", "poucos_participantes", "no_censo"
    )


def _share(part: str, whole: str, name: str) -> str:
    return f"round({part} * 100.0::DOUBLE / nullif({whole}, 0), 1) AS {name}"


# Sums by kind of school (masked or not, in the census or not), then shares of those sums.
_KINDS = f"SELECT poucos_participantes AS m, no_censo AS c, count(*) AS e, CAST(sum(participantes) AS BIGINT) AS p FROM {_MATCH} GROUP BY m, c"
_TOTALS = f"""SELECT CAST(sum(e) AS BIGINT) AS escolas, CAST(sum(if(m, e, 0)) AS BIGINT) AS escolas_mascaradas,
    CAST(sum(if(m, p, 0)) AS BIGINT) AS participantes_em_mascaradas, CAST(sum(if(c, e, 0)) AS BIGINT) AS escolas_no_censo,
    CAST(sum(if(c, p, 0)) AS BIGINT) AS participantes_no_censo, (SELECT count(*) FROM person) AS participantes,
    CAST(sum(p) AS BIGINT) AS participantes_com_escola FROM ({_KINDS})"""


@query("AGG-07_join_coverage", "SELECT *, " + ", ".join((
    _share("participantes_com_escola", "participantes", "pct_com_escola"),
    _share("escolas_mascaradas", "escolas", "pct_mascaradas"),
    _share("escolas_no_censo", "escolas", "pct_no_censo"),
    _share("escolas_no_censo", "(escolas - escolas_mascaradas)", "pct_no_censo_reais"),
    _share("participantes_no_censo", "participantes_com_escola", "pct_participantes"),
    _share("participantes_no_censo", "(participantes_com_escola - participantes_em_mascaradas)", "pct_participantes_reais"),
)) + f" FROM ({_TOTALS})")
def join_coverage(lake):
    matched = exams.census_match(lake.exam_school, lake.census_for_exam)
    return exams.coverage(matched, exams.file_summary(lake.participant))


# The lower ends of the bands and their labels.
_BANDS = "(VALUES (0, 0, '1'), (1, 2, '2 a 4'), (2, 5, '5 a 9'), (3, 10, '10 a 29'), (4, 30, '30 a 99'), (5, 100, '100 ou mais'))"


@query("AGG-08_participant_bands", f"""SELECT b.faixa, b.rotulo, count(*) AS escolas, CAST(sum(s.participantes) AS BIGINT) AS participantes,
    count(*) FILTER (s.no_censo) AS no_censo FROM {_MATCH} s ASOF JOIN {_BANDS} AS b(faixa, de, rotulo) ON s.participantes >= b.de GROUP BY ALL""")
def participant_bands(lake):
    return exams.bands(exams.census_match(lake.exam_school, lake.census_for_exam))


@query("AGG-09_prepared_coverage", """SELECT count(*) AS escolas_enem, count(c.co_entidade) AS escolas_com_censo,
    count(*) - count(c.co_entidade) AS escolas_sem_censo, count(*) FILTER (c.co_entidade IS NULL AND poucos_participantes) AS poucos_sem_censo,
    CAST(sum(participantes) AS BIGINT) AS participantes, CAST(coalesce(sum(participantes) FILTER (c.co_entidade IS NOT NULL), 0) AS BIGINT) AS participantes_com_censo
    FROM exam_school e LEFT JOIN census_for_exam c ON c.co_entidade = e.co_escola""")
def prepared_coverage(lake):
    return exams.prepared_coverage(lake.exam_input, lake.census_for_exam)


# A raw code is unreadable for every fifth customer, so those can't be found by it.
@query("JOIN-09_semi_join_on_safe_cast", f"""SELECT count(*) AS escolas FROM (SELECT co_escola FROM {_MATCH} WHERE NOT (no_censo OR poucos_participantes))
    SEMI JOIN (SELECT c_custkey AS co_escola FROM customer WHERE c_custkey % 5 <> 0) USING (co_escola)""")
def semi_join_safe_cast(lake):
    key = F.col("c_custkey").cast("string")
    raw = lake.table("customer").select(F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("x"), key)).otherwise(key).alias("CO_ENTIDADE"))
    return exams.known_only_in_raw(exams.census_match(lake.exam_school, lake.census_for_exam), raw, "CO_ENTIDADE")


# -- metrics -------------------------------------------------------------------------------------

_THAT_YEAR = "performance_years r JOIN school_years s ON s.co_entidade = r.co_escola AND s.ano = r.ano"


def _sides(item: str, area: str, year: int, minimum: int) -> str:
    """Means and numbers of schools per network and state of an item, then both sides next to each other."""
    by_state = f"""SELECT s.rede, d.m['{item}'] AS lado, avg(r.{area}) AS media, count(DISTINCT r.co_escola) AS n FROM {_THAT_YEAR}
        JOIN profile d ON d.escola_infra_sk = r.escola_infra_sk AND d.co_entidade = r.co_escola
        WHERE r.ano = {year} AND r.{area} IS NOT NULL GROUP BY ALL"""
    return f"""SELECT com.rede, round(com.media - sem.media, 6) AS diferenca, com.n AS n_com, sem.n AS n_sem
        FROM (SELECT * FROM ({by_state}) WHERE lado = 'existente') com JOIN (SELECT * FROM ({by_state}) WHERE lado = 'inexistente') sem
        USING (rede) WHERE least(com.n, sem.n) >= {minimum}"""


@query("AGG-10_score_mean", f"""SELECT count(DISTINCT r.co_escola) AS n_escolas, round(avg(r.media_geral), 6) AS media,
    round(stddev_samp(r.media_geral), 6) AS desvio_padrao FROM {_THAT_YEAR} WHERE r.ano = {EXAM_YEAR} AND s.rede = 'estadual'
    AND r.media_geral IS NOT NULL HAVING count(DISTINCT r.co_escola) >= 10""")
def score_mean(lake):
    metric = metrics.METRICS["media_enem_escolas"]
    out = metric(lake.performance_years, lake.school_years, year=EXAM_YEAR, where=F.col("rede") == "estadual")
    return out.withColumns({c: F.round(c, 6) for c in ("media", "desvio_padrao")})


@query("AGG-11_with_without_item", _sides("item_2", "media_geral", EXAM_YEAR, 10))
def with_without_item(lake):
    metric = metrics.METRICS["diferenca_media_com_sem_item"]
    out = metric(lake.performance_years, lake.school_years, lake.profile, item="item_2", year=EXAM_YEAR)
    return out.withColumn("diferenca", F.round("diferenca", 6))


@query("AGG-12_state_share", f"""SELECT situacao, n_escolas, round(100.0::DOUBLE * n_escolas / (SELECT count(*) FROM school_years WHERE ano = {EXAM_YEAR}), 1)
    AS percentual FROM (SELECT coalesce(p.m['item_2'], 'nao_informado') AS situacao, count(*) AS n_escolas FROM
      (SELECT *, TIMESTAMP '{EXAM_REFERENCE}' AS em FROM school_years WHERE ano = {EXAM_YEAR}) s
      ASOF LEFT JOIN profile p ON p.co_entidade = s.co_entidade AND s.em >= p.valid_from GROUP BY ALL)""")
def state_share(lake):
    metric = metrics.METRICS["pct_escolas_por_situacao_do_item"]
    return metric(lake.school_years, lake.performance_years, lake.profile, item="item_2", year=EXAM_YEAR)


def _covered(year: int, registered: str, has_results: str) -> str:
    """Coverage of a year from the sets of ids: ``registered`` and ``has_results`` are conditions on a school's number."""
    return f"""SELECT n AS escolas_enem, f AS encontradas, n - f AS nao_encontradas, m AS mascaradas, round(100.0::DOUBLE * f / n, 1) AS percentual,
        {year} AS ano FROM (SELECT count(*) AS n, count(*) FILTER (in_year) AS f, count(*) FILTER (NOT in_year AND poucos_participantes) AS m
        FROM (SELECT poucos_participantes, co_escola IN (SELECT co_entidade FROM school WHERE {registered}) AS in_year FROM exam_school WHERE {has_results}))"""


@query("AGG-13_exam_coverage", _covered(EXAM_YEAR, "co_entidade % 7 <> 0", "true") + " UNION ALL " + _covered(EXAM_YEAR - 1, "co_entidade % 5 <> 0", "co_escola % 2 = 0"))
def exam_coverage(lake):
    metric = metrics.METRICS["cobertura_enem_censo"]
    each = [metric(lake.exam_years, lake.census_years, year=y).withColumn("ano", F.lit(y)) for y in (EXAM_YEAR, EXAM_YEAR - 1)]
    return each[0].unionByName(each[1])


@query("MET-01_metric_registry", f"SELECT n_com + n_sem AS n, rede FROM ({_sides('item_1', 'media_cn', EXAM_YEAR - 1, 50)})")
def metric_registry(lake):
    """Another item, area, year and minimum through the same registry entry."""
    metric = metrics.METRICS["diferenca_media_com_sem_item"]
    out = metric(lake.performance_years, lake.school_years, lake.profile, item="item_1", year=EXAM_YEAR - 1, area="media_cn", minimum=50)
    return out.select((F.col("n_com") + F.col("n_sem")).alias("n"), "rede")


@query("WIN-09_percent_rank", """SELECT co_escola, sg_uf_esc, round(percent_rank() OVER (PARTITION BY sg_uf_esc ORDER BY media_geral), 9) AS percentil,
    count(*) OVER (PARTITION BY sg_uf_esc) AS n_grupo FROM exam_school WHERE media_geral IS NOT NULL""")
def percent_rank(lake):
    rows = lake.exam_school.where(F.col("media_geral").isNotNull()).select("co_escola", "sg_uf_esc", "media_geral")
    return metrics.percent_ranks(rows, ["sg_uf_esc"], "media_geral").select(
        "co_escola", "sg_uf_esc", F.round("percentil", 9).alias("percentil"), "n_grupo"
    )


@query("AGG-24_exact_quantiles", """SELECT origem, count(*) AS amostras, round(median(l_extendedprice), 6) AS mediana_s,
    round(quantile_cont(l_extendedprice, 0.95), 6) AS p95_s, min(l_extendedprice) AS minimo_s, max(l_extendedprice) AS maximo_s
    FROM lineitem JOIN inspection ON vistoria_id = l_orderkey GROUP BY origem""")
def exact_quantiles(lake):
    from ledgerlake.streaming import telemetry

    rows = lake.table("lineitem").join(lake.inspection, F.col("l_orderkey") == F.col("vistoria_id")).select("origem", "l_extendedprice")
    out = telemetry.latency_summary(rows, ["origem"], "l_extendedprice", bucket=lambda v: F.floor(v / 100))
    return out.withColumns({c: F.round(c, 6) for c in ("mediana_s", "p95_s")})


@query("AGG-25_nearest_rank", """SELECT origem, list_sort(list(l_quantity))[greatest(CAST(floor(count(*) * 0.95) AS INT), 1)] AS p95
    FROM lineitem JOIN inspection ON vistoria_id = l_orderkey GROUP BY origem""")
def nearest_rank(lake):
    rows = lake.table("lineitem").join(lake.inspection, F.col("l_orderkey") == F.col("vistoria_id")).select("origem", "l_quantity")
    return ordered.nearest_rank(rows, ["origem"], "l_quantity", 0.95, "p95", lambda v: F.floor(v))


# -- reads of the layers -------------------------------------------------------------------------

@query("AGG-17_one_region", "SELECT count(*) AS linhas FROM wide WHERE sg_uf = 'ASIA' AND item_codigo = 'item_3' AND situacao = 'inexistente'")
def one_region(lake):
    return workload.one_region(lake.wide, "ASIA", "item_3")


@query("AGG-17_one_region_by_network", """SELECT tp_dependencia, tp_localizacao, count(*) FILTER (situacao = 'inexistente') AS ausentes
    FROM wide WHERE sg_uf = 'EUROPE' GROUP BY ALL""")
def one_region_by_network(lake):
    return workload.one_region_by_network(lake.wide, "EUROPE")


@query("AGG-17_national", "SELECT sg_uf, item_codigo, count(*) FILTER (situacao = 'inexistente') AS ausentes FROM wide GROUP BY ALL")
def national(lake):
    return workload.national(lake.wide)


@query("AGG-17_one_school", "SELECT * FROM wide WHERE co_entidade = 11")
def one_school(lake):
    return workload.one_school(lake.wide, 11)


@query("AGG-18_absent_per_item", "SELECT item_codigo, count(*) AS linhas FROM event WHERE situacao = 'inexistente' GROUP BY item_codigo")
def absent_per_item(lake):
    return workload.absent_per_item(lake.event)


@query("AGG-18_region_by_joins", """SELECT count(*) AS linhas FROM event JOIN school USING (co_entidade) JOIN municipality m USING (co_municipio)
    WHERE m.sg_uf = 'AFRICA' AND item_codigo = 'item_3' AND situacao = 'inexistente'""")
def region_by_joins(lake):
    return workload.region_by_joins(lake.event.drop("sg_uf"), lake.school, lake.municipality, "AFRICA", "item_3")


@query("AGG-18_full_scan", """SELECT count(*) AS linhas, count(DISTINCT co_entidade) AS escolas, count(DISTINCT item_codigo) AS itens,
    count(DISTINCT situacao) AS situacoes FROM event""")
def full_scan(lake):
    return workload.full_scan(lake.event)


@query("AGG-19_workload_counters", """SELECT 'municipios' AS medida, count(*) AS valor FROM municipality
    UNION ALL SELECT 'escolas', count(*) FROM school UNION ALL SELECT 'vistorias', count(*) FROM inspection
    UNION ALL SELECT 'itens', count(*) FROM item UNION ALL SELECT 'itens_existentes', count(*) FROM item WHERE situacao = 'existente'
    UNION ALL SELECT 'itens_nao_informados', count(*) FROM item WHERE situacao = 'nao_informado'
    UNION ALL SELECT 'escolas_sem_item_1', count(*) FROM latest WHERE item_codigo = 'item_1' AND situacao = 'inexistente'
    UNION ALL SELECT 'escolas_sem_item_3', count(*) FROM latest WHERE item_codigo = 'item_3' AND situacao = 'inexistente'""")
def workload_counters(lake):
    return workload.counters(lake.municipality, lake.school, lake.inspection, lake.item, lake.latest, ("item_1", "item_3"))


@query("SORT-02_hash_sample", "SELECT DISTINCT co_entidade FROM event ORDER BY md5(co_entidade::VARCHAR), co_entidade LIMIT 25")
def hash_sample(lake):
    return workload.hash_sample(lake.event, "co_entidade", 25)


_CHOSEN = "(SELECT DISTINCT co_entidade FROM event ORDER BY md5(co_entidade::VARCHAR), co_entidade LIMIT 25)"


@query("JOIN-10_day_batch", f"SELECT co_entidade IN {_CHOSEN} AS no_lote, count(*) AS linhas, count(DISTINCT co_entidade) AS escolas FROM event GROUP BY ALL")
def day_batch(lake):
    base, batch = workload.day_batch(lake.event, "co_entidade", 25)
    both = base.withColumn("no_lote", F.lit(False)).unionByName(batch.withColumn("no_lote", F.lit(True)))
    return both.groupBy("no_lote").agg(F.count("*").alias("linhas"), F.countDistinct("co_entidade").alias("escolas"))


@query("JOIN-10_modulo_batches", "SELECT CAST(co_entidade % 20 AS INT) AS lote, count(*) AS linhas FROM event GROUP BY ALL")
def modulo_batches(lake):
    return workload.batch_number(lake.event, "co_entidade", 20).groupBy("lote").agg(F.count("*").alias("linhas"))


@query("PRJ-17_incremental_reload", "SELECT * FROM event WHERE registrado_em > TIMESTAMP '2001-06-01'")
def incremental_reload(lake):
    return workload.newer_than(lake.event, "2001-06-01 00:00:00")


@query("AGG-35_base_sanity", f"""SELECT count(*) AS linhas, count(DISTINCT co_escola) AS escolas, DATE '{EXAM_REFERENCE}' AS primeira_referencia,
    DATE '{EXAM_REFERENCE}' AS ultima_referencia, count(*) = count(DISTINCT co_escola) AND count(*) > 0 AS valida FROM performance""")
def base_sanity(lake):
    return quality.base_problems(lake.performance, "data_referencia_infraestrutura")


@query("SC-03_safe_cast", """SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE value::VARCHAR END AS DOUBLE) AS valor,
    TRY_CAST(event_type AS BIGINT) AS inteiro FROM events""")
def safe_cast(lake):
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    return lake.table("events").select(
        "event_id", text.try_cast("double").alias("valor"), F.col("event_type").try_cast("bigint").alias("inteiro")
    )


@query("SC-20_finite_scores", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS nota FROM events""")
def finite_scores(lake):
    """A third of the values are turned into NaN or infinity and must come back as NULL."""
    from ledgerlake.functions.columns import finite

    k = F.col("event_id")
    dirty = F.when(k % 6 == 0, F.lit(float("nan"))).when(k % 6 == 3, F.lit(float("-inf"))).otherwise(F.col("value"))
    return lake.table("events").select("event_id", finite(dirty).alias("nota"))


@query("SC-12_month_limits", """SELECT DISTINCT mes_ocorrencia AS mes, (mes_ocorrencia||'-01')::TIMESTAMP AS inicio,
    (mes_ocorrencia||'-01')::TIMESTAMP + INTERVAL 1 MONTH AS fim, strftime((mes_ocorrencia||'-01')::TIMESTAMP - INTERVAL 1 MONTH, '%Y-%m') AS mes_anterior,
    (mes_ocorrencia||'-01')::TIMESTAMP + INTERVAL 1 MONTH + INTERVAL 7 DAY AS fechamento FROM event""")
def month_limits(lake):
    from ledgerlake.streaming import windows

    return windows.month_bounds(lake.event.select(F.col("mes_ocorrencia").alias("mes")).distinct())


@query("SC-05_row_text_and_hash", """SELECT vistoria_id, item_codigo, md5(concat_ws('|', vistoria_id, item_codigo, coalesce(quantidade::VARCHAR, 'nulo'))) AS m,
    sha256(concat_ws('|', vistoria_id, item_codigo, coalesce(quantidade::VARCHAR, 'nulo'))) AS s, substr(situacao, 1, 5) AS curto,
    split_part(origem, '_', 1) AS prefixo, regexp_full_match(item_codigo, '[a-z_]+[0-4]') AS baixo FROM event""")
def row_text_and_hash(lake):
    from ledgerlake.functions.columns import row_text

    text = row_text(["vistoria_id", "item_codigo", "quantidade"])
    return lake.event.select(
        "vistoria_id", "item_codigo", F.md5(text).alias("m"), F.sha2(text, 256).alias("s"),
        F.substring("situacao", 1, 5).alias("curto"), F.split("origem", "_")[0].alias("prefixo"),
        F.col("item_codigo").rlike("^[a-z_]+[0-4]$").alias("baixo"),
    )
