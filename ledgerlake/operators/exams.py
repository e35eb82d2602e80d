"""Exam results: one row per examinee -> school aggregates, file summary, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import AREAS, BAND_EDGES, ESSAY, MIN_PARTICIPANTS, OBJECTIVE_AREAS
from ledgerlake.functions.columns import all_of, band_index, band_label, pct

SCORE = "decimal(18,6)"
SCHOOL_ATTRIBUTES = (
    "co_municipio_esc", "sg_uf_esc", "tp_dependencia_adm_esc", "tp_localizacao_esc", "tp_sit_func_esc",
)


def participants(raw: DataFrame) -> DataFrame:
    """Valid scores per examinee: objective only when present, essay only with a status."""
    columns = [
        F.col("NU_ANO").cast("smallint").alias("ano"),
        F.col("CO_ESCOLA").cast("bigint").alias("co_escola"),
        F.col("CO_MUNICIPIO_ESC").cast("int").alias("co_municipio_esc"),
        F.col("SG_UF_ESC").alias("sg_uf_esc"),
        F.col("TP_DEPENDENCIA_ADM_ESC").cast("smallint").alias("tp_dependencia_adm_esc"),
        F.col("TP_LOCALIZACAO_ESC").cast("smallint").alias("tp_localizacao_esc"),
        F.col("TP_SIT_FUNC_ESC").cast("smallint").alias("tp_sit_func_esc"),
    ]
    for area in OBJECTIVE_AREAS:
        here = F.col(f"TP_PRESENCA_{area.upper()}") == "1"
        score = F.col(f"NU_NOTA_{area.upper()}").cast("double")
        columns += [F.when(here, score).alias(f"nota_{area}"), (here & score.isNull()).alias(f"faltante_{area}")]
    essay = F.when(F.col("TP_STATUS_REDACAO").isNotNull(), F.col("NU_NOTA_REDACAO").cast("double"))
    return raw.select(*columns, essay.alias("nota_redacao"))


def has_all_scores() -> Column:
    return all_of(F.col(f"nota_{a}").isNotNull() for a in AREAS)


def has_no_score() -> Column:
    return all_of(F.col(f"nota_{a}").isNull() for a in AREAS)


def exact_mean(x: Column) -> Column:
    """Mean over exact decimals: independent of row order and partitioning."""
    return F.sum(x.cast(SCORE)).cast("double") / F.nullif(F.count(x), F.lit(0))


def school_results(rows: DataFrame) -> DataFrame:
    """Per-school results; rows without a school are left out."""
    complete = has_all_scores()
    five = F.when(complete, sum((F.col(f"nota_{a}").cast(SCORE) for a in AREAS), F.lit(0).cast(SCORE)))
    n_complete = F.count(five)
    return (
        rows.where(F.col("co_escola").isNotNull())
        .groupBy("co_escola")
        .agg(
            F.any_value("ano", F.lit(True)).alias("ano"),
            *[F.any_value(a, F.lit(True)).alias(a) for a in SCHOOL_ATTRIBUTES],
            F.count("*").alias("participantes"),
            n_complete.alias("participantes_com_todas_as_notas"),
            F.count_if(has_no_score()).alias("participantes_sem_nota_valida"),
            *[c for a in AREAS for c in (
                F.count(f"nota_{a}").alias(f"notas_validas_{a}"),
                exact_mean(F.col(f"nota_{a}")).alias(f"media_{a}"),
            )],
            F.count_if(F.col(f"nota_{ESSAY}") == 0).alias("redacoes_nota_zero"),
            (F.sum(five).cast("double") / F.nullif(5 * n_complete, F.lit(0))).alias("media_geral"),
            (F.count("*") < MIN_PARTICIPANTS).alias("poucos_participantes"),
        )
    )


def file_summary(rows: DataFrame) -> DataFrame:
    """One row about the whole exam file, including rows without a school."""
    missing = sum((F.count_if(F.col(f"faltante_{a}")) for a in OBJECTIVE_AREAS), F.lit(0).cast("bigint"))
    zero = sum((F.count_if(F.col(f"nota_{a}") == 0) for a in OBJECTIVE_AREAS), F.lit(0).cast("bigint"))
    return rows.agg(
        F.any_value("ano", F.lit(True)).alias("ano"),
        F.count("*").alias("participantes"),
        F.count("co_escola").alias("participantes_com_escola"),
        F.countDistinct("co_escola").alias("escolas"),
        F.count_if(has_all_scores()).alias("participantes_com_todas_as_notas"),
        F.count_if(has_no_score()).alias("participantes_sem_nota_valida"),
        missing.alias("notas_objetivas_faltantes"),
        zero.alias("notas_objetivas_zero"),
        F.count_if(F.col("nota_redacao") == 0).alias("redacoes_nota_zero"),
    )


def mean_without_zero_essays(results: DataFrame) -> DataFrame:
    """Essay mean without zero essays, recovered from the aggregates alone."""
    scored = F.col("notas_validas_redacao") - F.col("redacoes_nota_zero")
    mean = F.col("media_redacao") * F.col("notas_validas_redacao") / F.nullif(scored, F.lit(0))
    return results.withColumn("media_redacao_sem_zeros", mean)


def prepared(results: DataFrame) -> DataFrame:
    """Exam results under the star schema's names."""
    names = {
        "co_escola": "co_entidade", "participantes": "n_participantes",
        "participantes_sem_nota_valida": "n_participantes_sem_nota",
        "participantes_com_todas_as_notas": "n_participantes_com_todas_as_notas",
    }
    kept = [
        "co_escola", "ano", "participantes", "participantes_com_todas_as_notas", "participantes_sem_nota_valida",
        *[f"media_{a}" for a in AREAS], "media_geral", "poucos_participantes",
    ]
    return results.select(*[F.col(c).alias(names.get(c, c)) for c in kept])


def census_match(results: DataFrame, schools: DataFrame) -> DataFrame:
    """Exam schools with a flag telling whether the census knows them."""
    known = schools.select(F.col("co_entidade").alias("co_escola"), F.lit(True).alias("_known"))
    return results.join(known, "co_escola", "left").withColumn(
        "no_censo", F.coalesce("_known", F.lit(False))
    ).drop("_known")


def _sum_if(condition: Column, value: str) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0).cast("bigint"))


def coverage(matched: DataFrame, summary: DataFrame) -> DataFrame:
    """Join coverage with percentages over all schools and over unmasked ones."""
    masked, known = F.col("poucos_participantes"), F.col("no_censo")
    totals = matched.agg(
        F.count("*").alias("escolas"),
        F.count_if(masked).alias("escolas_mascaradas"),
        _sum_if(masked, "participantes").alias("participantes_em_mascaradas"),
        F.count_if(known).alias("escolas_no_censo"),
        _sum_if(known, "participantes").alias("participantes_no_censo"),
    )
    one = summary.select("participantes", "participantes_com_escola")
    real = F.col("escolas") - F.col("escolas_mascaradas")
    in_real = F.col("participantes_com_escola") - F.col("participantes_em_mascaradas")
    return (
        totals.withColumn("participantes", one.select("participantes").scalar())
        .withColumn("participantes_com_escola", one.select("participantes_com_escola").scalar())
        .withColumns({
            "pct_com_escola": pct(F.col("participantes_com_escola"), F.col("participantes"), 1),
            "pct_mascaradas": pct(F.col("escolas_mascaradas"), F.col("escolas"), 1),
            "pct_no_censo": pct(F.col("escolas_no_censo"), F.col("escolas"), 1),
            "pct_no_censo_reais": pct(F.col("escolas_no_censo"), real, 1),
            "pct_participantes": pct(F.col("participantes_no_censo"), F.col("participantes_com_escola"), 1),
            "pct_participantes_reais": pct(F.col("participantes_no_censo"), in_real, 1),
        })
    )


def bands(matched: DataFrame) -> DataFrame:
    """Schools by number of participants, in fixed bands."""
    return (
        matched.groupBy(
            band_index("participantes", BAND_EDGES).alias("faixa"),
            band_label("participantes", BAND_EDGES).alias("rotulo"),
        )
        .agg(
            F.count("*").alias("escolas"),
            F.sum("participantes").alias("participantes"),
            F.count_if(F.col("no_censo")).alias("no_censo"),
        )
    )


def known_only_in_raw(matched: DataFrame, raw_codes: DataFrame, code: str) -> DataFrame:
    """Unmatched real-code exam schools that still exist in the raw census file (text codes)."""
    raw = raw_codes.select(F.col(code).try_cast("bigint").alias("co_escola"))
    return (
        matched.where(~F.col("no_censo") & ~F.col("poucos_participantes"))
        .join(raw, "co_escola", "left_semi")
        .agg(F.count("*").alias("escolas"))
    )


def prepared_coverage(exam: DataFrame, schools: DataFrame) -> DataFrame:
    """Coverage counters kept as a contract beside the prepared sources."""
    rows = exam.join(schools.select("co_entidade", F.lit(True).alias("_known")), "co_entidade", "left")
    known = F.coalesce("_known", F.lit(False))
    return rows.agg(
        F.count("*").alias("escolas_enem"),
        F.count_if(known).alias("escolas_com_censo"),
        F.count_if(~known).alias("escolas_sem_censo"),
        F.count_if(~known & F.col("poucos_participantes")).alias("poucos_sem_censo"),
        F.coalesce(F.sum("n_participantes"), F.lit(0).cast("bigint")).alias("participantes"),
        _sum_if(known, "n_participantes").alias("participantes_com_censo"),
    )
