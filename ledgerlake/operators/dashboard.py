"""Dashboard extract and the calculations made over a slice of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import AREAS, MIN_GROUP, STATES
from ledgerlake.functions.columns import encode_items, finite
from ledgerlake.operators import metrics, ordered

# Display names by school network code.
NETWORKS = {1: "Federal", 2: "Estadual", 3: "Municipal", 4: "Privada"}
SCORES = ("media_geral", *[f"media_{a}" for a in AREAS])


def census_base(schools: DataFrame, municipalities: DataFrame, profiles_at_reference: DataFrame) -> DataFrame:
    """Schools with place and the profile in force at the reference date (never a later one)."""
    place = municipalities.select("co_municipio", "no_municipio", "sg_uf")
    profile = profiles_at_reference.select("co_entidade", F.col("escola_infra_sk").alias("perfil"), "itens")
    return (
        schools.select("co_entidade", "tp_dependencia", "localizacao", "co_municipio")
        .join(place, "co_municipio", "left").join(profile, "co_entidade", "left")
    )


def exam_base(performance: DataFrame, schools: DataFrame, profiles: DataFrame) -> DataFrame:
    """Exam facts of registered schools with the profile their own key points to."""
    known = performance.join(schools.select("co_entidade"), "co_entidade", "left_semi")
    own = profiles.select("escola_infra_sk", "co_entidade", "itens")
    return known.join(own, ["escola_infra_sk", "co_entidade"], "left").withColumnRenamed("escola_infra_sk", "perfil")


def slice_filter(uf: str | None = None, municipality: int | None = None, network: int | str | None = None,
                 location: str | None = None) -> Column:
    """Optional filters; ``network='publica'`` means federal, state and municipal."""
    keep = F.lit(True)
    if uf is not None:
        keep = keep & (F.col("sg_uf") == uf)
    if municipality is not None:
        keep = keep & (F.col("co_municipio") == municipality)
    if network == "publica":
        keep = keep & F.col("tp_dependencia").isin(1, 2, 3)
    elif network is not None:
        keep = keep & (F.col("tp_dependencia") == network)
    if location is not None:
        keep = keep & (F.col("localizacao") == location)
    return keep


def exam_slice(exam: DataFrame, census_slice: DataFrame) -> DataFrame:
    place = census_slice.select("co_entidade", "tp_dependencia", "localizacao", "sg_uf")
    return exam.join(place, "co_entidade")


def network_label() -> Column:
    out = F.lit("Não informada")
    for code, label in NETWORKS.items():
        out = F.when(F.col("tp_dependencia") == code, label).otherwise(out)
    return out


def kpis(census_slice: DataFrame, exam: DataFrame, score: str = "media_geral") -> DataFrame:
    left = census_slice.agg(F.count("*").alias("censo"), F.count("perfil").alias("perfis_censo"))
    right = exam.agg(
        F.count("*").alias("enem"),
        F.coalesce(F.sum("n_participantes"), F.lit(0).cast("bigint")).alias("participantes"),
        F.count("perfil").alias("perfis_enem"),
        F.count_if(finite(score).isNull()).alias("escolas_sem_nota"),
    )
    # One subquery for all four: each of its own would build the exam side again.
    one = right.select(F.struct(*right.columns).alias("_exam")).scalar()
    return left.withColumn("_exam", one).select("*", *[f"_exam.{c}" for c in right.columns]).drop("_exam")


def summarize(score: str | Column) -> dict[str, Column]:
    """n, mean and deviation (0 for one score) of finite scores."""
    value = finite(score)
    return {
        "n": F.count(value), "media": F.avg(value),
        "desvio": F.when(F.count(value) > 0, F.coalesce(F.stddev_samp(value), F.lit(0.0))),
    }


def _suppressed(grouped: DataFrame, minimum: int) -> DataFrame:
    shown = F.col("n") >= minimum
    return grouped.withColumns({"media": F.when(shown, F.col("media")), "desvio": F.when(shown, F.col("desvio"))})


def score_summary(exam: DataFrame, by: Sequence[Column], score: str, minimum: int = MIN_GROUP) -> DataFrame:
    grouped = exam.groupBy(*by).agg(*[c.alias(n) for n, c in summarize(score).items()])
    return _suppressed(grouped, minimum)


def by_network_and_state(exam: DataFrame, item: str, score: str = "media_geral", minimum: int = MIN_GROUP) -> DataFrame:
    return score_summary(
        exam, [network_label().alias("rede"), metrics.item_state(item).alias("estado")], score, minimum
    )


def by_network_and_location(exam: DataFrame, score: str = "media_geral", minimum: int = MIN_GROUP) -> DataFrame:
    return score_summary(exam, [network_label().alias("rede"), F.col("localizacao")], score, minimum)


def by_area(exam: DataFrame, minimum: int = MIN_GROUP) -> DataFrame:
    long = exam.select(*[finite(s).alias(s) for s in SCORES]).unpivot([], list(SCORES), "area", "nota")
    return score_summary(long, [F.col("area")], "nota", minimum)


def suppressed_groups(comparison: DataFrame) -> DataFrame:
    return comparison.agg(F.count_if(F.col("media").isNull()).alias("grupos_pequenos"))


def pairs(comparison: DataFrame) -> DataFrame:
    """Networks where both "has" and "lacks" are shown, with the difference of means."""
    has = F.max(F.when(F.col("estado") == "existente", F.col("media")))
    lacks = F.max(F.when(F.col("estado") == "inexistente", F.col("media")))
    sides = comparison.groupBy("rede").agg(has.alias("media_com"), lacks.alias("media_sem"))
    return sides.where(F.col("media_com").isNotNull() & F.col("media_sem").isNotNull()).withColumn(
        "diferenca", F.col("media_com") - F.col("media_sem")
    )


def item_matrix(census_slice: DataFrame, catalog: Sequence[str]) -> DataFrame:
    """Schools per item and state; one pass over the schools, catalog x 5 counters."""
    states = census_slice.select(*[metrics.item_state(c).alias(c) for c in catalog])
    long = states.unpivot([], list(catalog), "item_codigo", "_state")
    return long.groupBy("item_codigo").agg(*[F.count_if(F.col("_state") == s).alias(s) for s in STATES])


def by_region(census_slice: DataFrame, item: str) -> DataFrame:
    state = metrics.item_state(item)
    return census_slice.groupBy("sg_uf").agg(
        F.count("*").alias("total"), *[F.count_if(state == s).alias(s) for s in STATES]
    )


def by_network(census_slice: DataFrame) -> DataFrame:
    return census_slice.groupBy(network_label().alias("rede")).agg(F.count("*").alias("escolas"))


def histogram(exam: DataFrame, score: str, bins: int = 24, low: float = 0.0, high: float = 1000.0) -> DataFrame:
    """Fixed equal-width bins over the score scale; both ends are clamped into the last bins."""
    value = finite(score)
    width = (high - low) / bins
    index = F.least(F.greatest(F.floor((value - low) / width), F.lit(0)), F.lit(bins - 1)).cast("int")
    return exam.where(value.isNotNull()).groupBy(index.alias("faixa")).agg(F.count("*").alias("escolas"))


def top_absences(matrix: DataFrame, n: int = 3) -> DataFrame:
    """Items most often declared absent."""
    return (
        matrix.where(F.col("inexistente") > 0).select("item_codigo", "inexistente")
        .orderBy(F.desc("inexistente"), "item_codigo").limit(n)
    )


def share_order(regions: DataFrame) -> DataFrame:
    share = F.col("existente") / F.col("total")
    return regions.select("sg_uf", F.round(share, 6).alias("parte")).orderBy(F.desc(share), "sg_uf")


def coverage(exam_input: DataFrame, census: DataFrame) -> DataFrame:
    rows = exam_input.join(census.select("co_entidade", F.lit(True).alias("_known")), "co_entidade", "left")
    known = F.coalesce("_known", F.lit(False))
    return rows.agg(
        F.count("*").alias("entrada"), F.count_if(known).alias("identificadas"),
        F.count_if(~known).alias("sem_juncao"),
        F.count_if(~known & F.col("poucos_participantes")).alias("mascaradas"),
    )


def municipality_rows(census: DataFrame) -> DataFrame:
    """Municipalities of the extract with their position; missing names are spelled out."""
    rows = census.select(
        "co_municipio", F.coalesce("no_municipio", F.lit("Município não informado")).alias("no_municipio"),
        F.coalesce("sg_uf", F.lit("Não informada")).alias("sg_uf"),
    ).distinct()
    return ordered.global_index(rows, "co_municipio", _thousands, "posicao")


def _thousands(value: Column) -> Column:
    return F.floor(value / 100_000)


def school_rows(census: DataFrame, municipalities: DataFrame, catalog: Sequence[str]) -> DataFrame:
    """Schools with positions and one digit per item, ready to be written as JSON arrays."""
    place = municipalities.select("co_municipio", F.col("posicao").alias("municipio"))
    location = F.when(F.col("localizacao") == "urbana", 1).when(F.col("localizacao") == "rural", 2).otherwise(0)
    rows = census.join(place, "co_municipio").select(
        "co_entidade", "municipio", F.col("tp_dependencia").alias("rede"), location.alias("local"),
        encode_items("itens", sorted(catalog)).alias("itens"), F.col("perfil").isNotNull().alias("tem_perfil"),
    )
    return ordered.global_index(rows, "co_entidade", _thousands, "posicao")


def exam_rows(exam: DataFrame, school_positions: DataFrame, catalog: Sequence[str]) -> DataFrame:
    place = school_positions.select("co_entidade", F.col("posicao").alias("escola"))
    return exam.join(place, "co_entidade").select(
        "escola", encode_items("itens", sorted(catalog)).alias("itens"),
        *[finite(s).alias(s) for s in SCORES], "n_participantes", F.col("perfil").isNotNull().alias("tem_perfil"),
    )
