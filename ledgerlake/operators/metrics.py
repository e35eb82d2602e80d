"""Analytic metrics, with small-group suppression applied in one place.

``METRICS`` is the registry: every metric names its grain, its filters and its minimum group.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import ABSENT, MIN_GROUP, ORIGIN_ON_SITE, PRESENT, UNKNOWN
from ledgerlake.functions.columns import NTZ, pct
from ledgerlake.operators import history, ordered

PUBLIC = ("federal", "estadual", "municipal")


@dataclass(frozen=True)
class Metric:
    name: str
    grain: str
    filters: tuple[str, ...]
    minimum: int
    compute: Callable[..., DataFrame]
    group_sizes: tuple[str, ...] = ()
    # True where small groups must be gone before something else is computed from the rest.
    suppresses_inside: bool = False

    def __call__(self, *frames: DataFrame, **params) -> DataFrame:
        """Compute, then drop every group whose size columns are under the minimum."""
        minimum = params.pop("minimum", self.minimum)
        if self.suppresses_inside:
            params["minimum"] = minimum
        out = self.compute(*frames, **params)
        for size in self.group_sizes:
            out = out.where(F.col(size) >= minimum)
        return out


def item_state(item: str) -> Column:
    return F.coalesce(F.try_element_at("itens", F.lit(item)), F.lit(UNKNOWN))


def sliced(schools: DataFrame, where: Column | None) -> DataFrame:
    """Schools of a slice; the condition may use any column of the given school frame."""
    return schools if where is None else schools.where(where)


def of_year(performance: DataFrame, schools: DataFrame, year: int, where: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Results of one year and the schools registered for it: a metric never mixes years."""
    return performance.where(F.col("ano") == year), sliced(schools.where(F.col("ano_censo_referencia") == year), where)


def score_mean(
    performance: DataFrame, schools: DataFrame, year: int, area: str = "media_geral", where: Column | None = None
) -> DataFrame:
    """Mean score of a year's schools; the group size is the number of different schools."""
    results, known = of_year(performance, schools, year, where)
    rows = results.where(F.col(area).isNotNull()).join(known.select("co_entidade"), "co_entidade", "left_semi")
    return rows.agg(
        F.count_distinct("co_entidade").alias("n_escolas"), F.avg(area).alias("media"), F.stddev_samp(area).alias("desvio_padrao")
    )


def with_without(
    performance: DataFrame, schools: DataFrame, profiles: DataFrame, item: str, year: int, area: str = "media_geral",
    where: Column | None = None,
) -> DataFrame:
    """Mean score of a year's schools with the item minus mean of those without it, per network."""
    results, known = of_year(performance, schools, year, where)
    rows = (
        results.where(F.col(area).isNotNull())
        .join(known.select("co_entidade", "rede"), "co_entidade")
        .join(profiles.select("escola_infra_sk", "co_entidade", "itens"), ["escola_infra_sk", "co_entidade"])
    )
    present, absent = item_state(item) == PRESENT, item_state(item) == ABSENT
    return rows.groupBy("rede").agg(
        (F.avg(F.when(present, F.col(area))) - F.avg(F.when(absent, F.col(area)))).alias("diferenca"),
        F.count_distinct(F.when(present, F.col("co_entidade"))).alias("n_com"),
        F.count_distinct(F.when(absent, F.col("co_entidade"))).alias("n_sem"),
    )


def state_share(
    schools: DataFrame, performance: DataFrame, profiles: DataFrame, item: str, year: int, where: Column | None = None
) -> DataFrame:
    """Share of a year's schools per state of the item at that year's reference date; unknown counts too.

    The profiles are filtered to the one reference instant first, so the join is one row per school.
    """
    results, known = of_year(performance, schools, year, where)
    reference = results.agg(F.max("data_referencia_infraestrutura").cast(NTZ).alias("em")).scalar()
    at_reference = profiles.where((F.col("valid_from") <= reference) & (reference < F.col("valid_to")))
    states = known.join(at_reference.select("co_entidade", "itens"), "co_entidade", "left")
    counted = states.groupBy(item_state(item).alias("situacao")).agg(F.count("*").alias("n_escolas"))
    return ratio_to_total(counted, "n_escolas", "percentual", 1)


def ratio_to_total(grouped: DataFrame, count: str, name: str, digits: int) -> DataFrame:
    """Share of each group in the whole, over the already grouped rows."""
    total = grouped.agg(F.sum(count).alias("_t")).scalar()
    return grouped.withColumn(name, pct(F.col(count), total, digits))


def exam_coverage(exam: DataFrame, schools: DataFrame, year: int, where: Column | None = None) -> DataFrame:
    """Schools with results of a year that are registered for that year.

    A school counts once, however many registrations of the year it has; those of other years do not count.
    """
    results, known = of_year(exam, schools, year, where)
    registered = known.groupBy("co_entidade").agg(F.lit(True).alias("_known"))
    rows = results.join(registered, "co_entidade", "left")
    known = F.coalesce("_known", F.lit(False))
    return rows.agg(
        F.count("*").alias("escolas_enem"),
        F.count_if(known).alias("encontradas"),
        F.count_if(~known).alias("nao_encontradas"),
        F.count_if(~known & F.col("poucos_participantes")).alias("mascaradas"),
    ).withColumn("percentual", pct(F.col("encontradas"), F.col("escolas_enem"), 1))


def unit_bucket(value: Column) -> Column:
    return F.floor(value)


def percent_ranks(rows: DataFrame, groups: list[str], value: str, bucket=unit_bucket) -> DataFrame:
    """Add percent rank and group size without putting a whole group into one task."""
    ranks = ordered.value_ranks(rows, groups, value, bucket).select(
        *groups, value,
        F.when(F.col("total") > 1, F.col("before") / (F.col("total") - 1)).otherwise(F.lit(0.0)).alias("percentil"),
        F.col("total").alias("n_grupo"),
    )
    return ordered.null_safe_join(rows, ranks, [*groups, value])


def inspection_priority(
    performance: DataFrame,
    schools: DataFrame,
    municipalities: DataFrame,
    profiles: DataFrame,
    fact_item: DataFrame,
    item: str,
    year: int,
    as_of: str,
    share: float = 0.2,
    days: int = 365,
    minimum: int = MIN_GROUP,
) -> DataFrame:
    """Public schools of a year to inspect first, numbered within each state.

    The ranked schools and the few that are kept are written once: ranks read their input again.
    """
    results, known = of_year(performance, schools, year, F.col("rede").isin(*PUBLIC))
    base = ordered.settle(
        results.where(F.col("media_geral").isNotNull())
        .join(known.select("co_entidade", "rede", "co_municipio"), "co_entidade")
        .join(municipalities.select("co_municipio", "sg_uf"), "co_municipio")
        .select("co_entidade", "rede", "sg_uf", "media_geral"),
        True,
    )
    ranked = percent_ranks(base, ["rede", "sg_uf"], "media_geral")
    current = profiles.where("is_current").select("co_entidade", "itens")
    low = (
        ranked.where((F.col("n_grupo") >= minimum) & (F.col("percentil") < share))
        .join(current, "co_entidade")
        .where(item_state(item) != PRESENT)
        .drop("itens")
    )
    recent = recently_inspected(fact_item, as_of, days)
    kept = ordered.settle(low.join(recent, "co_entidade", "left_anti"), True)
    keyed = kept.withColumn("_place", F.struct("media_geral", "co_entidade"))
    places = ordered.value_ranks(keyed, ["sg_uf"], "_place", lambda c: F.floor(c["media_geral"])).select(
        "sg_uf", F.col("_place.co_entidade").alias("co_entidade"), (F.col("before") + 1).alias("posicao_na_uf")
    )
    return ordered.null_safe_join(kept, places, ["sg_uf", "co_entidade"]).select(
        "co_entidade", "rede", "sg_uf", "media_geral", "percentil", "n_grupo", "posicao_na_uf"
    )


def recently_inspected(fact_item: DataFrame, as_of: str, days: int) -> DataFrame:
    """Schools with an on-site inspection in the last ``days`` days; duplicates are removed map-side."""
    since = F.lit(as_of).cast(NTZ) - F.make_dt_interval(F.lit(days))
    return fact_item.where((F.col("origem") == ORIGIN_ON_SITE) & (F.col("ocorrido_em") >= since)).select("co_entidade").distinct()


METRICS: dict[str, Metric] = {
    m.name: m
    for m in (
        Metric("media_enem_escolas", "school and year", ("year", "area", "uf", "municipality", "network", "location", "item state"),
               MIN_GROUP, score_mean, ("n_escolas",)),
        Metric("diferenca_media_com_sem_item", "school and year", ("year", "area", "item", "uf", "municipality", "location"),
               MIN_GROUP, with_without, ("n_com", "n_sem")),
        Metric("pct_escolas_por_situacao_do_item", "school and year", ("year", "item", "uf", "municipality", "network", "location"),
               0, state_share),
        Metric("cobertura_enem_censo", "exam school and year", ("year",), 0, exam_coverage),
        Metric("prioridade_vistoria", "school and year", ("year", "uf"), MIN_GROUP, inspection_priority, suppresses_inside=True),
    )
}


def fine_grain_share(fact_item: DataFrame, schools: DataFrame, municipalities: DataFrame, item: str, year: int) -> DataFrame:
    """Share of schools with the item by state and network, from the item-level fact."""
    last = history.latest_in_year(fact_item, item, year).withColumn("_has", F.col("situacao") == PRESENT)
    return _share_by_place(last, schools, municipalities)


def wide_grain_share(fact_year: DataFrame, schools: DataFrame, municipalities: DataFrame, item: str, year: int) -> DataFrame:
    """The same question on the yearly fact."""
    rows = fact_year.where((F.col("ano") == year) & F.col(item).isNotNull()).select("co_entidade", F.col(item).alias("_has"))
    return _share_by_place(rows, schools, municipalities)


def _share_by_place(rows: DataFrame, schools: DataFrame, municipalities: DataFrame) -> DataFrame:
    return (
        rows.join(schools.select("co_entidade", "rede", "co_municipio"), "co_entidade")
        .join(municipalities.select("co_municipio", "sg_uf"), "co_municipio")
        .groupBy("sg_uf", "rede")
        .agg(F.count("*").alias("escolas"), pct(F.count_if("_has"), F.count("*"), 1).alias("pct_com_item"))
    )


def best_covered_year(fact_year: DataFrame) -> DataFrame:
    return (
        fact_year.groupBy("ano").agg(F.count("*").alias("escolas"))
        .orderBy(F.desc("escolas"), F.desc("ano")).limit(1)
    )


def lacking_now(latest: DataFrame, schools: DataFrame, item: str) -> DataFrame:
    """Schools lacking the item by network, from the current state."""
    rows = latest.where((F.col("item_codigo") == item) & (F.col("situacao") == ABSENT))
    return _count_by_network(rows, schools)


def lacking_last_year(last_rows: DataFrame, schools: DataFrame, item: str) -> DataFrame:
    """Same, from each school's last yearly row; "known and not present" counts as lacking."""
    return _count_by_network(last_rows.where(~F.col(item)), schools)


def lacking_in_year(fact_year: DataFrame, schools: DataFrame, item: str, year: int) -> DataFrame:
    return _count_by_network(fact_year.where((F.col("ano") == year) & ~F.col(item)), schools)


def _count_by_network(rows: DataFrame, schools: DataFrame) -> DataFrame:
    return (
        rows.join(schools.select("co_entidade", "tp_dependencia"), "co_entidade")
        .groupBy("tp_dependencia").agg(F.count("*").alias("escolas"))
    )


def lacking_with_zero_groups(last_rows: DataFrame, schools: DataFrame, item: str) -> DataFrame:
    """Conditional count: networks with no lacking school stay, with zero."""
    return (
        last_rows.join(schools.select("co_entidade", "tp_dependencia"), "co_entidade")
        .groupBy("tp_dependencia").agg(F.count_if(~F.col(item)).alias("escolas"))
    )
