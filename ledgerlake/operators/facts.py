"""Dimensions and facts of the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import EVENT_CONTENT, PRESENT
from ledgerlake.functions.columns import NTZ, month_of, pct, year_of
from ledgerlake.operators import history
from ledgerlake.operators.history import COUNTERS


def network_name(code: str) -> Column:
    """School networks by code; everything else is private."""
    return (
        F.when(F.col(code) == 1, "federal").when(F.col(code) == 2, "estadual")
        .when(F.col(code) == 3, "municipal").otherwise("privada")
    )


def dim_school(schools: DataFrame) -> DataFrame:
    return schools.select(
        "co_entidade", "no_entidade", "co_municipio", "tp_dependencia",
        network_name("tp_dependencia").alias("rede"),
        F.when(F.col("tp_localizacao") == 1, "urbana").otherwise("rural").alias("localizacao"),
        "ano_censo_referencia",
    )


def dim_item(catalog: DataFrame) -> DataFrame:
    return catalog.select(F.col("codigo").alias("item_codigo"), "descricao", "categoria")


def dim_municipality(municipalities: DataFrame) -> DataFrame:
    return municipalities.select("co_municipio", "no_municipio", "sg_uf", "co_uf")


def canonical_events(
    inspections: DataFrame, items: DataFrame, schools: DataFrame, municipalities: DataFrame
) -> DataFrame:
    """Origin tables -> canonical events; personal and free-text columns are never selected."""
    place = schools.join(municipalities, "co_municipio").select("co_entidade", "sg_uf")
    headers = inspections.select("vistoria_id", "co_entidade", "origem", "ocorrido_em", "registrado_em")
    lines = items.select("vistoria_id", "item_codigo", "situacao", "quantidade")
    joined = lines.join(headers.join(place, "co_entidade"), "vistoria_id")
    return joined.withColumn("mes_ocorrencia", month_of("ocorrido_em")).select(
        *EVENT_CONTENT, F.lit(None).cast("bigint").alias("lsn_origem")
    )


def wide_table(items: DataFrame, schools: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Item rows with their school and municipality, clustered for min/max pruning on write."""
    place = schools.join(municipalities, "co_municipio")
    joined = items.join(place, "co_entidade").select(
        F.col("ano_censo_referencia").alias("ano_censo"), "sg_uf", "co_municipio", "no_municipio",
        "co_entidade", "tp_dependencia", "tp_localizacao", "item_codigo", "situacao",
    )
    return joined


def fact_item(events: DataFrame, profiles: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """One row per (inspection, item) with the profile in force at the event."""
    facts = events.select(
        "vistoria_id", "item_codigo", "co_entidade", "ocorrido_em",
        F.col("ocorrido_em").cast("date").alias("data_ocorrencia"), "origem", "situacao", "quantidade",
    )
    found = history.as_of(facts, profiles, "co_entidade", "ocorrido_em", ["escola_infra_sk"], hot)
    return found.select(
        "vistoria_id", "item_codigo", "co_entidade", "ocorrido_em", "data_ocorrencia", "origem",
        "escola_infra_sk", "situacao", "quantidade",
    )


def year_reference(year: str, as_of: str) -> Column:
    """Last millisecond of the year, but never after ``as_of``."""
    end = F.make_timestamp_ntz(
        F.col(year), F.lit(12), F.lit(31), F.lit(23), F.lit(59), F.lit(59.999).cast("decimal(8,6)")
    )
    return F.least(end, F.lit(as_of).cast(NTZ))


def fact_year(
    events: DataFrame, profiles: DataFrame, catalog: Sequence[str], as_of: str, hot: DataFrame | None = None
) -> DataFrame:
    """One row per (school, year with events): year-end profile, one boolean column per item."""
    check_catalog(catalog)
    years = events.select("co_entidade", year_of("ocorrido_em").alias("ano")).distinct()
    asked = years.withColumn("em", year_reference("ano", as_of))
    take = ["escola_infra_sk", "n_itens_conhecidos", *COUNTERS, "itens"]
    found = history.as_of(asked, profiles, "co_entidade", "em", take, hot)
    return found.select(
        "co_entidade",
        "ano",
        "escola_infra_sk",
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_itens_conhecidos", *COUNTERS)],
        pct(F.col("n_existentes"), F.col("n_itens_conhecidos"), 2).alias("pct_existentes"),
        *[(F.try_element_at("itens", F.lit(code)) == PRESENT).alias(code) for code in sorted(catalog)],
    )


def check_catalog(catalog: Sequence[str]) -> None:
    """Item codes become column names, so the (tiny, driver-side) catalog is guarded."""
    import re

    if not catalog:
        raise ValueError("the item catalog is empty")
    bad = [c for c in catalog if not re.fullmatch(r"[a-z_0-9]+", c)]
    if bad or len(set(catalog)) != len(catalog):
        raise ValueError(f"invalid or repeated item codes: {bad or sorted(catalog)}")


def bad_codes(catalog: DataFrame, code: str = "codigo", pattern: str = "^[a-z_]+$") -> DataFrame:
    return catalog.where(~F.col(code).rlike(pattern))


def fact_performance(
    exam: DataFrame, schools: DataFrame, profiles: DataFrame, reference: str, hot: DataFrame | None = None
) -> DataFrame:
    """Exam results of registered schools with the profile at the reference date."""
    dated = exam.withColumn("data_referencia_infraestrutura", F.lit(reference).cast("date"))
    known = dated.join(schools.select("co_entidade"), "co_entidade", "left_semi")
    asked = known.withColumn("_at_ref", F.col("data_referencia_infraestrutura").cast(NTZ))
    return history.as_of(asked, profiles, "co_entidade", "_at_ref", ["escola_infra_sk"], hot).drop("_at_ref")


def last_year_rows(facts: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with no later year for the same school, as an aggregate instead of a self anti-join.

    Name the ``columns`` a question needs: only those are read.
    """
    wanted = [c for c in (columns or facts.columns) if c not in ("co_entidade", "ano")]
    newest = [F.max_by(c, "ano").alias(c) for c in wanted]
    return facts.groupBy("co_entidade").agg(F.max("ano").alias("ano"), *newest).select("co_entidade", "ano", *wanted)


def with_profile(facts: DataFrame, profiles: DataFrame) -> DataFrame:
    """Join by surrogate key guarded by the entity; a missing profile stays missing."""
    return facts.join(
        profiles.select("escola_infra_sk", "co_entidade", "itens"), ["escola_infra_sk", "co_entidade"], "left"
    )
