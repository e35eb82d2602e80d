"""Stored star schema: built aside, checked, then published as one unit.

Readers always see one whole build. A build that fails, or whose checks fail, is never published and
the previous one stays in place; ``vacuum`` removes refused and superseded builds.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.contracts import EVENT_KEY, STATES
from ledgerlake.operators import facts, history, quality
from ledgerlake.sources.log import RETAIN_SECONDS
from ledgerlake.sources.publication import Buckets, Publication

TABLES = (
    "dim_item", "dim_municipio", "dim_escola", "dim_escola_infraestrutura", "fato_vistoria_item",
    "fato_infra_escola_ano", "fato_desempenho_escola_ano",
)


@dataclass(frozen=True)
class Inputs:
    events: DataFrame
    schools: DataFrame
    municipalities: DataFrame
    catalog: DataFrame
    exam: DataFrame | None = None


class Star:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.published = Publication(spark, self.root)

    def version(self) -> int:
        return self.published.version()

    def read(self, table: str, version: int | None = None) -> DataFrame:
        return self.published.read(table, version)

    def vacuum(self, retain_seconds: float = RETAIN_SECONDS) -> int:
        return self.published.vacuum(retain_seconds)

    def build(
        self, inputs: Inputs, as_of: str, exam_reference: str | None = None, hot: DataFrame | None = None
    ) -> int:
        """Build every table from one set of inputs; returns the published version.

        Tables with schools are dealt into the same buckets by school, as many as a shuffle has partitions, so that
        joins and aggregates by school read them in place. With very large schools they are not: a bucket is read
        by one task.
        """
        draft = self.published.draft()
        by_school = None if hot is not None else Buckets("co_entidade", int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        codes = [r[0] for r in inputs.catalog.select("codigo").collect()]  # the catalog is tiny
        facts.check_catalog(codes)
        items = draft.write("dim_item", facts.dim_item(inputs.catalog))
        places = draft.write("dim_municipio", facts.dim_municipality(inputs.municipalities))
        schools = draft.write("dim_escola", facts.dim_school(inputs.schools), buckets=by_school)
        changes = history.item_change(inputs.events, hot)
        profiles = draft.write("dim_escola_infraestrutura", history.dim_profile(changes, codes, hot is not None), sort=["co_entidade"], buckets=by_school)
        results = None
        # The facts need nothing from each other, so their jobs run side by side.
        with ThreadPoolExecutor(3) as pool:
            fine_job = pool.submit(
                draft.write, "fato_vistoria_item", facts.fact_item(inputs.events, profiles, hot), sort=["item_codigo", "ocorrido_em"], buckets=by_school
            )
            wide_job = pool.submit(
                draft.write, "fato_infra_escola_ano", facts.fact_year(inputs.events, profiles, codes, as_of, hot), by=["ano"], sort=["co_entidade"],
                buckets=by_school,
            )
            if inputs.exam is not None and exam_reference is not None:
                results = pool.submit(
                    draft.write, "fato_desempenho_escola_ano", facts.fact_performance(inputs.exam, inputs.schools, profiles, exam_reference, hot),
                    buckets=by_school,
                ).result()
            fine, wide = fine_job.result(), wide_job.result()
        failed = quality.run_checks(self.checks(items, schools, places, profiles, fine, wide, results, hot)).where(F.col("falhas") > 0).collect()  # one row per check
        if failed:
            raise ValueError("build not published: " + ", ".join(f"{r['teste']} ({r['falhas']})" for r in failed))
        return draft.publish()

    @staticmethod
    def checks(
        items: DataFrame, schools: DataFrame, places: DataFrame, profiles: DataFrame, fine: DataFrame, wide: DataFrame,
        results: DataFrame | None = None, hot: DataFrame | None = None,
    ) -> dict:
        checks = {
            "escola_unica": quality.unique(schools, ["co_entidade"]),
            "municipio_conhecido": quality.orphans(schools, "co_municipio", places, "co_municipio"),
            "perfil_unico": quality.unique(profiles, ["co_entidade", "escola_infra_sk"]),
            "versoes_sem_sobreposicao": quality.overlaps(profiles, "co_entidade", hot),
            "uma_versao_atual": quality.current_count(profiles, "co_entidade"),
            # An item outside the catalog would open versions that show nothing, so it is refused.
            "item_conhecido": quality.orphans(fine, "item_codigo", items, "item_codigo"),
            "situacao_aceita": quality.accepted_values(fine, "situacao", STATES),
            "escola_do_fato_anual_conhecida": quality.orphans(wide, "co_entidade", schools, "co_entidade"),
            "perfil_do_fato_anual_conhecido": quality.orphans(wide, "escola_infra_sk", profiles, "escola_infra_sk"),
            "fato_fino_unico": quality.unique(fine, EVENT_KEY),
            "escola_do_fato_conhecida": quality.orphans(fine, "co_entidade", schools, "co_entidade"),
            "perfil_do_fato_conhecido": quality.orphans(fine, "escola_infra_sk", profiles, "escola_infra_sk"),
            "fato_anual_unico": quality.unique(wide, ["co_entidade", "ano"]),
            "percentual_entre_0_e_100": quality.in_range(wide, "pct_existentes", 0, 100),
        }
        if results is not None:
            checks |= {
                "desempenho_unico": quality.unique(results, ["co_entidade", "ano"]),
                "escola_do_desempenho_conhecida": quality.orphans(results, "co_entidade", schools, "co_entidade"),
                # A school that was never inspected has results without a profile.
                "perfil_do_desempenho_conhecido": quality.orphans(results.where(F.col("escola_infra_sk").isNotNull()), "escola_infra_sk", profiles, "escola_infra_sk"),
            }
        return checks
