"""Ingestion: what to do with a file, and idempotent consolidation into the origin tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import CENSUS_COLUMNS, ORIGIN_CENSUS
from ledgerlake.functions.columns import NTZ, instant_text, surrogate_key
from ledgerlake.operators import census
from ledgerlake.sources.publication import Publication

SKIP, REPUBLISH, INGEST = "ignorar", "republicar_silver", "ingerir"


def current_hash(manifest: DataFrame) -> DataFrame:
    """Hash in force per (source, year): that of the last completed ingestion."""
    return manifest.groupBy("fonte", "ano").agg(
        F.max_by("hash_sha256", F.struct("concluido_em", "iniciado_em")).alias("hash_vigente")
    )


def decide(files: DataFrame, manifest: DataFrame, published: DataFrame, force: bool = False) -> DataFrame:
    """Per (source, year): skip, republish only the Silver copy, or ingest.

    ``files`` and ``published`` hold (fonte, ano, hash_sha256 / hash_publicado). Only the last
    manifest row counts, so going back to an older file ingests again.
    """
    state = files.join(current_hash(manifest), ["fonte", "ano"], "left").join(published, ["fonte", "ano"], "left")
    same = F.col("hash_vigente").eqNullSafe(F.col("hash_sha256"))
    done = F.col("hash_publicado").eqNullSafe(F.col("hash_sha256"))
    action = F.when(~same | F.lit(force), INGEST).when(done, SKIP).otherwise(REPUBLISH)
    return state.select("fonte", "ano", "hash_sha256", action.alias("acao"))


def manifest_row(decided: DataFrame, force: bool, counters: dict[str, Column], started: str, finished: str) -> DataFrame:
    """One manifest row per completed ingestion, to be appended."""
    return decided.where(F.col("acao") == INGEST).select(
        "fonte", "ano", "hash_sha256", F.lit(force).alias("forcada"),
        *[c.alias(n) for n, c in counters.items()],
        F.lit(started).cast(NTZ).alias("iniciado_em"), F.lit(finished).cast(NTZ).alias("concluido_em"),
    )


CENSUS = "censo"


def census_marker(year: int) -> str:
    return f"{CENSUS}/{year}"


def publish_census(
    published: Publication, raw: DataFrame, column_by_item: Mapping[str, str], year: int, source_hash: str, force: bool = False
) -> bool:
    """Municipalities, schools and item states of a census year as one unit, marked with the file's hash.

    Nothing is written if that hash is published already (False). Schools of another year are refused.
    """
    if not force and published.marker(census_marker(year)) == source_hash:
        return False
    census.require_columns(raw, [*CENSUS_COLUMNS, *column_by_item.values()], "census file")
    active = census.active_schools(raw).persist()
    try:
        others = active.where(~F.col("NU_ANO_CENSO").eqNullSafe(str(year))).limit(1)
        if not others.isEmpty():
            raise ValueError(f"the census file is not of {year} alone")
        tables = {
            "municipio": census.municipalities(active), "escola": census.schools(active).drop("ano_censo_referencia"),
            "vistoria_item": census.item_states(active, column_by_item),
        }
        published.publish(tables, year, markers={census_marker(year): source_hash})
    finally:
        active.unpersist()
    return True


def absent_rows(staged: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows a consolidation would insert: keys not stored yet."""
    return staged.join(stored.select(*keys), list(keys), "left_anti")


def baseline_inspections(schools: DataFrame, reference: str) -> DataFrame:
    """One census inspection per school at the reference date, with a deterministic id."""
    at = F.lit(reference).cast(NTZ)
    identity = F.concat_ws("|", F.lit(ORIGIN_CENSUS), F.col("co_entidade").cast("string"), instant_text(at))
    return schools.select(
        surrogate_key(identity).alias("vistoria_id"), "co_entidade", F.lit(ORIGIN_CENSUS).alias("origem"),
        at.alias("ocorrido_em"), at.alias("registrado_em"),
    )


def baseline_items(inspections: DataFrame, staged_items: DataFrame, reference: str) -> DataFrame:
    """Attach staged census items to the baseline inspection of their school."""
    base = inspections.where(
        (F.col("origem") == ORIGIN_CENSUS) & (F.col("ocorrido_em") == F.lit(reference).cast(NTZ))
    ).select("vistoria_id", "co_entidade")
    return staged_items.join(base, "co_entidade").select("vistoria_id", "item_codigo", "situacao")


def consolidate(
    staged: dict[str, DataFrame], stored: dict[str, DataFrame], reference: str
) -> dict[str, DataFrame]:
    """New rows for municipality, school, inspection and item tables; nothing is ever updated."""
    new_inspections = absent_rows(
        baseline_inspections(staged["school"], reference),
        stored["inspection"].where(F.col("origem") == ORIGIN_CENSUS), ["co_entidade", "ocorrido_em"],
    )
    columns = new_inspections.columns
    all_inspections = stored["inspection"].select(*columns).unionByName(new_inspections)
    items = baseline_items(all_inspections, staged["item"], reference)
    return {
        "municipality": absent_rows(staged["municipality"], stored["municipality"], ["co_municipio"]),
        "school": absent_rows(staged["school"], stored["school"], ["co_entidade"]),
        "inspection": new_inspections,
        "item": absent_rows(items, stored["item"], ["vistoria_id", "item_codigo"]),
    }
