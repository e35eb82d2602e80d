"""Census file: header contract, active schools, typed tables, flags to long states."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import ABSENT, PRESENT, UNKNOWN

ACTIVE = "1"


def require_columns(df: DataFrame, required: Sequence[str], what: str, ordered: bool = False) -> DataFrame:
    """Fail, before any job runs, naming every missing column."""
    present = set(df.columns)
    missing = [c for c in required if c not in present]
    if missing:
        raise ValueError(f"{what}: missing columns {', '.join(missing if ordered else sorted(missing))}")
    return df


def active_schools(raw: DataFrame) -> DataFrame:
    return raw.where(
        (F.col("TP_SITUACAO_FUNCIONAMENTO") == ACTIVE)
        & F.col("CO_ENTIDADE").isNotNull()
        & F.col("CO_MUNICIPIO").isNotNull()
    )


def municipalities(active: DataFrame) -> DataFrame:
    return active.select(
        F.col("CO_MUNICIPIO").cast("int").alias("co_municipio"),
        F.col("NO_MUNICIPIO").alias("no_municipio"),
        F.col("SG_UF").alias("sg_uf"),
        F.col("CO_UF").cast("smallint").alias("co_uf"),
    ).distinct()


def _located(active: DataFrame) -> DataFrame:
    return active.where(F.col("TP_DEPENDENCIA").isNotNull() & F.col("TP_LOCALIZACAO").isNotNull())


def schools(active: DataFrame) -> DataFrame:
    return _located(active).select(
        F.col("CO_ENTIDADE").cast("bigint").alias("co_entidade"),
        F.col("NO_ENTIDADE").alias("no_entidade"),
        F.col("CO_MUNICIPIO").cast("int").alias("co_municipio"),
        F.col("TP_DEPENDENCIA").cast("smallint").alias("tp_dependencia"),
        F.col("TP_LOCALIZACAO").cast("smallint").alias("tp_localizacao"),
        F.col("NU_ANO_CENSO").cast("smallint").alias("ano_censo_referencia"),
    )


def item_states(active: DataFrame, column_by_item: Mapping[str, str]) -> DataFrame:
    """Wide flags -> one row per (school, item); only '1' and '0' are statements.

    A blank becomes '' first because unpivot drops NULL values.
    """
    flat = _located(active).select(
        F.col("CO_ENTIDADE").cast("bigint").alias("co_entidade"),
        *[F.coalesce(F.col(c), F.lit("")).alias(item) for item, c in column_by_item.items()],
    )
    state = F.when(F.col("flag") == "1", PRESENT).when(F.col("flag") == "0", ABSENT).otherwise(UNKNOWN)
    return flat.unpivot("co_entidade", list(column_by_item), "item_codigo", "flag").select(
        "co_entidade", "item_codigo", state.alias("situacao")
    )
