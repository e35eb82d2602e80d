"""Reports over the item table: layer reads, workload counters, sampling, day batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import ABSENT, PRESENT, UNKNOWN


def one_region(wide: DataFrame, uf: str, item: str) -> DataFrame:
    return wide.where(
        (F.col("sg_uf") == uf) & (F.col("item_codigo") == item) & (F.col("situacao") == ABSENT)
    ).agg(F.count("*").alias("linhas"))


def one_region_by_network(wide: DataFrame, uf: str) -> DataFrame:
    return wide.where(F.col("sg_uf") == uf).groupBy("tp_dependencia", "tp_localizacao").agg(
        F.count_if(F.col("situacao") == ABSENT).alias("ausentes")
    )


def national(wide: DataFrame) -> DataFrame:
    return wide.groupBy("sg_uf", "item_codigo").agg(F.count_if(F.col("situacao") == ABSENT).alias("ausentes"))


def one_school(wide: DataFrame, school: int) -> DataFrame:
    return wide.where(F.col("co_entidade") == school)


def absent_per_item(items: DataFrame) -> DataFrame:
    return items.where(F.col("situacao") == ABSENT).groupBy("item_codigo").agg(F.count("*").alias("linhas"))


def region_by_joins(items: DataFrame, schools: DataFrame, municipalities: DataFrame, uf: str, item: str) -> DataFrame:
    """Filter on the far dimension; the item rows shrink by one semi join before they are counted."""
    place = schools.join(municipalities.where(F.col("sg_uf") == uf), "co_municipio").select("co_entidade")
    rows = items.where((F.col("item_codigo") == item) & (F.col("situacao") == ABSENT))
    return rows.join(place, "co_entidade", "left_semi").agg(F.count("*").alias("linhas"))


def full_scan(items: DataFrame) -> DataFrame:
    return items.agg(
        F.count("*").alias("linhas"), F.countDistinct("co_entidade").alias("escolas"),
        F.countDistinct("item_codigo").alias("itens"), F.countDistinct("situacao").alias("situacoes"),
    )


def counters(
    municipalities: DataFrame, schools: DataFrame, inspections: DataFrame, items: DataFrame,
    latest: DataFrame, lacking: tuple[str, str],
) -> DataFrame:
    """One row per workload counter; item counters share one pass."""
    def rows(label: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("valor")).select(F.lit(label).alias("medida"), "valor")

    by_state = items.agg(
        F.count("*").alias("itens"),
        F.count_if(F.col("situacao") == PRESENT).alias("itens_existentes"),
        F.count_if(F.col("situacao") == UNKNOWN).alias("itens_nao_informados"),
    ).unpivot([], ["itens", "itens_existentes", "itens_nao_informados"], "medida", "valor")
    absent = F.col("situacao") == ABSENT
    lack = latest.agg(*[
        F.count_if(absent & (F.col("item_codigo") == code)).alias(f"escolas_sem_{code}") for code in lacking
    ]).unpivot([], [f"escolas_sem_{c}" for c in lacking], "medida", "valor")
    return (
        rows("municipios", municipalities).unionByName(rows("escolas", schools))
        .unionByName(rows("vistorias", inspections)).unionByName(by_state).unionByName(lack)
    )


def hash_sample(keys: DataFrame, key: str, n: int) -> DataFrame:
    """Repeatable pseudo-random sample: smallest md5 of the key first (top-n per task, then merged)."""
    return keys.select(key).distinct().orderBy(F.md5(F.col(key).cast("string")), key).limit(n)


def day_batch(df: DataFrame, key: str, n_keys: int) -> tuple[DataFrame, DataFrame]:
    """(base, batch): whole entities of the hash sample go to the batch, everything else stays."""
    chosen = hash_sample(df, key, n_keys)
    return df.join(chosen, key, "left_anti"), df.join(chosen, key, "left_semi")


def batch_number(df: DataFrame, key: str, n: int) -> DataFrame:
    """Split whole entities into ``n`` batches by a stable modulo."""
    return df.withColumn("lote", F.pmod(F.col(key), F.lit(n)).cast("int"))


def newer_than(events: DataFrame, mark: str) -> DataFrame:
    """Incremental reload: records after the high-water mark; a plain, pushable predicate."""
    return events.where(F.col("registrado_em") > F.lit(mark).cast("timestamp_ntz"))


def inspect_whole_catalog(headers: DataFrame, catalog: list[str], state: str) -> DataFrame:
    """Every new header against every (driver-side, tiny) catalog item."""
    codes = F.array(*[F.lit(c) for c in catalog])
    return headers.select("vistoria_id", F.explode(codes).alias("item_codigo"), F.lit(state).alias("situacao"))


def school_history(events: DataFrame, school: int, item: str) -> DataFrame:
    return events.where((F.col("co_entidade") == school) & (F.col("item_codigo") == item)).select(
        "ocorrido_em", "vistoria_id", "situacao", "quantidade"
    ).orderBy("ocorrido_em", "vistoria_id")


def inspection_events(events: DataFrame, inspection: int, month: str | Column) -> DataFrame:
    """Events of one inspection, pruned to its month partition."""
    return events.where((F.col("mes_ocorrencia") == month) & (F.col("vistoria_id") == inspection))
