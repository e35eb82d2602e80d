"""Row-by-row reconciliation of two tables and the questions asked about the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import EVENT_CONTENT, EVENT_KEY
from ledgerlake.functions.columns import row_text
from ledgerlake.session import spread

ONLY_ORIGIN, ONLY_TARGET, EQUAL, DIFFERENT = "so_na_origem", "so_no_destino", "iguais", "diferentes"


def compare(origin: DataFrame, target: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Full outer join by key on 128-bit row digests: only keys, day and digest are shuffled."""
    digest = F.unhex(F.md5(row_text(EVENT_CONTENT)))
    a = origin.select(*keys, F.col("registrado_em").cast("date").alias("_da"), digest.alias("_a"))
    b = target.select(
        *keys, F.col("registrado_em").cast("date").alias("_db"), digest.alias("_b"),
        F.col("lsn_origem").isNotNull().alias("_cdc"),
    )
    kind = (
        F.when(F.col("_a").isNull(), ONLY_TARGET).when(F.col("_b").isNull(), ONLY_ORIGIN)
        .when(F.col("_a") == F.col("_b"), EQUAL).otherwise(DIFFERENT)
    )
    return spread(a, *keys).join(spread(b, *keys).hint("merge"), list(keys), "full_outer").select(
        *keys, F.coalesce("_da", "_db").alias("dia"),
        F.coalesce("_cdc", F.lit(False)).alias("veio_do_cdc"), kind.alias("situacao"),
    )


def without_accepted(comparison: DataFrame, accepted: DataFrame) -> DataFrame:
    """Drop the keys whose exact state was accepted by an operator."""
    return comparison.join(accepted.select(*EVENT_KEY).distinct(), list(EVENT_KEY), "left_anti")


def totals(comparison: DataFrame) -> DataFrame:
    cdc, kind = F.col("veio_do_cdc"), F.col("situacao")
    return comparison.agg(
        F.count_if((kind == EQUAL) & ~cdc).alias("iguais_sem_lsn"),
        F.count_if((kind == EQUAL) & cdc).alias("iguais_com_lsn"),
        F.count_if((kind == DIFFERENT) & ~cdc).alias("diferentes_sem_lsn"),
        F.count_if((kind == DIFFERENT) & cdc).alias("diferentes_com_lsn"),
        F.count_if(kind == ONLY_ORIGIN).alias("so_na_origem"),
        F.count_if(kind == ONLY_TARGET).alias("so_no_destino"),
    )


def by_day(comparison: DataFrame) -> DataFrame:
    return (
        comparison.where(F.col("situacao") != EQUAL).groupBy("dia", "situacao")
        .agg(F.count("*").alias("linhas"))
    )


def explain_missing(comparison: DataFrame, pending: DataFrame, queued: DataFrame) -> DataFrame:
    """Why origin rows are not in the target: still pending, in the error queue, or unexplained."""
    p = spread(pending.select(*EVENT_KEY), *EVENT_KEY).distinct().withColumn("_p", F.lit(True))
    q = (
        spread(queued.where(F.col("operacao") == "insert").select(*EVENT_KEY), *EVENT_KEY).distinct()
        .withColumn("_q", F.lit(True))
    )
    rows = (
        spread(comparison.where(F.col("situacao") == ONLY_ORIGIN), *EVENT_KEY)
        .join(p, list(EVENT_KEY), "left").join(q, list(EVENT_KEY), "left")
    )
    is_p, is_q = F.col("_p").isNotNull(), F.col("_q").isNotNull()
    return rows.agg(
        F.count_if(is_p).alias("pendentes"),
        F.count_if(~is_p & is_q).alias("na_fila"),
        F.count_if(~is_p & ~is_q).alias("sem_explicacao"),
    )


def confirm_extras(comparison: DataFrame, later_origin: DataFrame) -> DataFrame:
    """Target-only keys that a later read of the origin still does not know."""
    extra = comparison.where(F.col("situacao") == ONLY_TARGET).select(*EVENT_KEY)
    known = spread(later_origin.select(*EVENT_KEY), *EVENT_KEY).hint("merge")
    return spread(extra, *EVENT_KEY).join(known, list(EVENT_KEY), "left_anti")


def missing_and_unknown(target: DataFrame, origin: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Counts of origin rows the target lacks and of target rows the origin does not know."""
    both = origin.select(*keys, F.lit(1).alias("_side")).unionByName(target.select(*keys, F.lit(2).alias("_side")))
    sides = (
        spread(both, *keys)
        .groupBy(*keys).agg(F.bit_or("_side").alias("_sides"))
    )
    return sides.agg(
        F.count_if(F.col("_sides") == 1).alias("faltam"), F.count_if(F.col("_sides") == 2).alias("desconhecidos")
    )


def pending_headers(headers: DataFrame, items: DataFrame, facts: DataFrame) -> DataFrame:
    """Headers with at least one item that the fact does not hold; header without items is no event."""
    missing = items.select(*EVENT_KEY).join(facts.select(*EVENT_KEY), list(EVENT_KEY), "left_anti")
    return headers.join(missing.select("vistoria_id").distinct(), "vistoria_id", "left_semi")


def key_set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys on one side only."""
    both = (
        a.select(key, F.lit(1).alias("_s")).unionByName(b.select(key, F.lit(2).alias("_s")))
        .groupBy(key).agg(F.bit_or("_s").alias("_s"))
    )
    return both.where(F.col("_s") != 3).select(
        key, F.when(F.col("_s") == 1, "esquerda").otherwise("direita").alias("lado")
    )


def year_counts(lake: DataFrame, origin: DataFrame, year: str) -> DataFrame:
    """Rows per year on both sides, with an equality flag."""
    a = lake.groupBy(year).agg(F.count("*").alias("no_lago"))
    b = origin.groupBy(year).agg(F.count("*").alias("na_origem"))
    zero = F.lit(0).cast("bigint")
    return a.join(b, year, "full_outer").select(
        year, F.coalesce("no_lago", zero).alias("no_lago"), F.coalesce("na_origem", zero).alias("na_origem"),
        F.col("no_lago").eqNullSafe(F.col("na_origem")).alias("iguais"),
    )
