"""Freshness of the built layer against its service level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import GOLD_SLA_SECONDS
from ledgerlake.functions.columns import NTZ, seconds_between


def measure(
    pending: DataFrame, now: str, built: bool = True, sla_s: int = GOLD_SLA_SECONDS,
    command: str = "medir-frescor", table: str = "fato_infra_escola_ano",
) -> DataFrame:
    """One measurement: headers waiting, since when, and whether that is within the level.

    Exactly the level is within it; a clock ahead of the record time gives zero, never less; a layer
    that was never built violates the level and measures nothing.
    """
    at = F.lit(now).cast(NTZ)
    waiting = pending.agg(
        F.count("*").alias("vistorias_pendentes"), F.min("registrado_em").alias("pendente_desde")
    )
    wait = F.greatest(
        F.coalesce(seconds_between("pendente_desde", at), F.lit(0).cast("decimal(20,6)")), F.lit(0).cast("decimal(20,6)")
    ).cast("double")
    known = F.lit(built)
    return waiting.select(
        at.alias("medido_em"), F.lit(command).alias("comando"), F.lit(table).alias("tabela"),
        known.alias("gold_construida"),
        F.when(known, F.col("vistorias_pendentes")).alias("vistorias_pendentes"),
        F.when(known, F.col("pendente_desde")).alias("pendente_desde"),
        F.when(known, wait).alias("frescor_s"),
        F.lit(float(sla_s)).alias("sla_s"),
        (known & (wait <= sla_s)).alias("dentro_do_sla"),
    )


def last_measurements(log: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` measurements in chronological order."""
    return log.orderBy(F.desc("medido_em")).limit(n).orderBy("medido_em")
