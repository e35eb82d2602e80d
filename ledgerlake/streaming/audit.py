"""Operation balance and the audit report of the change stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import DRAIN_SLA_SECONDS

# Operations and the telemetry column that counts each.
OPERATIONS = {"insert": "itens", "update": "atualizacoes", "delete": "exclusoes", "truncate": "truncamentos"}


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def applied_since(events: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Events the stream delivered since its first telemetry row (none without telemetry)."""
    first = telemetry.agg(F.min("lsn_fim")).scalar()
    return events.where(F.col("lsn_origem") >= first).agg(F.count("*").alias("aplicadas"))


def operation_balance(
    telemetry: DataFrame, applied: DataFrame, queue: DataFrame, pending: DataFrame, treated: DataFrame
) -> DataFrame:
    """Read, applied, queued, pending, treated and already-present rows per operation.

    ``queue``: untreated dead letters; ``treated``: dead letters with a receipt; ``pending``:
    captured changes not delivered yet (operacao). A re-delivered LSN counts once, by its last row.
    Several changes of one key in one transaction share one queue entry, so an operation of an LSN
    counts as fully treated once nothing of it is left in the queue, and is capped otherwise.
    """
    counts = list(OPERATIONS.values())
    last = telemetry.groupBy("lsn_fim").agg(
        F.max_by(F.struct(*counts), F.struct("passada_em", "posicao_na_passada")).alias("_l")
    )
    pairs = F.explode(F.create_map(*[x for op, c in OPERATIONS.items() for x in (F.lit(op), F.col(f"_l.{c}"))]))
    by_lsn = last.select(F.col("lsn_fim").alias("lsn_origem"), pairs.alias("operacao", "lidas"))
    read = by_lsn.groupBy("operacao").agg(F.sum("lidas").alias("lidas_do_wal"))

    identity = ["lsn_origem", "operacao"]
    left = queue.groupBy(*identity).agg(F.count("*").alias("_left"))
    done = treated.groupBy(*identity).agg(F.count("*").alias("_done"))
    settled = done.join(by_lsn, identity, "left").join(left, identity, "left")
    capped = (
        F.when(F.col("operacao") == "insert", F.col("_done"))
        .when(F.col("_left").isNull(), F.coalesce("lidas", _zero()))
        .otherwise(F.least("_done", F.coalesce("lidas", _zero())))
    )
    treated_by_op = settled.groupBy("operacao").agg(F.sum(capped).alias("tratadas"))

    queued = queue.groupBy("operacao").agg(F.count("*").alias("na_fila"))
    waiting = pending.groupBy("operacao").agg(F.count("*").alias("pendentes"))
    all_ops = telemetry.sparkSession.createDataFrame([(op,) for op in OPERATIONS], "operacao string")
    out = all_ops
    for part in (read, queued, waiting, treated_by_op):
        out = out.join(part, "operacao", "left")
    out = out.withColumn("aplicadas", F.when(F.col("operacao") == "insert", applied.scalar()))
    numbers = ("lidas_do_wal", "aplicadas", "na_fila", "pendentes", "tratadas")
    out = out.withColumns({n: F.coalesce(n, _zero()) for n in numbers})
    settled_now = F.when(F.col("operacao") == "insert", _zero()).otherwise(F.col("tratadas"))
    return out.withColumn(
        "ja_estavam", F.col("lidas_do_wal") - F.col("aplicadas") - F.col("na_fila") - settled_now
    ).select("operacao", *numbers, "ja_estavam")


def report(
    compared: DataFrame,
    missing: DataFrame,
    extras: DataFrame,
    queue: DataFrame,
    balance: DataFrame,
    order: DataFrame,
    drifts: DataFrame,
    freshness_s: float | None,
    sla_s: float = DRAIN_SLA_SECONDS,
) -> DataFrame:
    """Violations as rows (violacao, quantidade); an empty result means a clean audit."""
    spark = compared.sparkSession

    def one(label: str, df: DataFrame, value: Column) -> DataFrame:
        return df.agg(value.alias("quantidade")).select(F.lit(label).alias("violacao"), F.col("quantidade").cast("bigint"))

    different = F.sum(F.col("diferentes_sem_lsn") + F.col("diferentes_com_lsn"))
    not_insert = F.when(F.col("operacao") != "insert", F.col("lidas_do_wal") + F.col("pendentes") - F.col("tratadas"))
    in_queue = F.greatest(F.count("*"), missing.select("na_fila").scalar())
    rows = [
        one("conteudo_diferente", compared, different),
        one("sem_explicacao", missing, F.sum("sem_explicacao")),
        one("so_no_destino", extras, F.count("*")),
        one("pendencias_na_fila", queue, in_queue),
        one("desvios_do_insert_only", balance, F.greatest(F.sum(not_insert), _zero())),
        one("lsn_invertido", order, F.sum("inversoes_de_lsn")),
        one("esquema_fora_do_contrato", drifts, F.count("*")),
    ]
    never = freshness_s is None
    stale = 0 if never or freshness_s <= sla_s else 1
    rows.append(spark.createDataFrame(
        [("nunca_drenado", int(never)), ("frescor_acima_do_sla", stale)], "violacao string, quantidade bigint"
    ))
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out.where(F.col("quantidade") > 0)
