"""Telemetry of the change stream: per-transaction rows, latency, delivery order, reload losses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.contracts import TOLERANCE_DAYS
from ledgerlake.functions.columns import NTZ, seconds_between
from ledgerlake.operators import ordered
from ledgerlake.operators.ordered import CHUNK

TELEMETRY_SCHEMA = T.StructType([
    T.StructField("passada_em", T.TimestampNTZType()), T.StructField("posicao_na_passada", T.LongType()),
    T.StructField("lsn_fim", T.LongType()), T.StructField("confirmada_em", T.TimestampNTZType()),
    *[T.StructField(c, T.DoubleType()) for c in (
        "espera_s", "leitura_s", "atraso_de_captura_s", "conversao_s", "gravacao_s", "atraso_de_carga_s",
        "ponta_a_ponta_s")],
    *[T.StructField(c, T.LongType()) for c in (
        "vistorias", "itens", "atualizacoes", "exclusoes", "truncamentos", "itens_rejeitados")],
    T.StructField("registrado_em", T.TimestampNTZType()), T.StructField("ocorrido_em", T.TimestampNTZType()),
    T.StructField("desvios_de_esquema", T.StringType()),
])
DURATIONS = (
    "espera_s", "leitura_s", "atraso_de_captura_s", "conversao_s", "gravacao_s", "atraso_de_carga_s",
    "ponta_a_ponta_s",
)


@dataclass(frozen=True)
class Clock:
    """UTC instants of one pass, as ``yyyy-MM-dd HH:mm:ss.ffffff`` text."""

    read_start: str
    read_end: str
    converted: str
    written: str


def _at(text: str) -> Column:
    return F.lit(text).cast(NTZ)


def transaction_rows(
    changes: DataFrame, events: DataFrame, rejected: DataFrame, clock: Clock, drifts: DataFrame | None = None
) -> DataFrame:
    """One row per delivered transaction."""
    op, table = F.col("op"), F.col("tabela")
    base = changes.groupBy(F.col("lsn").alias("lsn_fim")).agg(
        F.min("seq").alias("posicao_na_passada"),
        F.max("commit_ts").alias("confirmada_em"),
        F.count_if((op == "insert") & (table == "vistoria")).alias("vistorias"),
        F.count_if((op == "insert") & (table == "vistoria_item")).alias("itens"),
        F.count_if(op == "update").alias("atualizacoes"),
        F.count_if(op == "delete").alias("exclusoes"),
        F.count_if(op == "truncate").alias("truncamentos"),
    )
    instants = events.groupBy(F.col("lsn_origem").alias("lsn_fim")).agg(
        F.max("registrado_em").alias("registrado_em"), F.min("ocorrido_em").alias("ocorrido_em")
    )
    refused = rejected.where(F.col("operacao") == "insert").groupBy(F.col("lsn_origem").alias("lsn_fim")).agg(
        F.count("*").alias("_rejected")
    )
    rows = base.join(instants, "lsn_fim", "left").join(refused, "lsn_fim", "left")
    if drifts is not None:
        rows = rows.join(drifts.withColumnRenamed("anuncio", "lsn_fim"), "lsn_fim", "left")
    else:
        rows = rows.withColumn("desvios_de_esquema", F.lit(None).cast("string"))
    start, end, conv, done = _at(clock.read_start), _at(clock.read_end), _at(clock.converted), _at(clock.written)
    commit = F.col("confirmada_em")

    def secs(a: Column, b: Column) -> Column:
        return seconds_between(a, b).cast("double")

    return rows.withColumns({
        "passada_em": start,
        "itens_rejeitados": F.coalesce("_rejected", F.lit(0).cast("bigint")),
        # A commit may fall between reading the clock and reading the stream: then nothing waited.
        "espera_s": F.greatest(F.lit(0.0), secs(commit, start)),
        "leitura_s": secs(start, end),
        "atraso_de_captura_s": secs(commit, end),
        "conversao_s": secs(end, conv),
        "gravacao_s": secs(conv, done),
        "atraso_de_carga_s": secs(end, done),
        "ponta_a_ponta_s": secs(commit, done),
    }).select(*TELEMETRY_SCHEMA.names)


def read_range(telemetry: DataFrame, above: int = -1, upto: int | None = None) -> DataFrame:
    rows = telemetry.where(F.col("lsn_fim") > above)
    if upto is not None:
        rows = rows.where(F.col("lsn_fim") <= upto)
    return rows.orderBy("passada_em", "posicao_na_passada")


def _second(value: Column) -> Column:
    """Whole seconds: at most a million distinct microsecond values fall into one bucket."""
    return F.floor(value)


def latency_summary(times: DataFrame, groups: list[str], value: str, minimum: int = 2, bucket=_second) -> DataFrame:
    """n, median, interpolated p95, min and max per group; groups under ``minimum`` are left out."""
    spots = ordered.exact_quantiles(times, groups, value, {"mediana_s": 0.5, "p95_s": 0.95}, bucket)
    plain = times.where(F.col(value).isNotNull()).groupBy(*groups).agg(
        F.count("*").alias("amostras"), F.min(value).alias("minimo_s"), F.max(value).alias("maximo_s")
    )
    if groups:
        out = plain.join(spots, groups)
    else:
        out = plain.withColumns({c: spots.select(c).scalar() for c in ("mediana_s", "p95_s")})
    return out.where(F.col("amostras") >= minimum)


def latencies(telemetry: DataFrame) -> DataFrame:
    """Latency summary of every duration column of the telemetry."""
    long = telemetry.select(*DURATIONS).unpivot([], list(DURATIONS), "medida", "segundos")
    return latency_summary(long, ["medida"], "segundos")


def order_quality(
    rows: DataFrame,
    stream: str = "fluxo",
    arrival: tuple[str, ...] = ("passada_em", "posicao_na_passada"),
    limit: int = ordered.HOT_ROWS,
    tolerance_days: int = TOLERANCE_DAYS,
) -> DataFrame:
    """Delivery order of a stream: re-deliveries, inversions, disorder and lateness.

    Only the first sight of an LSN counts. A long stream is one hot key, so it is scanned in chunks of counted
    rows, whether it arrived in one pass or over years.
    """
    at = F.struct(*arrival)
    firsts = rows.groupBy(stream, "lsn_fim").agg(
        F.min(at).alias("_at"), F.min_by(F.struct("registrado_em", "ocorrido_em"), at).alias("_t"),
        F.count("*").alias("_times"),
    ).select(
        stream, "lsn_fim", "_times", *[F.col(f"_at.{a}").alias(a) for a in arrival],
        F.col("_t.registrado_em").alias("registrado_em"),
        F.when(F.col("_t.registrado_em").isNotNull(), F.col("_t.ocorrido_em")).alias("ocorrido_em"),
    )
    hot = ordered.hot_keys(rows, [stream], limit)
    unit = {"_pass": F.col(arrival[0]), "_piece": F.floor(F.col(arrival[-1]) / min(ordered.UNIT, limit))}
    lined = ordered.with_counted_chunks(firsts, [stream], hot, unit, limit)
    seen = {"_lsn": "lsn_fim", "_reg": "registrado_em", "_occ": "ocorrido_em"}
    scanned = ordered.running_max(lined, [stream], list(arrival), seen, hot is not None)
    back = F.col("registrado_em") < F.col("_reg")
    gap = F.when(back, seconds_between("registrado_em", "_reg").cast("double"))
    late = F.col("registrado_em") > F.col("ocorrido_em") + F.make_dt_interval(F.lit(tolerance_days))
    return scanned.groupBy(stream).agg(
        F.count("*").alias("transacoes"),
        (F.sum("_times") - F.count("*")).alias("reentregas"),
        F.count_if(F.col("lsn_fim") < F.col("_lsn")).alias("inversoes_de_lsn"),
        F.count_if(back).alias("inversoes_de_registro"),
        F.coalesce(F.max(gap), F.lit(0.0)).alias("maior_inversao_de_registro_s"),
        F.count_if(F.col("ocorrido_em") < F.col("_occ")).alias("fora_de_ordem_no_evento"),
        F.count_if(late).alias("alem_da_tolerancia"),
    )


def reload_losses(
    pairs: DataFrame, period_s: int, margin_s: int, record: str = "registrado_em", commit: str = "confirmada_em"
) -> DataFrame:
    """Transactions a reload every ``period_s`` seconds by record-time mark would never see.

    A cycle's mark is the largest record time of earlier cycles; rows at or under mark - margin are
    lost, and being smaller they never raise the mark. Cycles are scanned in chunks.
    """
    start = pairs.agg(F.min(commit)).scalar()
    cycle = F.floor(seconds_between(start, F.col(commit)) / F.lit(period_s))
    rows = pairs.withColumn("_cycle", cycle)
    tops = rows.groupBy("_cycle").agg(F.max(record).alias("_top"))
    tops = tops.withColumn(CHUNK, F.floor(F.col("_cycle") / 100_000))
    marks = ordered.running_max(tops, [], ["_cycle"], {"_mark": "_top"}, True).select("_cycle", "_mark")
    margin = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(margin_s).cast("decimal(18,6)"))
    lost = F.col(record) <= F.col("_mark") - margin
    return rows.join(marks, "_cycle").agg(F.count_if(lost).alias("perdidas"))
