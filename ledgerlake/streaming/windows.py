"""Monthly windows: late data is found, reconciled and logged, never dropped.

The control state (mark, ids seen in the margin, headers still without items) is small: ids are kept
as closed ranges, and looked up in them without expanding them. ``plan`` and ``reconcile`` are plain DataFrame steps; ``MonthlyWindows`` strings
them together over stored tables.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.contracts import MARK_MARGIN_SECONDS
from ledgerlake.functions.columns import NTZ, month_close, month_of, month_start, seconds_between
from ledgerlake.operators import ordered, quality
from ledgerlake.sources.log import ATTEMPTS, Conflict
from ledgerlake.sources.tables import VersionedTable

def check_month(month: str) -> str:
    if not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", month):
        raise ValueError(f"expected a month as AAAA-MM, got {month!r}")
    return month


def lateness(headers: DataFrame) -> DataFrame:
    """Month, delay and whether the record came within month end + tolerance."""
    month = month_of("ocorrido_em")
    return headers.withColumns({
        "mes": month,
        "fechamento": month_close(month),
        "atraso_dias": F.round(seconds_between("ocorrido_em", "registrado_em").cast("double") / 86400, 1),
        "dentro_da_tolerancia": F.col("registrado_em") <= month_close(month),
    })


def _margin(mark: Column, seconds: int) -> Column:
    return mark - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds).cast("decimal(18,6)"))


@dataclass(frozen=True)
class Plan:
    new: DataFrame
    completed: DataFrame
    still_without_items: DataFrame
    seen_in_margin: DataFrame


#: Ids of one run that are sent to every task at most; above it they are joined by a shuffle.
FEW_IDS = 1_000_000


def plan(
    headers: DataFrame,
    items: DataFrame,
    seen: DataFrame,
    waiting: DataFrame,
    mark: str | None,
    limit: str,
    margin_s: int = MARK_MARGIN_SECONDS,
) -> Plan:
    """What is new since the mark.

    Records in ``(mark - margin, limit]`` are read again; those at or before the mark that the
    previous run had already seen are not new. Headers remembered as empty are new once they have
    items, however late. ``seen`` and ``waiting`` are closed ranges ``lo..hi`` of ids. Items are looked up only for
    headers in the margin or waiting; these are counted first, and few are sent to the stored items.
    """
    top = F.lit(limit).cast(NTZ)
    at = F.lit(mark).cast(NTZ)
    record = F.col("registrado_em")
    read = headers.where(record <= top)
    if mark is not None:
        read = read.where(record > _margin(at, margin_s))
    span = waiting.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    around = headers.where(F.col("vistoria_id").between(span["lo"], span["hi"])) if span["lo"] is not None else headers.where(F.lit(False))
    held = around.join(ordered.ids_in_ranges(around, "vistoria_id", waiting), "vistoria_id", "left_semi")
    asked = read.select("vistoria_id").unionByName(held.select("vistoria_id")).distinct()
    if mark is not None and asked.limit(FEW_IDS + 1).count() <= FEW_IDS:
        asked = F.broadcast(asked)
    with_items = items.select("vistoria_id").join(asked, "vistoria_id", "left_semi").distinct()
    filled = read.join(with_items, "vistoria_id", "left_semi")
    empty = read.join(with_items, "vistoria_id", "left_anti").select("vistoria_id")
    if mark is None:
        fresh = filled
    else:
        before = filled.where(record <= at)
        again = before.join(ordered.ids_in_ranges(before, "vistoria_id", seen), "vistoria_id", "left_anti")
        fresh = filled.where(record > at).unionByName(again)
    completed = held.join(with_items, "vistoria_id", "left_semi")
    still = held.select("vistoria_id").join(with_items, "vistoria_id", "left_anti").unionByName(empty).distinct()
    return Plan(
        new=fresh.unionByName(completed).distinct(),
        completed=completed,
        still_without_items=still,
        seen_in_margin=read.where(record > _margin(top, margin_s)).select("vistoria_id"),
    )


def reopened(new: DataFrame, limit: str) -> DataFrame:
    """Closed months that late records open again: events, largest delay, instant."""
    late = lateness(new).where(~F.col("dentro_da_tolerancia"))
    return late.groupBy("mes").agg(
        F.count("*").alias("eventos"), F.max("atraso_dias").alias("maior_atraso_dias")
    ).withColumn("reaberta_em", F.lit(limit).cast(NTZ))


def compare_months(origin: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows and fingerprint of every month on both sides, in one pass over each."""
    return _compared(origin, quality.fingerprint(stored, by=["mes_ocorrencia"]))


def compare_with_table(origin: DataFrame, table: VersionedTable, months: Sequence[str] | None = None) -> DataFrame:
    """The same against a stored table, whose kept fingerprints are merged instead of reading it."""
    if not table.summed:
        stored = table.read()
        return compare_months(origin, stored if months is None else in_months(stored, months))
    return _compared(origin, table.fingerprint(by_partition=True, values=months))


def _compared(origin: DataFrame, stored: DataFrame) -> DataFrame:
    a = quality.fingerprint(origin, by=["mes_ocorrencia"]).select(
        "mes_ocorrencia", F.col("linhas").alias("linhas_na_origem"), F.col("impressao").alias("_a")
    )
    zero = F.lit(0).cast("decimal(38,0)")
    both = a.join(stored, "mes_ocorrencia", "full_outer")
    return both.select(
        F.col("mes_ocorrencia").alias("mes"),
        F.coalesce("linhas", F.lit(0).cast("bigint")).alias("linhas"),
        F.coalesce("linhas_na_origem", F.lit(0).cast("bigint")).alias("linhas_na_origem"),
        F.coalesce("impressao", zero).alias("impressao"),
        (F.coalesce("_a", zero) == F.coalesce("impressao", zero)).alias("confere_com_a_origem"),
    )


def in_months(events: DataFrame, months: Sequence[str]) -> DataFrame:
    return events.where(F.col("mes_ocorrencia").isin(list(months)))


def reconcile(origin: DataFrame, table: VersionedTable, months: Sequence[str]) -> tuple[DataFrame, int]:
    """Insert what the stored months lack, in one job for all months; equal months are not touched.

    Returns the windows after the repair and the number of rows inserted. The list of months is
    calendar-sized; the stored side is never scanned where its fingerprints are kept.
    """
    wanted = in_months(origin, months)
    before = compare_with_table(wanted, table, months)
    unequal = [r["mes"] for r in before.where(~F.col("confere_com_a_origem")).select("mes").collect()]
    inserted = 0
    if unequal:
        inserted = table.insert_if_absent(in_months(wanted, unequal)).inserted
    return compare_with_table(wanted, table, months), inserted


def reprocess(origin: DataFrame, table: VersionedTable, months: Sequence[str]) -> tuple[DataFrame, int]:
    """Idempotent backfill of a list of months."""
    return reconcile(origin, table, [check_month(m) for m in months])


CONTROL_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()),
    T.StructField("mes", T.StringType()), T.StructField("linhas", T.LongType()),
    T.StructField("impressao", T.DecimalType(38, 0)), T.StructField("confere", T.BooleanType()),
    T.StructField("eventos", T.LongType()), T.StructField("maior_atraso_dias", T.DoubleType()),
    T.StructField("instante", T.TimestampNTZType()),
])


@dataclass(frozen=True)
class RunReport:
    previous_mark: str | None
    mark: str | None
    new_events: int
    months: list[str]
    inserted: int


class MonthlyWindows:
    """Run the windows over stored tables; the control state is replaced as one commit."""

    def __init__(self, spark: SparkSession, events: VersionedTable, control_root: str, margin_s: int = MARK_MARGIN_SECONDS):
        self.spark, self.events, self.margin_s = spark, events, margin_s
        self.control = VersionedTable(spark, control_root, CONTROL_SCHEMA, ["kind"])

    def state(self, kind: str, version: int | None = None) -> DataFrame:
        return self.control.read(version).where(F.col("kind") == kind)

    def mark(self, version: int | None = None) -> str | None:
        row = self.state("mark", version).select(F.col("instante").cast("string")).first()
        return row[0] if row else None

    def _ids(self, kind: str) -> DataFrame:
        return ordered.expand_ranges(self.state(kind), [], "vistoria_id")

    def _ranges(self, ids: DataFrame, kind: str) -> DataFrame:
        return self._row(ordered.id_ranges(ids, [], "vistoria_id").withColumn("kind", F.lit(kind)))

    @staticmethod
    def _row(df: DataFrame) -> DataFrame:
        return df.select(*[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CONTROL_SCHEMA.fields
        ])

    def _window_rows(self, windows: DataFrame) -> DataFrame:
        return self._row(windows.withColumn("kind", F.lit("window")).withColumn("confere", F.col("confere_com_a_origem")))

    def run(self, headers: DataFrame, items: DataFrame, origin_events: DataFrame) -> RunReport:
        """One run. If another one replaces the control state meanwhile, it is done again from that state."""
        return self._retried(lambda: self._run(headers, items, origin_events))

    def _retried(self, work):
        for _ in range(ATTEMPTS):
            try:
                return work()
            except Conflict:
                continue
        raise Conflict(f"{self.control.root}: other runs kept replacing the control state")

    def _run(self, headers: DataFrame, items: DataFrame, origin_events: DataFrame) -> RunReport:
        at = self.control.version()
        previous = self.mark(at)
        # The upper bound is read first: what is recorded during this run belongs to the next one.
        limit = headers.agg(F.max("registrado_em").cast("string")).first()[0]
        if limit is None:
            return RunReport(previous, previous, 0, [], 0)
        if previous is not None and limit < previous:
            limit = previous  # another run may have read later headers; the mark never goes back
        todo = plan(headers, items, self.state("seen", at), self.state("waiting", at), previous, limit, self.margin_s)
        new = todo.new.persist()
        try:
            per_month = lateness(new).groupBy("mes").count().collect()  # calendar months
            months = sorted(r["mes"] for r in per_month)
            windows, inserted = reconcile(origin_events, self.events, months) if months else (None, 0)
            state = self._row(self.spark.createDataFrame([("mark", limit)], "kind string, instante string"))
            state = state.unionByName(self._ranges(todo.seen_in_margin, "seen"))
            state = state.unionByName(self._ranges(todo.still_without_items, "waiting"))
            state = state.unionByName(self.state("reopened", at))
            if previous is not None:
                log = reopened(new, limit).withColumnRenamed("reaberta_em", "instante")
                state = state.unionByName(self._row(log.withColumn("kind", F.lit("reopened"))))
            kept = self.state("window", at)
            if windows is not None:
                kept = kept.where(~F.col("mes").isin(months)).unionByName(self._window_rows(windows))
            self.control.replace(state.unionByName(kept), read=at)
        finally:
            new.unpersist()
        return RunReport(previous, limit, sum(r["count"] for r in per_month), months, inserted)

    def reprocess(self, origin_events: DataFrame, months: Sequence[str]) -> DataFrame:
        def work() -> DataFrame:
            at = self.control.version()
            windows, _ = reprocess(origin_events, self.events, months)
            others = self.control.read(at).where(~((F.col("kind") == "window") & F.col("mes").isin(list(months))))
            self.control.replace(others.unionByName(self._window_rows(windows)), read=at)
            return windows

        return self._retried(work)

    def windows(self) -> DataFrame:
        return self.state("window").select("mes", "linhas", "impressao", F.col("confere").alias("confere_com_a_origem"))

    def reopenings(self) -> DataFrame:
        return self.state("reopened").select("mes", "eventos", "maior_atraso_dias", F.col("instante").alias("reaberta_em"))


def month_bounds(months: DataFrame) -> DataFrame:
    """First instant of each month, of the next one, and the closing instant."""
    start = month_start("mes")
    return months.select(
        "mes", start.cast(NTZ).alias("inicio"), F.add_months(start, 1).cast(NTZ).alias("fim"),
        F.substring(F.add_months(start, -1).cast("string"), 1, 7).alias("mes_anterior"),
        month_close("mes").alias("fechamento"),
    )
