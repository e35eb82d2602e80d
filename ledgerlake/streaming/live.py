"""Month windows that the stream keeps up: every commit of the event table moves them once.

The state names the last version of the event table that it has taken in. Taking in the commits after it
and naming the new version is one commit of the state, so a stop between writing events and this, a batch that is
delivered again, or another process doing the same neither loses nor doubles a row. Late rows are not dropped:
they are counted in their month and reopen it, with a line in the log.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sources.log import ATTEMPTS, Conflict
from ledgerlake.sources.tables import REPLACE, REWRITE, VersionedTable
from ledgerlake.streaming.windows import lateness

MARK, WINDOW, REOPENED = "mark", "window", "reopened"

STATE_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("versao", T.LongType()), T.StructField("mes", T.StringType()),
    T.StructField("linhas", T.LongType()), T.StructField("atrasadas", T.LongType()), T.StructField("maior_atraso_dias", T.DoubleType()),
    T.StructField("instante", T.TimestampNTZType()),
])


@dataclass(frozen=True)
class Taken:
    """Versions of the event table before and after; ``rebuilt`` if the whole table was counted."""

    before: int
    after: int
    rebuilt: bool = False


def _months(events: DataFrame) -> DataFrame:
    """Rows, late rows, largest delay and last record of each month; one row a month."""
    timed = lateness(events)
    late = ~F.col("dentro_da_tolerancia")
    return timed.groupBy("mes").agg(
        F.count("*").alias("linhas"), F.count_if(late).alias("atrasadas"),
        F.max(F.when(late, F.col("atraso_dias"))).alias("maior_atraso_dias"), F.max("registrado_em").alias("instante"),
    )


class LiveWindows:
    def __init__(self, spark: SparkSession, events: VersionedTable, root: str):
        self.spark, self.events = spark, events
        self.state = VersionedTable(spark, root, STATE_SCHEMA, ["kind"])

    def mark(self, version: int | None = None) -> int:
        row = self.state.read(version).where(F.col("kind") == MARK).select("versao").first()
        return row[0] if row else 0

    def windows(self, version: int | None = None) -> DataFrame:
        return self.state.read(version).where(F.col("kind") == WINDOW).select("mes", "linhas", "atrasadas", "maior_atraso_dias")

    def reopenings(self, version: int | None = None) -> DataFrame:
        out = self.state.read(version).where(F.col("kind") == REOPENED)
        return out.select("versao", "mes", F.col("linhas").alias("eventos"), "maior_atraso_dias", F.col("instante").alias("reaberta_em"))

    def catch_up(self) -> Taken:
        """Take in every commit of the event table since the last time."""
        for _ in range(ATTEMPTS):
            try:
                return self._catch_up()
            except Conflict:
                continue  # another process took in the same commits: from its state, then
        raise Conflict(f"{self.state.root}: other writers kept replacing the state")

    def _catch_up(self) -> Taken:
        at = self.state.version()
        last, top = self.mark(at), self.events.version()
        if top == last:
            return Taken(last, last)
        entries = self.events.commits.history(last, top)
        # Entries that retention has dropped, or a replaced content, leave only counting the table anew.
        rebuild = [e["version"] for e in entries] != list(range(last + 1, top + 1)) or any(e["kind"] == REPLACE for e in entries)
        if rebuild:
            months = _months(self.events.read(top))
            windows = months
        else:
            months = _months(self.events.added([e for e in entries if e["kind"] != REWRITE])).persist()
            windows = self.windows(at).unionByName(months.drop("instante")).groupBy("mes").agg(
                F.sum("linhas").alias("linhas"), F.sum("atrasadas").alias("atrasadas"), F.max("maior_atraso_dias").alias("maior_atraso_dias")
            )
        try:
            lines = [self._rows(windows, WINDOW, top), self.state.read(at).where(F.col("kind") == REOPENED)]
            if not rebuild and last:
                late = months.where(F.col("atrasadas") > 0)
                lines.append(self._rows(late.withColumn("linhas", F.col("atrasadas")), REOPENED, top))
            mark = self._rows(self.spark.range(1).select(F.lit(None).cast("string").alias("mes")), MARK, top)
            for part in lines:
                mark = mark.unionByName(part)
            # Calendar months: a handful of rows, one file.
            self.state.replace(mark.coalesce(1), read=at)
        finally:
            months.unpersist()
        return Taken(last, top, rebuild)

    @staticmethod
    def _rows(df: DataFrame, kind: str, version: int) -> DataFrame:
        given = {"kind": F.lit(kind), "versao": F.lit(version)}
        return df.select(*[
            (given.get(f.name, F.col(f.name) if f.name in df.columns else F.lit(None))).cast(f.dataType).alias(f.name) for f in STATE_SCHEMA.fields
        ])
