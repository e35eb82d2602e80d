"""Change-stream delivery with Structured Streaming.

Each micro-batch: convert, insert events if absent, queue what cannot be delivered, log telemetry.
The engine advances its checkpoint only after the batch function returns, so a crash in between
delivers the batch again and the keyed sinks absorb the repetition: effectively once.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ledgerlake.contracts import DLQ_KEY, EVENT_CONTENT, EVENT_KEY, EVENT_SCHEMA
from ledgerlake.sources.log import ATTEMPTS, Conflict
from ledgerlake.sources.tables import VersionedTable, Written
from ledgerlake.streaming import envelope, telemetry
from ledgerlake.streaming.live import LiveWindows
from ledgerlake.streaming.recovery import RECEIPT_SCHEMA, REVIEWED_SCHEMA

log = logging.getLogger(__name__)

FRESHNESS_SCHEMA = T.StructType([T.StructField("drenado_em", T.TimestampNTZType())])


@dataclass(frozen=True)
class Tables:
    """The stored tables of one delivery pipeline."""

    events: VersionedTable
    queue: VersionedTable
    telemetry: VersionedTable
    freshness: VersionedTable
    receipts: VersionedTable
    reviewed: VersionedTable

    @classmethod
    def under(cls, spark: SparkSession, root: str) -> Tables:
        return cls(
            events=VersionedTable(
                spark, f"{root}/events", EVENT_SCHEMA, EVENT_KEY, "mes_ocorrencia", ["lsn_origem"], ["co_entidade"], EVENT_CONTENT
            ),
            queue=VersionedTable(spark, f"{root}/queue", envelope.DLQ_SCHEMA, DLQ_KEY),
            telemetry=VersionedTable(spark, f"{root}/telemetry", telemetry.TELEMETRY_SCHEMA, ["passada_em", "lsn_fim"]),
            freshness=VersionedTable(spark, f"{root}/freshness", FRESHNESS_SCHEMA, ["drenado_em"]),
            receipts=VersionedTable(spark, f"{root}/receipts", RECEIPT_SCHEMA, DLQ_KEY),
            reviewed=VersionedTable(spark, f"{root}/reviewed", REVIEWED_SCHEMA, [*DLQ_KEY, *EVENT_KEY]),
        )


def utc_now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def publish_baseline(tables: Tables, origin: DataFrame, force: bool = False) -> Written:
    """Load the origin once, before the stream starts on the same table; the key resolves overlap."""
    if not force and not tables.events.is_empty():
        return Written(0, 0, tables.events.version())
    return tables.events.insert_if_absent(origin)


def deliver(
    changes: DataFrame, headers: DataFrame, tables: Tables, read_start: str | None = None,
    fail_after_write: bool = False, drifts: DataFrame | None = None, live: LiveWindows | None = None,
) -> Written:
    """Deliver one batch of captured changes; ``live`` month windows then take in what was written."""
    start = read_start or utc_now()
    changes = changes.persist()
    enriched = None
    try:
        with envelope.headers_of(changes, headers) as named:
            enriched = envelope.enrich(changes, named).persist()
            read_end = utc_now()
            events, rejected = envelope.events_of(enriched), envelope.rejections(enriched)
            converted = utc_now()
            letters = rejected.unionByName(envelope.insert_only_violations(changes))
            # Two independent tables: their jobs run side by side, and both must be done to go on.
            with ThreadPoolExecutor(2) as pool:
                inserting = pool.submit(tables.events.insert_if_absent, events)
                queueing = pool.submit(tables.queue.insert_if_absent, letters)
                written = inserting.result()
                queueing.result()
            clock = telemetry.Clock(start, read_end, converted, utc_now())
            _log_pass(changes, events, rejected, clock, tables, drifts)
    finally:
        if enriched is not None:
            enriched.unpersist()
        changes.unpersist()
    if fail_after_write:
        raise RuntimeError("stopped after writing and before the position advanced")
    if live is not None:
        live.catch_up()
    return written


#: What a store may fail with; a wrong schema or expression is no such failure and is raised.
STORE_ERRORS = (Py4JJavaError, OSError)


def _log_pass(changes, events, rejected, clock, tables: Tables, drifts) -> None:
    """A store that fails to log never blocks delivery."""
    try:
        tables.telemetry.append(telemetry.transaction_rows(changes, events, rejected, clock, drifts))
    except STORE_ERRORS:
        log.exception("telemetry of the pass was not logged")


def drained(tables: Tables, at: str) -> None:
    """Everything committed before ``at`` is readable; an idle pass renews it too. An earlier instant never
    takes the place of a later one.
    """
    spark = tables.freshness.spark
    given = spark.createDataFrame([(at,)], "drenado_em string").select(F.col("drenado_em").cast("timestamp_ntz"))
    try:
        for _ in range(ATTEMPTS):
            seen = tables.freshness.version()
            newest = tables.freshness.read(seen).unionByName(given).agg(F.max("drenado_em").alias("drenado_em"))
            try:
                tables.freshness.replace(newest, read=seen)
                return
            except Conflict:
                continue  # another pass renewed it meanwhile
    except STORE_ERRORS:
        log.exception("drain instant was not logged")


def drained_at(tables: Tables) -> DataFrame:
    return tables.freshness.read()


def source(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Envelope files as a stream; ``max_files`` or ``max_bytes`` limits how much one micro-batch takes.

    A limit in bytes admits files in the order of their arrival until it is reached, one at least: a thousand small
    files or one large one make a pass of about the same work.
    """
    if max_files is not None and max_bytes is not None:
        raise ValueError("limit a pass by files or by bytes, not by both")
    reader = spark.readStream.schema(envelope.ENVELOPE_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def start(
    stream: DataFrame, headers: Callable[[], DataFrame], tables: Tables, checkpoint: str,
    every: str | None = None, fail_after_write: bool = False, drifts: DataFrame | None = None, limited: bool = False,
    live: LiveWindows | None = None,
) -> StreamingQuery:
    """Start delivery: one bounded pass, or every ``every`` (for example ``2 seconds``) for ever.

    ``headers`` is called per batch, so each batch joins the headers as they are then. A query that goes on
    renews the drain instant after each batch and while it idles: a batch takes what was there when the
    one before it ended, unless the source is ``limited`` per batch.
    """
    taken = {"at": utc_now()}

    def batch(changes: DataFrame, _: int) -> None:
        deliver(changes, headers(), tables, fail_after_write=fail_after_write, drifts=drifts, live=live)
        if every and not limited:
            drained(tables, taken["at"])
        taken["at"] = utc_now()

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if not every:
        return writer.trigger(availableNow=True).start()
    query = writer.trigger(processingTime=every).start()
    tables.freshness.spark.streams.addListener(IdleFreshness(tables, str(query.id)))
    return query


def run_once(
    spark: SparkSession, path: str, headers: Callable[[], DataFrame], tables: Tables, checkpoint: str,
    max_files: int | None = None, fail_after_write: bool = False, drifts: DataFrame | None = None, max_bytes: int | None = None,
    live: LiveWindows | None = None,
) -> None:
    """Deliver what is pending now, then stop. A pass that drained everything renews the freshness."""
    began = utc_now()
    start(source(spark, path, max_files, max_bytes), headers, tables, checkpoint, fail_after_write=fail_after_write, drifts=drifts, live=live).awaitTermination()
    drained(tables, began)


class IdleFreshness(StreamingQueryListener):
    """Renews the drain instant of one continuous query while nothing arrives, until the query ends."""

    def __init__(self, tables: Tables, query: str):
        self.tables, self.query = tables, query

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None: ...

    def onQueryIdle(self, event) -> None:
        if str(event.id) == self.query:
            drained(self.tables, event.timestamp.replace("T", " ").rstrip("Z"))

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query:
            self.tables.freshness.spark.streams.removeListener(self)
