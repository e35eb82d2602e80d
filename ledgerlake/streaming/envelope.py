"""Change envelope -> canonical events, with row-level quarantine.

An envelope row is one captured change: ``lsn, commit_ts, tabela, op, valores`` where ``valores``
maps column names to captured text. A column that was not captured is absent from the map.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.contracts import EVENT_CONTENT, EVENT_REQUIRED, INSERT_ONLY_REASON, REASON_MAX_CHARS
from ledgerlake.functions.columns import month_of

ITEMS, HEADERS = "vistoria_item", "vistoria"
INT_MIN, INT_MAX = -(2**31), 2**31 - 1

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("lsn", T.LongType(), False),
    T.StructField("seq", T.LongType(), False),
    T.StructField("commit_ts", T.TimestampNTZType(), False),
    T.StructField("tabela", T.StringType(), False),
    T.StructField("op", T.StringType(), False),
    T.StructField("valores", T.MapType(T.StringType(), T.StringType()), True),
])

DLQ_SCHEMA = T.StructType([
    T.StructField("lsn_origem", T.LongType(), False),
    T.StructField("chave", T.StringType(), False),
    T.StructField("confirmada_em", T.TimestampNTZType(), False),
    T.StructField("tabela", T.StringType(), False),
    T.StructField("operacao", T.StringType(), False),
    T.StructField("vistoria_id", T.LongType(), True),
    T.StructField("item_codigo", T.StringType(), True),
    T.StructField("motivo", T.StringType(), False),
])


def value(name: str) -> Column:
    return F.try_element_at("valores", F.lit(name))


def has(name: str) -> Column:
    return F.coalesce(F.map_contains_key("valores", F.lit(name)), F.lit(False))


def inspection_id() -> Column:
    """Header id of a change: the items table calls it ``vistoria_id``, the header table ``id``."""
    return F.when(F.col("tabela") == HEADERS, value("id")).otherwise(value("vistoria_id")).try_cast("bigint")


def _rejection() -> Column:
    """First reason a captured item cannot become an event, NULL when it can.

    Fixed values: the prefix before the colon is the error class that reports are grouped by.
    """
    quantity = value("quantidade")
    whole = quantity.try_cast("decimal(38,0)")
    is_whole = quantity.rlike(r"^\s*[+-]?\d+\s*$")
    checks = [
        (~has("vistoria_id"), F.lit("KeyError: 'vistoria_id'")),
        (value("vistoria_id").isNull(), F.lit("TypeError: vistoria_id")),
        (value("vistoria_id").try_cast("bigint").isNull(),
         F.concat(F.lit("ValueError: vistoria_id "), value("vistoria_id"))),
        (F.col("_header").isNull(), F.concat(F.lit("KeyError: "), value("vistoria_id"))),
        (~has("quantidade"), F.lit("KeyError: 'quantidade'")),
        (~has("item_codigo"), F.lit("KeyError: 'item_codigo'")),
        (~has("situacao"), F.lit("KeyError: 'situacao'")),
        (quantity.isNotNull() & ~is_whole, F.concat(F.lit("ValueError: quantidade "), quantity)),
        (F.coalesce(_null_columns() != "", F.lit(False)),
         F.concat(F.lit("ValueError: coluna obrigatória nula: "), _null_columns())),
        (quantity.isNotNull() & (whole.isNull() | ~whole.between(INT_MIN, INT_MAX)),
         F.concat(F.lit("OverflowError: quantidade "), quantity)),
    ]
    out = F.lit(None).cast("string")
    for condition, reason in reversed(checks):
        out = F.when(condition, reason).otherwise(out)
    return out


def _null_columns() -> Column:
    given = {"vistoria_id": value("vistoria_id"), "item_codigo": value("item_codigo"), "situacao": value("situacao")}
    return F.array_join(F.array_compact(F.array(*[
        F.when(given.get(c, F.col(c)).isNull(), F.lit(c)) for c in EVENT_REQUIRED
    ])), ", ")


#: Bytes of a broadcast key, and of all keys of a batch that are broadcast at most.
KEY_BYTES = 16
BROADCAST_BYTES = 32 << 20


def enrich(changes: DataFrame, headers: DataFrame) -> DataFrame:
    """Give each captured item insert its header; items without a readable one keep NULLs.

    ``headers``: vistoria_id, co_entidade, sg_uf, origem, ocorrido_em, registrado_em.
    """
    items = changes.where((F.col("tabela") == ITEMS) & (F.col("op") == "insert")).withColumn(
        "vistoria_id", inspection_id()
    )
    known = headers.withColumn("_header", F.lit(True)).withColumn("mes_ocorrencia", month_of("ocorrido_em"))
    return items.join(known, "vistoria_id", "left").withColumn("motivo", _rejection())


@contextmanager
def headers_of(changes: DataFrame, headers: DataFrame) -> Iterator[DataFrame]:
    """The headers that a batch names. Its keys are counted first: few are sent to the stored headers, which
    then are neither shuffled nor read by other ids; many are joined by a shuffle. The keys are held until the block ends.
    """
    keys = changes.where((F.col("tabela") == ITEMS) & (F.col("op") == "insert")).select(inspection_id().alias("vistoria_id"))
    keys = keys.where(F.col("vistoria_id").isNotNull()).distinct().persist()
    try:
        few = keys.count() * KEY_BYTES <= BROADCAST_BYTES
        yield headers.join(F.broadcast(keys) if few else keys, "vistoria_id", "left_semi")
    finally:
        keys.unpersist()


def events_of(enriched: DataFrame) -> DataFrame:
    good = enriched.where(F.col("motivo").isNull()).withColumns({
        "item_codigo": value("item_codigo"), "situacao": value("situacao"),
        "quantidade": F.trim(value("quantidade")).cast("int"), "lsn_origem": F.col("lsn"),
    })
    return good.select(*EVENT_CONTENT, "lsn_origem")


def dead_letter(reason: Column) -> list[Column]:
    shown = F.coalesce(inspection_id().cast("string"), F.lit("None"))
    item = F.coalesce(value("item_codigo"), F.lit("None"))
    return [
        F.col("lsn").alias("lsn_origem"),
        F.concat_ws("/", "tabela", "op", shown, item).alias("chave"),
        F.col("commit_ts").alias("confirmada_em"),
        "tabela",
        F.col("op").alias("operacao"),
        inspection_id().alias("vistoria_id"),
        value("item_codigo").alias("item_codigo"),
        F.substring(reason, 1, REASON_MAX_CHARS).alias("motivo"),
    ]


def rejections(enriched: DataFrame) -> DataFrame:
    return enriched.where(F.col("motivo").isNotNull()).select(*dead_letter(F.col("motivo")))


def insert_only_violations(changes: DataFrame) -> DataFrame:
    """Updates, deletes and truncates: key and fixed reason only, no captured value leaks."""
    return changes.where(F.col("op") != "insert").select(*dead_letter(F.lit(INSERT_ONLY_REASON)))


def reasons(queue: DataFrame) -> DataFrame:
    """Queued rows per operation and error class."""
    return queue.groupBy("operacao", F.split("motivo", ":")[0].alias("classe")).agg(F.count("*").alias("linhas"))
