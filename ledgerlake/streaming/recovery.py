"""Dead-letter recovery: selective replay, accepted deviations, and what they exempt."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.contracts import DLQ_KEY, EVENT_CONTENT, EVENT_KEY, EVENT_REQUIRED
from ledgerlake.functions.columns import NTZ, OPERATOR, all_of, hash_number, row_text
from ledgerlake.session import spread
from ledgerlake.sources.tables import VersionedTable

REPLAY, ACCEPT = "reprocessar", "aceitar_desvio"
#: Accepted deviations that are sent to every task at most, and event keys of a replay.
FEW_TREATMENTS, FEW_KEYS = 100_000, 1_000_000

RECEIPT_SCHEMA = T.StructType([
    T.StructField("lsn_origem", T.LongType(), False), T.StructField("chave", T.StringType(), False),
    T.StructField("acao", T.StringType(), False), T.StructField("responsavel", T.StringType(), False),
    T.StructField("motivo", T.StringType(), False), T.StructField("tratado_em", T.TimestampNTZType(), False),
    T.StructField("estado_origem", T.DecimalType(38, 0), False),
    T.StructField("estado_delta", T.DecimalType(38, 0), False),
])
# Reviewed keys are rows of their own: a receipt for a truncate reviews the whole table.
REVIEWED_SCHEMA = T.StructType([
    T.StructField("lsn_origem", T.LongType(), False), T.StructField("chave", T.StringType(), False),
    T.StructField("vistoria_id", T.LongType(), False), T.StructField("item_codigo", T.StringType(), False),
])


@dataclass(frozen=True)
class ReplayCounts:
    recovered: int
    already_treated: int
    pending: int
    read: int


def state_number(columns: Sequence[str] = EVENT_CONTENT) -> Column:
    """Order-free fingerprint of a set of rows, so even a whole table is one distributed sum."""
    return F.coalesce(F.sum(hash_number(row_text(columns))), F.lit(0).cast("decimal(38,0)"))


def occurrences(queue: DataFrame) -> DataFrame:
    """One row per dead-letter identity, whatever an older batch repeated."""
    rest = [c for c in queue.columns if c not in DLQ_KEY]
    return queue.groupBy(*DLQ_KEY).agg(F.max(F.struct(*rest)).alias("_r")).select(
        *DLQ_KEY, *[f"_r.{c}" for c in rest]
    )


def untreated_inserts(queue: DataFrame, receipts: DataFrame) -> DataFrame:
    return occurrences(queue.where(F.col("operacao") == "insert")).join(
        receipts.select(*DLQ_KEY), list(DLQ_KEY), "left_anti"
    )


def replay_candidates(queue: DataFrame, receipts: DataFrame, origin: DataFrame) -> DataFrame:
    """Untreated inserts whose event the origin can supply whole, with the LSN of the occurrence."""
    todo = untreated_inserts(queue, receipts).select(*DLQ_KEY, *EVENT_KEY)
    found = todo.join(origin.select(*EVENT_CONTENT), list(EVENT_KEY))
    return found.where(all_of(F.col(c).isNotNull() for c in EVENT_REQUIRED))


def _among(rows: DataFrame, wanted: DataFrame, few: bool) -> DataFrame:
    """Rows whose key is wanted; keys that were counted and are few go to the rows, which then are not shuffled."""
    keys = wanted.select(*EVENT_KEY)
    return rows.join(F.broadcast(keys) if few else keys, list(EVENT_KEY), "left_semi")


def verified(candidates: DataFrame, stored: DataFrame, few: bool = False) -> DataFrame:
    """Candidates stored exactly once and with equal content (the LSN is not content)."""
    same = candidates.withColumn("_want", row_text(EVENT_CONTENT))
    # The stored side is filtered by the keys before anything is grouped.
    kept = _among(stored, candidates, few)
    have = kept.groupBy(*EVENT_KEY).agg(F.count("*").alias("_n"), F.max(row_text(EVENT_CONTENT)).alias("_have"))
    return same.join(have, list(EVENT_KEY)).where((F.col("_n") == 1) & (F.col("_want") == F.col("_have"))).drop(
        "_want", "_n", "_have"
    )


def replay(
    queue: DataFrame, receipts: VersionedTable, origin: DataFrame, events: VersionedTable,
    operator: str, reason: str, at: str, chosen: DataFrame | None = None,
) -> ReplayCounts:
    """Recover dead-letter inserts from the origin by key; the first receipt of an occurrence stays.

    ``chosen`` (lsn_origem, chave) restricts the replay to some occurrences. Insertion looks for the key in
    *any* month, because the stored row may lie in another one.
    """
    checked_operator(operator, reason)
    if chosen is not None:
        queue = queue.join(chosen.select(*DLQ_KEY).distinct(), list(DLQ_KEY), "left_semi")
    known = receipts.read()
    inserts = occurrences(queue.where(F.col("operacao") == "insert"))
    total = inserts.count()
    todo = untreated_inserts(queue, known).persist()
    waiting = todo.count()
    few = waiting <= FEW_KEYS
    # Of the origin, only the rows that are asked for: read once, counted and replayed.
    found = _among(origin.select(*EVENT_CONTENT), todo, few).persist()
    read = todo.join(found.select(*EVENT_KEY), list(EVENT_KEY), "left_semi").count()
    good = replay_candidates(queue, known, found).persist()
    events.insert_if_absent(good, prune=False)
    done = verified(good, events.read(), few and good.count() <= FEW_KEYS)
    number = hash_number(row_text(EVENT_CONTENT))
    new = done.select(
        *DLQ_KEY, F.lit(REPLAY).alias("acao"), F.lit(operator).alias("responsavel"), F.lit(reason).alias("motivo"),
        F.lit(at).cast(NTZ).alias("tratado_em"), number.cast("decimal(38,0)").alias("estado_origem"),
        number.cast("decimal(38,0)").alias("estado_delta"),
    )
    recovered = receipts.insert_if_absent(new).inserted
    for held in (todo, found, good):
        held.unpersist()
    return ReplayCounts(recovered, total - waiting, waiting - recovered, read)


@dataclass(frozen=True)
class Scope:
    """What one kind of deviation covers: rows that agree with the entry in ``columns``."""

    table: str
    operation: str
    columns: tuple[str, ...]


# A truncate empties a whole table; other operations touch a header with its items, or one item.
SCOPES = {
    (s.table, s.operation): s
    for s in (
        Scope("vistoria", "update", ("vistoria_id",)),
        Scope("vistoria", "delete", ("vistoria_id",)),
        Scope("vistoria", "truncate", ()),
        Scope("vistoria_item", "update", EVENT_KEY),
        Scope("vistoria_item", "delete", EVENT_KEY),
        Scope("vistoria_item", "truncate", ()),
    )
}


def covered(entry: dict) -> Column:
    """Condition for the rows that accepting ``entry`` covers."""
    scope = SCOPES.get((entry["tabela"], entry["operacao"]))
    if scope is None:
        raise ValueError(f"a deviation of {entry['operacao']} on {entry['tabela']} can't be accepted")
    unknown = [c for c in scope.columns if entry[c] is None]
    if unknown:
        raise ValueError(f"the entry names no {', '.join(unknown)}")
    return all_of([F.lit(True), *(F.col(c) == F.lit(entry[c]) for c in scope.columns)])


def checked_operator(operator: str, reason: str) -> None:
    """Receipts name an operational id and say why."""
    if not re.fullmatch(OPERATOR, operator):
        raise ValueError(f"{operator!r} is no operational id")
    if not reason.strip():
        raise ValueError("a treatment needs a reason")


def acceptance(entry: dict, origin: DataFrame, target: DataFrame, operator: str, reason: str, at: str) -> DataFrame:
    """Receipt row with the fingerprint of both sides within the entry's scope."""
    checked_operator(operator, reason)
    inside = covered(entry)
    here = origin.where(inside).agg(state_number().alias("estado_origem"))
    there = target.where(inside).agg(state_number()).scalar()
    fixed = {"lsn_origem": F.lit(entry["lsn_origem"]).cast("bigint"), "chave": F.lit(entry["chave"]), "acao": F.lit(ACCEPT),
             "responsavel": F.lit(operator), "motivo": F.lit(reason), "tratado_em": F.lit(at).cast(NTZ)}
    return here.select(*[v.alias(k) for k, v in fixed.items()], "estado_origem", there.alias("estado_delta"))


def reviewed_keys(entry: dict, origin: DataFrame, target: DataFrame) -> DataFrame:
    inside = covered(entry)
    keys = origin.where(inside).select(*EVENT_KEY).unionByName(target.where(inside).select(*EVENT_KEY)).distinct()
    return keys.select(
        F.lit(entry["lsn_origem"]).cast("bigint").alias("lsn_origem"), F.lit(entry["chave"]).alias("chave"), *EVENT_KEY
    )


def accept(
    entry: dict, receipts: VersionedTable, reviewed: VersionedTable, origin: DataFrame, target: DataFrame,
    operator: str, reason: str, at: str,
) -> bool:
    """Accept one deviation; False when a receipt already exists (the first one stays)."""
    mine = (F.col("lsn_origem") == entry["lsn_origem"]) & (F.col("chave") == entry["chave"])
    if not receipts.read().where(mine).isEmpty():
        return False
    # Keys first: a receipt is never visible without the keys it reviewed.
    reviewed.insert_if_absent(reviewed_keys(entry, origin, target))
    return receipts.insert_if_absent(acceptance(entry, origin, target, operator, reason, at)).inserted == 1


def active_treatments(queue: DataFrame, receipts: DataFrame) -> DataFrame:
    """Dead-letter identities that have a receipt."""
    return receipts.join(queue.select(*DLQ_KEY).distinct(), list(DLQ_KEY), "left_semi").select(*DLQ_KEY)


def accepted_keys(queue: DataFrame, receipts: DataFrame, reviewed: DataFrame, origin: DataFrame, target: DataFrame) -> DataFrame:
    """Event keys exempt from the row checksum: only while both states equal their receipt."""
    live = receipts.where(F.col("acao") == ACCEPT).join(
        queue.select(*DLQ_KEY).distinct(), list(DLQ_KEY), "left_semi"
    )
    # A receipt may review a whole table: its keys are joined by key, not dealt by receipt, and not sent to every task
    # because their files are small. Accepted deviations are decisions of operators; the number is looked at first.
    few = live.limit(FEW_TREATMENTS + 1).count() <= FEW_TREATMENTS

    def listed(treatments: DataFrame) -> DataFrame:
        return F.broadcast(treatments) if few else treatments

    kept = reviewed.join(listed(live.select(*DLQ_KEY)), list(DLQ_KEY), "left_semi")

    def state(side: DataFrame, name: str) -> DataFrame:
        covered = spread(kept, *EVENT_KEY).join(spread(side.select(*EVENT_CONTENT), *EVENT_KEY).hint("merge"), list(EVENT_KEY))
        return covered.groupBy(*DLQ_KEY).agg(state_number().alias(name))

    zero = F.lit(0).cast("decimal(38,0)")
    now = (
        live.join(state(origin, "_o"), list(DLQ_KEY), "left").join(state(target, "_t"), list(DLQ_KEY), "left")
        .where((F.coalesce("_o", zero) == F.col("estado_origem")) & (F.coalesce("_t", zero) == F.col("estado_delta")))
    )
    return spread(kept.join(listed(now.select(*DLQ_KEY)), list(DLQ_KEY), "left_semi").select(*EVENT_KEY), *EVENT_KEY).distinct()
