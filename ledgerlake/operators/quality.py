"""Declarative data checks. Every check returns the failing rows; no rows means it passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import EVENT_CONTENT, EVENT_KEY, PRESENT, STATES
from ledgerlake.functions.columns import NTZ, all_of, differs, entries_text, hash_number, row_text
from ledgerlake.operators import ordered


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; a NULL key is not a key."""
    known = df.where(all_of(F.col(k).isNotNull() for k in keys))
    return known.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.where(~F.col(column).isin(*values))


def in_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where((F.col(column) < low) | (F.col(column) > high))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose key is unknown to the parent; a NULL key is allowed."""
    known = parent.select(F.col(pk).alias(fk)).distinct()
    return child.where(F.col(fk).isNotNull()).join(known, fk, "left_anti")


def overlaps(versions: DataFrame, entity: str, hot: DataFrame | None = None) -> DataFrame:
    """Versions that start before the previous one ends, or that last no time at all."""
    chunked = ordered.with_chunks(versions, [entity], hot, ordered.by_day(F.col("valid_from")))
    seen = ordered.neighbour(chunked, [entity], ["valid_from", "valid_to"], {"_ends": "valid_to"}, -1, hot is not None)
    bad = (F.col("_ends") > F.col("valid_from")) | (F.col("valid_from") >= F.col("valid_to"))
    return seen.where(bad).drop("_ends", ordered.CHUNK)


def current_count(versions: DataFrame, entity: str) -> DataFrame:
    """Entities without exactly one current version."""
    return versions.groupBy(entity).agg(F.count_if("is_current").alias("n_current")).where(F.col("n_current") != 1)


def volume(df: DataFrame, origin: DataFrame) -> DataFrame:
    """One row when the table does not hold as many rows as its origin."""
    counts = df.agg(F.count("*").alias("rows")).withColumn(
        "expected", origin.agg(F.count("*")).scalar()
    )
    return counts.where(F.col("rows") != F.col("expected"))


def share_out_of_bounds(
    facts: DataFrame, place: DataFrame, key: str, group: str, low: float = 0.05, high: float = 0.95
) -> DataFrame:
    """Groups whose share of present items is not strictly inside the bounds."""
    # Counted per key before the join, so a hot key joins as one row.
    counted = facts.groupBy(key).agg(F.count_if(F.col("situacao") == PRESENT).alias("_p"), F.count("*").alias("_n"))
    shares = (
        counted.join(place.select(key, group), key)
        .groupBy(group)
        .agg((F.sum("_p") / F.sum("_n")).alias("share"))
    )
    return shares.where(~((F.col("share") > low) & (F.col("share") < high)))


@dataclass(frozen=True)
class Constraint:
    name: str
    holds: Column


def event_constraints() -> list[Constraint]:
    """Row rules of the event log."""
    c = F.col
    return [
        Constraint("estado_conhecido", c("situacao").isin(*STATES)),
        Constraint("quantidade_nao_negativa", c("quantidade").isNull() | (c("quantidade") >= 0)),
        Constraint("registro_depois_do_evento", c("ocorrido_em") <= c("registrado_em")),
    ]


def exam_constraints(census_year: int) -> list[Constraint]:
    """Row rules of the exam input."""
    c = F.col
    n = c("n_participantes")
    return [
        Constraint("participantes_positivos", n > 0),
        Constraint("completos_ate_o_total", c("n_participantes_com_todas_as_notas").between(0, n)),
        Constraint("sem_nota_ate_o_total", c("n_participantes_sem_nota").between(0, n)),
        Constraint("ano_da_referencia", c("ano") == census_year),
        Constraint("ano_valido", c("ano").between(2007, 2100)),
    ]


def registration_constraints() -> list[Constraint]:
    c = F.col
    return [
        Constraint("rede_valida", c("tp_dependencia").between(1, 4)),
        Constraint("localizacao_valida", c("tp_localizacao").isin(1, 2)),
        Constraint("ano_do_censo_valido", c("ano_censo_referencia").between(2007, 2100)),
    ]


def uf_constraint() -> list[Constraint]:
    return [Constraint("uf_valida", F.col("co_uf").between(11, 53))]


def violations(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Failing rows with the names of the rules they break; unknown (NULL) does not fail."""
    broken = F.array_compact(F.array(*[
        F.when(~F.coalesce(k.holds, F.lit(True)), F.lit(k.name)) for k in constraints
    ]))
    return df.withColumn("regras", F.array_join(broken, ",")).where(F.col("regras") != "")


def split_by(df: DataFrame, constraints: Sequence[Constraint]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rows that break a rule)."""
    ok = all_of(F.coalesce(k.holds, F.lit(True)) for k in constraints)
    return df.where(ok), df.where(~ok)


def rule_counts(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Failures per rule, in one pass over the table."""
    counts = df.agg(*[
        F.count_if(~F.coalesce(k.holds, F.lit(True))).alias(k.name) for k in constraints
    ])
    return counts.unpivot([], [k.name for k in constraints], "regra", "falhas")


def invalid_instants(texts: DataFrame, key: str, text: str, limit: int = 10) -> DataFrame:
    """First rows, by key, whose instant is not finite or outside years 1..9999, with the total."""
    bad = texts.where(~_valid_instant(text))
    total = bad.agg(F.count("*").alias("_n")).scalar()
    return bad.orderBy(key).limit(limit).withColumn("total", total)


def _valid_instant(text: str) -> Column:
    parsed = F.col(text).rlike(r"^\d{4}-") & F.col(text).try_cast(NTZ).isNotNull()
    low = F.col(text) >= "0001-01-01"
    return F.coalesce(parsed & low, F.lit(False))


def guard_instants(texts: DataFrame, key: str, text: str) -> None:
    """Stop a publication that holds instants no reader could represent."""
    examples = invalid_instants(texts, key, text).collect()  # at most ten rows
    if examples:
        shown = "; ".join(f"id={r[key]}, ocorrido_em={r[text]}" for r in examples)
        raise ValueError(f"{examples[0]['total']} inspections outside years 0001-9999 or not finite: {shown}")


def allowed_columns(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Project to the allow-list; anything personal never leaves the origin."""
    return df.select(*[c for c in allowed if c in df.columns])


def leaked_columns(df: DataFrame, allowed: Sequence[str]) -> list[str]:
    return sorted(set(df.columns) - set(allowed))


def comparable(df: DataFrame) -> DataFrame:
    """Replace maps, which cannot be grouped or compared, by their sorted entries."""
    maps = [f.name for f in df.schema.fields if f.dataType.typeName() == "map"]
    return df.withColumns({m: entries_text(m) for m in maps}) if maps else df


def table_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs, with the signed surplus of ``a``; one shuffle.

    Equal to (A except all B) union all (B except all A), without duplicating rows.
    """
    left = comparable(a).withColumn("_side", F.lit(1))
    right = comparable(b).select(*a.columns).withColumn("_side", F.lit(-1))
    return (
        left.unionByName(right).groupBy(*a.columns)
        .agg(F.sum("_side").alias("excedente")).where(F.col("excedente") != 0)
    )


def difference_count(a: DataFrame, b: DataFrame) -> DataFrame:
    return table_difference(a, b).agg(
        F.coalesce(F.sum(F.abs("excedente")), F.lit(0).cast("bigint")).alias("diferencas")
    )


def fingerprint(df: DataFrame, columns: Sequence[str] = EVENT_CONTENT, by: Sequence[str] = ()) -> DataFrame:
    """Order-free exact fingerprint: row count and sum of 64 md5 bits of each row."""
    total = F.sum(hash_number(row_text(columns)))
    return df.groupBy(*by).agg(
        F.count("*").alias("linhas"),
        F.coalesce(total, F.lit(0).cast("decimal(38,0)")).alias("impressao"),
    )


def xor_fingerprint(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Order-free fingerprint per group: xor of two 60-bit parts of each row's md5."""
    digest = F.md5(row_text(columns))
    parts = {n: F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint") for n, at in (("impressao_a", 1), ("impressao_b", 16))}
    return df.groupBy(*by).agg(F.count("*").alias("linhas"), *[F.bit_xor(v).alias(n) for n, v in parts.items()])


def rows_and_keys(df: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Rows and distinct composite keys; the key is a struct, so NULL parts still count."""
    return df.agg(F.count("*").alias("linhas"), F.countDistinct(F.struct(*keys)).alias("chaves"))


def not_insert_only(before: DataFrame, after: DataFrame, keys: Sequence[str], content: Sequence[str]) -> DataFrame:
    """Rows of an earlier snapshot that were changed or removed later."""
    rest = [c for c in content if c not in keys]
    now = after.select(*keys, F.struct(*rest).alias("_now"))
    joined = before.select(*keys, F.struct(*rest).alias("_then")).join(now, list(keys), "left")
    kind = F.when(F.col("_now").isNull(), "removida").when(differs("_then", "_now"), "alterada")
    return joined.withColumn("tipo", kind).where(F.col("tipo").isNotNull()).select(*keys, "tipo")


def closed_history_changes(before: DataFrame, after: DataFrame, year: int) -> DataFrame:
    """Differences in the yearly facts up to a closed year after newer data arrived."""
    return table_difference(before.where(F.col("ano") <= year), after.where(F.col("ano") <= year))


def base_problems(base: DataFrame, reference: str) -> DataFrame:
    """Base table facts the dashboard relies on: non-empty, one row per school, one reference date."""
    return base.agg(
        F.count("*").alias("linhas"),
        F.countDistinct("co_entidade").alias("escolas"),
        F.min(reference).alias("primeira_referencia"),
        F.max(reference).alias("ultima_referencia"),
    ).withColumn(
        "valida",
        (F.col("linhas") > 0) & (F.col("linhas") == F.col("escolas"))
        & F.col("primeira_referencia").eqNullSafe(F.col("ultima_referencia"))
        & F.col("primeira_referencia").isNotNull(),
    )


def run_checks(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Name and number of failing rows of each check."""
    rows = [df.agg(F.count("*").alias("falhas")).select(F.lit(n).alias("teste"), "falhas") for n, df in checks.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out
