"""Item history: changes, type-2 profiles, point-in-time lookup, latest state.

One partitioning by entity serves the chain from events to profiles; rows of hot chunks are dealt out for their changes and
for their profiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.contracts import ABSENT, PRESENT, UNDER_WORK, UNKNOWN, UNUSABLE
from ledgerlake.functions.columns import NTZ, differs, end_of_time, profile_key
from ledgerlake.operators import ordered
from ledgerlake.operators.ordered import HOT_ROWS, by_day

COUNTERS = {
    "n_existentes": PRESENT,
    "n_inexistentes": ABSENT,
    "n_em_obra": UNDER_WORK,
    "n_inutilizaveis": UNUSABLE,
}


def hot_entities(events: DataFrame, limit: int = HOT_ROWS) -> DataFrame | None:
    return ordered.hot_keys(events, ["co_entidade"], limit)


def known_states(events: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Events whose state is known, laid out once by entity for the chain below, or with the chunks of hot entities."""
    slim = events.where(F.col("situacao") != UNKNOWN).select(
        "co_entidade", "item_codigo", "situacao", "quantidade",
        F.col("ocorrido_em").alias("desde"), "vistoria_id",
    )
    chunked = ordered.with_chunks(slim, ["co_entidade"], hot, by_day(F.col("desde")))
    # A checkpoint keeps no layout.
    return ordered.settle(chunked, True) if hot is not None else chunked.repartition("co_entidade")


def state_runs(known: DataFrame, hot: bool = False) -> DataFrame:
    """Mark the rows that open a run of equal states of one (entity, item)."""
    keys, order = ["co_entidade", "item_codigo"], ["desde", "vistoria_id"]
    out = ordered.neighbour(known, keys, order, {"_before": "situacao"}, -1, hot)
    return out.withColumn("inicia_trecho", differs("situacao", "_before").cast("int")).drop("_before")


def numbered_runs(runs: DataFrame, hot: bool = False) -> DataFrame:
    """Run number inside (entity, item); the runs of a hot entity are numbered chunk by chunk."""
    keys, order = ["co_entidade", "item_codigo"], ["desde", "vistoria_id"]
    out = ordered.running_sum(runs, keys, order, {"trecho": "inicia_trecho"}, hot)
    return out.withColumn("trecho", F.col("trecho").cast("bigint"))


def quantity_in_force(runs: DataFrame, hot: bool = False) -> DataFrame:
    """Carry the last informed quantity forward inside a run, and never across runs.

    A row that opens a run, or that informs a quantity, sets the carried value; the opening row of
    a run may set it to "none".
    """
    sets_it = (F.col("inicia_trecho") == 1) | F.col("quantidade").isNotNull()
    marked = runs.withColumn("_set", F.when(sets_it, F.struct("quantidade")))
    out = ordered.carry_last(
        marked, ["co_entidade", "item_codigo"], ["desde", "vistoria_id"], {"_force": "_set"}, hot
    )
    return out.withColumn("quantidade_vigente", F.col("_force.quantidade")).drop("_set", "_force")


def changes_only(rows: DataFrame, hot: bool = False) -> DataFrame:
    """Keep the rows where the state or the quantity in force changes."""
    keys, order = ["co_entidade", "item_codigo"], ["desde", "vistoria_id"]
    out = ordered.neighbour(rows, keys, order, {"_before": "quantidade_vigente"}, -1, hot)
    changed = (F.col("inicia_trecho") == 1) | differs("quantidade_vigente", "_before")
    return out.where(changed).select(
        "co_entidade", "item_codigo", "situacao", F.col("quantidade_vigente").alias("quantidade"),
        "desde", "vistoria_id", *ordered.part([], hot),
    )


def validity(changes: DataFrame, hot: bool = False) -> DataFrame:
    """Half-open interval [desde, ate); two changes at one instant leave the lower id empty."""
    keys, order = ["co_entidade", "item_codigo"], ["desde", "vistoria_id"]
    out = ordered.neighbour(changes, keys, order, {"ate": "desde"}, 1, hot)
    return out.withColumn("ate", F.coalesce("ate", end_of_time()))


def item_change(events: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Compressed state history of each (entity, item) with validity intervals."""
    known = known_states(events, hot)
    if hot is None:
        return validity(changes_only(quantity_in_force(state_runs(known))))
    keys = ["co_entidade", "item_codigo"]
    chunked, others = ordered.apart(known, keys)
    changes = validity(changes_by_chunk(chunked), True)
    alone = [*keys, ordered.CHUNK]
    rest = ordered.neighbour(_changes(_marked(others), None), alone, ["desde", "vistoria_id"], {"ate": "desde"}, 1, False)
    rest = rest.withColumn("ate", F.coalesce("ate", end_of_time()))
    return ordered.settle(changes.unionByName(rest), True)


def _marked(known: DataFrame) -> DataFrame:
    """What a chunk of one (entity, item) tells by itself: its opening row, and where later rows set a quantity."""
    scan = W.partitionBy("co_entidade", "item_codigo", ordered.CHUNK).orderBy("desde", "vistoria_id")
    before = scan.rowsBetween(W.unboundedPreceding, -1)
    rows = known.withColumns({
        "_before": F.lag(F.struct("situacao"), 1).over(scan),
        "_opening": F.first(F.struct("situacao", "quantidade")).over(scan.rowsBetween(W.unboundedPreceding, W.currentRow)),
        "_closes": F.lead(F.lit(True), 1).over(scan).isNull(),
    })
    sets_it = differs("situacao", "_before.situacao") | F.col("quantidade").isNotNull()
    marked = rows.withColumn("_set", F.when(F.col("_before").isNotNull() & sets_it, F.struct("quantidade")))
    return marked.withColumn("_held", F.last("_set", ignorenulls=True).over(before))


def _opening_set(state: Column) -> Column:
    """Quantity that the opening row of a chunk sets, after the state carried into the chunk."""
    opening = F.col("_opening")
    opens = state.isNull() | differs(opening["situacao"], state["situacao"])
    return F.when(opens | opening["quantidade"].isNotNull(), F.struct(opening["quantidade"].alias("quantidade")))


def _borders(marked: DataFrame) -> DataFrame:
    """State and quantity in force that are carried into each chunk of an (entity, item)."""
    along = W.partitionBy("co_entidade", "item_codigo").orderBy(ordered.CHUNK)
    closing = marked.where("_closes").select(
        "co_entidade", "item_codigo", ordered.CHUNK, "_opening", "situacao", F.coalesce("_set", "_held").alias("_later")
    )
    carried = closing.withColumn("_state", F.lag(F.struct("situacao"), 1).over(along))
    left = carried.withColumn("_left", F.coalesce(F.col("_later"), _opening_set(F.col("_state"))))
    force = F.last("_left", ignorenulls=True).over(along.rowsBetween(W.unboundedPreceding, -1))
    return left.select("co_entidade", "item_codigo", ordered.CHUNK, "_state", force.alias("_force"))


def _changes(marked: DataFrame, borders: DataFrame | None) -> DataFrame:
    """Rows of chunks where the state or the quantity in force changes, as ``changes_only`` finds them."""
    keys = ["co_entidade", "item_codigo", ordered.CHUNK]
    if borders is None:
        never = F.lit(False)
        rows = marked.withColumns({"_state": F.when(never, F.struct("situacao")), "_force": F.when(never, F.struct("quantidade"))})
    else:
        rows = marked.join(borders, keys, "left")
    first = F.col("_before").isNull()
    opens = differs("situacao", F.coalesce("_before", "_state")["situacao"])
    before = F.when(first, F.col("_force")).otherwise(F.coalesce(F.col("_held"), _opening_set(F.col("_state")), F.col("_force")))
    rows = rows.withColumns({"_opens": opens, "_earlier": before["quantidade"]})
    force = F.when(F.col("_opens") | F.col("quantidade").isNotNull(), F.col("quantidade")).otherwise(F.col("_earlier"))
    return rows.where(F.col("_opens") | differs(force, "_earlier")).select(
        "co_entidade", "item_codigo", "situacao", force.alias("quantidade"), "desde", "vistoria_id", ordered.CHUNK)


def changes_by_chunk(known: DataFrame) -> DataFrame:
    """Runs, quantities in force and changes of hot entities in one scan.

    The state and the quantity carried into a chunk are found together from one row a chunk, where a scan for
    each step would deal out and write the rows of all of them each time.
    """
    marked = _marked(known)
    return _changes(marked, _borders(marked))


def profile_starts(changes: DataFrame) -> DataFrame:
    """Instants at which anything of an entity changes, with the highest inspection id."""
    return changes.groupBy("co_entidade", F.col("desde").alias("valid_from")).agg(
        F.max("vistoria_id").alias("vistoria_origem_id")
    )


def profile_states(changes: DataFrame, catalog: Sequence[str], hot: bool = False) -> DataFrame:
    """State of every item at every profile start, without joining starts to intervals.

    Each change sets one item; carrying every item's last value forward in time order makes each
    row hold the whole profile after that change, and the last row of an instant is the profile
    that starts there. One sort of the changes; work grows with changes x catalog size, never with
    starts x changes.
    """
    if hot:
        chunked, others = ordered.apart(changes.drop("ate"), ["co_entidade"])
        alone = _profile_states(others, ["co_entidade", ordered.CHUNK], catalog, False)
        return _profile_states(chunked, ["co_entidade"], catalog, True).unionByName(alone)
    return _profile_states(changes, ["co_entidade"], catalog, False)


def _profile_states(changes: DataFrame, keys: Sequence[str], catalog: Sequence[str], hot: bool) -> DataFrame:
    order = ["desde", "vistoria_id", "item_codigo"]
    spread = changes.select(
        *ordered.part(keys, hot), *order,
        *[
            F.when(F.col("item_codigo") == code, F.struct("situacao", "quantidade")).alias(f"_{i}")
            for i, code in enumerate(catalog)
        ],
    )
    values = {f"_v{i}": f"_{i}" for i in range(len(catalog))}
    seen = ordered.carry_last(spread, keys, order, values, hot, {"_next": "desde"})
    closes_instant = F.col("_next").isNull() | (F.col("_next") > F.col("desde"))
    return seen.where(closes_instant).select(
        "co_entidade", F.col("desde").alias("valid_from"), F.col("vistoria_id").alias("vistoria_origem_id"),
        "_next", *values,
    )


def _profile_map(catalog: Sequence[str], part: str) -> Column:
    entries = F.array(*[
        F.struct(F.lit(code).alias("key"), F.col(f"_v{i}.{part}").alias("value"))
        for i, code in enumerate(catalog)
    ])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def dim_profile(changes: DataFrame, catalog: Sequence[str], hot: bool = False) -> DataFrame:
    """Type-2 profile dimension: one version per instant at which the entity's profile changes."""
    codes = sorted(catalog)
    def count_of(state: str) -> Column:
        # One SQL text per counter: compiled, and far fewer calls than one column object per item.
        return F.expr("cast(" + " + ".join(
            f"if(_v{i}.situacao <=> '{state}', 1, 0)" for i in range(len(codes))) + " as bigint)")

    counted = profile_states(changes, codes, hot).select(
        "co_entidade", "valid_from", "vistoria_origem_id", "_next",
        *[count_of(state).alias(name) for name, state in COUNTERS.items()],
        _profile_map(codes, "situacao").alias("itens"), _profile_map(codes, "quantidade").alias("quantidades"),
    ).withColumn("n_itens_conhecidos", F.size("itens").cast("bigint"))
    return counted.select(
        profile_key("co_entidade", "valid_from").alias("escola_infra_sk"),
        "co_entidade",
        "valid_from",
        F.coalesce("_next", end_of_time()).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
        "vistoria_origem_id",
        "n_itens_conhecidos",
        *COUNTERS,
        "itens",
        "quantidades",
    )


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    take: Sequence[str],
    hot: DataFrame | None = None,
    chunk=by_day,
) -> DataFrame:
    """Left point-in-time join: the version with ``valid_from <= at < valid_to``.

    Versions and facts of a key are read in time order and the last version seen is carried to the
    facts: one sort of facts + versions, where a range join would try every pair of a key.
    Versions of one key must not overlap (see ``quality.overlaps``).
    """
    version_rows = versions.select(
        key, F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"),
        F.struct("valid_to", *take).alias("_version"),
    )
    # Fact columns stay top-level, so those nobody asks for are pruned from the scan.
    fact_rows = facts.withColumns({"_at": F.col(at), "_kind": F.lit(1)})
    lined_up = fact_rows.unionByName(version_rows, allowMissingColumns=True)
    chunked = ordered.with_chunks(lined_up, [key], hot, chunk(F.col("_at")))
    carried = ordered.carry_last(chunked, [key], ["_at", "_kind"], {"_seen": "_version"}, hot is not None)
    valid = F.col("_at") < F.col("_seen.valid_to")
    return carried.where(F.col("_kind") == 1).select(
        *facts.columns, *[F.when(valid, F.col(f"_seen.{c}")).alias(c) for c in take]
    )


def profile_at(versions: DataFrame, instant: str) -> DataFrame:
    """Profiles in force at one instant."""
    t = F.lit(instant).cast(NTZ)
    return versions.where((F.col("valid_from") <= t) & (t < F.col("valid_to")))


def latest_state(events: DataFrame) -> DataFrame:
    """Current known state per (entity, item); ties go to the higher inspection id.

    An aggregate, not a window: a hot entity is reduced map-side.
    """
    at = F.struct("ocorrido_em", "vistoria_id")
    newest = (
        events.where(F.col("situacao") != UNKNOWN)
        .groupBy("co_entidade", "item_codigo")
        .agg(F.max_by(F.struct("situacao", "quantidade", "ocorrido_em", "vistoria_id"), at).alias("_e"))
    )
    return newest.select(
        "co_entidade", "item_codigo", "_e.situacao", "_e.quantidade",
        F.col("_e.ocorrido_em").alias("vigente_desde"), "_e.vistoria_id",
    )


def latest_in_year(fact_item: DataFrame, item: str, year: int) -> DataFrame:
    """Last known state of one item per entity inside one calendar year."""
    rows = fact_item.where(
        (F.col("item_codigo") == item)
        & (F.col("situacao") != UNKNOWN)
        & (F.col("ocorrido_em") >= F.lit(f"{year:04d}-01-01").cast(NTZ))
        & (F.col("ocorrido_em") < F.lit(f"{year + 1:04d}-01-01").cast(NTZ))
    )
    return rows.groupBy("co_entidade").agg(
        F.max_by("situacao", F.struct("ocorrido_em", "vistoria_id")).alias("situacao")
    )


def latest_registration(schools: DataFrame) -> DataFrame:
    """Newest yearly registration per school; ties by name, lowest first."""
    others = [c for c in schools.columns if c not in ("co_entidade", "ano_censo_referencia", "no_entidade")]
    newest = F.min(F.struct(-F.col("ano_censo_referencia").cast("int"), F.col("no_entidade"), *others)).alias("_s")
    return schools.groupBy("co_entidade").agg(newest).select(
        "co_entidade", "_s.no_entidade", *[f"_s.{c}" for c in others],
        (-F.col("_s.col1")).alias("ano_censo_referencia"),
    )


def registration_conflicts(schools: DataFrame) -> DataFrame:
    """(school, year) pairs registered with different contents."""
    return (
        schools.distinct().groupBy("co_entidade", "ano_censo_referencia")
        .agg(F.count("*").alias("n")).where(F.col("n") > 1)
    )


def apply_revisit(state: DataFrame, revisit: DataFrame) -> DataFrame:
    """Keyed update of a current-state table: the newer row of each (entity, item) wins."""
    both = state.unionByName(revisit)
    others = [c for c in both.columns if c not in ("co_entidade", "item_codigo")]
    newest = F.max_by(F.struct(*others), F.struct("atualizado_em", "vistoria_id")).alias("_s")
    return both.groupBy("co_entidade", "item_codigo").agg(newest).select(
        "co_entidade", "item_codigo", *[f"_s.{c}" for c in others]
    )
