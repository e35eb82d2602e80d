"""Ordered scans that survive a hot key.

A window partitioned by an entity puts that entity's whole history into one task. Here an entity
above ``HOT_ROWS`` rows is cut into consecutive *chunks* (calendar days by default); each chunk is
scanned by its own task and the little state that crosses a chunk border travels in one summary row
per chunk. Entities below the limit keep a NULL chunk: for them the plan is the plain window.

Which keys are hot is found by one aggregation before the plan is built (``hot_keys``). The list
holds at most rows / limit keys, which is what bounds its broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.functions.columns import all_of
from ledgerlake.session import work_dir

HOT_ROWS = 1_000_000
CHUNK = "_chunk"


def by_day(ts: Column) -> Column:
    return ts.cast("date")


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``limit`` rows, or None when there are none (the usual case)."""
    hot = df.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > limit).select(*keys)
    # Fixed once, so that every step of a plan splits the same keys and the rows are counted once.
    fixed = settle(hot, True)
    return None if fixed.isEmpty() else fixed


def with_chunks(df: DataFrame, keys: Sequence[str], hot: DataFrame | None, chunk: Column) -> DataFrame:
    """Add the chunk column: ``chunk`` for hot keys, NULL for all others."""
    if hot is None:
        return df
    # The hot list has at most rows / limit keys, so its broadcast is bounded.
    marked = df.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), list(keys), "left")
    return marked.withColumn(CHUNK, F.when(F.col("_hot"), chunk)).drop("_hot")


def part(keys: Sequence[str], hot: bool) -> list[str]:
    """Columns a scan of ``keys`` is partitioned by."""
    return [*keys, CHUNK] if hot else list(keys)


def _order(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def settle(df: DataFrame, hot: bool) -> DataFrame:
    """Cut the lineage of a chunked scan with a reliable checkpoint.

    Every chunked step reads its input twice (rows and chunk summaries); without a cut the reads
    would double at each step. The plain path has no second read and is left alone.
    """
    if not hot:
        return df
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_dir(spark))
    return df.checkpoint()


def apart(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of hot chunks, dealt by key and chunk, and the others, whose chunk hands on no state.

    A chunked step reads its rows twice. With no NULL in keys and chunk, the optimizer adds no filter of its own to
    either read, so both use one exchange, and the join with the borders needs no other.
    """
    inside = all_of(F.col(c).isNotNull() for c in part(keys, True))
    return df.where(inside).repartition(*part(keys, True)), df.where(~inside)


def _attach(df: DataFrame, keys: Sequence[str], edges: DataFrame) -> DataFrame:
    """Give every row of a hot chunk the state carried into that chunk."""
    return df.join(edges, [*keys, CHUNK], "left")


def carry_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str], hot: bool,
    following: dict[str, str] | None = None,
) -> DataFrame:
    """Last known value so far: ``{output: input}``; NULL inputs never overwrite.

    ``following`` are values of the next row, taken in the same scan; their inputs must not be NULL in hot chunks.
    """
    following = following or {}
    ordering = W.partitionBy(*part(keys, hot)).orderBy(*order)
    scan = ordering.rowsBetween(W.unboundedPreceding, W.currentRow)
    out = df.withColumns({
        **{o: F.last(i, ignorenulls=True).over(scan) for o, i in values.items()},
        **{o: F.lead(i, 1).over(ordering) for o, i in following.items()},
    })
    if not hot:
        return out
    at = _order(order)
    summary = (
        df.where(F.col(CHUNK).isNotNull())
        .groupBy(*keys, CHUNK)
        .agg(*[F.max_by(i, F.when(F.col(i).isNotNull(), at)).alias(f"_in_{o}") for o, i in values.items()],
             *[F.min_by(i, at).alias(f"_in_{o}") for o, i in following.items()])
    )
    along = W.partitionBy(*keys).orderBy(CHUNK)
    before = along.rowsBetween(W.unboundedPreceding, -1)
    edges = summary.withColumns({
        **{f"_in_{o}": F.last(f"_in_{o}", ignorenulls=True).over(before) for o in values},
        **{f"_in_{o}": F.lead(f"_in_{o}", 1).over(along) for o in following},
    })
    out = _attach(out, keys, edges).withColumns(
        {o: F.coalesce(F.col(o), F.col(f"_in_{o}")) for o in [*values, *following]}
    )
    return out.drop(*[f"_in_{o}" for o in [*values, *following]])


def neighbour(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str], step: int, hot: bool
) -> DataFrame:
    """Value on the previous (``step=-1``) or next (``step=1``) row of the key."""
    shift, pick = (F.lag, F.max_by) if step < 0 else (F.lead, F.min_by)
    payload = F.struct(*[F.col(i).alias(o) for o, i in values.items()])
    scan = W.partitionBy(*part(keys, hot)).orderBy(*order)
    out = df.withColumn("_near", shift(payload, 1).over(scan))
    if hot:
        summary = (
            df.where(F.col(CHUNK).isNotNull())
            .groupBy(*keys, CHUNK)
            .agg(pick(payload, _order(order)).alias("_edge"))
        )
        edges = summary.withColumn("_edge", shift("_edge", 1).over(W.partitionBy(*keys).orderBy(CHUNK)))
        out = _attach(out, keys, edges).withColumn("_near", F.coalesce("_near", "_edge")).drop("_edge")
    return out.withColumns({o: F.col(f"_near.{o}") for o in values}).drop("_near")


def running_max(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str], hot: bool
) -> DataFrame:
    """Maximum over all *earlier* rows of the key; NULL where there is none."""
    scan = W.partitionBy(*part(keys, hot)).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = df.withColumns({o: F.max(i).over(scan) for o, i in values.items()})
    if not hot:
        return out
    summary = (
        df.where(F.col(CHUNK).isNotNull())
        .groupBy(*keys, CHUNK)
        .agg(*[F.max(i).alias(f"_in_{o}") for o, i in values.items()])
    )
    before = W.partitionBy(*keys).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    edges = summary.withColumns({f"_in_{o}": F.max(f"_in_{o}").over(before) for o in values})
    # greatest() skips NULL, so either side may be missing.
    out = _attach(out, keys, edges).withColumns(
        {o: F.greatest(F.col(o), F.col(f"_in_{o}")) for o in values}
    )
    return out.drop(*[f"_in_{o}" for o in values])


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str], hot: bool
) -> DataFrame:
    """Sum over all rows of the key up to and with this one: ``{output: input}``."""
    scan = W.partitionBy(*part(keys, hot)).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = df.withColumns({o: F.sum(i).over(scan) for o, i in values.items()})
    if not hot:
        return out
    summary = (
        df.where(F.col(CHUNK).isNotNull())
        .groupBy(*keys, CHUNK)
        .agg(*[F.sum(i).alias(f"_in_{o}") for o, i in values.items()])
    )
    before = W.partitionBy(*keys).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    edges = summary.withColumns({f"_in_{o}": F.sum(f"_in_{o}").over(before) for o in values})
    out = _attach(out, keys, edges).withColumns(
        {o: F.coalesce(F.col(o) + F.col(f"_in_{o}"), F.col(o), F.col(f"_in_{o}")) for o in values}
    )
    return out.drop(*[f"_in_{o}" for o in values])


#: Consecutive positions that are counted together when a hot key is cut by rows.
UNIT = 10_000


def with_counted_chunks(
    df: DataFrame, keys: Sequence[str], hot: DataFrame | None, unit: dict[str, Column], limit: int = HOT_ROWS
) -> DataFrame:
    """Add the chunk column of hot keys: about ``limit`` consecutive rows each, however they lie in time.

    ``unit`` names expressions that rise with the order and hold few rows for each value; these units are
    counted, and a chunk is the units whose first row has the same ``limit`` before it. So no chunk has more than
    ``limit`` rows and one unit.
    """
    if hot is None:
        return df
    marked = df.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), list(keys), "left").withColumns(unit)
    counted = marked.where("_hot").groupBy(*keys, *unit).agg(F.count("*").alias("_rows"))
    before = W.partitionBy(*keys).orderBy(*unit).rowsBetween(W.unboundedPreceding, -1)
    cut = counted.withColumn(CHUNK, F.floor(F.coalesce(F.sum("_rows").over(before), F.lit(0)) / limit).cast("long")).drop("_rows")
    # Chunks are needed twice by every scan, so they are fixed once.
    return settle(null_safe_join(marked, cut, [*keys, *unit], "left").drop("_hot", *unit), True)


#: Buckets whose sizes one window adds up.
BLOCK = 1 << 20


def value_ranks(df: DataFrame, groups: Sequence[str], value: str, bucket: Callable[[Column], Column]) -> DataFrame:
    """Distinct values of each group with ``n`` rows, ``before`` smaller rows and group ``total``.

    Equal values are counted before anything is sorted, and values are sorted inside buckets, so
    neither a hot group nor a hot value lands in one task. ``bucket`` must be monotone in the value.
    From this one table follow rank, percent rank, row number (unique values) and exact quantiles.
    """
    counted = df.groupBy(*groups, value).agg(F.count("*").alias("n")).withColumn("_bucket", bucket(F.col(value)))
    inside = W.partitionBy(*groups, "_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    local = counted.withColumn("_local", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    # The input is read once: bucket sizes come from the counted values.
    sizes = counted.groupBy(*groups, "_bucket").agg(F.sum("n").alias("_size")).withColumn("_block", F.floor(F.col("_bucket") / BLOCK))
    # Prefix sums in two levels: over the buckets of a block, and over the blocks, so that neither window holds all
    # the buckets of a group.
    inner = W.partitionBy(*groups, "_block").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    blocks = sizes.groupBy(*groups, "_block").agg(F.sum("_size").alias("_held"))
    outer = W.partitionBy(*(groups or [F.lit(0)]))
    edges = blocks.select(
        *groups, "_block",
        F.coalesce(F.sum("_held").over(outer.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"),
        F.sum("_held").over(outer).alias("total"),
    )
    offsets = null_safe_join(sizes.withColumn("_inside", F.coalesce(F.sum("_size").over(inner), F.lit(0))), edges, [*groups, "_block"]).select(
        *groups, "_bucket", (F.col("_inside") + F.col("_ahead")).alias("_offset"), "total"
    )
    return null_safe_join(local, offsets, [*groups, "_bucket"]).select(
        *groups, value, "n", (F.col("_local") + F.col("_offset")).alias("before"), "total"
    )


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join in which NULL is a key value like any other, as it is for GROUP BY and PARTITION BY."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    condition = same[0]
    for part_of in same[1:]:
        condition = condition & part_of
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, probs: dict[str, float], bucket: Callable[[Column], Column]
) -> DataFrame:
    """Exact interpolated quantiles per group, one output column per probability."""
    ranks = value_ranks(df.where(F.col(value).isNotNull()), groups, value, bucket)
    aggs = []
    for name, p in probs.items():
        place = F.lit(p) * (F.col("total") - 1)
        for suffix, index in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            hit = (F.col("before") <= index) & (index < F.col("before") + F.col("n"))
            aggs.append(F.max(F.when(hit, F.col(value))).alias(f"_{name}_{suffix}"))
        aggs.append(F.max(place - F.floor(place)).alias(f"_{name}_w"))
    picked = ranks.groupBy(*groups).agg(*aggs)
    return picked.select(
        *groups,
        *[
            (F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_w")).alias(n)
            for n in probs
        ],
    )


def nearest_rank(
    df: DataFrame, groups: Sequence[str], value: str, p: float, name: str, bucket: Callable[[Column], Column]
) -> DataFrame:
    """The ``int(n * p)``-th smallest value of each group (1-based, at least the first)."""
    ranks = value_ranks(df.where(F.col(value).isNotNull()), groups, value, bucket)
    index = F.greatest(F.floor(F.col("total") * F.lit(p)) - 1, F.lit(0))
    hit = (F.col("before") <= index) & (index < F.col("before") + F.col("n"))
    return ranks.groupBy(*groups).agg(F.max(F.when(hit, F.col(value))).alias(name))


def global_index(df: DataFrame, order: str, bucket: Callable[[Column], Column], name: str) -> DataFrame:
    """Zero-based position of each row in the order of a unique column."""
    ranks = value_ranks(df, [], order, bucket).select(order, F.col("before").alias(name))
    return df.join(ranks, order)


def id_ranges(df: DataFrame, groups: Sequence[str], id_col: str, width: int = 1_000_000) -> DataFrame:
    """Compress distinct ids into closed ranges ``lo..hi`` of consecutive ids.

    Islands are found inside id buckets (at most ``width`` ids each); only islands that touch a
    bucket border can join across it, and those are merged on the small island table.
    """
    ids = df.select(*groups, id_col).distinct().withColumn("_b", F.floor(F.col(id_col) / width))
    inside = W.partitionBy(*groups, "_b").orderBy(id_col)
    islands = (
        ids.withColumn("_g", F.col(id_col) - F.row_number().over(inside))
        .groupBy(*groups, "_b", "_g")
        .agg(F.min(id_col).alias("lo"), F.max(id_col).alias("hi"))
        .drop("_g")
    )
    border = (F.pmod(F.col("lo"), F.lit(width)) == 0) | (F.pmod(F.col("hi") + 1, F.lit(width)) == 0)
    closed = islands.where(~border).select(*groups, "lo", "hi")
    # At most two border islands per bucket: ids / width * 2 rows.
    chain = W.partitionBy(*groups).orderBy("lo")
    merged = (
        islands.where(border)
        .withColumn("_new", F.when(F.col("lo") == F.lag("hi").over(chain) + 1, 0).otherwise(1))
        .withColumn("_run", F.sum("_new").over(chain.rowsBetween(W.unboundedPreceding, W.currentRow)))
        .groupBy(*groups, "_run")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .select(*groups, "lo", "hi")
    )
    return closed.unionByName(merged)


def expand_ranges(df: DataFrame, groups: Sequence[str], id_col: str, piece: int = 100_000) -> DataFrame:
    """Inverse of :func:`id_ranges`; a wide range is cut into pieces before it is expanded."""
    starts = df.select(*groups, "lo", "hi", F.explode(F.sequence("lo", "hi", F.lit(piece))).alias("_from"))
    last = F.least(F.col("_from") + (piece - 1), F.col("hi"))
    return starts.select(*groups, F.explode(F.sequence("_from", last)).alias(id_col))


#: Blocks of ids by the power of two of their size.
LEVELS = 63


def range_blocks(ranges: DataFrame) -> DataFrame:
    """``level, block`` of the blocks of 2**level aligned ids that closed ranges ``lo..hi`` consist of.

    A range is cut into at most two blocks a level, so it takes at most 126 rows however many ids it holds.
    """
    level = F.col("level")

    def shifted(c: Column) -> Column:
        return F.call_function("shiftright", c, level.cast("int"))

    # Blocks that start at or after lo, and blocks that end at or before hi.
    cut = (
        ranges.where(F.col("lo") <= F.col("hi"))
        .select("lo", (F.col("hi") + 1).alias("end"), F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level"))
        .select("level", (-shifted(-F.col("lo"))).alias("first"), shifted(F.col("end")).alias("stop"))
        .where(F.col("first") < F.col("stop"))
    )
    left = F.when(F.col("first") % 2 != 0, F.col("first"))
    right = F.when(F.col("stop") % 2 != 0, F.col("stop") - 1)
    both = F.filter(F.array(left, right), lambda x: x.isNotNull())
    return cut.select("level", F.explode(both).alias("block")).distinct()


def ids_in_ranges(ids: DataFrame, id_col: str, ranges: DataFrame) -> DataFrame:
    """Distinct ids (the column ``id_col``) that lie in one of the closed ranges ``lo..hi``.

    An interval index: ranges become blocks of 2**level ids, an id looks up the one block that could hold it at each
    level in use (63 at most), an equal join. No range is expanded into its ids.
    """
    blocks = range_blocks(ranges)
    levels = sorted(r["level"] for r in blocks.select("level").distinct().collect())
    asked = ids.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    if not levels:
        return asked.where(F.lit(False))
    looked = asked.select(id_col, F.explode(F.array(*[F.lit(x) for x in levels])).alias("level"))
    looked = looked.withColumn("block", F.call_function("shiftright", F.col(id_col), F.col("level")))
    # Blocks are disjoint wherever ranges are; ranges that overlap may hold an id twice.
    return looked.join(blocks, ["level", "block"], "left_semi").select(id_col).distinct()
