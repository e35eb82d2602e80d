"""Near-duplicate groups: banded MinHash, odd sketches for the candidates, full sets for the links.

Documents with the same shingle set form a class, represented by its smallest id. A class has ``bands`` times
``rows`` MinHash samples; classes that agree in a whole band share a bucket. The number of bands makes a
linked pair miss all of them with a chance of at most ``MISS``. ``FOLDED`` samples of a class that shares a bucket
are folded into a parity bitmap (an odd sketch): the set bits of two bitmaps' XOR estimate how many samples differ,
finest where the sets are alike. Only pairs whose sizes and bitmaps allow a link are compared in full, and linked are
only those whose full sets meet the threshold.

Components, without putting out the pairs of a bucket:
1. Each bucket is compared with one leader, the member that meets most others over all its buckets (of
   copies of one text, that text). A member goes with the smallest leader it is linked to.
2. In a bucket that still holds several such groups, their members are compared by sizes and bitmaps, and put out
   is a forest: at most one pair for each member, enough to see which groups may be linked at all, directly or
   over others. What hangs together so is a crowd; no pair that could be linked lies across two crowds.
3. Each member of a crowd is sent there once with its full set; members of different groups are compared and a
   forest of the links is put out.
4. All links are joined into components.
Steps 2 and 3 work in cells, pairs of blocks of at most about ``CELL`` members. A group of more members has blocks of
its own, which are not compared with each other. So no pair that could join two components is left out, at any size.

Words are runs without the bytes 09-0D and 20, with A-Z folded; a shingle is ``k`` of them. Null, empty and
wordless texts have no shingles and are linked with nothing; a text of fewer than ``k`` words is one
shingle. Rows that share an id are one document, linked if any of their texts is. A row without an id is
linked with nothing and has no component. Other columns are not looked at; an empty table gives an
empty result.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import grams, mix, passes, prepare, sieve, sieve_slot, stored, whole, words

SHINGLE = 5
ROWS = 6
#: Chance that a pair right at the threshold shares no bucket.
MISS = 1e-6
#: MinHash samples that are folded into an odd sketch, its bits, and how many standard deviations of the
#: estimate a pair right at the threshold may lie below it.
FOLDED = 512
BITS = 4096
DEVIATIONS = 5.0
#: Members of a block; a task compares two blocks at once.
CELL = 512
#: Rows of one class that are joined by one task; classes of more are sent to every task (at most 100 000 of them).
CLASS_ROWS = 2048


def bands_for(threshold: float, rows: int = ROWS) -> int:
    return math.ceil(math.log(MISS) / math.log1p(-(threshold**rows)))


def shingle_sets(text: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    out: list[np.ndarray] = []
    for w in words(text, lower=True):
        at, value = grams(w.hash, w.row, k)
        row = w.row[at]
        begin = np.searchsorted(row, np.arange(w.rows + 1))
        for i in range(w.rows):
            n = int(w.begin[i + 1] - w.begin[i])
            if n >= k:
                out.append(np.unique(value[begin[i] : begin[i + 1]]))
            else:
                out.append(np.array([whole(w.hash[w.of_row(i)])]) if n else np.zeros(0, np.uint64))
    return out


def samples(shingles: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash values (32 bits) of a set of shingle hashes."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    turn, scale = _turns(n)
    best = np.full(n, 0xFFFFFFFF, np.uint32)
    room = np.empty((min(len(short), 256), n), np.uint32)
    for low in range(0, len(short), 256):
        some = short[low : low + 256, None]
        block = room[: len(some)]
        np.bitwise_xor(some, turn, out=block)
        np.multiply(block, scale, out=block)
        np.minimum(best, block.min(axis=0), out=best)
    return best


@functools.cache
def _turns(n: int) -> tuple[np.ndarray, np.ndarray]:
    """One xor mask and one odd factor for each sample."""
    wide = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (wide >> np.uint64(32)).astype(np.uint32), wide.astype(np.uint32) | np.uint32(1)


def odd_sketch(values: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples: each (position, value) turns one bit over."""
    place = mix(values.astype(np.uint64) | (np.arange(1, len(values) + 1, dtype=np.uint64) << np.uint64(32))) % np.uint64(BITS)
    parity = np.bincount(place.astype(np.int64), minlength=BITS) & 1
    return np.packbits(parity.astype(np.uint8))


def differing_at_most(threshold: float) -> float:
    """Bits that the sketches of a pair at the threshold differ in, with room for the estimate's error."""
    least = threshold - DEVIATIONS * math.sqrt(threshold * (1 - threshold) / FOLDED) - 0.005
    return BITS / 2 * (1 - math.exp(-4 * FOLDED * (1 - max(0.0, least)) / BITS))


def _signatures(docs: DataFrame, key: str, text: str, k: int, bands: int, rows: int) -> DataFrame:
    """Size, 128-bit hash and bands of every text's set; a task puts out the bands of a set once."""
    shape = "doc_id long, n_shingles long, set1 long, set2 long, bands array<long>"

    def run(batches):
        known = set()
        for b in batches:
            sizes, ones, twos, keys = [], [], [], []
            for s in shingle_sets(b.column(1), k):
                sizes.append(len(s))
                if not len(s):
                    ones.append(None), twos.append(None), keys.append(None)
                    continue
                one = int(mix(s).sum().astype(np.int64))
                two = int(np.bitwise_xor.reduce(mix(s ^ np.uint64(0x452821E638D01377))).astype(np.int64))
                ones.append(one), twos.append(two)
                if (one, two) in known:
                    keys.append(None)
                    continue
                known.add((one, two))
                band = np.arange(1, bands + 1, dtype=np.uint64)
                for column in samples(s, bands * rows).reshape(bands, rows).T:
                    band = mix(band * np.uint64(0x9FB21C651E98DF25) + column)
                keys.append(band.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(ones, pa.int64()), pa.array(twos, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set1", "set2", "bands"],
            )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, shape)


def _features(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """``node, size_of, odd, shingles`` of the texts of the given nodes; a sieve keeps other rows out of the shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(sieve(nodes.select(F.xxhash64("node").alias("hashed")), "hashed"))

    def run(batches):
        for b in batches:
            b = b.filter(pa.array(passes(shared.value, np.asarray(b.column(2)))))
            sets = shingle_sets(b.column(1), k)
            odds = [odd_sketch(samples(x, FOLDED)).tobytes() if len(x) else b"" for x in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(odds, pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())],
                names=["node", "size_of", "odd", "shingles"],
            )

    slotted = docs.filter("node IS NOT NULL").select("node", "text", sieve_slot(F.xxhash64("node")).alias("slot"))
    made = slotted.mapInArrow(run, "node long, size_of long, odd binary, shingles binary").filter("size_of > 0")
    kept = made.join(nodes, "node", "left_semi").groupBy("node", F.xxhash64("shingles").alias("h"))
    return kept.agg(*(F.first(c).alias(c) for c in ("size_of", "odd", "shingles"))).drop("h")


def _hashes(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def _bitmaps(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BITS // 64)


def _possible(pairs: DataFrame, most: float) -> DataFrame:
    """Of ``a, b, odd_a, odd_b`` the pairs whose sketches allow a link."""

    def run(batches):
        for b in batches:
            differing = np.bitwise_count(_bitmaps(b.column("odd_a")) ^ _bitmaps(b.column("odd_b"))).sum(axis=1)
            yield b.select(["a", "b"]).filter(pa.array(differing <= most))

    return pairs.select("a", "b", "odd_a", "odd_b").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, features: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets meet the threshold."""

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(_hashes(b.column(2)), _hashes(b.column(3)), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = features.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    two = features.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of all nodes of ``links`` (columns a, b).

    Alternates two steps until nothing changes: all larger neighbours of a node are linked to its
    smallest neighbour; a node and its smaller neighbours are linked to the smallest of them. Each round
    is an aggregation and a join, and its links are written to the shared folder.
    """
    state = None
    now = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = stored(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "links")
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = large.join(lower, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = stored(ends.select("e.*").filter("a <> b").distinct(), "links")
        n, h = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (n, h) == state:
            break
        state = (n, h)
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _cells(members: DataFrame, by: str, cell: int) -> DataFrame:
    """The rows of ``members`` (``by, node, component, ...``) dealt to cells: ``own`` block, ``low`` and ``high`` block.

    Members of small components share blocks; a component of ``cell`` members or more has blocks of its own. A
    member goes to a cell with each block but those of its own large component.
    """
    parts = F.ceil(F.col("n") / cell).cast("long")
    sizes = members.groupBy(by, "component").agg(F.count("*").alias("n"))
    large = F.when(F.col("n") >= cell, F.struct("component", parts.alias("parts")))
    all_of = sizes.groupBy(by).agg(F.sum(F.when(F.col("n") < cell, F.col("n")).otherwise(0)).alias("few"), F.collect_list(large).alias("large"))
    few_parts = F.ceil(F.col("few") / cell).cast("long")
    numbered = lambda owner, n: F.transform(F.filter(F.sequence(F.lit(0).cast("long"), n), lambda i: i < n), lambda i: F.struct(owner.alias("owner"), i.alias("part")))
    nobody = F.lit(None).cast("long")
    blocks = all_of.select(
        by, few_parts.alias("few_parts"),
        F.concat(numbered(nobody, few_parts), F.flatten(F.transform("large", lambda x: numbered(x["component"], x["parts"])))).alias("blocks"),
    )
    name = lambda owner, part: F.concat_ws("/", F.coalesce(owner.cast("string"), F.lit("few")), part.cast("string"))
    dealt = members.join(sizes, [by, "component"]).join(blocks, by)
    owner = F.when(F.col("n") >= cell, F.col("component"))
    part = F.pmod(F.xxhash64("node", by), F.when(F.col("n") >= cell, parts).otherwise(F.col("few_parts")))
    dealt = dealt.withColumns({"owner": owner, "own": name(owner, part)})
    other = F.explode(F.filter("blocks", lambda x: x["owner"].isNull() | ~x["owner"].eqNullSafe(F.col("owner")))).alias("other")
    paired = dealt.select(*members.columns, "own", other).withColumn("other", name(F.col("other.owner"), F.col("other.part")))
    return paired.select(*members.columns, "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))


class _Forest:
    """Groups of a cell's members that grow together."""

    def __init__(self, rows: pa.Table):
        self.component = np.asarray(rows["component"])
        self.root = np.unique(self.component, return_inverse=True)[1]
        whole = len(rows) == 0 or rows["low"][0] == rows["high"][0]
        self.block = None if whole else np.asarray(rows["own"].combine_chunks().dictionary_encode().indices)

    def apart(self, i: int) -> np.ndarray:
        """Members after ``i`` that belong to another group, and to the other block of a cell of two."""
        out = self.root[i + 1 :] != self.root[i]
        return out if self.block is None else out & (self.block[i + 1 :] != self.block[i])

    def join(self, i: int, others: np.ndarray) -> list[int]:
        """One of ``others`` for each group that is new to ``i``'s; these groups become one."""
        roots, first = np.unique(self.root[others], return_index=True)
        self.root[np.isin(self.root, roots)] = self.root[i]
        return others[first].tolist()


def _edges(a: list[int], b: list[int]) -> pa.Table:
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _alike(rows: pa.Table, ratio: float, most: float) -> pa.Table:
    """Components of a cell that may be linked by sizes and sketches: a forest of them."""
    size, odd, forest = np.asarray(rows["size_of"]), _bitmaps(rows["odd"]), _Forest(rows)
    a, b = [], []
    for i in range(len(size) - 1):
        others = forest.apart(i) & (np.minimum(size[i + 1 :], size[i]) >= ratio * np.maximum(size[i + 1 :], size[i]))
        at = i + 1 + np.flatnonzero(others)
        at = at[np.bitwise_count(odd[at] ^ odd[i]).sum(axis=1) <= most]
        if len(at):
            own = forest.component[i]
            for j in forest.join(i, at):
                a.append(own), b.append(forest.component[j])
    return _edges(a, b)


def _linked(rows: pa.Table, percent: int) -> pa.Table:
    """Links of a cell's members by their full sets: a forest of them."""
    sets, node, forest = _hashes(rows["shingles"]), np.asarray(rows["node"]), _Forest(rows)
    size = np.array([len(x) for x in sets], np.int64)
    begin = np.concatenate(([0], np.cumsum(size)))
    known, flat = np.unique(np.concatenate(sets), return_inverse=True) if sets else (np.zeros(0), np.zeros(0, np.int64))
    mine = np.zeros(len(known), bool)
    a, b = [], []
    for i in range(len(sets) - 1):
        others = forest.apart(i) & (100 * np.minimum(size[i + 1 :], size[i]) >= percent * np.maximum(size[i + 1 :], size[i]))
        if not others.any():
            continue
        own = flat[begin[i] : begin[i + 1]]
        mine[own] = True
        both = np.add.reduceat(mine[flat[begin[i + 1] :]].astype(np.int64), begin[i + 1 : -1] - begin[i + 1])
        mine[own] = False
        at = i + 1 + np.flatnonzero(others & (100 * both >= percent * (size[i + 1 :] + size[i] - both)) & (both > 0))
        if len(at):
            for j in forest.join(i, at):
                a.append(node[i]), b.append(node[j])
    return _edges(a, b)


def _placed(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component`` of every row; classes of very many rows do not meet in one task."""
    rows = signed.select("doc_id", "n_shingles", "set1", "set2")
    limit = max(CLASS_ROWS, signed.count() // 100_000)
    # Classes of more rows than that are fewer than 100 000.
    many = classes.filter(F.col("times") > limit).select("set1", "set2", F.col("component").alias("found"))
    few = classes.filter(F.col("times") <= limit).select("set1", "set2", "component")
    marked = rows.join(F.broadcast(many), ["set1", "set2"], "left")
    met = marked.filter("found IS NULL").join(few, ["set1", "set2"], "left")
    columns = ["doc_id", "n_shingles", "component"]
    return met.select(*columns).union(marked.filter("found IS NOT NULL").select("doc_id", "n_shingles", "found"))


def near_duplicates(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text", k: int = SHINGLE, rows: int = ROWS, cell: int = CELL) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; linked are sets with 100 * common >= percent * all."""
    prepare(docs.sparkSession)
    threshold = percent / 100
    bands = bands_for(threshold, rows)
    most = differing_at_most(threshold)
    signed = stored(_signatures(docs, key, text, k, bands, rows), "signatures")
    usable = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stored(usable.groupBy("set1", "set2").agg(F.min("doc_id").alias("node"), F.count("*").alias("times")), "classes")
    # One layout by bucket serves the copies of a set, the buckets' sizes and the join of both.
    in_bucket = usable.filter("bands IS NOT NULL").select("set1", "set2", F.explode("bands").alias("bucket")).repartition("bucket").distinct()
    met = in_bucket.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    shared = stored(in_bucket.join(met, "bucket").join(classes, ["set1", "set2"]).select("bucket", "node", "size"), "buckets")
    crowd = shared.groupBy("node").agg(F.sum("size").alias("crowd"))
    leaders = shared.join(crowd, "node").groupBy("bucket").agg((-F.max(F.struct("crowd", -F.col("node")))["col2"]).alias("leader"))

    chosen = docs.select(F.col(key).cast("long").alias("node"), F.col(text).cast("string").alias("text"))
    features = stored(_features(chosen, crowd.select("node"), k), "features")

    def sided(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(features.select(F.col("node").alias(side), F.col("size_of").alias(f"size_{side}"), F.col("odd").alias(f"odd_{side}")), side)
        return pairs.filter(F.least("size_a", "size_b") * 100 >= percent * F.greatest("size_a", "size_b"))

    stars = shared.join(leaders, "bucket").filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    first = stored(_confirmed(_possible(sided(stars), most).distinct(), features, percent), "links")
    # A member goes with its smallest confirmed leader, and with that one's: enough to skip most pairs below.
    led = first.groupBy(F.col("b").alias("node")).agg(F.least(F.min("a"), F.col("b")).alias("component"))
    above = led.select(F.col("node").alias("component"), F.col("component").alias("top"))
    joined = stored(led.join(above, "component", "left").select("node", F.coalesce("top", "component").alias("component")), "joined")

    member = shared.join(joined, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    mixed = member.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("bucket")
    left = stored(member.join(mixed, "bucket"), "left")
    sketched = left.join(features.select("node", "size_of", "odd"), "node")
    alike = _cells(sketched, "bucket", cell).groupBy("bucket", "low", "high").applyInArrow(lambda t: _alike(t, threshold, most), "a long, b long")
    crowds = components(alike).select(F.col("node").alias("component"), F.col("component").alias("crowd"))
    crowded = left.select("node", "component").distinct().join(crowds, "component").join(features.select("node", "shingles"), "node")
    second = _cells(crowded, "crowd", cell).groupBy("crowd", "low", "high").applyInArrow(lambda t: _linked(t, percent), "a long, b long")

    # Ids with several sets join the classes of these.
    sets = F.struct("set1", "set2")
    several = usable.groupBy("doc_id").agg(F.min(sets).alias("x"), F.max(sets).alias("y")).filter("x <> y").select("doc_id")
    own = usable.join(several, "doc_id", "left_semi").join(classes, ["set1", "set2"]).select("doc_id", "node").distinct()
    same = own.join(own.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id").select("a", F.col("node").alias("b"))
    final = components(first.union(second).union(same))
    located = classes.join(final, "node", "left").select("set1", "set2", "times", F.coalesce("component", "node").alias("component"))
    found = _placed(signed, located)
    return found.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text", k: int = SHINGLE) -> DataFrame:
    """The rows of ``docs``, with all their columns, of one document a group: that of the smallest id.

    Of rows that repeat a kept id one stays; rows without an id all stay.
    """
    found = stored(near_duplicates(docs, percent, key, text, k).select("doc_id", "component_id"), "groups")
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    repeated = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("times")).filter("times > 1").select("doc_id")
    # Rows whose ids are in neither list, by a bitmap of fixed size, stay without being shuffled.
    spark = docs.sparkSession
    listed = spark.sparkContext.broadcast(sieve(gone.union(repeated).select(F.xxhash64("doc_id").alias("hashed")), "hashed"))

    @F.pandas_udf("boolean")
    def may_be_listed(slot: pd.Series) -> pd.Series:
        return pd.Series(passes(listed.value, slot.to_numpy()))

    asked = F.col(key).cast("long")
    marked = docs.select(F.struct(*docs.columns).alias("row"), asked.alias("doc_id"), may_be_listed(sieve_slot(F.xxhash64(asked))).alias("_listed"))
    free = marked.filter("NOT _listed OR doc_id IS NULL")
    rest = marked.filter("_listed AND doc_id IS NOT NULL").join(gone, "doc_id", "left_anti")
    again = rest.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.first("row").alias("row"))
    once = rest.join(repeated, "doc_id", "left_anti")
    return free.select("row.*").union(once.select("row.*")).union(again.select("row.*"))
