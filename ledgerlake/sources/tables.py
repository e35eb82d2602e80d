"""Versioned Parquet tables: atomic commits, pinned reads, insert-if-absent, rewrites that lose nothing.

A commit writes its files to a folder of its own and then one log entry; only logged files are ever read. So a reader
sees whole commits, a failed write leaves nothing visible, and any past version can be pinned. An entry adds one
commit and names the commits that it takes the place of (and the version its writer had read): a rewrite removes only
what it has read, and a commit that came between stays. Where what it names is gone already, it fails with a
``Conflict`` and is done again from the new state.

The log keeps for every file its rows, the least and greatest values of the table's statistics columns, its partition
value and, where asked for, an additive fingerprint of its rows. Reads and inserts choose files by them before Spark
lists any; fingerprints are sums over the live files. The list of files is on the driver, as Spark's own file
index is.
Where a Delta catalog is configured, ``DataFrame.mergeInto`` does the same work as ``insert_if_absent``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.columns import hash_number, row_text
from ledgerlake.sources.log import ATTEMPTS, RETAIN_SECONDS, CommitLog, Conflict, delete_folder, delete_stale

LOG_SCHEMA = "version int, commit string, kind string, received long, inserted long"
#: Keys of a batch up to this size are sent to every task.
BROADCAST_BYTES = 32 << 20
#: Files up to this number are named one by one; of more, the commits' folders are.
NAMED_FILES = 32
#: Longer texts are no statistics.
STATISTIC_CHARS = 64
COPIES = "_copies"
INSERT, APPEND, REWRITE, REPLACE = "insert", "append", "rewrite", "replace"


@dataclass(frozen=True)
class Written:
    received: int
    inserted: int
    version: int

    @property
    def discarded(self) -> int:
        return self.received - self.inserted


@dataclass(frozen=True)
class Made:
    """Files of a commit that is not published yet."""

    commit: str
    files: list[dict] = field(default_factory=list)

    @property
    def rows(self) -> int:
        return sum(f["rows"] for f in self.files)

    def entry(self, kind: str, received: int | None = None, removes: Sequence[str] = (), read: int = 0) -> dict:
        rows = self.rows
        return {
            "commit": self.commit, "kind": kind, "received": rows if received is None else received, "inserted": rows,
            "read": read, "removes": list(removes), "files": self.files,
        }


def live_commits(state: list[dict], entry: dict) -> list[dict]:
    """The commits that are part of the table after an entry."""
    gone = set(entry["removes"])
    return [c for c in state if c["commit"] not in gone] + [{"commit": entry["commit"], "files": entry["files"]}]


Ranges = Mapping[str, tuple]


def can_hold(file: dict, ranges: Ranges) -> bool:
    """Whether a file may hold a row with each column inside its (least, greatest) range."""
    for column, (low, high) in ranges.items():
        known = file["ranges"].get(column)
        if known is not None and (known[0] is None or known[0] > high or known[1] < low):
            return False
    return True


class VersionedTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        keys: Sequence[str],
        partition: str | None = None,
        first: Sequence[str] = (),
        statistics: Sequence[str] = (),
        summed: Sequence[str] = (),
    ):
        """``first``: columns that decide which of two equal keys inside one batch is kept.

        ``statistics``: columns besides the keys whose range is kept for each file; ``summed``: columns whose
        fingerprint is.
        """
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.partition, self.first = list(keys), partition, list(first)
        ordered = (T.IntegralType, T.StringType)
        wanted = dict.fromkeys([*self.keys, *statistics])
        self.statistics = [c for c in wanted if c != partition and isinstance(schema[c].dataType, ordered)]
        self.summed = list(summed)
        self.commits = CommitLog(spark, self.root, live_commits, [])

    # -- versions ---------------------------------------------------------------------------

    def log(self) -> DataFrame:
        names = [x.split()[0] for x in LOG_SCHEMA.split(", ")]
        return self.spark.createDataFrame([tuple(e[n] for n in names) for e in self.commits.history()], LOG_SCHEMA)

    def version(self) -> int:
        return self.commits.version()

    def is_empty(self) -> bool:
        return not any(c["files"] for c in self.commits.current()[1])

    def read(self, version: int | None = None, only: Ranges | None = None) -> DataFrame:
        """The latest version, or one fixed version; later commits do not change the result.

        ``only`` gives inclusive ranges of columns: rows outside are left out, files that cannot hold any inside are
        not listed.
        """
        return self._load(self.commits.current(version)[1], only or {})

    def added(self, entries: Sequence[dict]) -> DataFrame:
        """The rows that some log entries added (not those that they took the place of)."""
        return self._load([{"commit": e["commit"], "files": e["files"]} for e in entries])

    def _load(self, live: Sequence[dict], only: Ranges = {}, holds: Callable[[dict], bool] = lambda f: True) -> DataFrame:  # noqa: B006
        ranges = {c: r for c, r in only.items() if c != self.partition}
        values = only.get(self.partition)

        def chosen(f: dict) -> bool:
            inside = values is None or f["value"] is None or values[0] <= f["value"] <= values[1]
            return f["rows"] > 0 and inside and can_hold(f, ranges) and holds(f)

        files = [(c["commit"], f["name"]) for c in live for f in c["files"] if chosen(f)]
        if not files:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.option("basePath", f"{self.root}/data")
        if len(files) <= NAMED_FILES:
            out = reader.schema(self.schema).parquet(*[f"{self._folder(c)}/{n}" for c, n in files])
        else:
            # One root; the commit is a partition column, so other commits' files are never opened.
            of = T.StructType([*self.schema.fields, T.StructField("commit", T.StringType())])
            out = reader.schema(of).parquet(f"{self.root}/data").where(F.col("commit").isin(sorted({c for c, _ in files})))
        out = out.select(*self.schema.names)
        for c, (low, high) in only.items():
            out = out.where(F.col(c).between(F.lit(low), F.lit(high)))
        return out

    def _folder(self, commit: str) -> str:
        return f"{self.root}/data/commit={commit}"

    # -- writes -----------------------------------------------------------------------------

    def _write(self, df: DataFrame) -> Made:
        """Write the files of a commit and measure them, in one pass over what was written."""
        commit = f"c{uuid.uuid4().hex}"
        out = df.select(*self.schema.names)
        if self.partition:
            # Few files per partition value, yet a hot value is split over several writer tasks.
            out = out.hint("rebalance", self.partition)
        writer = out.write.option("compression", "zstd")
        if self.partition:
            writer = writer.partitionBy(self.partition)
        writer.parquet(self._folder(commit))
        return Made(commit, self._measured(commit))

    def _measured(self, commit: str) -> list[dict]:
        rows = self.spark.read.schema(self.schema).option("basePath", self._folder(commit)).parquet(self._folder(commit))
        texts = [c for c in self.statistics if isinstance(self.schema[c].dataType, T.StringType)]
        wanted = [F.count("*").alias("rows")]
        for c in self.statistics:
            wanted += [F.min(c).alias(f"low {c}"), F.max(c).alias(f"high {c}")]
        wanted += [F.max(F.length(c)).alias(f"long {c}") for c in texts]
        if self.summed:
            wanted.append(F.sum(hash_number(row_text(self.summed))).cast("string").alias("sum"))
        by = [F.col("_metadata.file_path").alias("path"), *([F.col(self.partition).cast("string").alias("value")] if self.partition else [])]
        files = []
        for r in rows.groupBy(*by).agg(*wanted, *_by_hash(texts)).collect():  # one row a file
            bounded = [c for c in self.statistics if c not in texts or (r[f"long {c}"] or 0) <= STATISTIC_CHARS]
            files.append({
                "name": unquote(r["path"].split(f"/commit={commit}/", 1)[1]), "rows": r["rows"], "value": r["value"] if self.partition else None,
                "ranges": {c: [r[f"low {c}"], r[f"high {c}"]] for c in bounded}, **({"sum": r["sum"]} if self.summed else {}),
            })
        return sorted(files, key=lambda f: f["name"])

    def _drop(self, made: Made) -> None:
        delete_folder(self.spark, self._folder(made.commit))

    def append(self, df: DataFrame) -> Written:
        made = self._write(df)
        return Written(made.rows, made.rows, self.commits.publish(made.entry(APPEND)))

    def replace(self, df: DataFrame, read: int | None = None) -> Written:
        """Publish a new content as one unit; a build that fails leaves the old one in place.

        It takes the place of the commits of version ``read``, from which ``df`` was computed: then nothing may have
        been committed since, or a ``Conflict`` is raised. Without ``read`` it takes the place of what is stored when
        the call begins; rows that others add meanwhile stay.
        """
        strict = read is not None
        version, live = self.commits.current(read)
        removes = [c["commit"] for c in live]
        made = self._write(df)

        def holds(now: int, state: list[dict]) -> bool:
            return now == version if strict else set(removes) <= {c["commit"] for c in state}

        return self._published(made, made.entry(REPLACE, removes=removes, read=version), holds)

    def _published(self, made: Made, entry: dict, holds: Callable[[int, list], bool]) -> Written:
        try:
            return Written(made.rows, made.rows, self.commits.publish(entry, holds))
        except Conflict:
            self._drop(made)
            raise

    def compact(self) -> Written:
        """Rewrite the files of a version as few; what others commit meanwhile stays beside them."""
        for _ in range(ATTEMPTS):
            version, live = self.commits.current()
            removes = [c["commit"] for c in live]
            made = self._write(self._load(live))
            try:
                return self._published(
                    made, made.entry(REWRITE, removes=removes, read=version), lambda _, state: set(removes) <= {c["commit"] for c in state}  # noqa: B023
                )
            except Conflict:
                continue  # another rewrite took some of these commits: once more from its result
        raise Conflict(f"{self.root}: other writers kept rewriting")

    def insert_if_absent(self, batch: DataFrame, prune: bool = True) -> Written:
        """Insert the rows whose key is not stored yet; the first writer of a key wins.

        Only absent rows are written, so a repeated batch writes nothing. With ``prune`` only the partitions
        that occur in the batch are searched, so a key stored under another partition value is inserted
        again. If another writer commits keys in the range of what was written, they are looked up as well and the
        rest is written anew; other commits do not disturb. An empty batch makes no version.
        """
        unique = first_per_key(batch.select(*self.schema.names), self.keys, self.first, COPIES).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            profile = self._profile(unique)
            received = sum(r["copies"] for r in profile)
            for _ in range(ATTEMPTS):
                version, live = self.commits.current()
                if not profile:
                    return Written(received, 0, version)
                made = self._write(self._absent(unique.drop(COPIES), live, profile, prune))
                if not made.rows:
                    self._drop(made)
                    return Written(received, 0, version)
                taken = self._insert(made, version, received, prune)
                if taken:
                    return Written(received, made.rows, taken)
                self._drop(made)
        finally:
            unique.unpersist()
        raise Conflict(f"{self.root}: other writers kept committing")

    def _insert(self, made: Made, version: int, received: int, prune: bool) -> int | None:
        """Publish rows that were absent from ``version``; None if a later commit may hold one of their keys."""
        entry = made.entry(INSERT, received, read=version)
        for _ in range(ATTEMPTS):
            if self.commits.add(version + 1, entry):
                return version + 1
            for other in self.commits.history(version):
                version = other["version"]
                if other["kind"] == REPLACE or (other["kind"] != REWRITE and any(self._meet(a, b, prune) for a in made.files for b in other["files"])):
                    return None
        return None

    def _meet(self, a: dict, b: dict, prune: bool) -> bool:
        """Whether two files may hold one key."""
        same = not prune or a["value"] == b["value"]
        return same and can_hold(b, {c: tuple(r) for c, r in a["ranges"].items() if c in self.keys and r[0] is not None})

    def _profile(self, unique: DataFrame) -> list[dict]:
        """Rows, copies, size and key ranges of a batch for each partition value (calendar months: few)."""
        by = [F.col(self.partition).cast("string").alias("value")] if self.partition else [F.lit(None).cast("string").alias("value")]
        ranged = [c for c in self.keys if c in self.statistics]
        size = sum((F.coalesce(F.length(c), F.lit(0)) + 16 for c in self.keys), F.lit(16))
        found = unique.groupBy(*by).agg(
            F.count("*").alias("rows"), F.sum(COPIES).alias("copies"), F.sum(size).alias("bytes"),
            *[x for c in ranged for x in (F.min(c).alias(f"low {c}"), F.max(c).alias(f"high {c}"))], *_by_hash(ranged),
        ).collect()
        return [
            {"value": r["value"], "rows": r["rows"], "copies": r["copies"], "bytes": r["bytes"],
             "ranges": {c: (r[f"low {c}"], r[f"high {c}"]) for c in ranged if r[f"low {c}"] is not None}}
            for r in found if r["rows"]
        ]

    def _absent(self, batch: DataFrame, live: list[dict], profile: list[dict], prune: bool) -> DataFrame:
        """Rows of a batch of unique keys that are not stored, looked up only in files that may hold one."""

        def holds(f: dict) -> bool:
            return any((not prune or f["value"] == p["value"]) and can_hold(f, p["ranges"]) for p in profile)

        if not any(holds(f) for c in live for f in c["files"]):
            return batch
        stored = self._load(live, holds=holds)
        if prune and self.partition:
            stored = stored.where(F.col(self.partition).cast("string").isin([p["value"] for p in profile]))
        wanted = batch.select(*self.keys)
        if sum(p["bytes"] for p in profile) <= BROADCAST_BYTES:
            # The measured, small batch goes to the stored keys, which then are not shuffled.
            wanted = F.broadcast(wanted)
        found = stored.select(*self.keys).join(wanted, self.keys, "left_semi")
        return batch.join(found, self.keys, "left_anti")

    # -- fingerprints -----------------------------------------------------------------------

    def fingerprint(self, by_partition: bool = False, version: int | None = None, values: Sequence[str] | None = None) -> DataFrame:
        """Rows and fingerprint of the table, or of each partition value (all, or only some).

        The files' sums are merged; only files whose sums were not kept are read. Partition values are few
        (calendar months), so what is summed here has a few rows a file.
        """
        if not self.summed:
            raise ValueError("the table keeps no fingerprints")
        live = self.commits.current(version)[1]
        wanted = None if values is None else set(values)
        inside = lambda f: f["rows"] > 0 and (wanted is None or f["value"] in wanted)
        sums: dict[str | None, list[int]] = {} if by_partition else {None: [0, 0]}
        for c in live:
            for f in c["files"]:
                if inside(f) and f.get("sum") is not None:
                    total = sums.setdefault(f["value"] if by_partition else None, [0, 0])
                    total[0] += f["rows"]
                    total[1] += int(f["sum"])
        if any(inside(f) and f.get("sum") is None for c in live for f in c["files"]):
            rest = self._load(live, holds=lambda f: inside(f) and f.get("sum") is None)
            rest = rest if wanted is None else rest.where(F.col(self.partition).cast("string").isin(list(wanted)))
            by = [F.col(self.partition).cast("string").alias("value")] if by_partition else []
            more = rest.groupBy(*by).agg(F.count("*").alias("n"), F.sum(hash_number(row_text(self.summed))).alias("s"))
            for r in more.collect():
                total = sums.setdefault(r["value"] if by_partition else None, [0, 0])
                total[0] += r["n"]
                total[1] += int(r["s"] or 0)
        named = f"{self.partition} string, " if by_partition else ""
        rows = [(*((v,) if by_partition else ()), n, str(s)) for v, (n, s) in sums.items()]
        return self.spark.createDataFrame(rows, f"{named}linhas long, impressao string").withColumn("impressao", F.col("impressao").cast("decimal(38,0)"))

    # -- retention --------------------------------------------------------------------------

    def vacuum(self, retain_seconds: float = RETAIN_SECONDS) -> int:
        """Delete commit folders older than ``retain_seconds`` that no retained version names."""
        named = {f"commit={c['commit']}" for state in self.commits.forget(retain_seconds) for c in state}
        return len(delete_stale(self.spark, f"{self.root}/data", named, retain_seconds))


def _by_hash(texts: Sequence[str]) -> list[Column]:
    """An aggregate that makes Spark keep the few groups of a task as objects, in a hash map.

    For the least and greatest of texts alone it would sort all rows by group first.
    """
    return [F.size(F.collect_set(F.lit(1))).alias(COPIES + "_held")] if texts else []


def first_per_key(df: DataFrame, keys: Sequence[str], first: Sequence[str] = (), copies: str | None = None) -> DataFrame:
    """One row per key, chosen by ``first`` and then by the remaining values; reduced map-side.

    ``copies`` names an extra column with the number of rows each kept row stands for.
    """
    rest = [*first, *[c for c in df.columns if c not in keys and c not in first]]
    counted = [F.count("*").alias(copies)] if copies else []
    if not rest:
        return df.groupBy(*keys).agg(F.count("*").alias(copies or "_n")).select(*keys, *([copies] if copies else []))
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r"), *counted)
    return kept.select(
        *[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns], *([copies] if copies else [])
    )
