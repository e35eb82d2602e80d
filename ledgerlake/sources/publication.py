"""Several tables, or some years of them, published as one unit.

Every table and part (a year) is written to a folder of its own, never over another one. One log entry then names the
folder of each, with the marker of the source they came from; readers resolve folders through the log. So readers,
and whoever starts again after a stop at any step, find the old set or the new one, whole. What was written but not
published, and what was superseded, is deleted by ``vacuum`` after its retention.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.log import RETAIN_SECONDS, CommitLog, delete_stale

WHOLE = ""


def _after(state: dict, entry: dict) -> dict:
    """Folders by table and part, and markers by source, after an entry."""
    tables = {t: dict(parts) for t, parts in state["tables"].items()}
    for table, parts in entry["tables"].items():
        tables.setdefault(table, {}).update(parts)
    for table, part in entry["gone"]:
        tables.get(table, {}).pop(part, None)
    layouts = {t: x for t, x in state["layouts"].items() if t not in entry["tables"]} | entry["layouts"]
    return {"tables": tables, "markers": {**state["markers"], **entry["markers"]}, "layouts": layouts}


@dataclass(frozen=True)
class Buckets:
    """Files of a table dealt by the hash of a column, so that joins and aggregates on it need no exchange."""

    column: str
    number: int
    sort: tuple[str, ...] = ()


class Publication:
    """Readers' side: the published tables under a root."""

    def __init__(self, spark: SparkSession, root: str, part: str = "ano"):
        """``part`` names the column that a part's value stands for."""
        self.spark, self.root, self.part = spark, root.rstrip("/"), part
        self.commits = CommitLog(spark, self.root, _after, {"tables": {}, "markers": {}, "layouts": {}})

    def version(self) -> int:
        return self.commits.version()

    def parts(self, table: str, version: int | None = None) -> dict[str, str]:
        """Folder of each published part of a table, by the part's value."""
        return self.commits.current(version)[1]["tables"].get(table, {})

    def read(self, table: str, version: int | None = None, only: Sequence[object] | None = None) -> DataFrame:
        """A table of one version: the latest or a pinned one; ``only`` some of its parts."""
        state = self.commits.current(version)[1]
        parts = state["tables"].get(table, {})
        if table in state["layouts"]:
            return self._bucketed(table, state["layouts"][table])
        chosen = parts if only is None else {p: f for p, f in parts.items() if p in {str(x) for x in only}}
        if not chosen:
            raise ValueError(f"{table} was never published" if not parts else f"{table} has no such part")
        reader = self.spark.read.option("basePath", f"{self.root}/{table}")
        return reader.parquet(*[f"{self.root}/{table}/{f}" for f in chosen.values()]).drop("build")

    def _bucketed(self, table: str, layout: dict) -> DataFrame:
        """The table by its entry in the session's catalog, from which Spark takes the buckets; made where it is absent."""
        name = f"{table}_{layout['build']}"
        if not self.spark.catalog.tableExists(name):
            by = f"PARTITIONED BY ({', '.join(layout['by'])}) " if layout["by"] else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({layout['schema']}) USING parquet {by}CLUSTERED BY ({layout['column']}) "
                f"SORTED BY ({', '.join(layout['sort'])}) INTO {layout['number']} BUCKETS LOCATION '{self.root}/{table}/build={layout['build']}'"
            )
            if layout["by"]:
                self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return self.spark.table(name)

    def marker(self, source: str) -> str | None:
        """What the source of the published data was marked with (a file's hash)."""
        return self.commits.current()[1]["markers"].get(source)

    def markers(self) -> DataFrame:
        """``fonte, ano, hash_publicado`` of everything published."""
        rows = [(*k.rsplit("/", 1), v) for k, v in self.commits.current()[1]["markers"].items()]
        return self.spark.createDataFrame(rows, "fonte string, ano string, hash_publicado string").withColumn("ano", F.col("ano").cast("int"))

    def draft(self) -> Draft:
        return Draft(self)

    def publish(
        self, tables: Mapping[str, DataFrame], part: object = None, by: Mapping[str, Sequence[str]] | None = None,
        markers: Mapping[str, str] | None = None,
    ) -> int:
        """Write one part of several tables side by side and publish them together; the frames lack the part's column."""
        draft = self.draft()
        with ThreadPoolExecutor(max(1, min(4, len(tables)))) as pool:
            jobs = [pool.submit(draft.write, name, df, part, (by or {}).get(name, ())) for name, df in tables.items()]
            for job in jobs:
                job.result()
        return draft.publish(markers)

    def vacuum(self, retain_seconds: float = RETAIN_SECONDS) -> int:
        """Delete refused and superseded folders that are older than the retention and named by no retained version."""
        states = self.commits.forget(retain_seconds)
        named: dict[str, set] = {}
        for state in states:
            for table, parts in state["tables"].items():
                named.setdefault(table, set()).update(f.split("/")[0] for f in parts.values())
        deleted = 0
        for table in self._tables():
            for folder in delete_stale(self.spark, f"{self.root}/{table}", named.get(table, set()), retain_seconds):
                self.spark.sql(f"DROP TABLE IF EXISTS {table}_{folder.removeprefix('build=')}")
                deleted += 1
        return deleted

    def _tables(self) -> list[str]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return [n for n in names if not n.startswith("_")]


class Draft:
    """Tables that are being written for one publication; nothing of it is visible before ``publish``."""

    def __init__(self, of: Publication):
        self.of, self.build = of, f"b{uuid.uuid4().hex}"
        self.tables: dict[str, dict[str, str]] = {}
        self.gone: list[tuple[str, str]] = []
        self.layouts: dict[str, dict] = {}

    def write(
        self, table: str, df: DataFrame, part: object = None, by: Sequence[str] = (), sort: Sequence[str] = (), spread: bool = True,
        buckets: Buckets | None = None,
    ) -> DataFrame:
        """Write one table (or one part of it) and hand back the stored copy, so later steps start from files.

        Rows of a partition value go to few files, a hot value to several; ``spread`` is off where ``df`` is laid out
        already. A whole table may be dealt into ``buckets``.
        """
        if part is not None and self.of.part in df.columns:
            raise ValueError(f"{self.of.part} is given by the part")
        folder = f"build={self.build}" + ("" if part is None else f"/{self.of.part}={part}")
        path = f"{self.of.root}/{table}/{folder}"
        if buckets is not None:
            if part is not None:
                raise ValueError("only whole tables are bucketed")
            return self._write_buckets(table, df, by, buckets, path, folder)
        if by and spread:
            df = df.hint("rebalance", *by)
        if sort:
            df = df.sortWithinPartitions(*by, *sort)
        df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
        self.tables.setdefault(table, {})[WHOLE if part is None else str(part)] = folder
        return self.of.spark.read.option("basePath", f"{self.of.root}/{table}").parquet(path).drop("build")

    def _write_buckets(self, table: str, df: DataFrame, by: Sequence[str], buckets: Buckets, path: str, folder: str) -> DataFrame:
        order = (buckets.column, *buckets.sort)
        # Dealt by the bucket column first, so a task holds few buckets; several files of a bucket are fine.
        writer = df.repartition(buckets.number, buckets.column).write.format("parquet").option("compression", "zstd").option("path", path)
        writer = writer.partitionBy(*by) if by else writer
        writer.bucketBy(buckets.number, buckets.column).sortBy(*order).saveAsTable(f"{table}_{self.build}")
        out = self.of.spark.table(f"{table}_{self.build}")
        self.tables.setdefault(table, {})[WHOLE] = folder
        self.layouts[table] = {
            "build": self.build, "column": buckets.column, "number": buckets.number, "sort": list(order), "by": list(by),
            "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields),
        }
        return out

    def drop(self, table: str, part: object) -> None:
        """Publish without a part that is there now."""
        self.gone.append((table, str(part)))

    def publish(self, markers: Mapping[str, str] | None = None) -> int:
        return self.of.commits.publish({"build": self.build, "tables": self.tables, "gone": self.gone, "markers": dict(markers or {}), "layouts": self.layouts})
