"""Table layouts: partitioned writes, published years, compaction, evolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.publication import Publication

LAYOUTS: dict[str, tuple[str, ...]] = {"nenhum": (), "ano": ("ano_censo",), "ano_uf": ("ano_censo", "sg_uf")}
CODECS = ("none", "snappy", "zstd")


def write(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "append", codec: str = "zstd") -> None:
    """Rebalanced by partition value: few files each, and a hot value is split over tasks."""
    out = df.hint("rebalance", *by) if by else df
    writer = out.write.mode(mode).option("compression", codec)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def require_one_year(df: DataFrame, year: str = "ano_censo") -> int:
    """The single year of a yearly folder; a folder mixing years is refused."""
    bounds = df.agg(F.min(year), F.max(year)).first()
    if bounds[0] is None or bounds[0] != bounds[1]:
        raise ValueError(f"expected one year, found {bounds[0]}..{bounds[1]}")
    return bounds[0]


def clustered(df: DataFrame, by: Sequence[str], sort: Sequence[str]) -> DataFrame:
    """Lay rows out for a partitioned write: rows of a partition value go to few tasks, sorted.

    A range split on (partition columns + sort columns) spreads a hot partition value over tasks and
    keeps min/max statistics narrow.
    """
    return df.repartitionByRange(*[F.col(c) for c in (*by, *sort)]).sortWithinPartitions(*by, *sort)


WIDE = "larga"


def wide_years(spark: SparkSession, path: str) -> Publication:
    """The wide analytic table: one part a census year."""
    return Publication(spark, path, "ano_censo")


def publish_year(df: DataFrame, path: str) -> int:
    """Wide analytic table: replace one census year as a whole, partitioned by (year, state).

    The year is written to a folder of its own and then named by one log entry, so a stop at any step leaves the old
    year or the new one, and states that are gone leave no partition behind.
    """
    year = require_one_year(df)
    by, sort = ["sg_uf"], ["co_municipio", "co_entidade", "item_codigo"]
    draft = wide_years(df.sparkSession, path).draft()
    draft.write(WIDE, clustered(df.drop("ano_censo"), by, sort), year, by, spread=False)
    draft.publish()
    return year


def read_years(spark: SparkSession, path: str, only: Sequence[int] | None = None) -> DataFrame:
    """The published years of the wide table, or some of them."""
    return wide_years(spark, path).read(WIDE, only=only)


def reapply(batch: DataFrame, path: str, keys: Sequence[str], by: Sequence[str]) -> None:
    """Append the rows of a batch that a log-less table does not hold yet."""
    held = batch.sparkSession.read.parquet(path).select(*keys)
    write(batch.join(held, list(keys), "left_anti"), path, by)


def compact(spark: SparkSession, source: str, target: str, by: Sequence[str]) -> None:
    """Rewrite many small files as few, next to the original; readers switch when it is complete."""
    out = spark.read.parquet(source).hint("rebalance", *by)
    out.write.option("compression", "zstd").partitionBy(*by).parquet(target)


def csv_copy(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").option("sep", ";").csv(path)
