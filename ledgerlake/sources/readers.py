"""Readers for raw text, Parquet folders and relational origins."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.columns import hash_number
from ledgerlake.operators.census import require_columns


def raw_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``;``-separated Latin-1 file with a header; every column is text, an empty field is NULL."""
    return spark.read.csv(
        path, sep=";", header=True, encoding="ISO-8859-1", inferSchema=False, nullValue="", emptyValue=""
    )


def parquet_contract(spark: SparkSession, files: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Exactly the contract's columns from Parquet files, ignoring values in folder names."""
    df = spark.read.option("recursiveFileLookup", "true").parquet(*files)
    return require_columns(df, columns, "Parquet source").select(*columns)


def partitioned(spark: SparkSession, root: str, merge_schema: bool = False) -> DataFrame:
    """Folder layout with partition columns; old files lack newer columns and read as NULL."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(root)


def latest_year(df: DataFrame, year: str) -> DataFrame:
    """Only the newest yearly partition (the maximum comes from partition values)."""
    return df.where(F.col(year) == df.select(F.max(year)).scalar())


def union_years(tables: Sequence[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def jdbc(spark: SparkSession, options: Mapping[str, str], table: str, split: str, low: int, high: int, parts: int) -> DataFrame:
    """One origin table, read in parallel by ranges of a numeric key."""
    return spark.read.format("jdbc").options(**options).options(
        dbtable=table, partitionColumn=split, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)
    ).load()


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of every file under a path (files up to 2 GB, the limit of a binary column)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        F.col("path").alias("arquivo"), F.sha2("content", 256).alias("hash_sha256"), "length"
    )


#: Bytes of a block of ``block_hashes``.
HASH_BLOCK = 64 << 20
_PIECE = 4 << 20


def block_hashes(spark: SparkSession, path: str, block: int = HASH_BLOCK) -> DataFrame:
    """``arquivo, blocos, hash_blocos, length`` of every file under a path, of any size.

    The hash is the SHA-256 of the SHA-256 digests of the file's blocks of ``block`` bytes, in their order. Files
    without a byte are not listed, as in every Spark source. Blocks are read by tasks of their own, a piece at a time, through the file system that
    the path's scheme names; no task and no column holds a file.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("arquivo"), "length")
    last = F.floor((F.col("length") - 1) / block)
    blocks = files.select("arquivo", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("bloco"))

    def digests(batches):
        for b in batches:
            hexes = [_block_digest(name, n * block, block) for name, n in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hexes, pa.string())], names=["arquivo", "length", "bloco", "digest"])

    read = blocks.repartition(F.col("arquivo"), F.col("bloco")).mapInArrow(digests, "arquivo string, length long, bloco long, digest string")
    ordered = F.array_sort(F.collect_list(F.struct("bloco", "digest")))
    joined = read.groupBy("arquivo").agg(F.count("*").alias("blocos"), ordered.alias("_d"), F.max("length").alias("length"))
    return joined.select("arquivo", "blocos", F.sha2(F.unhex(F.array_join(F.transform("_d", lambda d: d["digest"]), "")), 256).alias("hash_blocos"), "length")


def _block_digest(name: str, start: int, length: int) -> str:
    """SHA-256 of a part of a file, read in pieces."""
    uri = "file://" + name.removeprefix("file:") if name.startswith("file:/") and not name.startswith("file://") else name
    system, inside = fs.FileSystem.from_uri(uri)
    digest = hashlib.sha256()
    with system.open_input_file(inside) as stream:
        stream.seek(min(start, stream.size()))
        while length and (piece := stream.read(min(length, _PIECE))):
            digest.update(piece)
            length -= len(piece)
    return digest.hexdigest()


def large_file_digest(spark: SparkSession, path: str) -> DataFrame:
    """Order-free digest of a text file of any size: lines and sum of line hashes."""
    line = F.col("value")
    return spark.read.text(path).agg(
        F.count("*").alias("linhas"), F.sum(hash_number(line)).alias("impressao")
    )
