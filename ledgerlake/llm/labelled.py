"""Labelled rows for the two scorers: which may be learnt from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a model is fitted on at most (16 bytes each when broadcast).
SAMPLE = 40_000


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id has remainder null."""
    return F.crc32(F.encode(key.cast("string"), "UTF-8")) % modulus


def sample(labels: DataFrame, label: str, learnable: Column, key: str = "doc_id", rows: int = SAMPLE) -> DataFrame:
    """``id, label, half`` of at most ``rows`` documents: those first by a hash of their id, in two halves by another.

    Ids with a null or another label than 0 or 1, or with both, are left out; a repeated one counts once.
    """
    usable = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1) & learnable)
    one = usable.groupBy(F.col(key).alias("id")).agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other"))
    return one.filter("label = other").orderBy(F.xxhash64("id"), "id").limit(rows).select("id", "label", (F.crc32(F.encode(F.concat(F.lit("half "), F.col("id").cast("string")), "UTF-8")) % 2).cast("int").alias("half"))


def labelled_texts(docs: DataFrame, chosen: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``text, label, half`` of the sampled documents; the sample is broadcast, its size has a bound."""
    picked = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    return picked.join(F.broadcast(chosen), "id").select("text", "label", "half")
