"""Corpus preparation: toxicity, near duplicates, benchmark leaks, personal data, packing.

Each stage reads what the one before it kept, from files in the shared folder, and all but the last return
the columns of the documents they got. Null and empty texts pass every filter and are packed as empty
documents; rows without an id pass too. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontamination, labelled, neardup, packing, pii, toxicity
from ledgerlake.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more as toxic go; labels of held-out ids are not learnt from."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), labelled.remainder(F.col("doc_id"), 3) != 1)
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more, the one with the smallest id stays."""
    return neardup.one_of_each(docs, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with half or more of a benchmark item's words under tiles go."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; no document goes."""
    return pii.redact_personal_data(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences for training from what is left."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact),
    ("packing", pack),
]
#: Tokenisers, fitted scores and similarity joins are beyond SQL; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
