"""Pseudonymization of inspection staff on request."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The text that replaces a person's name and the registration prefix.
ANONYMOUS_NAME = "Técnico anonimizado"
PREFIX = "anonimizado-"


def check_requests(requests: DataFrame) -> DataFrame:
    """Requests that must be refused: empty or already pseudonymized registrations."""
    return requests.where(
        F.col("matricula").isNull() | (F.col("matricula") == "") | F.col("matricula").startswith(PREFIX)
    )


def pseudonymize(staff: DataFrame, requests: DataFrame) -> DataFrame:
    """Staff table after the requests; ids stay, unknown registrations match nobody."""
    asked = requests.select("matricula").distinct().withColumn("_asked", F.lit(True))
    hit = F.col("_asked").isNotNull()
    return (
        staff.join(asked, "matricula", "left")
        .withColumns({
            "nome": F.when(hit, ANONYMOUS_NAME).otherwise(F.col("nome")),
            "matricula": F.when(hit, F.concat(F.lit(PREFIX), F.col("id").cast("string"))).otherwise(F.col("matricula")),
            "ativo": F.when(hit, False).otherwise(F.col("ativo")),
        })
        .select(*staff.columns)
    )


def pseudonymized(staff: DataFrame, requests: DataFrame, inspections: DataFrame) -> DataFrame:
    """Who was matched and how many inspections stay linked to the id."""
    matched = staff.join(requests.select("matricula").distinct(), "matricula", "left_semi").select(
        F.col("id").alias("tecnico_id")
    )
    linked = inspections.groupBy("tecnico_id").agg(F.count("*").alias("_n"))
    return matched.join(linked, "tecnico_id", "left").select(
        "tecnico_id", F.coalesce("_n", F.lit(0).cast("bigint")).alias("vistorias")
    )
