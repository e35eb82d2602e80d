"""Schema drift of the captured tables against the contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.contracts import STREAM_CONTRACT
from ledgerlake.session import spread

# Kinds of drift, and the separator used in telemetry text.
NEW, MISSING, CHANGED = "coluna_nova", "coluna_ausente", "tipo_alterado"
SEPARATOR = "; "


def contract(spark: SparkSession) -> DataFrame:
    rows = [(t, c, k) for t, columns in STREAM_CONTRACT.items() for c, k in columns.items()]
    return spark.createDataFrame(rows, "tabela string, coluna string, esperado string")


#: Columns of the contract whose presence is kept in one number.
_WORD = 62


def drift(expected: DataFrame, announced: DataFrame) -> DataFrame:
    """Per announcement: new, missing and retyped columns; tables outside the contract are ignored.

    ``announced``: anuncio, tabela, coluna, tipo. A rename shows as one new and one missing column. New and retyped
    columns are seen row by row against the contract, which every task has; for the missing ones an announcement
    sends one bit for each contract column that it names.
    """
    places = [(r["tabela"], r["coluna"], r["esperado"]) for r in expected.orderBy("tabela", "coluna").collect()]  # the contract
    count: dict[str, int] = {}
    placed = []
    for t, c, k in places:
        count[t] = place = count.get(t, -1) + 1
        placed.append((t, c, k, place // _WORD, 1 << place % _WORD))
    spark = announced.sparkSession
    contract_of = spark.createDataFrame(placed, "tabela string, coluna string, esperado string, _word int, _bit long")
    tables = spark.createDataFrame([(t,) for t in count], "tabela string")
    known = announced.join(F.broadcast(tables), "tabela", "left_semi").join(F.broadcast(contract_of), ["tabela", "coluna"], "left")
    # An announcement without an id names no column of the contract.
    known = known.withColumns({c: F.when(F.col("anuncio").isNotNull(), F.col(c)) for c in ("esperado", "_word", "_bit")})
    kind = (
        F.when(F.col("esperado").isNull(), NEW).when(F.col("tipo").isNull(), MISSING)
        .when((F.col("esperado") != "any") & (F.col("esperado") != F.col("tipo")), CHANGED)
    )
    shown = known.withColumn("desvio", kind).where(F.col("desvio").isNotNull()).select("anuncio", "tabela", "coluna", "desvio")
    words = [f"_w{i}" for i in range(max(count.values(), default=0) // _WORD + 1)]
    bits = [F.coalesce(F.bit_or(F.when(F.col("_word") == i, F.col("_bit"))), F.lit(0).cast("bigint")).alias(w) for i, w in enumerate(words)]
    named = spread(known.select("anuncio", "tabela", "_word", "_bit"), "anuncio").groupBy("anuncio", "tabela").agg(*bits)
    seen = F.element_at(F.array(*words), F.col("_word") + 1).bitwiseAND(F.col("_bit"))
    missing = named.join(F.broadcast(contract_of), "tabela").where(seen == 0)
    return shown.unionByName(missing.select("anuncio", "tabela", "coluna", F.lit(MISSING).alias("desvio")))


def drift_text(drifts: DataFrame) -> DataFrame:
    """One text per announcement; its length is bounded by the announced columns."""
    one = F.concat(F.col("tabela"), F.lit("."), F.col("coluna"), F.lit(": "), F.col("desvio"))
    return spread(drifts.select("anuncio", one.alias("_d")), "anuncio").groupBy("anuncio").agg(
        F.array_join(F.array_sort(F.collect_set("_d")), SEPARATOR).alias("desvios_de_esquema")
    )


def drift_seen(telemetry: DataFrame) -> DataFrame:
    """How often each drift was seen in the telemetry."""
    return (
        telemetry.where(F.col("desvios_de_esquema").isNotNull())
        .select(F.explode(F.split("desvios_de_esquema", SEPARATOR)).alias("desvio"))
        .groupBy("desvio").agg(F.count("*").alias("vezes"))
    )
