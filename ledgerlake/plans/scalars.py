"""Queries: scalar building blocks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions.columns import (
    differs, hash_number, instant_text, month_of, seconds_between, stable_json, truncated, valid_operator, year_of,
)
from ledgerlake.plans.registry import query


@query("SC-01_coalesce_nullif", "SELECT l_orderkey, l_linenumber, l_partkey, coalesce(nullif(l_discount, 0), -1) AS desconto FROM lineitem")
def coalesce_nullif(lake):
    return lake.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.coalesce(F.nullif("l_discount", F.lit(0.0)), F.lit(-1.0)).alias("desconto")
    )


@query("SC-02_case", """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS simples,
    CASE WHEN o_totalprice > 300000 THEN 'alto' WHEN o_totalprice > 100000 THEN 'medio' END AS buscado FROM orders""")
def case_forms(lake):
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return lake.table("orders").select(
        "o_orderkey", F.when(status == "F", 1).when(status == "O", 2).otherwise(3).alias("simples"),
        F.when(price > 300000, "alto").when(price > 100000, "medio").alias("buscado"),
    )


@query("SC-04_distinct_from", """SELECT vistoria_id, item_codigo, quantidade IS DISTINCT FROM 20 AS difere, (quantidade > 20) IS FALSE AS e_falso FROM event""")
def distinct_from(lake):
    return lake.event.select(
        "vistoria_id", "item_codigo", differs("quantidade", F.lit(20)).alias("difere"),
        (F.col("quantidade") > 20).eqNullSafe(F.lit(False)).alias("e_falso"),
    )


@query("SC-06_truncate", "SELECT c_custkey, substr(repeat(c_name, 20), 1, 200) AS motivo FROM customer")
def truncate(lake):
    return lake.table("customer").select("c_custkey", truncated(F.repeat("c_name", 20), 200).alias("motivo"))


@query("SC-07_split_and_join", """SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS classe, concat_ws('; ', o_orderstatus, o_orderpriority) AS texto FROM orders""")
def split_and_join(lake):
    return lake.table("orders").select(
        "o_orderkey", F.split("o_orderpriority", "-")[0].alias("classe"),
        F.array_join(F.array("o_orderstatus", "o_orderpriority"), "; ").alias("texto"),
    )


@query("SC-08_full_match", "SELECT c_custkey, regexp_full_match('operador-'||c_custkey, 'operador-[0-9]{2,6}') AS valido FROM customer")
def full_match(lake):
    return lake.table("customer").select(
        "c_custkey", valid_operator(F.concat(F.lit("operador-"), F.col("c_custkey").cast("string"))).alias("valido")
    )


@query("SC-09_month_and_day_text", """SELECT event_id, strftime(ts, '%Y-%m') AS mes, strftime(ts, '%Y-%m-%d') AS dia, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS instante FROM events""")
def month_and_day(lake):
    return lake.table("events").select(
        "event_id", month_of("ts").alias("mes"), F.substring(F.col("ts").cast("string"), 1, 10).alias("dia"),
        instant_text("ts").alias("instante"),
    )


@query("SC-10_year_and_date", "SELECT event_id, CAST(year(ts) AS INT) AS ano, CAST(ts AS DATE) AS data FROM events")
def year_and_date(lake):
    return lake.table("events").select("event_id", year_of("ts").alias("ano"), F.col("ts").cast("date").alias("data"))


@query("SC-11_make_and_least", """SELECT o_orderkey, least(make_timestamp(year(o_orderdate)::BIGINT, 12, 31, 23, 59, 59.999), TIMESTAMP '1999-06-30') AS em FROM orders""")
def make_and_least(lake):
    from ledgerlake.operators.facts import year_reference

    years = lake.table("orders").withColumn("ano", year_of("o_orderdate"))
    return years.select("o_orderkey", year_reference("ano", "1999-06-30 00:00:00").alias("em"))


@query("SC-13_seconds_between", """SELECT event_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00.5')) / 1e6 AS segundos,
    round((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00.5')) / 86400e6, 1) AS dias FROM events""")
def seconds(lake):
    start = F.lit("2024-01-01 00:00:00.5").cast("timestamp_ntz")
    length = seconds_between(start, "ts").cast("double")
    return lake.table("events").select("event_id", length.alias("segundos"), F.round(length / 86400, 1).alias("dias"))


@query("SC-16_hash_numbers", """SELECT event_id, CAST(('0x'||substr(md5(props), 17, 16))::UBIGINT AS VARCHAR) AS numero, md5(props) AS md5, sha256(props) AS sha FROM events""")
def hash_numbers(lake):
    return lake.table("events").select(
        "event_id", hash_number(F.col("props")).cast("string").alias("numero"), F.md5("props").alias("md5"),
        F.sha2("props", 256).alias("sha"),
    )


@query("SC-18_stable_json", """SELECT co_entidade, valid_from, '{"'||replace(replace(itens, '=', '":"'), ',', '","')||'"}' AS json FROM profile""")
def json_text(lake):
    return lake.profile.select("co_entidade", "valid_from", stable_json("itens").alias("json"))
