"""Queries: readers, writers, ingestion steps, versioned tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from ledgerlake.contracts import CENSUS_COLUMNS, EVENT_CONTENT, EVENT_KEY, EVENT_SCHEMA, EXAM_COLUMNS
from ledgerlake.operators import census, facts, metrics, quality
from ledgerlake.plans.adapter import AS_OF, CATALOG, CONTENT_TEXT, EXAM_REFERENCE, EXAM_YEAR, HASH64, LAST_YEAR, census_column
from ledgerlake.plans.analytics import census_raw
from ledgerlake.plans.registry import query
from ledgerlake.session import work_dir
from ledgerlake.sources import ingest, layouts, readers
from ledgerlake.sources.publication import Publication
from ledgerlake.sources.star import TABLES, Inputs, Star
from ledgerlake.sources.tables import VersionedTable


def events_table(lake) -> VersionedTable:
    return VersionedTable(lake.spark, work_dir(lake.spark), EVENT_SCHEMA, EVENT_KEY, "mes_ocorrencia", ["lsn_origem"], ["co_entidade"], EVENT_CONTENT)


def _raw_file(lake, df) -> str:
    path = f"{work_dir(lake.spark)}/raw"
    df.write.option("header", "true").option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    return path


@query("SRC-01_raw_text_file", """SELECT CAST(co_escola AS VARCHAR) AS CO_ESCOLA, p1 AS TP_PRESENCA_CN, p2 AS TP_PRESENCA_CH, s_cn AS NU_NOTA_CN FROM exam_row""")
def raw_text_file(lake):
    raw = readers.raw_text(lake.spark, _raw_file(lake, lake.exam_raw))
    return raw.select("CO_ESCOLA", "TP_PRESENCA_CN", "TP_PRESENCA_CH", F.col("NU_NOTA_CN").cast("double").alias("NU_NOTA_CN"))


@query("SRC-02_header_contract", "SELECT (SELECT count(*) FROM exam_row) AS linhas_enem, (SELECT count(*) FROM school) AS linhas_censo")
def header_contract(lake):
    exam = census.require_columns(readers.raw_text(lake.spark, _raw_file(lake, lake.exam_raw)), EXAM_COLUMNS, "exam file", ordered=True)
    wanted = [*CENSUS_COLUMNS, *[census_column(c) for c in CATALOG]]
    schools = census.require_columns(readers.raw_text(lake.spark, _raw_file(lake, census_raw(lake))), wanted, "census file")
    return exam.agg(F.count("*").alias("linhas_enem")).withColumn("linhas_censo", schools.agg(F.count("*")).scalar())


def _school_years(lake) -> str:
    path = f"{work_dir(lake.spark)}/escola"
    layouts.write(lake.school_files, path, ["ano_censo_referencia"])
    return path


@query("SRC-03_parquet_contract", "SELECT co_entidade, no_entidade FROM school_files")
def parquet_contract(lake):
    return readers.parquet_contract(lake.spark, [_school_years(lake)], ["co_entidade", "no_entidade"])


@query("SRC-04_partitioned_read", "SELECT co_entidade, no_entidade, ano_censo_referencia FROM school_files WHERE ano_censo_referencia = 2000")
def partitioned_read(lake):
    return readers.partitioned(lake.spark, _school_years(lake)).where(F.col("ano_censo_referencia") == 2000).select(
        "co_entidade", "no_entidade", "ano_censo_referencia"
    )


@query("SRC-05_latest_year", "SELECT co_entidade, no_entidade, ano_censo_referencia FROM school_files WHERE ano_censo_referencia = (SELECT max(ano_censo_referencia) FROM school_files)")
def latest_year(lake):
    every = readers.partitioned(lake.spark, _school_years(lake))
    return readers.latest_year(every, "ano_censo_referencia").select("co_entidade", "no_entidade", "ano_censo_referencia")


@query("SRC-06_origin_events_filtered", "SELECT * EXCLUDE (lsn_origem) FROM event WHERE ocorrido_em >= TIMESTAMP '2000-02-01' AND ocorrido_em < TIMESTAMP '2000-03-01'")
def origin_events(lake):
    """The filter is on the header's event time, so it reaches the header scan."""
    low, high = (F.lit(t).cast("timestamp_ntz") for t in ("2000-02-01", "2000-03-01"))
    headers = lake.inspection.where((F.col("ocorrido_em") >= low) & (F.col("ocorrido_em") < high))
    return facts.canonical_events(headers, lake.item, lake.school, lake.municipality).drop("lsn_origem")


@query("SRC-07_pinned_version", "SELECT * FROM event WHERE origem = 'censo_escolar'")
def pinned_version(lake):
    """The census baseline is version 1; reading that version ignores what came later."""
    table = events_table(lake)
    first = table.insert_if_absent(lake.stored("event").where(F.col("origem") == "censo_escolar")).version
    table.insert_if_absent(lake.stored("event"))
    return table.read(first)


@query("SRC-08_file_hashes", """SELECT mes, sha256(string_agg(o_orderkey, chr(10) ORDER BY o_orderkey) || chr(10)) AS hash_sha256,
    CAST(sum(length(o_orderkey::VARCHAR) + 1) AS BIGINT) AS length FROM (SELECT *, strftime(o_orderdate, '%Y-%m') AS mes FROM orders) GROUP BY mes""")
def file_hashes(lake):
    """A text file for each month of inspections, its keys line by line, hashed as a file."""
    path = f"{work_dir(lake.spark)}/meses"
    keys = lake.table("orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("mes"), "o_orderkey")
    sorted_keys = keys.repartition("mes").sortWithinPartitions("mes", "o_orderkey")
    sorted_keys.select("mes", F.col("o_orderkey").cast("string").alias("value")).write.partitionBy("mes").text(path)
    return readers.file_hashes(lake.spark, path).select(F.regexp_extract("arquivo", "mes=([0-9-]+)", 1).alias("mes"), "hash_sha256", "length")


@query("SRC-08_large_file_digest", "SELECT count(*) AS linhas, CAST(sum(('0x'||substr(md5(l), 17, 16))::UBIGINT::DECIMAL(28,0)) AS VARCHAR) AS impressao FROM (SELECT o_orderkey||';'||o_orderstatus AS l FROM orders)")
def large_file_digest(lake):
    path = f"{work_dir(lake.spark)}/lines"
    lake.table("orders").select(F.concat_ws(";", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("value")).write.text(path)
    return readers.large_file_digest(lake.spark, path).withColumn("impressao", F.col("impressao").cast("string"))


_FILES = "(SELECT c_mktsegment AS fonte, 2000 + CAST(c_custkey AS INT) AS ano, md5('v'||(c_custkey % 3)) AS hash_sha256 FROM customer)"
_MANIFEST = """(SELECT c_mktsegment AS fonte, 2000 + CAST(c_custkey AS INT) AS ano, md5('v'||(c_custkey % 2)) AS hash_vigente FROM customer WHERE c_custkey % 5 <> 0)"""


def _manifest(lake):
    """Two completed ingestions per school file; the later one counts."""
    files = lake.table("customer").select(
        F.col("c_mktsegment").alias("fonte"), (2000 + F.col("c_custkey")).cast("int").alias("ano"), F.col("c_custkey").alias("k")
    )
    current = files.where(F.col("k") % 5 != 0)
    at = [F.lit(t).cast("timestamp_ntz") for t in ("2024-01-01", "2024-02-01")]
    old = current.select("fonte", "ano", F.md5(F.concat(F.lit("v"), F.col("k") % 3)).alias("hash_sha256"), at[0].alias("iniciado_em"), at[0].alias("concluido_em"))
    new = current.select("fonte", "ano", F.md5(F.concat(F.lit("v"), F.col("k") % 2)).alias("hash_sha256"), at[1].alias("iniciado_em"), at[1].alias("concluido_em"))
    published = files.select("fonte", "ano", F.md5(F.concat(F.lit("v"), F.col("k") % 4)).alias("hash_publicado"))
    given = files.select("fonte", "ano", F.md5(F.concat(F.lit("v"), F.col("k") % 3)).alias("hash_sha256"))
    return given, old.unionByName(new), published


_DECIDED = f"""(SELECT f.fonte, f.ano, f.hash_sha256, CASE WHEN f.hash_sha256 IS DISTINCT FROM m.hash_vigente THEN 'ingerir'
    WHEN f.hash_sha256 = md5('v'||((f.ano - 2000) % 4)) THEN 'ignorar' ELSE 'republicar_silver' END AS acao
    FROM {_FILES} f LEFT JOIN {_MANIFEST} m ON m.fonte = f.fonte AND m.ano = f.ano)"""


@query("SRC-09_ingestion_decision", f"SELECT * FROM {_DECIDED}")
def ingestion_decision(lake):
    return ingest.decide(*_manifest(lake))


@query("SRC-10_manifest_append", f"""SELECT fonte, count(*) AS registros FROM (SELECT fonte FROM {_DECIDED} WHERE acao = 'ingerir'
    UNION ALL SELECT fonte FROM {_MANIFEST} UNION ALL SELECT fonte FROM {_MANIFEST}) GROUP BY fonte""")
def manifest_append(lake):
    files, manifest, published = _manifest(lake)
    path = f"{work_dir(lake.spark)}/manifesto"
    layouts.write(manifest, path)
    rows = ingest.manifest_row(
        ingest.decide(files, manifest, published), False, {}, "2024-03-01 00:00:00", "2024-03-01 00:05:00"
    )
    layouts.write(rows.select(*manifest.columns), path)
    return lake.spark.read.parquet(path).groupBy("fonte").agg(F.count("*").alias("registros"))


# -- sinks ---------------------------------------------------------------------------------------

def _wide(lake):
    return lake.stored("wide")


@query("SNK-01_zstd_parquet", "SELECT co_entidade, item_codigo, situacao FROM latest")
def zstd_parquet(lake):
    path = f"{work_dir(lake.spark)}/itens"
    layouts.write(lake.latest.select("co_entidade", "item_codigo", "situacao"), path)
    return lake.spark.read.parquet(path)


@query("SNK-02_replace_one_partition", """SELECT co_entidade, no_entidade, ano_censo_referencia FROM school_files WHERE ano_censo_referencia = 2000
    UNION ALL SELECT co_entidade, no_entidade||'-novo', ano_censo_referencia FROM school_files WHERE ano_censo_referencia = 2001""")
def replace_one_partition(lake):
    year = "ano_censo_referencia"
    published = Publication(lake.spark, work_dir(lake.spark), year)
    for y in (2000, 2001):
        published.publish({"escola": lake.school_files.where(F.col(year) == y).drop(year)}, y)
    newer = lake.school_files.where(F.col(year) == 2001).withColumn("no_entidade", F.concat("no_entidade", F.lit("-novo")))
    published.publish({"escola": newer.drop(year)}, 2001)
    return published.read("escola").select("co_entidade", "no_entidade", year)


_CENSUS_ROWS = """SELECT 'municipio' AS tabela, count(DISTINCT co_municipio) AS linhas FROM school WHERE co_entidade % 13 <> 0 AND co_entidade % 31 <> 0
    UNION ALL SELECT 'escola', count(*) FROM school WHERE {located} UNION ALL SELECT 'vistoria_item', 7 * count(*) FROM school WHERE {located}"""


@query("SNK-02_census_as_one_unit", f"SELECT *, 'b' AS hash_publicado FROM ({_CENSUS_ROWS.format(located='co_entidade % 13 <> 0 AND co_entidade % 31 <> 0 AND co_entidade % 17 <> 0')})")
def census_as_one_unit(lake):
    """Half of a census file published, the same hash again, a run that stopped before publishing, then the whole file."""
    published = Publication(lake.spark, work_dir(lake.spark), "ano_censo")
    raw, columns = census_raw(lake), {c: census_column(c) for c in CATALOG}
    half = raw.where(F.col("CO_ENTIDADE").cast("bigint") % 2 == 0)
    ingest.publish_census(published, half, columns, EXAM_YEAR, "a")
    ingest.publish_census(published, raw, columns, EXAM_YEAR, "a")
    published.draft().write("escola", census.schools(half).drop("ano_censo_referencia").limit(1), EXAM_YEAR)
    ingest.publish_census(published, raw, columns, EXAM_YEAR, "b")
    rows = quality.run_checks({t: published.read(t) for t in ("municipio", "escola", "vistoria_item")}).withColumnsRenamed({"teste": "tabela", "falhas": "linhas"})
    return rows.withColumn("hash_publicado", published.markers().select("hash_publicado").scalar())


@query("SNK-03_publish_year", """SELECT ano_censo, sg_uf, item_codigo, situacao, count(*) AS linhas FROM wide GROUP BY ALL
    UNION ALL SELECT ano_censo - 1, sg_uf, item_codigo, situacao, count(*) FROM wide WHERE sg_uf <> 'ASIA' GROUP BY ALL""")
def publish_year(lake):
    """Two years published, the older one again without one state: that state is gone, nothing is doubled."""
    path = f"{work_dir(lake.spark)}/larga"
    older = _wide(lake).withColumn("ano_censo", F.col("ano_censo") - 1)
    for year in (older, _wide(lake), older.where(F.col("sg_uf") != "ASIA")):
        layouts.publish_year(year, path)
    return layouts.read_years(lake.spark, path).groupBy("ano_censo", "sg_uf", "item_codigo", "situacao").agg(F.count("*").alias("linhas"))


@query("SNK-04_insert_if_absent", "SELECT * FROM event")
def insert_if_absent(lake):
    """A first batch, the same batch again, then everything."""
    table = events_table(lake)
    first = lake.stored("event").where(F.col("vistoria_id") % 3 == 0)
    table.insert_if_absent(first)
    table.insert_if_absent(first)
    table.insert_if_absent(lake.stored("event"))
    return table.read()


@query("SNK-04_first_writer_wins", "SELECT vistoria_id, item_codigo, CASE WHEN vistoria_id % 3 = 0 THEN 7::BIGINT ELSE lsn_origem END AS lsn_origem FROM event")
def first_writer_wins(lake):
    table = events_table(lake)
    table.insert_if_absent(lake.stored("event").where(F.col("vistoria_id") % 3 == 0).withColumn("lsn_origem", F.lit(7).cast("bigint")))
    table.insert_if_absent(lake.stored("event"))
    return table.read().select(*EVENT_KEY, "lsn_origem")


@query("SNK-04_commit_counts", """SELECT 1 AS version, count(*) FILTER (vistoria_id % 3 = 0) AS received, count(*) FILTER (vistoria_id % 3 = 0) AS inserted FROM event
    UNION ALL SELECT 2, count(*), count(*) FILTER (vistoria_id % 3 <> 0) FROM event""")
def commit_counts(lake):
    table = events_table(lake)
    table.insert_if_absent(lake.stored("event").where(F.col("vistoria_id") % 3 == 0))
    table.insert_if_absent(lake.stored("event").where(F.col("vistoria_id") < 0))
    table.insert_if_absent(lake.stored("event"))
    return table.log().select("version", "received", "inserted")


@query("SNK-05_reapply_batch", "SELECT ano_censo, co_entidade, item_codigo, situacao FROM wide")
def reapply_batch(lake):
    """A table that holds two thirds gets everything twice: each (year, school, item) is there once."""
    path, by = f"{work_dir(lake.spark)}/reaplicada", ["ano_censo", "sg_uf"]
    layouts.write(_wide(lake).where(F.col("co_entidade") % 3 != 0), path, by)
    for _ in range(2):
        layouts.reapply(_wide(lake), path, ["ano_censo", "co_entidade", "item_codigo"], by)
    return readers.partitioned(lake.spark, path).select("ano_censo", "co_entidade", "item_codigo", "situacao")


@query("SNK-06_append_batches", "SELECT sg_uf, count(*) AS linhas FROM wide GROUP BY sg_uf")
def append_batches(lake):
    path = f"{work_dir(lake.spark)}/lotes"
    for batch in range(3):
        layouts.write(_wide(lake).where(F.col("co_entidade") % 3 == batch), path, ["ano_censo", "sg_uf"])
    return readers.partitioned(lake.spark, path).groupBy("sg_uf").agg(F.count("*").alias("linhas"))


@query("SNK-07_compaction", "SELECT sg_uf, count(*) AS linhas, -count(*) FILTER (co_entidade % 4 = 3) AS excedente FROM wide GROUP BY sg_uf")
def compaction(lake):
    """Many small appends rewritten as few files: rows and, against the rows with one batch twice, the difference."""
    folder = work_dir(lake.spark)
    for batch in range(4):
        layouts.write(_wide(lake).where(F.col("co_entidade") % 4 == batch), f"{folder}/lotes", ["ano_censo", "sg_uf"])
    layouts.compact(lake.spark, f"{folder}/lotes", f"{folder}/compacta", ["ano_censo", "sg_uf"])
    compacted = readers.partitioned(lake.spark, f"{folder}/compacta")
    doubled = _wide(lake).unionByName(_wide(lake).where(F.col("co_entidade") % 4 == 3))
    surplus = quality.table_difference(compacted.select(*doubled.columns), doubled).groupBy("sg_uf").agg(F.sum("excedente").alias("excedente"))
    return compacted.groupBy("sg_uf").agg(F.count("*").alias("linhas")).join(surplus, "sg_uf", "left").fillna(0, ["excedente"])


@query("SNK-07_table_compaction", "SELECT mes_ocorrencia, count(*) AS linhas FROM event GROUP BY 1")
def table_compaction(lake):
    """A compaction while another writer inserts the last third: nothing is lost and nothing is doubled."""
    table, writer = events_table(lake), lake.stored("event")
    other = events_table(lake)
    other.root, other.commits = table.root, table.commits
    for batch in range(2):
        table.append(writer.where(F.col("vistoria_id") % 3 == batch))
    with ThreadPoolExecutor(2) as pool:
        jobs = [pool.submit(table.compact), pool.submit(other.insert_if_absent, writer.where(F.col("vistoria_id") % 3 != 0))]
        for job in jobs:
            job.result()
    return table.read().groupBy("mes_ocorrencia").agg(F.count("*").alias("linhas"))


@query("AGG-22_stored_fingerprint", f"SELECT mes_ocorrencia, count(*) AS linhas, CAST(sum({HASH64.format(CONTENT_TEXT)}) AS VARCHAR) AS impressao FROM event GROUP BY 1")
def stored_fingerprint(lake):
    """Sums kept with two commits, their compaction and one more commit; no row is read for the answer."""
    table = events_table(lake)
    for batch in range(2):
        table.append(lake.stored("event").where(F.col("vistoria_id") % 3 == batch))
    table.compact()
    table.insert_if_absent(lake.stored("event").where(F.col("vistoria_id") % 3 != 1))
    return table.fingerprint(by_partition=True).withColumn("impressao", F.col("impressao").cast("string"))


@query("PRJ-18_stored_school", "SELECT vistoria_id, item_codigo, situacao, quantidade FROM event WHERE co_entidade BETWEEN 5 AND 8")
def stored_school(lake):
    """Some schools' events of a stored table, from the files that can hold them."""
    table = events_table(lake)
    for low in (0, 40, 80):
        table.append(lake.stored("event").where((F.col("co_entidade") >= low) & (F.col("co_entidade") < (low + 40 if low < 80 else 1 << 40))))
    return table.read(only={"co_entidade": (5, 8)}).select("vistoria_id", "item_codigo", "situacao", "quantidade")


@query("SNK-08_schema_evolution", "SELECT item_codigo, count(*) AS linhas, count(CASE WHEN co_entidade % 2 = 1 THEN vistoria_id END) AS com_posicao FROM latest GROUP BY 1")
def schema_evolution(lake):
    path = f"{work_dir(lake.spark)}/evolucao"
    half = F.col("co_entidade") % 2
    columns = ["co_entidade", "item_codigo", "situacao"]
    layouts.write(lake.latest.where(half == 0).select(*columns), path)
    layouts.write(lake.latest.where(half == 1).select(*columns, F.col("vistoria_id").alias("lsn_origem")), path)
    return readers.partitioned(lake.spark, path, merge_schema=True).groupBy("item_codigo").agg(
        F.count("*").alias("linhas"), F.count("lsn_origem").alias("com_posicao")
    )


@query("SNK-09_same_answer_in_every_layout", """SELECT unnest(['csv', 'nenhum', 'ano', 'ano_uf', 'none', 'snappy', 'zstd']) AS formato, count(*) AS linhas,
    count(*) FILTER (situacao = 'inexistente') AS ausentes FROM wide""")
def same_answer(lake):
    folder = work_dir(lake.spark)
    wide = _wide(lake)
    layouts.csv_copy(wide, f"{folder}/csv")
    stored = {"csv": readers.raw_text(lake.spark, f"{folder}/csv")}
    for name, by in layouts.LAYOUTS.items():
        layouts.write(wide, f"{folder}/{name}", by)
        stored[name] = readers.partitioned(lake.spark, f"{folder}/{name}")
    for codec in layouts.CODECS:
        layouts.write(wide, f"{folder}/{codec}", codec=codec)
        stored[codec] = lake.spark.read.parquet(f"{folder}/{codec}")
    answers = [
        df.agg(F.count("*").alias("linhas"), F.count_if(F.col("situacao") == "inexistente").alias("ausentes")).withColumn("formato", F.lit(name))
        for name, df in stored.items()
    ]
    return readers.union_years(answers)


@query("SORT-01_clustered_layout", "SELECT sg_uf, min(co_municipio) AS primeiro, max(co_municipio) AS ultimo, count(*) AS linhas FROM wide GROUP BY sg_uf")
def clustered_layout(lake):
    path = f"{work_dir(lake.spark)}/ordenada"
    layouts.write(layouts.clustered(_wide(lake), ["sg_uf"], ["co_municipio", "co_entidade", "item_codigo"]), path)
    return lake.spark.read.parquet(path).groupBy("sg_uf").agg(
        F.min("co_municipio").alias("primeiro"), F.max("co_municipio").alias("ultimo"), F.count("*").alias("linhas")
    )


_REFERENCE = "2001-05-30 00:00:00"


def _staged(lake):
    """Staged census tables against origin tables that already hold part of them."""
    active = census.active_schools(census_raw(lake))
    staged = {
        "municipality": census.municipalities(active), "school": census.schools(active),
        "item": census.item_states(active, {c: census_column(c) for c in CATALOG}),
    }
    done = ingest.baseline_inspections(staged["school"].where(F.col("co_entidade") % 2 == 0), _REFERENCE)
    stored = {
        "municipality": staged["municipality"].where(F.col("co_municipio") < 10),
        "school": staged["school"].where(F.col("co_entidade") % 2 == 0),
        "inspection": done,
        "item": ingest.baseline_items(done, staged["item"], _REFERENCE).where(F.col("item_codigo") != "item_7"),
    }
    return staged, stored


_LOCATED = "co_entidade % 13 <> 0 AND co_entidade % 31 <> 0 AND co_entidade % 17 <> 0"


@query("SNK-10_consolidation_counts", f"""SELECT 'municipality' AS tabela, count(DISTINCT co_municipio) AS inseridas FROM school WHERE co_entidade % 13 <> 0 AND co_entidade % 31 <> 0 AND co_municipio >= 10
    UNION ALL SELECT 'school', count(*) FROM school WHERE {_LOCATED} AND co_entidade % 2 = 1
    UNION ALL SELECT 'inspection', count(*) FROM school WHERE {_LOCATED} AND co_entidade % 2 = 1
    UNION ALL SELECT 'item', 7 * count(*) FILTER (co_entidade % 2 = 1) + count(*) FILTER (co_entidade % 2 = 0) FROM school WHERE {_LOCATED}""")
def consolidation_counts(lake):
    new = ingest.consolidate(*_staged(lake), _REFERENCE)
    return quality.run_checks(new).withColumnsRenamed({"teste": "tabela", "falhas": "inseridas"})


@query("SNK-11_baseline_inspections", f"""SELECT ('0x'||substr(md5('censo_escolar|'||co_entidade||'|2001-05-30T00:00:00.000000'),1,15))::BIGINT AS vistoria_id, co_entidade,
    'censo_escolar' AS origem, TIMESTAMP '{_REFERENCE}' AS ocorrido_em, TIMESTAMP '{_REFERENCE}' AS registrado_em FROM school WHERE {_LOCATED}""")
def baseline_inspections(lake):
    return ingest.baseline_inspections(_staged(lake)[0]["school"], _REFERENCE)


def build_star(lake) -> Star:
    """Build from the stored events; exam results and registrations come from their own files."""
    star = Star(lake.spark, work_dir(lake.spark))
    inputs = Inputs(lake.stored("event"), lake.school, lake.municipality, lake.catalog, lake.exam_input)
    star.build(inputs, AS_OF, EXAM_REFERENCE, lake.hot)
    return star


@query("DQ-11_star_build", """SELECT 'dim_escola' AS tabela, count(*) AS linhas FROM school UNION ALL SELECT 'dim_escola_infraestrutura', count(*) FROM profile
    UNION ALL SELECT 'fato_vistoria_item', count(*) FROM fact_item UNION ALL SELECT 'fato_infra_escola_ano', count(*) FROM fact_year
    UNION ALL SELECT 'fato_desempenho_escola_ano', count(*) FROM exam_school UNION ALL SELECT 'dim_item', count(*) FROM catalog
    UNION ALL SELECT 'dim_municipio', count(*) FROM municipality""")
def star_build(lake):
    """The whole star schema built, checked and published; rows per stored table."""
    star = build_star(lake)
    return quality.run_checks({t: star.read(t) for t in TABLES}).withColumnsRenamed({"teste": "tabela", "falhas": "linhas"})


@query("DQ-11_stored_wide_grain_share", f"""SELECT (SELECT sg_uf FROM municipality WHERE co_municipio = p.co_municipio) AS sg_uf, p.rede, CAST(sum(p.n) AS BIGINT) AS escolas,
    round(sum(p.n * p.tem) * 100 / sum(p.n), 1) AS pct_com_item FROM (SELECT co_municipio, rede, item_3::INT::DOUBLE AS tem, count(*) AS n FROM dim_school, fact_year
    WHERE fact_year.co_entidade = dim_school.co_entidade AND ano = {LAST_YEAR} GROUP BY ALL) p WHERE p.tem IS NOT NULL GROUP BY 1, 2""")
def stored_wide_grain_share(lake):
    """A question answered from the stored tables instead of from the events."""
    star = build_star(lake)
    return metrics.wide_grain_share(
        star.read("fato_infra_escola_ano"), star.read("dim_escola"), star.read("dim_municipio"), "item_3", LAST_YEAR
    )


@query("DQ-11_failed_build_leaves_table", "SELECT mes_ocorrencia, count(*) AS linhas FROM event GROUP BY 1")
def failed_build(lake):
    """A replacement that fails on the way is never visible."""
    table = events_table(lake)
    table.insert_if_absent(lake.stored("event"))
    broken = lake.stored("event").withColumn("situacao", F.when(F.col("vistoria_id") > 0, F.raise_error(F.lit("planted"))).otherwise(F.col("situacao")))
    try:
        table.replace(broken)
    except Exception:  # noqa: BLE001 - the planted failure
        pass
    return table.read().groupBy("mes_ocorrencia").agg(F.count("*").alias("linhas"))


