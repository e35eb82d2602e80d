"""Driver tables seen as the library's inputs, once in Spark and once as SQL.

customer = school, nation = municipality, region = state, orders = inspection header,
lineitem = inspected item, events = change stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.contracts import (
    ABSENT, EVENT_CONTENT, ORIGIN_CENSUS, ORIGIN_ON_SITE, ORIGIN_SELF, PRESENT, UNDER_WORK, UNKNOWN, UNUSABLE,
)
from ledgerlake.operators import dashboard, exams, facts, history, ordered
from ledgerlake.session import work_dir

CATALOG = [f"item_{n}" for n in range(1, 8)]


def census_column(code: str) -> str:
    """Flag column of an item: the whole number of its code, so no two items share one."""
    return f"IN_{code.removeprefix('item_')}"


AS_OF = "2001-08-02 00:00:00"
EXAM_YEAR = 2001
EXAM_REFERENCE = "2001-06-01"
LAST_YEAR = 2000


class Lake:
    """Lazily built views over one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str, hot_rows: int = ordered.HOT_ROWS):
        self.spark, self.folder, self.hot_rows = spark, folder, hot_rows
        self._stored: dict[str, DataFrame] = {}

    def stored(self, view: str) -> DataFrame:
        """A view written once to the shared folder and read back, for queries that use it often."""
        if view not in self._stored:
            path = f"{work_dir(self.spark)}/{view}"
            # The target is read off the stored events, which are not built again for it.
            rows = self.planted(self.stored("event")) if view == "target" else getattr(self, view)
            rows.write.parquet(path)
            self._stored[view] = self.spark.read.parquet(path)
        return self._stored[view]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def lines(self) -> DataFrame:
        """lineitem with one row per (order, line): the smallest of the repeated rows."""
        raw = self.table("lineitem")
        rest = [c for c in raw.columns if c not in ("l_orderkey", "l_linenumber")]
        return (
            # Dealt first: the least of structs is found by sorting, which a task would do with all rows of its file.
            raw.repartition("l_orderkey", "l_linenumber").groupBy("l_orderkey", "l_linenumber")
            .agg(F.min(F.struct(*rest)).alias("_r"))
            .select("l_orderkey", "l_linenumber", *[f"_r.{c}" for c in rest])
        )

    @cached_property
    def municipality(self) -> DataFrame:
        return self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("co_municipio"), F.col("n_name").alias("no_municipio"),
            F.col("r_name").alias("sg_uf"), F.col("n_regionkey").alias("co_uf"),
        )

    @cached_property
    def school(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            k.alias("co_entidade"), F.col("c_name").alias("no_entidade"),
            F.col("c_nationkey").alias("co_municipio"),
            (k % 4 + 1).cast("int").alias("tp_dependencia"), (k % 2 + 1).cast("int").alias("tp_localizacao"),
            F.lit(EXAM_YEAR).alias("ano_censo_referencia"),
        )

    @cached_property
    def dim_school(self) -> DataFrame:
        return facts.dim_school(self.school)

    @cached_property
    def school_files(self) -> DataFrame:
        older = self.school.withColumn("ano_censo_referencia", F.lit(EXAM_YEAR - 1))
        newer = self.school.where(F.col("co_entidade") % 3 == 0).withColumn(
            "no_entidade", F.concat("no_entidade", F.lit("-B"))
        )
        return older.unionByName(newer)

    @cached_property
    def catalog(self) -> DataFrame:
        n = F.col("l_linenumber").cast("int")
        return self.table("lineitem").select("l_linenumber").distinct().select(
            F.concat(F.lit("item_"), n).alias("codigo"), F.concat(F.lit("Item "), n).alias("descricao"),
            F.concat(F.lit("IN_"), n).alias("coluna_censo"),
            F.when(n % 2 == 1, "odd").otherwise("even").alias("categoria"),
        )

    @cached_property
    def inspection(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.table("orders").select(
            F.col("o_orderkey").alias("vistoria_id"), F.col("o_custkey").alias("co_entidade"),
            F.col("o_orderdate").alias("ocorrido_em"),
            (F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 20).cast("int"))).alias("registrado_em"),
            F.when(status == "F", ORIGIN_CENSUS).when(status == "O", ORIGIN_ON_SITE).otherwise(ORIGIN_SELF).alias("origem"),
        )

    @cached_property
    def item(self) -> DataFrame:
        pair = F.concat("l_returnflag", "l_linestatus")
        state = (
            F.when(pair.isin("AF", "RF"), PRESENT).when(pair == "AO", ABSENT).when(pair == "NF", UNDER_WORK)
            .when(pair == "NO", UNUSABLE).otherwise(UNKNOWN)
        )
        return self.lines.select(
            F.col("l_orderkey").alias("vistoria_id"),
            F.concat(F.lit("item_"), F.col("l_linenumber")).alias("item_codigo"), state.alias("situacao"),
            F.when(F.col("l_discount") >= 0.03, F.col("l_quantity").cast("int")).alias("quantidade"),
        )

    @cached_property
    def event(self) -> DataFrame:
        rows = facts.canonical_events(self.inspection, self.item, self.school, self.municipality)
        line = F.substring("item_codigo", 6, 2).cast("int")
        return rows.withColumn("lsn_origem", F.when(line >= 4, F.col("vistoria_id")))

    @cached_property
    def hot(self) -> DataFrame | None:
        """Schools that may exceed the row limit: an inspection holds at most one row per item."""
        return ordered.hot_keys(self.inspection, ["co_entidade"], self.hot_rows // len(CATALOG))

    @cached_property
    def item_change(self) -> DataFrame:
        return history.item_change(self.event, self.hot)

    @cached_property
    def profile(self) -> DataFrame:
        return history.dim_profile(self.item_change, CATALOG, self.hot is not None)

    @cached_property
    def fact_item(self) -> DataFrame:
        return facts.fact_item(self.event, self.profile, self.hot)

    @cached_property
    def fact_year(self) -> DataFrame:
        return facts.fact_year(self.event, self.profile, CATALOG, AS_OF, self.hot)

    @cached_property
    def exam_raw(self) -> DataFrame:
        """Exam rows as the raw text file would hold them."""
        rows = self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        k, flag, status = F.col("o_custkey"), F.col("l_returnflag"), F.col("l_linestatus")
        has_school = F.col("o_orderkey") % 10 != 0
        first = F.when(flag == "R", "0").otherwise("1")
        second = F.when((flag == "N") & (status == "O"), "2").otherwise("1")
        out = rows.select(
            F.lit(str(EXAM_YEAR)).alias("NU_ANO"),
            F.when(has_school, k).cast("string").alias("CO_ESCOLA"),
            F.when(has_school, k % 25).cast("string").alias("CO_MUNICIPIO_ESC"),
            F.when(has_school, F.concat(F.lit("U"), k % 5)).alias("SG_UF_ESC"),
            F.when(has_school, k % 4 + 1).cast("string").alias("TP_DEPENDENCIA_ADM_ESC"),
            F.when(has_school, k % 2 + 1).cast("string").alias("TP_LOCALIZACAO_ESC"),
            F.when(has_school, F.lit("1")).alias("TP_SIT_FUNC_ESC"),
            first.alias("TP_PRESENCA_CN"), second.alias("TP_PRESENCA_CH"),
            second.alias("TP_PRESENCA_LC"), first.alias("TP_PRESENCA_MT"),
            (F.col("l_quantity") * 20).cast("string").alias("NU_NOTA_CN"),
            F.round(F.col("l_extendedprice") / 110, 1).cast("string").alias("NU_NOTA_CH"),
            (F.col("l_partkey") % 1000).cast("string").alias("NU_NOTA_LC"),
            F.when(F.col("l_tax") != 0, F.round(F.col("l_tax") * 10000)).cast("string").alias("NU_NOTA_MT"),
            F.when(first == "1", "1").alias("TP_STATUS_REDACAO"),
            F.round(F.col("l_discount") * 10000).cast("string").alias("NU_NOTA_REDACAO"),
        )
        return out

    @cached_property
    def participant(self) -> DataFrame:
        return exams.participants(self.exam_raw)

    @cached_property
    def exam_school(self) -> DataFrame:
        return exams.school_results(self.participant)

    @cached_property
    def exam_input(self) -> DataFrame:
        return exams.prepared(self.exam_school)

    @cached_property
    def census_for_exam(self) -> DataFrame:
        return self.school.where(F.col("co_entidade") % 7 != 0)

    @cached_property
    def performance(self) -> DataFrame:
        return self._performance(self.profile)

    def _performance(self, profile: DataFrame) -> DataFrame:
        return facts.fact_performance(self.exam_input, self.census_for_exam, profile, EXAM_REFERENCE, self.hot)

    @cached_property
    def performance_years(self) -> DataFrame:
        """Results of two years: the year before has other scores and half of the schools twice as good."""
        lower = F.when(F.col("co_entidade") % 2 == 0, F.col("media_geral") / 2).otherwise(F.col("media_geral") + 3)
        before = self.performance.withColumns({
            "ano": (F.col("ano") - 1).cast("smallint"), "media_geral": lower, "media_cn": F.col("media_cn") + 1,
            "data_referencia_infraestrutura": F.date_sub("data_referencia_infraestrutura", 400),
        })
        return self.performance.unionByName(before)

    @cached_property
    def school_years(self) -> DataFrame:
        """Registrations of two years; the year before, every school was in the state network."""
        before = self.dim_school.withColumns({"ano_censo_referencia": F.col("ano_censo_referencia") - 1, "rede": F.lit("estadual")})
        return self.dim_school.unionByName(before)

    @cached_property
    def exam_years(self) -> DataFrame:
        """Exam schools of two years: half of them also the year before."""
        before = self.exam_input.where(F.col("co_entidade") % 2 == 0).withColumn("ano", (F.col("ano") - 1).cast("smallint"))
        return self.exam_input.unionByName(before)

    @cached_property
    def census_years(self) -> DataFrame:
        """Registrations of two years, of different schools; some schools are registered twice for one year."""
        before = self.school.where(F.col("co_entidade") % 5 != 0).withColumn("ano_censo_referencia", F.col("ano_censo_referencia") - 1)
        again = self.census_for_exam.where(F.col("co_entidade") % 11 == 0)
        return self.census_for_exam.unionByName(before).unionByName(again)

    @cached_property
    def latest(self) -> DataFrame:
        return history.latest_state(self.event)

    @cached_property
    def wide(self) -> DataFrame:
        """Wide analytic table over the current state of every known item."""
        return facts.wide_table(self.latest, self.school, self.municipality)

    @cached_property
    def census_at(self) -> DataFrame:
        return self._census(self.profile)

    @cached_property
    def census_beside_exam(self) -> DataFrame:
        """``census_at`` for queries that read the exam too: off the profiles stored for both."""
        return self._census(self.stored("profile_of_exam"))

    @cached_property
    def profile_of_exam(self) -> DataFrame:
        """Versions that a lookup at the exam's reference can find; one without a start comes before all others."""
        t = F.lit(EXAM_REFERENCE).cast("timestamp_ntz")
        begun = F.col("valid_from").isNull() | (F.col("valid_from") <= t)
        return self.profile.where(begun & (t < F.col("valid_to")))

    def _census(self, profile: DataFrame) -> DataFrame:
        return dashboard.census_base(self.dim_school, self.municipality, history.profile_at(profile, EXAM_REFERENCE))

    @cached_property
    def exam_at(self) -> DataFrame:
        # The lookup at the reference and the join by key both read the profiles, which are built once.
        profile = self.stored("profile_of_exam")
        return dashboard.exam_base(self._performance(profile), self.dim_school, profile)

    @cached_property
    def exam_slice(self) -> DataFrame:
        return dashboard.exam_slice(self.exam_at, self.census_beside_exam)

    @cached_property
    def target(self) -> DataFrame:
        """The event table with planted losses, differences and extra rows."""
        return self.planted(self.event)

    @staticmethod
    def planted(event: DataFrame) -> DataFrame:
        k = F.col("vistoria_id")
        kept = event.where(k % 101 != 0).withColumn(
            "quantidade", F.when(k % 103 == 0, F.col("quantidade") + 1).otherwise(F.col("quantidade"))
        )
        extra = event.where(k % 107 == 0).withColumn("vistoria_id", -k - 1)
        return kept.unionByName(extra)

    @cached_property
    def stream(self) -> DataFrame:
        """Change envelope derived from the events table; values are text, as captured."""
        raw = self.table("events")
        k = F.get_json_object("props", "$.k").cast("int")
        kind = F.col("event_type")
        state = (
            F.when(kind == "signup", PRESENT).when(kind == "click", ABSENT).when(kind == "view", UNDER_WORK)
            .when(kind == "purchase", UNUSABLE).otherwise(UNKNOWN)
        )
        bad_op = F.when(k % 3 == 0, "update").when(k % 3 == 1, "delete").otherwise("truncate")
        return raw.select(
            F.col("event_id").alias("lsn"), F.col("ts").alias("commit_ts"),
            F.lit("vistoria_item").alias("tabela"),
            F.when(kind == "error", bad_op).otherwise("insert").alias("op"),
            F.col("user_id").cast("string").alias("vistoria_id"),
            F.concat(F.lit("item_"), k % 7 + 1).alias("item_codigo"),
            F.when(k != 13, state).alias("situacao"),
            F.when(k % 25 == 0, "many").otherwise(k.cast("string")).alias("quantidade"),
            (F.col("ts") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), k.cast("decimal(18,6)"))).alias("record_ts"),
            (F.col("ts") - F.make_dt_interval((k % 12).cast("int"))).alias("event_ts"),
        )

    @cached_property
    def changes(self) -> DataFrame:
        """The stream as an envelope: captured values in one map."""
        s = self.stream
        names = ("vistoria_id", "item_codigo", "situacao", "quantidade")
        values = F.create_map(*[x for n in names for x in (F.lit(n), F.col(n))])
        return s.select("lsn", F.col("lsn").alias("seq"), "commit_ts", "tabela", "op", values.alias("valores"))

    @cached_property
    def deliveries(self) -> DataFrame:
        """Telemetry-like rows with planted re-deliveries, inversions and unknown instants."""
        lsn = F.col("lsn")
        known = lsn % 29 != 0
        return self.stream.select(
            F.when(lsn >= 0, "principal").otherwise("outro").alias("fluxo"), F.col("commit_ts").alias("passada_em"), lsn.alias("posicao_na_passada"),
            F.when(lsn % 17 == 0, lsn - 25).otherwise(lsn).alias("lsn_fim"),
            F.when(known, F.col("record_ts")).alias("registrado_em"), F.when(known, F.col("event_ts")).alias("ocorrido_em"),
        )

    @cached_property
    def stream_headers(self) -> DataFrame:
        """Readable inspection headers for the stream: every user but multiples of 50."""
        users = self.table("events").select("user_id").distinct().where(F.col("user_id") % 50 != 0)
        u = F.col("user_id")
        return users.select(
            u.alias("vistoria_id"), (u * 7).alias("co_entidade"), F.concat(F.lit("U"), u % 5).alias("sg_uf"),
            F.lit(ORIGIN_ON_SITE).alias("origem"),
            (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((u % 90).cast("int"))).alias("ocorrido_em"),
            (F.lit("2024-01-03").cast("timestamp_ntz") + F.make_dt_interval((u % 90 + u % 15).cast("int"))).alias("registrado_em"),
        )


# ---------------------------------------------------------------------------------------------
# The same views as SQL. Each entry may use the ones above it; ``sql()`` pulls in what it needs.

_STATE = (
    f"CASE WHEN l_returnflag||l_linestatus IN ('AF','RF') THEN '{PRESENT}'"
    f" WHEN l_returnflag||l_linestatus = 'AO' THEN '{ABSENT}'"
    f" WHEN l_returnflag||l_linestatus = 'NF' THEN '{UNDER_WORK}'"
    f" WHEN l_returnflag||l_linestatus = 'NO' THEN '{UNUSABLE}' ELSE '{UNKNOWN}' END"
)
_KEY = "('0x'||substr(md5({0}),1,15))::BIGINT"
HASH64 = "('0x'||substr(md5({0}),17,16))::UBIGINT::DECIMAL(28,0)"
MAX = "TIMESTAMP '9999-12-31 23:59:59.999999'"
CONTENT_TEXT = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR),'nulo')" for c in EVENT_CONTENT) + ")"
_NOTES = ("cn", "ch", "lc", "mt", "redacao")

def _mean(x: str) -> str:
    """Mean over exact decimals: the same whatever the order of the rows."""
    return f"sum({x}::DECIMAL(18,6))::DOUBLE / nullif(count({x}), 0)"


VIEWS: dict[str, str] = {
    "li": """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
        l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
    "municipality": """SELECT n_nationkey AS co_municipio, n_name AS no_municipio, r_name AS sg_uf, n_regionkey AS co_uf
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "school": f"""SELECT c_custkey AS co_entidade, c_name AS no_entidade, c_nationkey AS co_municipio,
        CAST(c_custkey % 4 + 1 AS INT) AS tp_dependencia, CAST(c_custkey % 2 + 1 AS INT) AS tp_localizacao,
        {EXAM_YEAR} AS ano_censo_referencia FROM customer""",
    "dim_school": """SELECT co_entidade, no_entidade, co_municipio, tp_dependencia,
        ['federal','estadual','municipal','privada'][tp_dependencia] AS rede,
        CASE tp_localizacao WHEN 1 THEN 'urbana' ELSE 'rural' END AS localizacao, ano_censo_referencia FROM school""",
    "school_files": f"""SELECT * REPLACE ({EXAM_YEAR - 1} AS ano_censo_referencia) FROM school
        UNION ALL SELECT * REPLACE (no_entidade||'-B' AS no_entidade) FROM school WHERE co_entidade % 3 = 0""",
    "catalog": """SELECT 'item_'||i AS codigo, 'Item '||i AS descricao, 'IN_'||i AS coluna_censo,
        CASE WHEN i % 2 = 1 THEN 'odd' ELSE 'even' END AS categoria FROM (SELECT DISTINCT l_linenumber AS i FROM lineitem)""",
    "inspection": f"""SELECT o_orderkey AS vistoria_id, o_custkey AS co_entidade, o_orderdate AS ocorrido_em,
        o_orderdate + to_days(CAST(o_orderkey % 20 AS INT)) AS registrado_em,
        CASE o_orderstatus WHEN 'F' THEN '{ORIGIN_CENSUS}' WHEN 'O' THEN '{ORIGIN_ON_SITE}' ELSE '{ORIGIN_SELF}' END AS origem
        FROM orders""",
    "item": f"""SELECT l_orderkey AS vistoria_id, 'item_'||l_linenumber AS item_codigo, {_STATE} AS situacao,
        CASE WHEN l_discount >= 0.03::DOUBLE THEN CAST(l_quantity AS INT) END AS quantidade FROM li""",
    "event": """SELECT vistoria_id, item_codigo, co_entidade, sg_uf, origem, ocorrido_em, registrado_em, situacao,
        quantidade, strftime(ocorrido_em, '%Y-%m') AS mes_ocorrencia,
        CASE WHEN CAST(substr(item_codigo, 6) AS INT) >= 4 THEN vistoria_id END AS lsn_origem
        FROM item JOIN inspection USING (vistoria_id) JOIN school USING (co_entidade) JOIN municipality USING (co_municipio)""",
    "known": f"""SELECT co_entidade, item_codigo, situacao, quantidade, ocorrido_em AS desde, vistoria_id
        FROM event WHERE situacao <> '{UNKNOWN}'""",
    "known_in_year": f"""SELECT co_entidade, item_codigo, situacao, ocorrido_em, vistoria_id, date_part('year', ocorrido_em) AS ano
        FROM event WHERE situacao <> '{UNKNOWN}'""",
    "runs": """SELECT *, CAST(sum(inicia_trecho) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS trecho FROM (
        SELECT *, CAST(situacao IS DISTINCT FROM lag(situacao) OVER (PARTITION BY co_entidade, item_codigo
        ORDER BY desde, vistoria_id) AS INT) AS inicia_trecho FROM known)
        WINDOW w AS (PARTITION BY co_entidade, item_codigo ORDER BY desde, vistoria_id)""",
    "in_force": """SELECT *, last_value(quantidade IGNORE NULLS) OVER (PARTITION BY co_entidade, item_codigo, trecho
        ORDER BY desde, vistoria_id ROWS UNBOUNDED PRECEDING) AS quantidade_vigente FROM runs""",
    "change_rows": """SELECT co_entidade, item_codigo, situacao, quantidade_vigente AS quantidade, desde, vistoria_id FROM (
        SELECT *, lag(quantidade_vigente) OVER (PARTITION BY co_entidade, item_codigo ORDER BY desde, vistoria_id) AS antes
        FROM in_force) WHERE inicia_trecho = 1 OR quantidade_vigente IS DISTINCT FROM antes""",
    "item_change": f"""SELECT *, coalesce(lead(desde) OVER (PARTITION BY co_entidade, item_codigo ORDER BY desde, vistoria_id),
        {MAX}) AS ate FROM change_rows""",
    # A version begins wherever something changed; its states are folded from all changes up to then.
    "version": """SELECT co_entidade, desde AS em, max(vistoria_id) AS vistoria_origem_id FROM change_rows GROUP BY co_entidade, desde""",
    "folded": """SELECT v.co_entidade, v.em, c.item_codigo, arg_max(c.situacao, (c.desde, c.vistoria_id)) AS situacao,
        arg_max(struct_pack(q := c.quantidade), (c.desde, c.vistoria_id)).q AS quantidade
        FROM version v JOIN change_rows c ON c.co_entidade = v.co_entidade AND c.desde <= v.em GROUP BY v.co_entidade, v.em, c.item_codigo""",
    "tally": """SELECT co_entidade, em, CAST(count(*) AS BIGINT) AS n, histogram(situacao) AS h, map_from_entries(list((item_codigo, situacao))) AS m,
        list_sort(list(item_codigo||'='||situacao)) AS i,
        list_sort(list(item_codigo||'='||quantidade) FILTER (quantidade IS NOT NULL)) AS q FROM folded GROUP BY co_entidade, em""",
    "profile": f"""SELECT {_KEY.format("t.co_entidade::VARCHAR||'|'||strftime(t.em,'%Y-%m-%dT%H:%M:%S.%f')")} AS escola_infra_sk,
        t.co_entidade, t.em AS valid_from, coalesce(n.em, {MAX}) AS valid_to, n.em IS NULL AS is_current, v.vistoria_origem_id,
        t.n AS n_itens_conhecidos, """
    + ", ".join(
        f"CAST(coalesce(t.h['{state}'], 0) AS BIGINT) AS {name}"
        for state, name in ((PRESENT, "n_existentes"), (ABSENT, "n_inexistentes"), (UNDER_WORK, "n_em_obra"), (UNUSABLE, "n_inutilizaveis"))
    )
    + """, t.m, array_to_string(t.i, ',') AS itens, coalesce(array_to_string(t.q, ','), '') AS quantidades
        FROM tally t JOIN version v USING (co_entidade, em) ASOF LEFT JOIN version n ON n.co_entidade = t.co_entidade AND t.em < n.em""",
    "fact_item": """SELECT e.vistoria_id, e.item_codigo, e.co_entidade, e.ocorrido_em, CAST(e.ocorrido_em AS DATE) AS data_ocorrencia,
        e.origem, p.escola_infra_sk, e.situacao, e.quantidade FROM event e LEFT JOIN profile p
        ON p.co_entidade = e.co_entidade AND e.ocorrido_em >= p.valid_from AND e.ocorrido_em < p.valid_to""",
    "year_end": f"""SELECT DISTINCT co_entidade, CAST(date_part('year', ocorrido_em) AS INT) AS ano,
        least(make_timestamp(CAST(date_part('year', ocorrido_em) AS BIGINT) + 1, 1, 1, 0, 0, 0) - INTERVAL 1 MILLISECOND, TIMESTAMP '{AS_OF}') AS em FROM event""",
    "fact_year": """SELECT y.co_entidade, y.ano, p.escola_infra_sk, coalesce(p.n_itens_conhecidos, 0) AS n_itens_conhecidos,
        coalesce(p.n_existentes, 0) AS n_existentes, coalesce(p.n_inexistentes, 0) AS n_inexistentes, coalesce(p.n_em_obra, 0) AS n_em_obra,
        coalesce(p.n_inutilizaveis, 0) AS n_inutilizaveis, round(100.0::DOUBLE * p.n_existentes / p.n_itens_conhecidos, 2) AS pct_existentes, """
    + ", ".join(f"p.m['{c}'] = '{PRESENT}' AS {c}" for c in CATALOG)
    + """ FROM year_end y ASOF LEFT JOIN profile p ON p.co_entidade = y.co_entidade AND y.em >= p.valid_from""",
    "exam_row": """SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS co_escola,
        CASE l_returnflag WHEN 'R' THEN '0' ELSE '1' END AS p1,
        CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN '2' ELSE '1' END AS p2,
        l_quantity*20 AS s_cn, round(l_extendedprice/110, 1) AS s_ch, (l_partkey % 1000)::DOUBLE AS s_lc,
        CASE WHEN l_tax <> 0 THEN round(l_tax*10000) END AS s_mt, round(l_discount*10000) AS s_re
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "sitting": "SELECT row_number() OVER () AS pessoa, * FROM exam_row",
    # One row per person and area; a score of a day the person missed does not count.
    "mark": " UNION ALL ".join(
        f"SELECT pessoa, co_escola, '{a}' AS area, CASE WHEN {day} = '1' THEN s_{'re' if a == 'redacao' else a} END AS nota, {day} = '1' AS veio FROM sitting"
        for a, day in (("cn", "p1"), ("ch", "p2"), ("lc", "p2"), ("mt", "p1"), ("redacao", "p1"))
    ),
    "person": f"""SELECT pessoa, any_value(co_escola) AS co_escola, count(nota) AS validas, sum(nota::DECIMAL(18,6)) AS soma,
        count(*) FILTER (area <> 'redacao' AND veio AND nota IS NULL) AS faltantes,
        count(*) FILTER (area <> 'redacao' AND nota = 0) AS zeros, count(*) FILTER (area = 'redacao' AND nota = 0) AS redacao_zero
        FROM mark GROUP BY pessoa""",
    "participant": f"""SELECT {EXAM_YEAR}::SMALLINT AS ano, any_value(co_escola) AS co_escola, CAST(any_value(co_escola) % 25 AS INT) AS co_municipio_esc,
        'U'||(any_value(co_escola) % 5) AS sg_uf_esc, CAST(any_value(co_escola) % 4 + 1 AS SMALLINT) AS tp_dependencia_adm_esc,
        CAST(any_value(co_escola) % 2 + 1 AS SMALLINT) AS tp_localizacao_esc,
        CASE WHEN any_value(co_escola) IS NOT NULL THEN 1::SMALLINT END AS tp_sit_func_esc, """
    + ", ".join(f"max(nota) FILTER (area = '{a}') AS nota_{a}" + ("" if a == "redacao" else f", bool_or(area = '{a}' AND veio AND nota IS NULL) AS faltante_{a}") for a in _NOTES)
    + " FROM mark GROUP BY pessoa",
    "school_area": f"SELECT co_escola, area, count(nota) AS validas, {_mean('nota')} AS media FROM mark GROUP BY co_escola, area",
    "school_people": """SELECT co_escola, count(*) AS participantes, count(*) FILTER (validas = 5) AS completas, count(*) FILTER (validas = 0) AS vazias,
        (sum(soma) FILTER (validas = 5))::DOUBLE / nullif(5 * count(*) FILTER (validas = 5), 0) AS media_geral,
        CAST(sum(redacao_zero) AS BIGINT) AS redacoes_nota_zero FROM person GROUP BY co_escola""",
    "exam_school": f"""SELECT {EXAM_YEAR}::SMALLINT AS ano, g.co_escola, CAST(g.co_escola % 25 AS INT) AS co_municipio_esc, 'U'||(g.co_escola % 5) AS sg_uf_esc,
        CAST(g.co_escola % 4 + 1 AS SMALLINT) AS tp_dependencia_adm_esc, CAST(g.co_escola % 2 + 1 AS SMALLINT) AS tp_localizacao_esc,
        1::SMALLINT AS tp_sit_func_esc, g.participantes, g.completas AS participantes_com_todas_as_notas, g.vazias AS participantes_sem_nota_valida, """
    + ", ".join(f"a_{a}.validas AS notas_validas_{a}, a_{a}.media AS media_{a}" for a in _NOTES)
    + """, g.redacoes_nota_zero, g.media_geral, g.participantes < 10 AS poucos_participantes FROM school_people g """
    + " ".join(f"JOIN school_area a_{a} ON a_{a}.co_escola = g.co_escola AND a_{a}.area = '{a}'" for a in _NOTES),
    "census_for_exam": "SELECT * FROM school WHERE co_entidade % 7 <> 0",
    "performance": f"""SELECT e.*, p.escola_infra_sk FROM (SELECT * FROM exam_school
          WHERE co_escola IN (SELECT co_entidade FROM census_for_exam)) e LEFT JOIN profile p
        ON p.co_entidade = e.co_escola AND TIMESTAMP '{EXAM_REFERENCE}' >= p.valid_from AND TIMESTAMP '{EXAM_REFERENCE}' < p.valid_to""",
    "performance_years": """SELECT ano, co_escola, media_geral, media_cn, escola_infra_sk FROM performance
        UNION ALL SELECT ano - 1, co_escola, CASE co_escola % 2 WHEN 0 THEN media_geral / 2 ELSE media_geral + 3 END, media_cn + 1,
        escola_infra_sk FROM performance""",
    "school_years": """SELECT ano_censo_referencia AS ano, co_entidade, co_municipio, rede FROM dim_school
        UNION ALL SELECT ano_censo_referencia - 1, co_entidade, co_municipio, 'estadual' FROM dim_school""",
    "priority_base": f"""SELECT r.co_escola AS co_entidade, s.rede, m.sg_uf, r.media_geral FROM performance_years r
        JOIN school_years s ON s.co_entidade = r.co_escola AND s.ano = r.ano AND s.rede <> 'privada' JOIN municipality m USING (co_municipio)
        WHERE r.ano = {EXAM_YEAR} AND r.media_geral IS NOT NULL""",
    "target": """SELECT * REPLACE (CASE WHEN vistoria_id % 103 = 0 THEN quantidade + 1 ELSE quantidade END AS quantidade)
        FROM event WHERE vistoria_id % 101 <> 0
        UNION ALL SELECT * REPLACE (-vistoria_id - 1 AS vistoria_id) FROM event WHERE vistoria_id % 107 = 0""",
    "latest": f"""SELECT co_entidade, item_codigo, situacao, quantidade, ocorrido_em AS vigente_desde, vistoria_id FROM event
        WHERE situacao <> '{UNKNOWN}' QUALIFY row_number() OVER (PARTITION BY co_entidade, item_codigo
        ORDER BY ocorrido_em DESC, vistoria_id DESC) = 1""",
    "stream": f"""SELECT event_id AS lsn, ts AS commit_ts, 'vistoria_item' AS tabela,
        CASE WHEN event_type <> 'error' THEN 'insert' WHEN k % 3 = 0 THEN 'update' WHEN k % 3 = 1 THEN 'delete' ELSE 'truncate' END AS op,
        user_id::VARCHAR AS vistoria_id, 'item_'||(k % 7 + 1) AS item_codigo,
        CASE WHEN k = 13 THEN NULL WHEN event_type = 'signup' THEN '{PRESENT}' WHEN event_type = 'click' THEN '{ABSENT}'
          WHEN event_type = 'view' THEN '{UNDER_WORK}' WHEN event_type = 'purchase' THEN '{UNUSABLE}' ELSE '{UNKNOWN}' END AS situacao,
        CASE WHEN k % 25 = 0 THEN 'many' ELSE k::VARCHAR END AS quantidade,
        ts - to_seconds(k) AS record_ts, ts - to_days(k % 12) AS event_ts
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
    "deliveries": """SELECT CASE WHEN lsn >= 0 THEN 'principal' ELSE 'outro' END AS fluxo, commit_ts AS passada_em, lsn AS posicao_na_passada,
        CASE WHEN lsn % 17 = 0 THEN lsn - 25 ELSE lsn END AS lsn_fim,
        CASE WHEN lsn % 29 <> 0 THEN record_ts END AS registrado_em, CASE WHEN lsn % 29 <> 0 THEN event_ts END AS ocorrido_em
        FROM stream""",
    "stream_headers": f"""SELECT user_id AS vistoria_id, user_id*7 AS co_entidade, 'U'||(user_id % 5) AS sg_uf,
        '{ORIGIN_ON_SITE}' AS origem, TIMESTAMP '2024-01-01' + to_days(CAST(user_id % 90 AS INT)) AS ocorrido_em,
        TIMESTAMP '2024-01-03' + to_days(CAST(user_id % 90 + user_id % 15 AS INT)) AS registrado_em
        FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 50 <> 0)""",
    "checked": """SELECT s.*, h.co_entidade, h.sg_uf, h.origem, h.ocorrido_em, h.registrado_em,
        CASE WHEN h.vistoria_id IS NULL THEN 'KeyError: '||s.vistoria_id
          WHEN TRY_CAST(s.quantidade AS BIGINT) IS NULL THEN 'ValueError: quantidade '||s.quantidade
          WHEN s.situacao IS NULL THEN 'ValueError: coluna obrigatória nula: situacao' END AS motivo
        FROM stream s LEFT JOIN stream_headers h ON h.vistoria_id = CAST(s.vistoria_id AS BIGINT) WHERE s.op = 'insert'""",
    "delivered": """SELECT CAST(vistoria_id AS BIGINT) AS vistoria_id, item_codigo, co_entidade, sg_uf, origem, ocorrido_em, registrado_em,
        situacao, CAST(quantidade AS INT) AS quantidade, strftime(ocorrido_em, '%Y-%m') AS mes_ocorrencia, lsn AS lsn_origem
        FROM checked WHERE motivo IS NULL""",
    "stored": """SELECT * FROM delivered QUALIFY row_number() OVER (PARTITION BY vistoria_id, item_codigo ORDER BY lsn_origem) = 1""",
    "queue": """SELECT lsn AS lsn_origem, 'vistoria_item/insert/'||vistoria_id||'/'||item_codigo AS chave, commit_ts AS confirmada_em,
        tabela, op AS operacao, CAST(vistoria_id AS BIGINT) AS vistoria_id, item_codigo, substr(motivo, 1, 200) AS motivo
        FROM checked WHERE motivo IS NOT NULL
        UNION ALL SELECT lsn, 'vistoria_item/'||op||'/'||vistoria_id||'/'||item_codigo, commit_ts, tabela, op,
        CAST(vistoria_id AS BIGINT), item_codigo, 'violacao_insert_only' FROM stream WHERE op <> 'insert'""",
    "compared": """SELECT coalesce(o.vistoria_id, t.vistoria_id) AS vistoria_id, coalesce(o.item_codigo, t.item_codigo) AS item_codigo,
        CAST(coalesce(o.registrado_em, t.registrado_em) AS DATE) AS dia, t.lsn_origem IS NOT NULL AS veio_do_cdc,
        CASE WHEN o.vistoria_id IS NULL THEN 'so_no_destino' WHEN t.vistoria_id IS NULL THEN 'so_na_origem'
          WHEN o.quantidade IS NOT DISTINCT FROM t.quantidade THEN 'iguais' ELSE 'diferentes' END AS situacao
        FROM event o FULL JOIN target t ON t.vistoria_id = o.vistoria_id AND t.item_codigo = o.item_codigo""",
    "wide": """SELECT ano_censo_referencia AS ano_censo, sg_uf, co_municipio, no_municipio, co_entidade, tp_dependencia, tp_localizacao,
        item_codigo, situacao FROM latest JOIN school USING (co_entidade) JOIN municipality USING (co_municipio)""",
    "census_at": f"""SELECT s.co_entidade, s.tp_dependencia, s.localizacao, s.co_municipio, m.no_municipio, m.sg_uf,
        p.escola_infra_sk AS perfil, p.m FROM dim_school s LEFT JOIN municipality m USING (co_municipio) LEFT JOIN profile p
        ON p.co_entidade = s.co_entidade AND TIMESTAMP '{EXAM_REFERENCE}' >= p.valid_from AND TIMESTAMP '{EXAM_REFERENCE}' < p.valid_to""",
    "exam_at": """SELECT e.*, e.escola_infra_sk AS perfil, p.m FROM performance e LEFT JOIN profile p
        ON p.escola_infra_sk = e.escola_infra_sk AND p.co_entidade = e.co_escola""",
    "exam_slice": """SELECT e.*, s.tp_dependencia, s.localizacao, s.sg_uf,
        ['Federal','Estadual','Municipal','Privada'][s.tp_dependencia] AS rede
        FROM exam_at e JOIN census_at s ON s.co_entidade = e.co_escola""",
}


def _needs(text: str, known: Sequence[str]) -> set[str]:
    import re

    words = set(re.findall(r"[a-z_0-9]+", text))
    return {v for v in known if v in words}


def sql(body: str) -> str:
    """``body`` preceded by the views it uses, directly or not."""
    names = list(VIEWS)
    wanted: set[str] = set()
    todo = _needs(body, names)
    while todo:
        wanted |= todo
        todo = {n for w in todo for n in _needs(VIEWS[w], names[: names.index(w)])} - wanted
    ordered = [n for n in names if n in wanted]
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    return f"WITH {ctes}\n{body}" if ctes else body
