"""Physical plans keep the shape the design promises."""

from pyspark.sql import functions as F

from ledgerlake.operators import facts, history, metrics
from ledgerlake.sources.star import Inputs, Star
from ledgerlake.streaming import run
from tests.conftest import event

import pytest

CODES = ["bib", "lab"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, events, folder):
    events([event(i, "lab", f"2024-01-{1 + i % 28:02d}", "existente", school=i % 5) for i in range(50)]).write.parquet(folder)
    return spark.read.parquet(folder)


def test_one_shuffle_from_events_to_profiles(stored):
    text = plan(history.dim_profile(history.item_change(stored), CODES))
    assert text.count("Exchange") == 1
    # Neither the record time nor the place is needed, so neither is read.
    assert "registrado_em" not in text and "sg_uf" not in text


def test_point_in_time_join_is_one_sort_not_a_range_join(spark, stored, folder):
    history.dim_profile(history.item_change(stored), CODES).write.parquet(f"{folder}-p")
    text = plan(facts.fact_item(stored, spark.read.parquet(f"{folder}-p")))
    assert "Join" not in text and text.count("Exchange") == 1


def test_filters_and_columns_reach_the_scan(spark, stored):
    text = plan(history.latest_in_year(stored, "lab", 2024))
    assert "EqualTo(item_codigo,lab)" in text and "GreaterThanOrEqual(ocorrido_em" in text
    assert "quantidade" not in text


def test_last_year_reads_only_what_is_asked(spark, folder):
    spark.createDataFrame([(1, 2024, True, False)], "co_entidade long, ano int, bib boolean, lab boolean").write.parquet(folder)
    text = plan(facts.last_year_rows(spark.read.parquet(folder), ["bib"]))
    assert "lab" not in text and "HashAggregate" in text and "SortAggregate" not in text


@pytest.fixture
def inputs(spark, events):
    schools = spark.createDataFrame([(1, "E", 7, 2, 1, 2024)], "co_entidade long, no_entidade string, co_municipio int, "
                                    "tp_dependencia int, tp_localizacao int, ano_censo_referencia int")
    places = spark.createDataFrame([(7, "B", "DF", 53)], "co_municipio int, no_municipio string, sg_uf string, co_uf int")
    catalog = spark.createDataFrame([(c, c, "x") for c in CODES], "codigo string, descricao string, categoria string")
    return Inputs(events([event(1, "lab", "2024-01-01", "existente")]), schools, places, catalog)


def test_star_build_is_published_whole_or_not_at_all(spark, events, inputs, folder):
    star = Star(spark, folder)
    with pytest.raises(ValueError):
        star.read("dim_escola")
    assert star.build(inputs, "2025-01-01 00:00:00") == 1
    # An event of an unknown school fails the checks, so the first build stays in place.
    stray = Inputs(events([event(2, "lab", "2024-01-01", "existente", school=99)]), inputs.schools, inputs.municipalities, inputs.catalog)
    with pytest.raises(ValueError, match="escola_do_fato_conhecida"):
        star.build(stray, "2025-01-01 00:00:00")
    # So does an item that no catalog names.
    unknown = Inputs(events([event(3, "sauna", "2024-01-01", "existente")]), inputs.schools, inputs.municipalities, inputs.catalog)
    with pytest.raises(ValueError, match="item_conhecido"):
        star.build(unknown, "2025-01-01 00:00:00")
    assert [r.vistoria_id for r in star.read("fato_vistoria_item").collect()] == [1]
    assert star.read("fato_infra_escola_ano").first().lab is True
    shares = metrics.wide_grain_share(star.read("fato_infra_escola_ano"), star.read("dim_escola"), star.read("dim_municipio"), "lab", 2024)
    assert shares.first().pct_com_item == 100.0


def test_idle_stream_renews_the_drain_instant(spark, folder):
    tables = run.Tables.under(spark, folder)

    class Idle:
        id = "q"
        timestamp = "2026-01-02T03:04:05.678Z"

    run.IdleFreshness(tables, "q").onQueryIdle(Idle())
    assert run.drained_at(tables).select(F.col("drenado_em").cast("string")).first()[0] == "2026-01-02 03:04:05.678"


@pytest.fixture
def no_broadcast(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_stored_star_is_read_in_place(spark, events, inputs, folder, no_broadcast):
    """Joins and aggregates by school over the stored tables exchange nothing by school; neither after the catalog forgot them."""
    rows = [event(i, "lab", f"20{20 + i % 4}-01-{1 + i % 28:02d}", "inexistente" if i % 3 else "existente", school=i % 7) for i in range(60)]
    schools = spark.range(7).selectExpr("id AS co_entidade", "'E' AS no_entidade", "7 AS co_municipio", "2 AS tp_dependencia", "1 AS tp_localizacao", "2024 AS ano_censo_referencia")
    star = Star(spark, folder)
    star.build(Inputs(events(rows), schools, inputs.municipalities, inputs.catalog), "2024-12-31 00:00:00")

    def asked():
        fine, wide, dim = star.read("fato_vistoria_item"), star.read("fato_infra_escola_ano"), star.read("dim_escola")
        return {
            "last": facts.last_year_rows(wide, ["lab"]), "lacking": metrics.lacking_last_year(facts.last_year_rows(wide, ["lab"]), dim, "lab"),
            "now": metrics.lacking_now(history.latest_state(fine), dim, "lab"), "year": metrics.lacking_in_year(wide, dim, "lab", 2023),
            "intervals": star.read("dim_escola_infraestrutura").groupBy("co_entidade").agg(F.max("valid_from")),
        }

    before = {}
    for name, df in asked().items():
        text = plan(df)
        assert "hashpartitioning(co_entidade" not in text, name
        before[name] = sorted(map(str, df.collect()))
    assert "PartitionFilters: [isnotnull(ano" in plan(asked()["year"])
    for table in spark.sql("SHOW TABLES").where("NOT isTemporary").collect():
        if table.tableName.startswith(("dim_", "fato_")):
            spark.sql(f"DROP TABLE {table.tableName}")
    for name, df in asked().items():
        assert "hashpartitioning(co_entidade" not in plan(df), name
        assert sorted(map(str, df.collect())) == before[name]
    assert star.read("fato_infra_escola_ano").count() == len({(r[2], r[5].year) for r in rows})
