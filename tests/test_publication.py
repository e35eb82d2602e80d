"""Several tables and years published as one unit: stops at every step, re-runs, retention, the build gate."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.contracts import CENSUS_COLUMNS
from ledgerlake.sources import ingest, layouts, readers
from ledgerlake.sources.log import CommitLog
from ledgerlake.sources.publication import Draft, Publication
from ledgerlake.sources.star import Inputs, Star
from tests.conftest import event

COLUMNS = {"lab": "IN_LAB", "bib": "IN_BIB"}


def census_file(spark, names, year=2024, lab="1"):
    rows = [(str(year), str(53000000 + i), n, "5300108", "Brasília", "DF", "53", "2", "1", "1", lab, "0") for i, n in enumerate(names)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in [*CENSUS_COLUMNS, *COLUMNS.values()]))


def content(published):
    """What a reader sees of the whole set."""
    schools = sorted((r.ano, r.no_entidade) for r in published.read("escola").collect())
    states = {(r.ano, r.situacao) for r in published.read("vistoria_item").where("item_codigo = 'lab'").collect()}
    return schools, states, published.marker("censo/2024")


OLD = ([(2024, "A"), (2024, "B")], {(2024, "existente")}, "h1")
NEW = ([(2024, "C")], {(2024, "inexistente")}, "h2")


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["before any table", "after one table", "after two tables", "after all tables", "while the entry is made", "after the entry"])
def test_a_stop_at_any_step_leaves_one_whole_set(spark, folder, monkeypatch, step):
    published = Publication(spark, folder)
    assert ingest.publish_census(published, census_file(spark, "AB"), COLUMNS, 2024, "h1")
    assert content(published) == OLD
    begun = []  # the tables are written side by side
    write, create, publish = Draft.write, CommitLog._create, Draft.publish
    limit = {"before any table": 0, "after one table": 1, "after two tables": 2}.get(step)

    def writing(self, *args, **kw):
        begun.append(args[0])
        if limit is not None and begun.index(args[0]) >= limit:
            raise Stop
        return write(self, *args, **kw)

    def entry(self, name, text):
        if step == "while the entry is made":
            raise Stop
        return create(self, name, text)

    def publishing(self, markers=None):
        if step == "after all tables":
            raise Stop
        out = publish(self, markers)
        if step == "after the entry":
            raise Stop
        return out

    monkeypatch.setattr(Draft, "write", writing)
    monkeypatch.setattr(Draft, "publish", publishing)
    monkeypatch.setattr(CommitLog, "_create", entry)
    with pytest.raises(Stop):
        ingest.publish_census(published, census_file(spark, "C", lab="0"), COLUMNS, 2024, "h2")
    monkeypatch.undo()
    again = Publication(spark, folder)
    assert content(again) == (NEW if step == "after the entry" else OLD)
    # The re-run needs no repair: it publishes, or finds its hash there already.
    assert ingest.publish_census(again, census_file(spark, "C", lab="0"), COLUMNS, 2024, "h2") == (step != "after the entry")
    assert content(again) == NEW
    again.vacuum(0)
    assert content(again) == NEW and again.vacuum(0) == 0
    assert spark.read.parquet(f"{folder}/escola").count() == 1


def test_years_are_published_on_their_own(spark, folder):
    published = Publication(spark, folder)
    ingest.publish_census(published, census_file(spark, "A", 2023), COLUMNS, 2023, "x")
    ingest.publish_census(published, census_file(spark, "B"), COLUMNS, 2024, "y")
    assert not ingest.publish_census(published, census_file(spark, "Z"), COLUMNS, 2024, "y")
    assert ingest.publish_census(published, census_file(spark, "BC"), COLUMNS, 2024, "y", force=True)
    schools = published.read("escola")
    assert sorted((r.ano, r.no_entidade) for r in schools.collect()) == [(2023, "A"), (2024, "B"), (2024, "C")]
    assert schools.columns[-1] == "ano" and "build" not in schools.columns
    assert [r.no_entidade for r in published.read("escola", only=[2023]).collect()] == ["A"]
    assert sorted((r.ano, r.no_entidade) for r in published.read("escola", version=2).collect()) == [(2023, "A"), (2024, "B")]
    assert {tuple(r) for r in published.markers().collect()} == {("censo", 2023, "x"), ("censo", 2024, "y")}
    draft = published.draft()
    draft.drop("escola", 2023)
    draft.publish()
    assert {r.ano for r in published.read("escola").collect()} == {2024}
    with pytest.raises(ValueError):
        published.read("escola", only=[2023])
    with pytest.raises(ValueError):
        published.read("nothing")


def test_a_file_of_other_years_or_columns_is_refused(spark, folder):
    published = Publication(spark, folder)
    both = census_file(spark, "A").unionByName(census_file(spark, "B", 2023))
    with pytest.raises(ValueError, match="2024 alone"):
        ingest.publish_census(published, both, COLUMNS, 2024, "h")
    with pytest.raises(ValueError, match="IN_BIB"):
        ingest.publish_census(published, census_file(spark, "A").drop("IN_BIB"), COLUMNS, 2024, "h")
    with pytest.raises(ValueError, match="ano"):
        published.draft().write("escola", spark.range(1).withColumn("ano", F.lit(1)), 2024)
    assert published.version() == 0


def test_a_wide_year_survives_a_stop(spark, folder, monkeypatch):
    schema = "ano_censo int, sg_uf string, co_municipio int, co_entidade long, item_codigo string, situacao string"
    df = spark.createDataFrame([(2024, "DF", 1, 11, "lab", "existente"), (2024, "SP", 2, 12, "lab", "existente")], schema)
    layouts.publish_year(df, folder)
    monkeypatch.setattr(Draft, "publish", lambda self, markers=None: (_ for _ in ()).throw(Stop()))
    with pytest.raises(Stop):
        layouts.publish_year(df.where("sg_uf = 'DF'"), folder)
    monkeypatch.undo()
    assert layouts.read_years(spark, folder).count() == 2
    layouts.publish_year(df.where("sg_uf = 'DF'"), folder)
    assert layouts.read_years(spark, folder).count() == 1
    layouts.wide_years(spark, folder).vacuum(0)
    assert readers.partitioned(spark, f"{folder}/{layouts.WIDE}").count() == 1


# -- star builds -------------------------------------------------------------------------------------

def star_inputs(spark, events, exam_school=1, repeated=False):
    rows = [event(1, "lab", "2024-01-10", "existente"), event(2, "bib", "2024-02-10", "inexistente")]
    schools = spark.createDataFrame([(1, "A", 10, 2, 1, 2024)], "co_entidade long, no_entidade string, co_municipio int, tp_dependencia int, tp_localizacao int, ano_censo_referencia int")
    places = spark.createDataFrame([(10, "X", "DF", 53)], "co_municipio int, no_municipio string, sg_uf string, co_uf int")
    catalog = spark.createDataFrame([("lab", "Lab", "IN_LAB", "a"), ("bib", "Bib", "IN_BIB", "a")], "codigo string, descricao string, coluna_censo string, categoria string")
    exam = spark.createDataFrame([(exam_school, 2024, 500.0)] * (2 if repeated else 1), "co_entidade long, ano int, media_geral double")
    return Inputs(events(rows), schools, places, catalog, exam)


def test_results_are_behind_the_gate(spark, events, folder):
    star = Star(spark, folder)
    assert star.build(star_inputs(spark, events), "2024-12-31 00:00:00", "2024-11-03") == 1
    assert star.read("fato_desempenho_escola_ano").count() == 1
    with pytest.raises(ValueError, match="desempenho_unico"):
        star.build(star_inputs(spark, events, repeated=True), "2024-12-31 00:00:00", "2024-11-03")
    assert star.version() == 1 and star.read("fato_desempenho_escola_ano").count() == 1
    # The refused build is removed by retention, the published one stays.
    assert star.vacuum() == 0
    assert star.vacuum(0) == 7 and star.read("fato_vistoria_item").count() == 2
    star.build(star_inputs(spark, events), "2024-12-31 00:00:00", "2024-11-03")
    assert star.read("dim_escola", version=1).count() == 1
    assert star.vacuum(0) == 7 and star.read("dim_escola").count() == 1


def test_the_gate_names_what_is_wrong_with_results(spark, events, folder):
    inputs = star_inputs(spark, events)
    schools = inputs.schools.select("co_entidade", "co_municipio")
    profiles = spark.createDataFrame([(1, 7, "2024-01-01", "2025-01-01", True)], "co_entidade long, escola_infra_sk long, valid_from string, valid_to string, is_current boolean")
    profiles = profiles.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")})
    results = spark.createDataFrame([(1, 2024, 7), (1, 2024, None), (9, 2024, 8)], "co_entidade long, ano int, escola_infra_sk long")
    fine = spark.createDataFrame([], "vistoria_id long, item_codigo string, co_entidade long, escola_infra_sk long, situacao string")
    wide = spark.createDataFrame([], "co_entidade long, ano int, escola_infra_sk long, pct_existentes double")
    checks = Star.checks(inputs.catalog.withColumnRenamed("codigo", "item_codigo"), schools, inputs.municipalities, profiles, fine, wide, results)
    found = {name: df.count() for name, df in checks.items()}
    assert {k: v for k, v in found.items() if v} == {"desempenho_unico": 1, "escola_do_desempenho_conhecida": 1, "perfil_do_desempenho_conhecido": 1}
