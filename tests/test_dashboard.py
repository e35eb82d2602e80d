"""Dashboard calculations and data checks on the twenty-school base."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import dashboard, quality, workload

CATALOG = ["biblioteca", "internet"]


@pytest.fixture
def census(spark):
    rows = [(i, 2, "urbana", 1 if i <= 10 else 2, "B" if i <= 10 else "S", "DF" if i <= 10 else "SP", 100 + i,
             {"biblioteca": "existente", "internet": "inexistente"}) for i in range(1, 21)]
    return spark.createDataFrame(rows, "co_entidade long, tp_dependencia int, localizacao string, co_municipio int, no_municipio string, "
                                       "sg_uf string, perfil long, itens map<string,string>")


@pytest.fixture
def exam(spark):
    rows = [(i, 100 + i, 10, 500.0 + i, 400.0 + i, 450.0 + i, 490.0 + i, 510.0 + i, 600.0 + i,
             {"biblioteca": "existente" if i > 10 else "inexistente"}) for i in range(1, 21)]
    return spark.createDataFrame(rows, "co_entidade long, perfil long, n_participantes long, media_geral double, media_cn double, "
                                       "media_ch double, media_lc double, media_mt double, media_redacao double, itens map<string,string>")


def test_slice(census, exam):
    for uf, mean in (("DF", 505.5), ("SP", 515.5)):
        here = census.where(dashboard.slice_filter(uf=uf, network="publica", location="urbana"))
        rows = dashboard.exam_slice(exam, here)
        area = {r.area: r for r in dashboard.by_area(rows).collect()}
        assert area["media_geral"].media == mean and area["media_geral"].n == 10
        k = dashboard.kpis(here, rows).first()
        assert (k.censo, k.enem, k.participantes, k.perfis_enem, k.escolas_sem_nota) == (10, 10, 100, 10, 0)
    assert census.where(dashboard.slice_filter(network=4)).isEmpty()


def test_small_groups_are_suppressed(census, exam):
    nine = exam.where("co_entidade <= 10").withColumn("media_geral", F.when(F.col("co_entidade") == 1, float("nan")).otherwise(F.col("media_geral")))
    row = dashboard.by_network_and_location(dashboard.exam_slice(nine, census)).first()
    assert (row.n, row.media, row.desvio) == (9, None, None)


def test_pairs(census, exam):
    groups = dashboard.by_network_and_state(dashboard.exam_slice(exam, census), "biblioteca")
    pair = dashboard.pairs(groups).first()
    assert (pair.rede, pair.diferenca) == ("Estadual", 10.0)
    assert dashboard.suppressed_groups(groups).first().grupos_pequenos == 0


def test_matrix_counts_unknown(spark, census):
    extra = spark.createDataFrame([(99, 2, "rural", 1, "B", "DF", None, None)], census.schema)
    got = {r.item_codigo: tuple(r)[1:] for r in dashboard.item_matrix(census.unionByName(extra), CATALOG).collect()}
    assert got == {"biblioteca": (20, 0, 0, 0, 1), "internet": (0, 20, 0, 0, 1)}
    regions = {r.sg_uf: r.total for r in dashboard.by_region(census, "biblioteca").collect()}
    assert regions == {"DF": 10, "SP": 10}
    assert [r.item_codigo for r in dashboard.top_absences(dashboard.item_matrix(census, CATALOG)).collect()] == ["internet"]


def test_extract_positions_and_codes(census, exam):
    places = dashboard.municipality_rows(census)
    schools = dashboard.school_rows(census, places, CATALOG).orderBy("posicao").collect()
    assert [(r.posicao, r.co_entidade) for r in schools][:2] == [(0, 1), (1, 2)]
    assert schools[0].itens == "12" and schools[0].municipio == 0 and schools[19].municipio == 1


def test_missing_profile_is_unknown(spark, exam):
    from ledgerlake.functions.columns import encode_items

    df = spark.createDataFrame([(None,)], "itens map<string,string>")
    assert df.select(encode_items("itens", CATALOG).alias("c")).first().c == "00"


def test_base_problems(exam):
    dated = exam.withColumn("ref", F.lit("2024-11-03").cast("date"))
    assert quality.base_problems(dated, "ref").first().valida
    assert not quality.base_problems(dated.unionByName(dated.limit(1)), "ref").first().valida
    assert not quality.base_problems(dated.where("false"), "ref").first().valida
    two = dated.withColumn("ref", F.when(F.col("co_entidade") == 1, F.lit("2024-01-01").cast("date")).otherwise(F.col("ref")))
    assert not quality.base_problems(two, "ref").first().valida


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", -1), (2, None, 7)], "k int, s string, q int")
    assert quality.unique(df, ["k"]).count() == 1
    assert quality.not_null(df, "s").count() == 1
    assert quality.accepted_values(df, "s", ["b"]).count() == 2
    assert quality.in_range(df, "q", 0, 6).count() == 2
    parent = spark.createDataFrame([(1,)], "k int")
    assert [r.k for r in quality.orphans(df, "k", parent, "k").collect()] == [2]
    assert quality.difference_count(df, df.limit(2)).first().diferencas == 1
    maps = spark.createDataFrame([({"b": "1", "a": "2"},)], "m map<string,string>")
    assert quality.table_difference(maps, maps).isEmpty()
    rules = [quality.Constraint("positive", F.col("q") > 0)]
    good, bad = quality.split_by(df, rules)
    assert (good.count(), bad.count()) == (2, 1)
    assert [r.regras for r in quality.violations(df, rules).collect()] == ["positive"]
    batches = workload.batch_number(df, "k", 2).groupBy("lote").count().count()
    assert batches == 2


def test_metric_slices_and_minimum(spark, census, exam):
    from ledgerlake.operators.metrics import METRICS

    schools = census.withColumns({"rede": F.lit("estadual"), "ano_censo_referencia": F.lit(2024)})
    results = exam.withColumn("ano", F.lit(2024))
    mean = METRICS["media_enem_escolas"]
    assert mean(results, schools, year=2024, where=F.col("sg_uf") == "DF").first().media == 505.5
    assert mean(results, schools, year=2024, where=F.col("co_entidade") < 5).isEmpty()
    assert mean(results, schools, year=2024, where=F.col("co_entidade") < 5, minimum=2).first().n_escolas == 4


def test_partitions_grow_with_the_input():
    from ledgerlake.session import shuffle_partitions

    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(10 << 40) == 40_960
