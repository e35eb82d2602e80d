"""Metrics of one year among several, suppression by different schools, groups without a name."""

import pytest

from ledgerlake.operators import metrics, ordered


@pytest.fixture
def two_years(spark):
    """Seven schools with results in two years; more in the registration of the later one."""
    results = [(i, y, f"k{i}", 10.0 * i + (y == 2030) * 5, f"{y}-04-01") for i in range(1, 8) for y in (2029, 2030)]
    performance = spark.createDataFrame(results, "co_entidade long, ano int, escola_infra_sk string, media_geral double, data_referencia_infraestrutura string")
    performance = performance.withColumn("data_referencia_infraestrutura", performance.data_referencia_infraestrutura.cast("date"))
    schools = spark.createDataFrame([(i, y, "estadual" if y == 2029 else "municipal") for i in range(1, 10) for y in (2029, 2030)], "co_entidade long, ano_censo_referencia int, rede string")
    profiles = spark.createDataFrame(
        [(f"k{i}", i, {"patio": "existente" if i <= 3 else "inexistente"}, "2000-01-01", "9999-01-01") for i in range(1, 8)] + [("k1", 99, {"patio": "inexistente"}, "2000-01-01", "9999-01-01")],
        "escola_infra_sk string, co_entidade long, itens map<string,string>, valid_from string, valid_to string",
    ).selectExpr("escola_infra_sk", "co_entidade", "itens", "cast(valid_from as timestamp_ntz) valid_from", "cast(valid_to as timestamp_ntz) valid_to")
    return performance, schools, profiles


def test_mean_is_of_one_year_and_groups_count_schools(two_years):
    performance, schools, _ = two_years
    mean = metrics.METRICS["media_enem_escolas"]
    row = mean(performance, schools, year=2029, minimum=7).first()
    assert (row.n_escolas, row.media) == (7, 40.0)
    assert mean(performance, schools, year=2030, minimum=7).first().media == 45.0
    # Fourteen rows are still seven schools.
    assert mean(performance.unionByName(performance), schools, year=2029, minimum=8).collect() == []


def test_sides_join_by_key_and_school(two_years):
    performance, schools, profiles = two_years
    rows = metrics.METRICS["diferenca_media_com_sem_item"](performance, schools, profiles, item="patio", year=2030, minimum=3).collect()
    assert [(r.rede, r.n_com, r.n_sem, r.diferenca) for r in rows] == [("municipal", 3, 4, 25.0 - 60.0)]


def test_shares_are_of_the_schools_of_the_year(two_years):
    performance, schools, profiles = two_years
    rows = metrics.METRICS["pct_escolas_por_situacao_do_item"](schools, performance, profiles, item="patio", year=2030).collect()
    assert {(r.situacao, r.n_escolas) for r in rows} == {("existente", 3), ("inexistente", 4), ("nao_informado", 2)}


def test_coverage_is_of_one_year(spark):
    exam = spark.createDataFrame([(1, 2029, False), (2, 2029, True), (1, 2030, False), (3, 2030, True), (4, 2030, False)], "co_entidade long, ano int, poucos_participantes boolean")
    schools = spark.createDataFrame([(1, 2029), (1, 2030), (1, 2030), (2, 2030), (3, 2029)], "co_entidade long, ano_censo_referencia int")
    metric = metrics.METRICS["cobertura_enem_censo"]
    assert tuple(metric(exam, schools, year=2029).first()) == (2, 1, 1, 1, 50.0)
    assert tuple(metric(exam, schools, year=2030).first()) == (3, 1, 2, 1, 33.3)
    with pytest.raises(TypeError):
        metric(exam, schools)


def test_unnamed_groups_are_ranked_like_others(spark):
    rows = spark.createDataFrame([(1, None, 3.0), (2, None, 1.0), (3, None, 2.0), (4, "a", 5.0), (5, "a", 5.0)], "id long, g string, v double")
    got = {r.id: (r.percentil, r.n_grupo) for r in metrics.percent_ranks(rows, ["g"], "v").collect()}
    assert got == {1: (1.0, 3), 2: (0.0, 3), 3: (0.5, 3), 4: (0.0, 2), 5: (0.0, 2)}
    quantiles = {r.g: r.q for r in ordered.exact_quantiles(rows, ["g"], "v", {"q": 0.5}, metrics.unit_bucket).collect()}
    assert quantiles == {None: 2.0, "a": 5.0}
