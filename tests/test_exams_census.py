"""Census and exam preparation."""

import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.contracts import CENSUS_COLUMNS, EXAM_COLUMNS
from ledgerlake.operators import census, exams
from ledgerlake.sources import readers


AREAS4 = ("cn", "ch", "lc", "mt")


def people(seed, schools=(41, 42, 43, None)):
    """Random people: school, present on each day (cn and mt, ch and lc), scores, essay score."""
    rng = random.Random(seed)
    out = []
    for n in range(60):
        days = {"cn": rng.random() < 0.8, "ch": rng.random() < 0.7}
        days |= {"mt": days["cn"], "lc": days["ch"]}
        scores = {a: rng.choice([None, 0.0, *(float(rng.randrange(300, 900)) for _ in range(4))]) if days[a] or rng.random() < 0.1 else None for a in AREAS4}
        essay = rng.choice([None, 0.0, 440.0, 520.0]) if days["ch"] else None
        out.append((schools[min(n // 25, 2)] if n % 9 else None, days, scores, essay))
    return out


def exam_rows(spark, given):
    text = lambda v: None if v is None else str(v)
    rows = []
    for school, days, scores, essay in given:
        place = (f"{school}00", "MG", "3", "2", "1") if school else (None,) * 5
        rows.append(("2019", text(school), *place, *("1" if days[a] else "0" for a in AREAS4), *(text(scores[a]) for a in AREAS4), text(essay and "1"), text(essay)))
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in EXAM_COLUMNS))


def counted(person):
    """Scores that count: those of a day the person came to, and the essay."""
    _, days, scores, essay = person
    return {**{a: scores[a] if days[a] else None for a in AREAS4}, "redacao": essay}


def mean(values):
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


@pytest.mark.parametrize("seed", [1, 2])
def test_school_results(spark, seed):
    given = people(seed)
    results = exams.school_results(exams.participants(exam_rows(spark, given)))
    got = {r.co_escola: r for r in exams.mean_without_zero_essays(results).collect()}
    assert set(got) == {p[0] for p in given if p[0]}
    for school, r in got.items():
        own = [counted(p) for p in given if p[0] == school]
        whole = [c for c in own if None not in c.values()]
        assert r.participantes == len(own) and r.poucos_participantes == (len(own) < 10)
        assert r.participantes_com_todas_as_notas == len(whole)
        assert r.participantes_sem_nota_valida == sum(not any(v is not None for v in c.values()) for c in own)
        for area in (*AREAS4, "redacao"):
            assert r[f"notas_validas_{area}"] == sum(c[area] is not None for c in own)
            assert r[f"media_{area}"] == pytest.approx(mean([c[area] for c in own]))
        assert r.media_geral == pytest.approx(mean([mean(c.values()) for c in whole]))
        essays = [c["redacao"] for c in own if c["redacao"]]
        assert r.redacoes_nota_zero == sum(c["redacao"] == 0 for c in own)
        assert r.media_redacao_sem_zeros == pytest.approx(mean(essays))


def test_summary_and_coverage(spark):
    given = people(3)
    rows = exams.participants(exam_rows(spark, given))
    s = exams.file_summary(rows).first()
    with_school = [p for p in given if p[0]]
    assert (s.participantes, s.participantes_com_escola, s.escolas) == (len(given), len(with_school), len({p[0] for p in with_school}))
    came = [(days[a], scores[a]) for _, days, scores, _ in given for a in AREAS4]
    assert s.notas_objetivas_faltantes == sum(c and v is None for c, v in came)
    assert s.notas_objetivas_zero == sum(c and v == 0 for c, v in came)
    schools = spark.createDataFrame([(41,), (77,)], "co_entidade long")
    matched = exams.census_match(exams.school_results(rows), schools)
    c = exams.coverage(matched, exams.file_summary(rows)).first()
    size = Counter(p[0] for p in with_school)
    assert (c.escolas, c.escolas_no_censo, c.participantes_no_censo) == (len(size), 1, size[41])
    assert c.escolas_mascaradas == sum(n < 10 for n in size.values())
    assert sum(r.escolas for r in exams.bands(matched).collect()) == len(size)
    assert {r.rotulo for r in exams.bands(matched).collect() if r.no_censo} == {"10 a 29"}


def census_frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in (*CENSUS_COLUMNS, "IN_BIB")))


def test_census_rules(spark):
    rows = [
        ("2024", "1", "Ágora", "10", "Brasília", "DF", "53", "2", "1", "1", "1"),
        ("2024", "2", "Fechada", "10", "Brasília", "DF", "53", "2", "1", "2", "1"),
        ("2024", "3", "Sem rede", "20", "Goiânia", "GO", "52", None, "1", "1", "0"),
        ("2024", None, "Sem código", "20", "Goiânia", "GO", "52", "2", "1", "1", "0"),
    ]
    active = census.active_schools(census_frame(spark, rows))
    assert {r.co_municipio for r in census.municipalities(active).collect()} == {10, 20}
    assert [r.co_entidade for r in census.schools(active).collect()] == [1]
    assert [tuple(r) for r in census.item_states(active, {"bib": "IN_BIB"}).collect()] == [(1, "bib", "existente")]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["1", "0", "", "9", None]), min_size=1, max_size=20))
def test_any_flag_becomes_a_state(spark, flags):
    rows = [("2024", str(i), "E", "1", "M", "DF", "53", "1", "1", "1", f) for i, f in enumerate(flags)]
    got = {r.co_entidade: r.situacao for r in census.item_states(census_frame(spark, rows), {"bib": "IN_BIB"}).collect()}
    want = {"1": "existente", "0": "inexistente"}
    assert got == {i: want.get(f, "nao_informado") for i, f in enumerate(flags)}


def test_raw_file_is_latin1_text(spark, folder, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_bytes("A;B\nÁgora;01\n;2\n".encode("latin-1"))
    rows = readers.raw_text(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [("Ágora", "01"), (None, "2")]
    with pytest.raises(ValueError, match="C, D"):
        census.require_columns(readers.raw_text(spark, str(path)), ["D", "A", "C"], "file")
    assert readers.file_hashes(spark, str(path)).count() == 1


def test_exact_mean_is_order_free(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "v double")
    assert df.agg(exams.exact_mean(F.col("v")).alias("m")).first().m == 0.6 / 3
