"""Item history, profiles and facts held against plain Python folds of generated histories."""

import datetime as dt
import random

import pytest

from ledgerlake.operators import facts, history, metrics, quality
from tests.conftest import event

ITEMS = ["patio", "rampa", "forno"]
END = dt.datetime.max


def profiles(events, rows, hot_limit=None):
    df = events(rows)
    hot = history.hot_entities(df, hot_limit) if hot_limit is not None else None
    return history.dim_profile(history.item_change(df, hot), ITEMS, hot is not None)


# -- properties ------------------------------------------------------------------------------------

def random_events(seed, n, schools=4):
    rng = random.Random(seed)
    rows, start = [], dt.datetime(2024, 1, 1)
    for i in range(n):
        # School 0 holds about a third of everything; ties in time are frequent.
        school = 0 if rng.random() < 0.35 else rng.randrange(schools)
        when = start + dt.timedelta(hours=6 * rng.randrange(n))
        state = rng.choice(["existente", "inexistente", "em_obra", "nao_informado"])
        rows.append(event(i, rng.choice(ITEMS), when, state, rng.choice([None, None, 1, 2]), school=school))
    return rows


def fold_changes(rows):
    """The definition, read row by row."""
    out = []
    groups = {}
    for r in rows:
        if r[7] != "nao_informado":
            groups.setdefault((r[2], r[1]), []).append((r[5], r[0], r[7], r[8]))
    for (school, item), seq in groups.items():
        state = quantity = None
        found = []
        for when, id, s, q in sorted(seq):
            force = q if s != state else (quantity if q is None else q)
            if s != state or force != quantity:
                found.append([school, item, s, force, when, id])
            state, quantity = s, force
        for i, c in enumerate(found):
            out.append((*c, found[i + 1][4] if i + 1 < len(found) else dt.datetime.max))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("limit", [None, 20])
def test_changes_equal_the_fold(events, seed, limit):
    rows = random_events(seed, 200)
    df = events(rows)
    hot = history.hot_entities(df, limit) if limit else None
    got = history.item_change(df, hot).select(
        "co_entidade", "item_codigo", "situacao", "quantidade", "desde", "vistoria_id", "ate")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == fold_changes(rows)


@pytest.mark.parametrize("limit", [None, 20])
def test_profiles_and_facts_equal_the_interval_definition(events, limit):
    rows = random_events(3, 200)
    df = events(rows)
    hot = history.hot_entities(df, limit) if limit else None
    changes = fold_changes(rows)
    want = {}
    for school, start in {(c[0], c[4]) for c in changes}:
        held = [c for c in changes if c[0] == school and c[4] <= start < c[6]]
        want[school, start] = (
            {c[1]: c[2] for c in held}, {c[1]: c[3] for c in held if c[3] is not None},
            max(c[5] for c in changes if c[0] == school and c[4] == start),
        )
    p = history.dim_profile(history.item_change(df, hot), ITEMS, hot is not None)
    p = p.cache()
    assert {(r.co_entidade, r.valid_from): (r.itens, r.quantidades, r.vistoria_origem_id) for r in p.collect()} == want
    start_of = {r.escola_infra_sk: r.valid_from for r in p.collect()}
    for r in facts.fact_item(df, p, hot).collect():
        earlier = [t for (s, t) in want if s == r.co_entidade and t <= r.ocorrido_em]
        assert start_of.get(r.escola_infra_sk) == max(earlier, default=None)


# -- versions over time ----------------------------------------------------------------------------

def starts(df):
    return {(r.co_entidade, r.valid_from): r.escola_infra_sk for r in df.collect()}


@pytest.mark.parametrize("limit", [None, 20])
def test_versions_tile_time(events, limit):
    df = profiles(events, random_events(5, 150), limit).cache()
    by_school = {}
    for r in df.collect():
        by_school.setdefault(r.co_entidade, []).append((r.valid_from, r.valid_to, r.is_current))
    for rows in by_school.values():
        rows.sort()
        assert all(x[1] == y[0] for x, y in zip(rows, rows[1:], strict=False))
        assert [x[2] for x in rows] == [False] * (len(rows) - 1) + [True] and rows[-1][1] == END
    assert quality.overlaps(df, "co_entidade").isEmpty() and quality.current_count(df, "co_entidade").isEmpty()


def test_profile_as_of_any_instant(events):
    rows = random_events(6, 120)
    df, changes = profiles(events, rows).cache(), fold_changes(rows)
    first, last = min(c[4] for c in changes), max(c[4] for c in changes)
    for when in (first - dt.timedelta(days=1), first, first + (last - first) / 3, last, last + dt.timedelta(days=400)):
        want = {}
        for c in changes:
            if c[4] <= when < c[6]:
                want.setdefault(c[0], {})[c[1]] = c[2]
        assert {r.co_entidade: r.itens for r in history.profile_at(df, str(when)).collect()} == want


def test_an_event_between_two_versions_changes_no_other_key(events):
    rows = random_events(7, 60, schools=2)
    before = starts(profiles(events, rows))
    known = sorted(t for s, t in before if s == 0)
    when = known[0] + (known[1] - known[0]) / 2
    extra = event(999, "patio", when, "inutilizavel", school=0)
    after = starts(profiles(events, [*rows, extra]))
    assert (0, when) in after and set(after) - set(before) <= {(0, when), *after} and all(after[k] == v for k, v in before.items() if k in after)


def test_keys_do_not_depend_on_the_session_zone(spark, events):
    rows = random_events(8, 40)
    here = starts(profiles(events, rows))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        assert starts(profiles(events, rows)) == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# -- facts ------------------------------------------------------------------------------------------

def yearly(rows, as_of):
    """Per school and year with an event: the items present at the year's end, or at ``as_of`` if that is earlier."""
    out, changes = {}, fold_changes(rows)
    for school, year in {(r[2], r[5].year) for r in rows}:
        when = min(dt.datetime(year, 12, 31, 23, 59, 59, 999000), as_of)
        held = {c[1]: c[2] for c in changes if c[0] == school and c[4] <= when < c[6]}
        out[school, year] = tuple(None if i not in held else held[i] == "existente" for i in ITEMS)
    return out


@pytest.mark.parametrize("as_of", [dt.datetime(2030, 1, 1), dt.datetime(2024, 9, 1)])
def test_yearly_fact(events, as_of):
    rows = random_events(9, 1500, schools=6)
    got = facts.fact_year(events(rows), profiles(events, rows), ITEMS, str(as_of)).collect()
    assert {(r.co_entidade, r.ano): tuple(r[i] for i in ITEMS) for r in got} == yearly(rows, as_of)
    for r in got:
        assert r.pct_existentes == (round(100 * r.n_existentes / r.n_itens_conhecidos, 2) if r.n_itens_conhecidos else None)


def test_events_of_later_years_leave_a_closed_year_alone(events):
    rows = random_events(10, 1900)
    closed = [r for r in rows if r[5].year == 2024]
    year = lambda some: facts.fact_year(events(some), profiles(events, some), ITEMS, "2030-01-01 00:00:00")
    assert len(closed) < len(rows) and quality.closed_history_changes(year(closed), year(rows), 2024).isEmpty()


def test_both_grains_give_the_same_share(spark, events):
    rows = random_events(11, 400, schools=9)
    schools = spark.createDataFrame([(i, ("estadual", "federal")[i % 2], i % 3) for i in range(9)], "co_entidade long, rede string, co_municipio int")
    places = spark.createDataFrame([(0, "MG"), (1, "BA"), (2, "BA")], "co_municipio int, sg_uf string")
    last = {}
    for r in sorted(rows, key=lambda r: (r[5], r[0])):
        if r[1] == "forno" and r[7] != "nao_informado" and r[5].year == 2024:
            last[r[2]] = r[7] == "existente"
    want = {}
    for school, has in last.items():
        want.setdefault((("MG", "BA", "BA")[school % 3], ("estadual", "federal")[school % 2]), []).append(has)
    want = {k: (len(v), round(100 * sum(v) / len(v), 1)) for k, v in want.items()}
    df, p = events(rows), profiles(events, rows).cache()
    fine = metrics.fine_grain_share(facts.fact_item(df, p), schools, places, "forno", 2024)
    wide = metrics.wide_grain_share(facts.fact_year(df, p, ITEMS, "2030-01-01 00:00:00"), schools, places, "forno", 2024)
    for share in (fine, wide):
        assert {(r.sg_uf, r.rede): (r.escolas, r.pct_com_item) for r in share.collect()} == want


def test_latest_state_is_the_last_known_by_time_then_id(events):
    rows = random_events(12, 300)
    want = {}
    for r in sorted(rows, key=lambda r: (r[5], r[0])):
        if r[7] != "nao_informado":
            want[r[2], r[1]] = (r[7], r[0])
    got = history.latest_state(events(rows)).collect()
    assert {(r.co_entidade, r.item_codigo): (r.situacao, r.vistoria_id) for r in got} == want


def test_latest_registration_and_conflicts(spark):
    rng = random.Random(13)
    rows = [(rng.randrange(12), rng.choice("PQRS"), rng.randrange(3), rng.randrange(2015, 2018)) for _ in range(60)]
    df = spark.createDataFrame(rows, "co_entidade long, no_entidade string, co_municipio int, ano_censo_referencia int")
    newest = {s: max(r[3] for r in rows if r[0] == s) for s, *_ in rows}
    got = {r.co_entidade: r for r in history.latest_registration(df).collect()}
    assert set(got) == set(newest)
    for s, r in got.items():
        assert (s, r.no_entidade, r.co_municipio, newest[s]) in rows and r.ano_censo_referencia == newest[s]
        assert r.no_entidade == min(x[1] for x in rows if x[0] == s and x[3] == newest[s])
    count = {}
    for r in set(rows):
        count[r[0], r[3]] = count.get((r[0], r[3]), 0) + 1
    assert {(r.co_entidade, r.n) for r in history.registration_conflicts(df).collect()} == {(s, n) for (s, _), n in count.items() if n > 1}


def test_missing_profile_is_not_replaced_by_the_current_one(spark, events):
    p = profiles(events, random_events(14, 30))
    fact = spark.createDataFrame([(None, 0)], "escola_infra_sk long, co_entidade long")
    assert facts.with_profile(fact, p).first().itens is None
