"""Versioned tables, layouts, ingestion decisions and monthly windows."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ledgerlake.contracts import EVENT_CONTENT, EVENT_KEY, EVENT_SCHEMA
from ledgerlake.operators import quality
from ledgerlake.sources import ingest, layouts, readers
from ledgerlake.sources.tables import VersionedTable, first_per_key
from ledgerlake.streaming import windows
from tests.conftest import at, event


@pytest.fixture
def table(spark, folder):
    return VersionedTable(spark, folder, EVENT_SCHEMA, EVENT_KEY, "mes_ocorrencia", ["lsn_origem"], ["co_entidade"], EVENT_CONTENT)


BATCH = [event(1, "lab", "2024-05-29", "existente"), event(2, "lab", "2024-05-30", "inexistente", 3)]


def test_insert_if_absent(events, table):
    assert table.read().count() == 0 and table.version() == 0
    first = table.insert_if_absent(events(BATCH))
    assert (first.received, first.inserted, first.discarded, first.version) == (2, 2, 0, 1)
    again = table.insert_if_absent(events(BATCH))
    assert (again.received, again.inserted, again.discarded) == (2, 0, 2)
    partly = table.insert_if_absent(events([BATCH[0], event(3, "lab", "2024-06-01", "existente")]))
    assert (partly.inserted, partly.version) == (1, 2)
    empty = table.insert_if_absent(events([]))
    assert (empty.received, empty.inserted, table.version()) == (0, 0, 2)
    assert table.read().count() == 3 and table.read(1).count() == 2


def test_key_in_another_month_is_inserted_unless_asked(events, table):
    table.insert_if_absent(events(BATCH))
    moved = [event(1, "lab", "2024-07-29", "existente")]
    assert table.insert_if_absent(events(moved), prune=False).inserted == 0
    assert table.insert_if_absent(events(moved)).inserted == 1


def test_first_path_keeps_its_position_in_any_order(events, table):
    table.insert_if_absent(events(BATCH))
    table.insert_if_absent(events([event(1, "lab", "2024-05-29", "existente", lsn=9)]))
    assert [r.lsn_origem for r in table.read().where("vistoria_id = 1").collect()] == [None]


def test_repeated_keys_inside_a_batch(spark, events, table):
    rows = [event(1, "lab", "2024-05-29", "existente", lsn=n) for n in (7, 5, 6)]
    done = table.insert_if_absent(events(rows))
    assert (done.received, done.inserted) == (3, 1)
    assert table.read().first().lsn_origem == 5
    assert first_per_key(spark.createDataFrame([(1,), (1,)], "k int"), ["k"]).count() == 1


def test_failed_replacement_is_invisible_and_vacuumed(events, table):
    table.insert_if_absent(events(BATCH))
    broken = events(BATCH).withColumn("situacao", F.when(F.col("vistoria_id") > 0, F.raise_error(F.lit("x"))).otherwise("a"))
    with pytest.raises(Exception):
        table.replace(broken)
    assert table.read().count() == 2
    assert table.vacuum() == 0  # too young
    table.vacuum(0)
    assert table.read().count() == 2 and table.vacuum(0) == 0
    table.replace(events(BATCH[:1]))
    assert table.read().count() == 1 and table.read(1).count() == 2


def test_compaction_keeps_the_answer(events, table):
    for row in BATCH:
        table.append(events([row]))
    before = table.read().cache()
    before.count()
    table.compact()
    assert quality.table_difference(before, table.read()).isEmpty()


def test_fingerprint(spark, events):
    number = lambda rows: quality.fingerprint(events(rows)).first().impressao
    assert number(BATCH) == number(BATCH[::-1])
    with_path = [event(1, "lab", "2024-05-29", "existente", lsn=4), BATCH[1]]
    assert number(BATCH) == number(with_path)
    assert number(BATCH) != number([BATCH[0], event(2, "lab", "2024-05-30", "inexistente", 4)])
    assert number([]) == 0


def test_wide_table_years(spark, folder):
    rows = [(2024, "DF", 1, "B", 11, 2, 1, "lab", "inexistente"), (2024, "SP", 2, "S", 12, 2, 1, "lab", "existente")]
    schema = ("ano_censo int, sg_uf string, co_municipio int, no_municipio string, co_entidade long, tp_dependencia int, "
              "tp_localizacao int, item_codigo string, situacao string")
    df = spark.createDataFrame(rows, schema)
    for _ in range(2):
        layouts.publish_year(df, folder)
    assert layouts.read_years(spark, folder).count() == 2
    older = df.withColumn("ano_censo", F.lit(2023))
    layouts.publish_year(older, folder)
    every = layouts.read_years(spark, folder)
    assert every.groupBy("ano_censo").count().count() == 2 and readers.latest_year(every, "ano_censo").count() == 2
    layouts.publish_year(older.where("sg_uf = 'SP'"), folder)
    assert {(r.ano_censo, r.sg_uf) for r in layouts.read_years(spark, folder).collect()} == {(2024, "DF"), (2024, "SP"), (2023, "SP")}
    assert [r.sg_uf for r in layouts.read_years(spark, folder, [2023]).collect()] == ["SP"]
    with pytest.raises(ValueError):
        layouts.publish_year(df.unionByName(older), folder)


def test_block_hashes_of_any_size(spark, tmp_path):
    """Files under a block, of exactly one, of several with a rest: one definition, as plain Python has it."""
    import hashlib
    import random

    block = 1000
    content = {f"f{n}": random.Random(n).randbytes(n) for n in (1, 999, 1000, 1001, 5000, 12_345)}
    for name, data in content.items():
        (tmp_path / name).write_bytes(data)

    def plain(data):
        parts = [data[i : i + block] for i in range(0, len(data), block)]
        return len(parts), hashlib.sha256(b"".join(hashlib.sha256(p).digest() for p in parts)).hexdigest(), len(data)

    got = {r.arquivo.rsplit("/", 1)[1]: (r.blocos, r.hash_blocos, r.length) for r in readers.block_hashes(spark, str(tmp_path), block).collect()}
    assert got == {name: plain(data) for name, data in content.items()}
    whole = {r.arquivo.rsplit("/", 1)[1]: r.hash_sha256 for r in readers.file_hashes(spark, str(tmp_path)).collect()}
    assert whole == {name: hashlib.sha256(data).hexdigest() for name, data in content.items()}


def test_going_back_to_an_older_file_ingests_again(spark):
    files = spark.createDataFrame([("censo", 2024, "A")], "fonte string, ano int, hash_sha256 string")

    def action(history, published, force=False):
        manifest = spark.createDataFrame(
            [("censo", 2024, h, f"2024-01-0{i + 1}") for i, h in enumerate(history)],
            "fonte string, ano int, hash_sha256 string, dia string",
        ).select("fonte", "ano", "hash_sha256", *[F.col("dia").cast("timestamp_ntz").alias(c) for c in ("iniciado_em", "concluido_em")])
        out = spark.createDataFrame([("censo", 2024, published)], "fonte string, ano int, hash_publicado string")
        return ingest.decide(files, manifest, out, force).first().acao

    assert action([], None) == "ingerir"
    assert action(["A"], "A") == "ignorar"
    assert action(["A"], "B") == "republicar_silver"
    assert action(["A", "B"], "B") == "ingerir"
    assert action(["A"], "A", force=True) == "ingerir"


# -- monthly windows -------------------------------------------------------------------------------

HEAD = "vistoria_id long, co_entidade long, ocorrido_em timestamp_ntz, registrado_em timestamp_ntz, origem string"


def heads(spark, rows):
    return spark.createDataFrame([(i, 1, at(o), at(r), "x") for i, o, r in rows], HEAD)


def test_month_and_tolerance(spark):
    rows = heads(spark, [
        (1, "2026-11-01 02:00:00", "2026-11-02"), (2, "2026-10-09", "2026-10-12"),
        (3, "2026-10-09", "2026-11-08 00:00:00"), (4, "2026-10-09", "2026-11-08 00:00:01"),
    ])
    got = {r.vistoria_id: (r.mes, r.dentro_da_tolerancia) for r in windows.lateness(rows).collect()}
    assert got == {1: ("2026-11", True), 2: ("2026-10", True), 3: ("2026-10", True), 4: ("2026-10", False)}
    bound = windows.month_bounds(spark.createDataFrame([("2026-12",)], "mes string")).first()
    assert (bound.inicio, bound.fim, bound.mes_anterior) == (at("2026-12-01"), at("2027-01-01"), "2026-11")
    with pytest.raises(ValueError):
        windows.check_month("2026-13")


def test_windows_run(spark, events, table, folder):
    origin = [event(1, "lab", "2026-01-10", "existente", recorded="2026-01-11"),
              event(2, "lab", "2026-02-10", "existente", recorded="2026-02-11")]
    items = lambda rows: events(rows).select("vistoria_id", "item_codigo", "situacao", "quantidade")
    headers = [(1, "2026-01-10", "2026-01-11"), (2, "2026-02-10", "2026-02-11"), (3, "2026-02-10", "2026-02-11")]
    monthly = windows.MonthlyWindows(spark, table, f"{folder}-control")
    first = monthly.run(heads(spark, headers), items(origin), events(origin))
    assert (first.previous_mark, first.new_events, first.months, first.inserted) == (None, 2, ["2026-01", "2026-02"], 2)
    assert monthly.reopenings().isEmpty()
    assert [r.vistoria_id for r in monthly._ids("waiting").collect()] == [3]

    again = monthly.run(heads(spark, headers), items(origin), events(origin))
    assert (again.new_events, again.inserted) == (0, 0)

    # A late record for a closed month, and items at last for the empty header.
    late = [*origin, event(4, "lab", "2026-01-05", "inexistente", recorded="2026-04-05"),
            event(3, "lab", "2026-02-10", "existente", recorded="2026-02-11")]
    headers.append((4, "2026-01-05", "2026-04-05"))
    third = monthly.run(heads(spark, headers), items(late), events(late))
    assert (third.new_events, third.months, third.inserted) == (2, ["2026-01", "2026-02"], 2)
    assert [(r.mes, r.eventos, r.maior_atraso_dias) for r in monthly.reopenings().collect()] == [("2026-01", 1, 90.0)]
    assert monthly._ids("waiting").isEmpty()
    assert all(r.confere_com_a_origem for r in monthly.windows().collect())
    assert quality.table_difference(table.read(), events(late)).isEmpty()
    monthly.reprocess(events(late), ["2026-01"])
    assert monthly.windows().count() == 2 and monthly.reopenings().count() == 1


def test_margin_brings_back_only_the_unseen(spark, events, table, folder):
    """A record a little before the mark that was committed after it is new exactly once."""
    a = event(1, "lab", "2026-01-10", "existente", recorded="2026-01-11 12:00:00")
    b = event(2, "lab", "2026-01-10", "existente", recorded="2026-01-11 11:55:00")
    items = lambda rows: events(rows).select("vistoria_id", "item_codigo", "situacao", "quantidade")
    h = [(1, "2026-01-10", "2026-01-11 12:00:00"), (2, "2026-01-10", "2026-01-11 11:55:00")]
    monthly = windows.MonthlyWindows(spark, table, f"{folder}-control")
    assert monthly.run(heads(spark, h[:1]), items([a]), events([a])).new_events == 1
    assert monthly.run(heads(spark, h), items([a, b]), events([a, b])).new_events == 1
    assert monthly.run(heads(spark, h), items([a, b]), events([a, b])).new_events == 0
