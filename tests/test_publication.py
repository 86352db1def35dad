"""Publication by pointer, the ledger of loads, the writers' lease, and refreshes by month."""

import datetime as dt
import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from cardwarden.operators import bronze, iforest, quality
from cardwarden.operators.normalize import flatten, normalize_records
from cardwarden.plans import ledger, publication, refresh, warehouse
from cardwarden.plans.lease import TableBusyError, lease_path, writer_lease
from cardwarden.sources import files
from cardwarden.sources.sample import sample_json
from cardwarden.sources.schemas import RAW_RECORD
from cardwarden.streaming.late_data import upsert_batch

BY_MONTH = ["bronze.cartoes_pagamento", "silver.stg_cpgf_despesas", "silver.fct_gastos_cartao", "gold.fct_gastos_cartao"]


def settings(load, **other):
    base = dict(load_id=load, as_of=dt.date(2026, 9, 30), run_ts=dt.datetime(2026, 9, 30, 12), forest=iforest.ForestSpec(trees=5))
    return refresh.Settings(**{**base, **other})


@pytest.fixture
def clean(spark):
    def drop():
        for layer in ("bronze", "silver", "gold", "t"):
            spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")

    drop()
    yield
    drop()


def records(spark, *changed):
    """Sample records with other values: (place in the sample, {field: value})."""
    texts = []
    for place, values in changed:
        texts.append((json.dumps(json.loads(sample_json()[place]) | values),))
    return spark.createDataFrame(texts, "texto STRING").select(F.from_json("texto", RAW_RECORD).alias("r")).select("r.*")


def folders(spark, table):
    return publication.month_folders(spark, table)


def content(spark, table, *columns):
    rows = spark.table(table)
    return sorted((tuple(map(str, r)) for r in rows.select(*(columns or sorted(rows.columns))).collect()))


def test_a_load_rewrites_only_its_months(spark, clean):
    refresh.ingest_sample(spark, settings("1"))
    refresh.audited_transform(spark, settings("1"))
    before = {t: folders(spark, t) for t in BY_MONTH}
    assert all(len(found) == 8 for found in before.values())
    # a new transaction of the one agency that all its rows are in January
    new = records(spark, (3, {"id": 8_000_001, "valorTransacao": "9.000,00"}))
    assert bronze.upsert(flatten(new, "2"), load_id="2") == {"2026-01"}
    refresh.audited_transform(spark, settings("2"))
    for table in BY_MONTH:
        after = folders(spark, table)
        assert {m for m in after if after[m] != before[table][m]} == {"2026-01"}, table
    january = spark.table("gold.fct_gastos_cartao").where("mes_extrato = '2026-01'")
    assert {f.split("/")[-3:-1] == folders(spark, BY_MONTH[3])["2026-01"].split("/")[-2:] for f in january.inputFiles()} == {True}

    # another amount in March of an agency with rows elsewhere: its means move there as well
    changed = records(spark, (8, {"valorTransacao": "1,00"}))
    assert bronze.upsert(flatten(changed, "3"), load_id="3") == {"2026-03"}
    before = {t: folders(spark, t) for t in BY_MONTH}
    refresh.audited_transform(spark, settings("3"))
    moved = lambda t: {m for m, path in folders(spark, t).items() if path != before[t][m]}
    assert moved("silver.fct_gastos_cartao") == {"2026-03"}
    agency = json.loads(sample_json()[8])["orgaoSuperior"]["codigo"]
    months = {json.loads(t)["mesExtrato"] for t in sample_json() if json.loads(t)["orgaoSuperior"]["codigo"] == agency}
    assert moved("gold.fct_gastos_cartao") == {f"{m[:4]}-{m[4:]}" for m in months}

    # nothing new: nothing is rewritten; and the same rows as by staging everything again
    before = {t: folders(spark, t) for t in BY_MONTH}
    refresh.audited_transform(spark, settings("3"))
    assert all(folders(spark, t) == before[t] for t in BY_MONTH)
    step_by_step = {t: content(spark, t) for t in BY_MONTH[1:]}
    spark.sql(f"DROP TABLE {ledger.TAKEN_TABLE}")
    refresh.audited_transform(spark, settings("3"))
    assert {t: content(spark, t) for t in BY_MONTH[1:]} == step_by_step
    # another cut-off stages everything again too
    refresh.transform(spark, settings("3", cutoff="2026-05"))
    assert min(folders(spark, BY_MONTH[1])) == "2026-05"


def test_a_planted_defect_leaves_the_old_tables(spark, clean):
    refresh.ingest_sample(spark, settings("1"))
    refresh.audited_transform(spark, settings("1"))
    before = {t: content(spark, t) for t in warehouse.TABLES.values()}
    wrong = records(spark, (0, {"id": 8_000_002, "dataTransacao": "01/01/2035"}))  # no such day in the calendar
    bronze.upsert(flatten(wrong, "2"), load_id="2")
    with pytest.raises(quality.QualityError, match="relationships fct_gastos_cartao.sk_data: 1"):
        refresh.audited_transform(spark, settings("2"))
    assert {t: content(spark, t) for t in warehouse.TABLES.values()} == before
    bronze.upsert(flatten(records(spark, (0, {"id": 8_000_002})), "3"), load_id="3")
    refresh.audited_transform(spark, settings("3"))
    assert spark.table("gold.fct_gastos_cartao").count() == len(sample_json()) + 1


def test_a_release_cut_off_is_finished_by_the_next_run(spark, clean, monkeypatch):
    spark.sql("CREATE DATABASE t")
    rows = lambda *values: spark.createDataFrame([(v, m) for v, m in values], "id INT, mes STRING")
    for table in ("t.a", "t.b", "t.c"):
        publication.prepare_months(rows((1, "m1"), (2, "m2"), (3, "m3")), table, None, "id")
    publication.release(spark, ["t.a", "t.b", "t.c"])
    for table in ("t.a", "t.b", "t.c"):
        coming = publication.prepare_months(rows((20, "m2")), table, {"m2", "m3"}, "id")
        assert content(spark, table) == [("1", "m1"), ("2", "m2"), ("3", "m3")]
        assert sorted(r.id for r in coming.collect()) == [1, 20]
    whole, done = publication.swap, []

    def lost(spark, table):
        if done:
            raise RuntimeError("driver lost")
        done.append(table)
        whole(spark, table)

    with monkeypatch.context() as m:
        m.setattr(publication, "swap", lost)
        with pytest.raises(RuntimeError):
            publication.release(spark, ["t.a", "t.b", "t.c"])
    assert [len(content(spark, t)) for t in ("t.a", "t.b", "t.c")] == [2, 3, 3]
    spark.sql("ALTER TABLE t.b RENAME TO t.b__last")  # lost between the two renames of the second
    assert publication.recover(spark, "t") == 1 and publication.recover(spark, "t") == 0
    for table in ("t.a", "t.b", "t.c"):
        assert content(spark, table) == [("1", "m1"), ("20", "m2")]
    # what nothing points to goes with the next version but one
    publication.prepare_months(rows((7, "m1")), "t.a", {"m1"}, "id")
    publication.release(spark, ["t.a"])
    assert publication.vacuum(spark, "t.a") == 1 and publication.vacuum(spark, "t.a") == 0
    assert content(spark, "t.a") == [("20", "m2"), ("7", "m1")]


def test_months_are_written_once(spark, clean):
    spark.sql("CREATE DATABASE t")
    rows = spark.range(1000).selectExpr("id", "concat('m', id % 4) AS mes")
    publication.prepare_months(rows, "t.a", None, "id")
    publication.release(spark, ["t.a"])
    publication.prepare_months(rows.where("mes = 'm1'"), "t.a", {"m1"}, "id")
    root = f"{spark.catalog.getDatabase('t').locationUri}/a__data"
    written = [len([p for p in files.children(spark, v) if "/mes=" in p]) for v in files.children(spark, root)]
    assert sorted(written) == [1, 4]
    assert not files.children(spark, f"{spark.catalog.getDatabase('t').locationUri}/a__next")


def test_one_writer_at_a_time(spark, clean):
    spark.sql("CREATE DATABASE t")
    with writer_lease(spark, "t.a"):
        with pytest.raises(TableBusyError), writer_lease(spark, "t.a", patience=0.3):
            pass
        with writer_lease(spark, "t.b", patience=0.1):  # another table
            pass
    with writer_lease(spark, "t.a", patience=0.1):
        pass
    files.create_new(spark, lease_path(spark, "t.a"))  # of a lost driver
    files.touch(spark, lease_path(spark, "t.a"), int((time.time() - 60) * 1000))
    with writer_lease(spark, "t.a", patience=5, stale=30):
        pass
    with writer_lease(spark, "t.a", stale=0.4):  # renewed while it is held
        time.sleep(1)
        with pytest.raises(TableBusyError), writer_lease(spark, "t.a", patience=0.2, stale=0.4):
            pass


def test_stream_and_batch_at_once(spark, clean):
    raw = records(spark, (0, {}), (1, {}), (4, {})).withColumns({"mes": F.lit("2026-01"), "pagina": F.lit(1)})
    sink, failed = upsert_batch("2026-09-30"), []

    def run(work, *args):
        try:
            work(*args)
        except Exception as error:  # shown by the assertion below
            failed.append(str(error)[:2000])

    batch = records(spark, (8, {}), (4, {"valorTransacao": "5,00"}))
    loads = [
        threading.Thread(target=run, args=(sink, raw, 0)),
        threading.Thread(target=run, args=(bronze.upsert, flatten(normalize_records(batch), "2026-10-01"))),
        threading.Thread(target=run, args=(sink, raw.where("id = 7000001"), 1)),
    ]
    for thread in loads:
        thread.start()
    for thread in loads:
        thread.join()
    assert not failed
    table = spark.table(bronze.BRONZE_TABLE)
    assert sorted(r.id for r in table.collect()) == [7000001, 7000002, 7000005, 7000009]
    assert ledger.is_done(spark, bronze.BRONZE_TABLE, "2026-09-30.000000001")
    before = folders(spark, bronze.BRONZE_TABLE)
    sink(raw, 0)  # a batch that comes again is not taken again
    assert folders(spark, bronze.BRONZE_TABLE) == before


def test_batch_copies_are_removed(spark, clean, tmp_path, monkeypatch):
    from cardwarden.sources import scratch

    monkeypatch.setattr(scratch, "scratch_root", lambda _: str(tmp_path))
    raw = records(spark, (0, {})).withColumns({"mes": F.lit("2026-01"), "pagina": F.lit(1)})
    upsert_batch("s")(raw, 0)
    assert not list((tmp_path / "cardwarden").iterdir())


def test_pages_are_noted(spark, clean, tmp_path):
    for page, place in ((1, 0), (1, 1), (2, 2), (4, 3)):
        folder = tmp_path / "mes=2026-01" / f"pagina={page}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{place}.json").write_text(f"[{sample_json()[place]}]")
    refresh.ingest_landing(spark, str(tmp_path), settings("1", first_month="1/2026", last_month="1/2026"))
    noted = spark.table(ledger.pages_table(bronze.BRONZE_TABLE)).orderBy("pagina").collect()
    assert [tuple(r) for r in noted] == [
        ("1", "2026-01", 1, 2, True), ("1", "2026-01", 2, 1, True), ("1", "2026-01", 4, 1, False),
    ]
    assert sorted(r.id for r in spark.table(bronze.BRONZE_TABLE).collect()) == [7000001, 7000002, 7000003]
