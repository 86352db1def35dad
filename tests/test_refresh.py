"""A whole refresh on the built-in sample and on landed pages, and the data checks."""

import datetime as dt
import json
import statistics
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from cardwarden.operators import calendar, dimensions, facts, iforest, quality
from cardwarden.operators.bronze import EmptyLoadError
from cardwarden.operators.normalize import flatten
from cardwarden.operators.staging import stage
from cardwarden.plans import refresh, warehouse
from cardwarden.sources.sample import read_sample, sample_json

def golden():
    """(id, mean, z, severity, weekday) of each record of the sample, by plain Python."""
    records = [json.loads(t) for t in sample_json()]
    amount = {r["id"]: Decimal(r["valorTransacao"].replace(".", "").replace(",", ".")) for r in records}
    agency = {r["id"]: r["orgaoSuperior"]["nome"] for r in records}
    rows = []
    for r in records:
        same = [amount[i] for i in amount if agency[i] == agency[r["id"]]]
        mean = (sum(same) / len(same)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        spread = statistics.stdev(same) if len(same) > 1 else 0
        z = (amount[r["id"]] - sum(same) / len(same)) / spread if spread else Decimal(0)
        z = float(z.quantize(Decimal("0.01"), ROUND_HALF_UP))
        high = amount[r["id"]]
        level = 3 if z >= 2.5 or high >= 40000 else 2 if z >= 1.8 or high >= 15000 else 1
        day = dt.datetime.strptime(r["dataTransacao"], "%d/%m/%Y").isoweekday() % 7 + 1
        rows.append((r["id"], str(mean), z, level, day))
    return rows


N_SAMPLE = len(sample_json())


def settings(**other):
    base = dict(load_id="carga-1", as_of=dt.date(2026, 9, 30),
                run_ts=dt.datetime(2026, 9, 30, 12), forest=iforest.ForestSpec(trees=20))
    return refresh.Settings(**{**base, **other})


@pytest.fixture
def clean(spark):
    def drop():
        for layer in ("bronze", "silver", "gold"):
            spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")

    drop()
    yield
    drop()


def test_sample_refresh_gives_the_golden_rows(spark, clean):
    summary = {r.table_name: r.n_rows for r in refresh.refresh(spark, settings()).collect()}
    assert summary == {
        "gold.fct_gastos_cartao": N_SAMPLE, "gold.dim_data": 1462, "gold.dim_orgaos": 4,
        "gold.dim_favorecidos": 6, "gold.dim_portadores": 4, "gold.dim_nivel_alerta": 3,
        "gold.score_anomalia_cartao": N_SAMPLE,
    }
    rows = spark.table("gold.fct_gastos_cartao").join(spark.table("gold.dim_data"), "sk_data")
    got = sorted(
        (r.id_transacao, str(r.media_orgao), r.z_score, r.ordem_severidade, r.dia_semana)
        for r in rows.collect()
    )
    assert got == golden()
    assert spark.table("gold.dim_favorecidos").columns == ["sk_favorecido", "nome_favorecido"]
    assert spark.table("gold.dim_portadores").columns == ["sk_portador", "nome_portador"]
    scores = spark.table("gold.score_anomalia_cartao")
    gold = [spark.table(f"gold.{t}") for t in (
        "fct_gastos_cartao", "dim_data", "dim_orgaos", "dim_favorecidos", "dim_portadores",
        "dim_nivel_alerta",
    )]
    star = facts.star_view(*gold, scores).where("nivel_alerta = 'CRITICO'").collect()
    assert [(r.id_transacao, r.nome_mes, r.nome_portador) for r in star] == [
        (7000002, "Janeiro", "PORTADOR B"),
    ]
    assert 0.0 <= star[0].anomaly_score <= 1.0
    assert scores.select("dt_processamento").distinct().count() == 1

    # the same refresh again changes nothing
    again = {r.table_name: r.n_rows for r in refresh.refresh(spark, settings()).collect()}
    assert again == summary

    # an empty result leaves the scores alone
    assert warehouse.save_scores(scores.limit(0)) == 0
    assert spark.table("gold.score_anomalia_cartao").count() == N_SAMPLE


def test_landed_pages_refresh(spark, clean, tmp_path):
    for i, text in enumerate(sample_json()):
        record = json.loads(text)
        month = record["mesExtrato"][:4] + "-" + record["mesExtrato"][4:]
        folder = tmp_path / f"mes={month}" / "pagina=1"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i}.json").write_text(json.dumps([record]))
    # the rolling window as of September holds July and August only
    summary = {
        r.table_name: r.n_rows
        for r in refresh.refresh(spark, settings(), str(tmp_path)).collect()
    }
    assert summary["gold.fct_gastos_cartao"] == 4
    # the next load has all months; bronze keeps what it had
    whole = settings(load_id="carga-2", first_month="1/2026", last_month="8/2026")
    summary = {r.table_name: r.n_rows for r in refresh.refresh(spark, whole, str(tmp_path)).collect()}
    assert summary["gold.fct_gastos_cartao"] == N_SAMPLE
    with pytest.raises(EmptyLoadError):
        refresh.refresh(spark, settings(as_of=dt.date(2030, 1, 1)), str(tmp_path))
    assert spark.table("bronze.cartoes_pagamento").count() == N_SAMPLE


def test_failing_check_stops_the_refresh(spark, clean):
    with pytest.raises(quality.QualityError, match="relationships fct_gastos_cartao.sk_data"):
        refresh.refresh(spark, settings(calendar_start="2026-02-01"))


def test_failing_anomalies_do_not(spark, clean, monkeypatch):
    def broken(*args):
        raise RuntimeError("no model")

    monkeypatch.setattr(refresh, "detect_anomalies", broken)
    names = {r.table_name for r in refresh.refresh(spark, settings()).collect()}
    assert "gold.fct_gastos_cartao" in names and warehouse.SCORE_TABLE not in names


def test_empty_layers(spark, clean):
    refresh.ingest_sample(spark, settings())
    models = refresh.transform(spark, settings(cutoff="2099-01"))
    assert refresh.detect_anomalies(spark, settings()) == {"status": "skipped", "count": 0}
    failed = quality.run_checks(models).where("failures > 0").collect()
    assert {(r.check, r.table_name) for r in failed} == {
        ("non_empty", t) for t in quality.NON_EMPTY_FACT + quality.NON_EMPTY_DIMENSIONS
    }
    with pytest.raises(warehouse.EmptyFactError):
        warehouse.require_fact(spark)


def test_checks_are_the_declared_fifty(spark):
    assert sum(map(len, quality.NOT_NULL.values())) == 26
    assert len(quality.UNIQUE) == 12
    assert sum(map(len, quality.RELATIONSHIPS.values())) == 9


def test_each_check_finds_its_defect(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "z")], "k INT, v STRING")
    parent = spark.createDataFrame([("a",)], "v STRING")
    failures = lambda report: [r.failures for r in report.collect()]
    assert failures(quality.check_not_null(rows, "t", ["k", "v"])) == [1, 1]
    assert failures(quality.check_unique(rows, "t", "k")) == [1]
    assert failures(quality.check_relationship(rows, "t", "v", parent)) == [2]
    assert failures(quality.check_accepted(rows, "t", "v", ["a", "b"])) == [1]
    assert failures(quality.check_non_empty(rows.limit(0), "t")) == [1]
    empty = rows.limit(0)
    assert failures(quality.check_not_null(empty, "t", ["k"])) == [0]
    assert failures(quality.check_relationship(empty, "t", "v", parent)) == [0]


def test_calendar(spark):
    days = calendar.calendar(spark)
    assert days.count() == 1462
    assert days.where("fl_fim_semana = 1").count() == 417
    march = days.where("sk_data = 20240331").first()
    assert (march.nome_mes, march.dia_semana, march.ano_mes) == ("Março", 1, "2024-03")
    unknown = days.where("sk_data = 19000101").first()
    assert (unknown.ano_mes, unknown.nome_mes, unknown.dia_semana) == ("1900-00", "Desconhecido", 0)


def test_older_version_in_period_outlives_newer_one_outside(spark):
    sample = flatten(read_sample(spark), "1").where("id = 7000001")
    newer = sample.withColumns({
        "mes_extrato": F.lit("202312"), "_dlt_load_id": F.lit("2"), "valor_transacao": F.lit("1,00"),
    })
    row = stage(sample.unionByName(newer)).collect()
    assert [(r.ano_mes_extrato, r.vl_transacao) for r in row] == [("2026-01", Decimal("912.40"))]


def test_severity_limits(spark):
    rows = spark.createDataFrame([
        (2.5, 1.0, 3), (2.49, 39999.99, 2), (None, 40000.0, 3), (1.8, 0.0, 2), (1.79, 14999.99, 1),
        (None, 15000.0, 2), (None, None, 1),
    ], "z DOUBLE, v DOUBLE, s INT")
    got = rows.select("s", facts.severity(F.col("z"), F.col("v")).alias("g")).collect()
    assert all(r.s == r.g for r in got)


def test_one_row_agency_has_z_zero(spark):
    staging = stage(flatten(read_sample(spark), "1")).where("id_transacao in (7000001, 7000002)")
    named = facts.with_agency_name(facts.fact_silver(staging), dimensions.dim_orgaos(staging))
    gold = facts.fact_gold(named, facts.agency_stats(named)).collect()
    assert {r.z_score for r in gold} == {0.0}


def test_equal_versions_are_settled_by_content(spark):
    sample = flatten(read_sample(spark), "1").where("id = 7000001")
    other = sample.withColumn("estabelecimento__nome", F.lit("ZZZ"))
    for rows in (sample.unionByName(other), other.unionByName(sample)):
        assert [r.nome_favorecido for r in stage(rows.coalesce(1)).collect()] == ["ZZZ"]


def test_a_cut_off_swap_leaves_a_whole_table(spark, clean, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS gold")
    publish = lambda n: warehouse.publish(spark.range(n), "gold.t")
    publish(3)

    def lost(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(warehouse, "_swap", lost)
        with pytest.raises(RuntimeError):
            publish(5)
    assert spark.table("gold.t").count() == 3
    spark.sql("ALTER TABLE gold.t RENAME TO gold.t__last")  # lost between the two renames
    warehouse.recover(spark, "gold.t")
    assert spark.table("gold.t").count() == 3
    assert publish(4).count() == 4
    assert {t.name for t in spark.catalog.listTables("gold") if not t.isTemporary} == {"t"}


def test_copies_of_a_run_are_removed(spark):
    from pathlib import Path

    from cardwarden.sources.scratch import materialize, scratch_run

    with pytest.raises(RuntimeError), scratch_run(spark) as folder:
        assert materialize(spark.range(4), "copy").count() == 4
        assert Path(folder.removeprefix("file:")).exists()
        raise RuntimeError("failed on the way")
    assert not Path(folder.removeprefix("file:")).exists()


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from cardwarden.sources.scratch import scratch_root

    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(session)
