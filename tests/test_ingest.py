"""Landing, normalisation, bronze upsert and the streaming sink."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from cardwarden.operators import bronze
from cardwarden.operators.normalize import flatten, normalize_records
from cardwarden.sources.landing import month_plan, read_landing
from cardwarden.sources.schemas import RAW_RECORD
from cardwarden.streaming.late_data import stream_landing

RICH = {
    "id": 31, "mesExtrato": "05/2026", "dataTransacao": "02/04/2026", "valorTransacao": "88,10",
    "tipoCartao": {"id": 7, "codigo": "7", "descricao": "Cartao azul"},
    "estabelecimento": {
        "id": 4, "cpfFormatado": "", "cnpjFormatado": "90.817.263/0004-15", "numeroInscricaoSocial": "",
        "nome": "90.817.263 PADARIA", "razaoSocialReceita": "PADARIA", "nomeFantasiaReceita": "PAO QUENTE",
        "tipo": "Entidade de teste",
    },
    "unidadeGestora": {
        "codigo": "606060", "nome": "UNIDADE X", "descricaoPoder": "EXECUTIVO",
        "orgaoVinculado": {"codigoSIAFI": "60606", "cnpj": "11222333000144", "sigla": "OVX", "nome": "Orgao X"},
        "orgaoMaximo": {"codigo": "60000", "sigla": "OSX", "nome": "Acima de X"},
    },
    "portador": {"cpfFormatado": "***.246.810-**", "nis": "", "nome": "RITA"},
}


def parse(spark, *records):
    texts = spark.createDataFrame([(json.dumps(r),) for r in records], "t STRING")
    return texts.select(F.from_json("t", RAW_RECORD).alias("r")).select("r.*")


def normal(spark, record):
    return normalize_records(parse(spark, record)).first().asDict(recursive=True)


def test_missing_parts_get_defaults(spark):
    got = normal(spark, {"id": 12345, "mesExtrato": "01/2026", "valorTransacao": "150,00"})
    assert got["id"] == 12345 and got["valorTransacao"] == "150,00"
    assert got["estabelecimento"]["nome"] == got["portador"]["nome"] == "NAO INFORMADO"
    assert got["estabelecimento"]["cgc"] == got["portador"]["cpf"] == "NAO INFORMADO"
    assert got["unidadeGestora"]["codigo"] == got["orgaoSuperior"]["codigo"] == "00000"
    assert got["unidadeGestora"]["descricaoPoder"] == "EXECUTIVO"
    assert (got["tipoCartao"]["id"], got["tipoCartao"]["codigo"]) == (1, "1")


def test_rich_record_is_kept(spark):
    got = normal(spark, RICH)
    firm = got["estabelecimento"]
    assert (firm["nome"], firm["razaoSocialReceita"]) == ("PADARIA", "PADARIA")
    assert firm["nomeFantasiaReceita"] == "PAO QUENTE"
    assert firm["cnpjFormatado"] == firm["cgc"] == RICH["estabelecimento"]["cnpjFormatado"]
    assert got["orgaoSuperior"] == {"codigo": "60000", "nome": "Acima de X", "sigla": "OSX"}
    assert (got["orgaoVinculado"]["codigo"], got["orgaoVinculado"]["sigla"]) == ("60606", "OVX")
    assert got["tipoCartao"] == {"id": 7, "codigo": "7", "descricao": "Cartao azul"}


def test_empty_object_counts_as_missing(spark):
    got = normal(spark, {
        "id": 1, "tipoCartao": {"id": 0}, "unidadeGestora": {"orgaoVinculado": {}},
        "orgaoVinculado": {"codigo": "9", "nome": "TOPO"},
        "estabelecimento": {"nome": "90.817.263 A", "razaoSocialReceita": "", "cgc": "X"},
    })
    assert got["orgaoVinculado"]["codigo"] == "9" and got["orgaoVinculado"]["nome"] == "TOPO"
    assert (got["tipoCartao"]["id"], got["tipoCartao"]["codigo"]) == (1, "1")
    assert got["estabelecimento"]["razaoSocialReceita"] == "A"
    assert got["estabelecimento"]["cgc"] == "X"


def test_flat_columns(spark):
    flat = flatten(normalize_records(parse(spark, RICH)), "carga")
    row = flat.first()
    assert row["estabelecimento__razao_social_receita"] == "PADARIA"
    assert row["orgao_superior__codigo"] == "60000" and row["_dlt_load_id"] == "carga"
    assert row["_dlt_id"] == flatten(parse(spark, RICH), "carga").first()["_dlt_id"]


def months(spark, first, last):
    pair = spark.createDataFrame([(first, last)], "inicio STRING, fim STRING")
    return sorted(r.mes for r in month_plan(pair).collect())


def test_month_plan(spark):
    assert months(spark, "11/2025", "202602") == ["2025-11", "2025-12", "2026-01", "2026-02"]
    assert months(spark, "03/2026", "01/2026") == []
    assert months(spark, "2026", "2026") == [f"2026-{m:02d}" for m in range(1, 8)]
    with pytest.raises(Exception, match="no such month"):
        months(spark, "13/2026", "01/2027")


def land(root, month, page, payload):
    folder = root / f"mes={month}" / f"pagina={page}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{uuid.uuid4().hex}.json").write_text(json.dumps(payload))


def test_pages_up_to_the_gap(spark, tmp_path, caplog):
    land(tmp_path, "2026-01", 1, [{"id": 1}, {"id": 2}])
    land(tmp_path, "2026-01", 2, {"id": 3})
    land(tmp_path, "2026-01", 3, [])
    land(tmp_path, "2026-01", 4, [{"id": 4}])
    land(tmp_path, "2026-02", 2, [{"id": 5}])
    for page in range(1, 8):
        land(tmp_path, "2026-03", page, [{"id": 100 + page}])
    land(tmp_path, "2026-04", 1, [{"id": 6}])
    got = read_landing(spark, str(tmp_path), "1/2026", "3/2026")
    assert sorted(r.id for r in got.collect()) == [1, 2, 3, *range(101, 108)]
    assert [r.getMessage() for r in caplog.records] == [
        "2026-01: 1 pages with 1 rows lie behind a gap and are dropped",
        "2026-02: 1 pages with 1 rows lie behind a gap and are dropped",
    ]
    capped = read_landing(spark, str(tmp_path), "1/2026", "3/2026", max_pages=5)
    assert sorted(r.id for r in capped.collect()) == [1, 2, 3, *range(101, 106)]
    assert read_landing(spark, str(tmp_path), "4/2026", "1/2026").count() == 0


def flat_rows(spark, load, *rows):
    records = [
        {"id": i, "mesExtrato": month, "valorTransacao": value} for i, month, value in rows
    ]
    return flatten(normalize_records(parse(spark, *records)), load)


def content(spark, table):
    rows = spark.table(table).select("id", "mes", "valor_transacao", "_dlt_load_id").collect()
    return sorted(tuple(r) for r in rows)


@pytest.fixture
def table(spark):
    name = f"b{uuid.uuid4().hex[:8]}.cartoes"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name.split('.')[0]} CASCADE")


def test_upsert_replaces_moves_and_keeps(spark, table):
    bronze.upsert(flat_rows(spark, "1", (1, "202601", "a"), (2, "02/2026", "b"),
                            (3, "202603", "c"), (4, "lixo", "d")), table)
    second = flat_rows(spark, "2", (2, "202603", "B"), (5, "202603", "e"), (5, "202603", "f"))
    expected = [
        (1, "2026-01", "a", "1"), (2, "2026-03", "B", "2"), (3, "2026-03", "c", "1"),
        (4, "outros", "d", "1"), (5, "2026-03", "f", "2"),
    ]
    for _ in range(2):  # the same load again changes nothing
        bronze.upsert(second, table)
        assert content(spark, table) == expected
    partitions = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    assert partitions == {"mes=2026-01", "mes=2026-03", "mes=outros"}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "STATIC"


def test_untouched_months_are_not_rewritten(spark, table, tmp_path):
    bronze.upsert(flat_rows(spark, "1", (1, "202601", "a"), (2, "202602", "b")), table)
    files = lambda: {
        f for f in spark.table(table).where("mes = '2026-01'").inputFiles()
    }
    before = files()
    bronze.upsert(flat_rows(spark, "2", (2, "202602", "B"), (3, "202602", "c")), table)
    assert files() == before and len(content(spark, table)) == 3


def test_months_that_do_not_exist_are_no_partitions(spark, table):
    bronze.upsert(flat_rows(spark, "1", (1, "999999", "a"), (2, "202677", "b"), (3, "202612", "c")), table)
    assert [r[:2] for r in content(spark, table)] == [(1, "outros"), (2, "outros"), (3, "2026-12")]


def test_stream_loads_follow_their_day():
    stream = [f"2026-09-30.{n:09d}" for n in (0, 7, 12)]
    assert sorted(["2026-10-01", *stream[::-1], "2026-09-30"]) == ["2026-09-30", *stream, "2026-10-01"]


def test_half_done_publication_is_finished(spark, table, monkeypatch):
    bronze.upsert(flat_rows(spark, "1", (1, "202601", "a"), (2, "202602", "b")), table)

    def lost(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(bronze, "_publish", lost)
        with pytest.raises(RuntimeError):
            bronze.upsert(flat_rows(spark, "2", (1, "202602", "A")), table)
    assert content(spark, table)[0] == (1, "2026-01", "a", "1")
    assert bronze.recover(spark, table) == 1
    assert content(spark, table) == [(1, "2026-02", "A", "2"), (2, "2026-02", "b", "1")]
    assert bronze.recover(spark, table) == 0


def test_bad_loads_are_refused(spark, table):
    empty = flat_rows(spark, "1", (1, "202601", "a")).limit(0)
    with pytest.raises(bronze.EmptyLoadError):
        bronze.require_records(empty)
    with pytest.raises(bronze.MissingKeyError):
        bronze.upsert(flat_rows(spark, "1", (None, "202601", "a")), table)


def test_merge_equals_brute_force(spark):
    old = [(i, "202601", f"v{i}") for i in range(60)]
    new = [(i % 80, "202602", f"n{i}") for i in range(20, 200, 3)]
    merged = bronze.merge(flat_rows(spark, "1", *old), flat_rows(spark, "2", *new))
    expected = {i: v for i, _, v in old}
    latest = {}
    for i, _, v in new:
        latest[i] = max(latest.get(i, ""), v)
    expected.update(latest)
    rows = merged.select("id", "valor_transacao").collect()
    assert len(rows) == len(expected) and {r[0]: r[1] for r in rows} == expected


def test_stream_of_late_pages(spark, table, tmp_path):
    root, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    land(root, "2026-01", 1, [{"id": 1, "mesExtrato": "202601", "valorTransacao": "1,00"},
                              {"id": 2, "mesExtrato": "202601", "valorTransacao": "2,00"}])

    def run():
        stream_landing(spark, str(root), checkpoint, "s", table).awaitTermination()

    run()
    land(root, "2026-01", 2, [{"id": 2, "mesExtrato": "202601", "valorTransacao": "9,00"}])
    land(root, "2026-02", 1, {"id": 3, "mesExtrato": "202602", "valorTransacao": "3,00"})
    run()
    run()
    assert [r[:3] for r in content(spark, table)] == [
        (1, "2026-01", "1,00"), (2, "2026-01", "9,00"), (3, "2026-02", "3,00"),
    ]
