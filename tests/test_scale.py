"""What must not grow faster than the rows: files, shuffles and steps done twice."""

import pytest
from pyspark.sql import functions as F

from cardwarden.operators import bronze, iforest
from cardwarden.plans import publication
from cardwarden.plans import testdata_queries as queries
from cardwarden.sources import files
from cardwarden.sources.landing import until_first_gap
from cardwarden.sources.scratch import METHOD_BYTES, METHOD_LIMIT, short_methods

SF_DIR = "/root/testdata/sf0.01"


def array_files(spark):
    """(pages, {file: its first character}) of the landed array files."""
    path = queries.land_arrays(spark, SF_DIR)
    texts = spark.read.text(path, wholetext=True).select(
        "mes", "pagina", F.col("_metadata.file_path").alias("f"), F.left("value", F.lit(1)).alias("c")
    ).collect()
    return {(r.mes, r.pagina) for r in texts}, {r.f: r.c for r in texts}


def test_array_files_follow_the_rows_of_a_page(spark):
    pages, found = array_files(spark)
    assert len(pages) <= len(found) <= 2 * len(pages)
    assert set(found.values()) == {"[", "{"}


def test_a_large_page_has_several_array_files(spark, monkeypatch):
    monkeypatch.setattr(queries, "ARRAY_ROWS", 5)
    pages, found = array_files(spark)
    arrays = [f for f, c in found.items() if c == "["]
    assert len(arrays) > 2 * len(pages)
    got = queries.read_landing(spark, arrays[0].rsplit("/", 3)[0], "1/1990", "12/2005")
    want = queries.landed_records(spark, SF_DIR)
    good = until_first_gap(want)
    assert sorted(r.id for r in got.select("id").collect()) == sorted(r.id for r in good.select("id").collect())


BRONZE = "id BIGINT, mes_extrato STRING, valor_transacao STRING, _dlt_load_id STRING, _dlt_id STRING"


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE scale")
    yield "scale"
    spark.sql("DROP DATABASE scale CASCADE")


def load(spark, number, ids):
    rows = [(i, f"2026{i % 3 + 1:02d}", f"{number},{i}", f"load-{number:03d}", f"{number}|{i}") for i in ids]
    return spark.createDataFrame(rows, BRONZE)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bits", [2**27, 2**15, 64])
def test_rows_of_a_loads_keys_are_never_settled(spark, monkeypatch, bits):
    monkeypatch.setattr(bronze, "KEY_BITS", bits)
    rows = spark.range(-3000, 6000).unionByName(spark.createDataFrame([(None,)], "id BIGINT"))
    keys = spark.range(-3000, 6000, 9)
    settled, others = bronze.split_by_keys(rows, keys, 1000)
    assert "Exchange hashpartitioning(id" not in plan(settled)
    kept = [r.id for r in settled.collect()]
    assert not {i for i in kept if i is not None} & set(range(-3000, 6000, 9))
    both = kept + [r.id for r in others.collect()]
    assert sorted(both, key=str) == sorted([r.id for r in rows.collect()], key=str)
    assert bits == 64 or len(kept) > 7000


def test_a_load_without_repeated_keys_is_not_shuffled(spark):
    once = bronze.one_per_key(load(spark, 1, range(100)))
    assert "Exchange" not in plan(once) and once.count() == 100
    twice = load(spark, 1, range(100)).unionByName(load(spark, 2, range(50, 60)))
    got = {r.id: r.valor_transacao for r in bronze.one_per_key(twice).collect()}
    assert got == {i: f"{2 if 50 <= i < 60 else 1},{i}" for i in range(100)}


def test_months_that_are_gathered_are_not_shuffled_again(spark):
    rows = spark.range(10).selectExpr("id", "'m' AS mes")
    assert "Exchange" not in plan(publication.by_month(None, "mes", "id", gathered=rows))
    assert "Exchange" in plan(publication.by_month(rows, "mes", "id", gathered=rows))


def test_many_small_loads_leave_few_files(spark, database, monkeypatch):
    monkeypatch.setattr(publication, "FEW_FILES", 3)
    table = f"{database}.cartoes"
    want = {}
    for number in range(1, 8):
        ids = range(0, 60) if number == 1 else range(number * 7, number * 7 + 4)
        bronze.upsert(load(spark, number, ids), table, f"load-{number:03d}")
        want |= {i: f"{number},{i}" for i in ids}
        assert {r.id: r.valor_transacao for r in spark.table(table).collect()} == want
        assert spark.table(table).count() == len(want)
    for path in publication.month_folders(spark, table).values():
        assert files.extent(spark, path)[0] <= 3 + 8


def test_landed_pages_are_packed(spark):
    path = queries.land_pages(spark, "/root/testdata/sf0.001")
    assert all(f.endswith(".json.gz") for f in spark.read.text(path).inputFiles())


@pytest.mark.parametrize("query", ["dq_all", "star_scored"])
def test_the_feed_is_staged_once(spark, monkeypatch, query):
    built, staged = [], queries.staged
    monkeypatch.setattr(queries, "staged", lambda *args: built.append(args) or staged(*args))
    queries.QUERIES[query](spark, "/root/testdata/sf0.001")
    assert len(built) == 1


def test_long_methods_are_split_while_a_copy_is_written(spark):
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, 65535)
    try:
        with short_methods(spark):
            assert int(spark.conf.get(METHOD_LIMIT)) == METHOD_BYTES
        assert int(spark.conf.get(METHOD_LIMIT)) == 65535
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def test_rows_of_no_tree_are_dropped_before_they_are_unfolded(spark):
    matrix = spark.range(100_000).select("id", *[F.col("id").cast("double").alias(c) for c in iforest.MODEL_COLUMNS])
    sample = iforest.sample_rows(matrix, 100_000, iforest.ForestSpec(trees=3, sample=20), "id")
    assert "exists(" in plan(sample)
    assert {r["tree"]: r["count"] for r in sample.groupBy("tree").count().collect()} == {0: 20, 1: 20, 2: 20}
