"""Joins by keys of which one holds a third of the rows."""

import statistics

import pytest
from pyspark.sql import functions as F

from cardwarden.operators.lookup import attach_attributes, attach_group_count, hot_keys


@pytest.fixture
def shuffled(spark):
    """No side is small enough to be broadcast by its size, and nothing is mended at run time."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_and_dim(spark, n=60_000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 != 1, F.concat(F.lit("k"), F.col("id") % 4000))
    rows = spark.range(n).select("id", key.alias("key"), F.col("id").alias("name"))
    dim = rows.where("key IS NOT NULL AND key NOT LIKE 'k%7'").select("key").distinct()
    return rows, dim.withColumns({"título": F.upper("key"), "size": F.length("key")})


def test_no_task_holds_the_hot_key(spark, shuffled):
    rows, dim = rows_and_dim(spark)
    joined = attach_attributes(rows, dim, "key", hot_keys(rows, ["key"])["key"], "id")
    def tasks(df):
        grouped = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.sum("size"))
        return [r["n"] for r in grouped.collect()]

    per_task = tasks(joined)
    assert sum(per_task) == 60_000 and len(per_task) == 16
    assert max(per_task) <= 2 * statistics.median(per_task)
    plain = rows.join(dim, "key", "left")
    by_key = tasks(plain)
    assert max(by_key) > 4 * statistics.median(by_key)  # what the plain join would do


def test_same_as_a_left_join(spark):
    rows, dim = rows_and_dim(spark, 9_000)
    hot = hot_keys(rows, ["key"], limit=5)["key"]
    assert hot.count() == 5 and hot.where("_hot_key = 'hot'").count() == 1
    joined = attach_attributes(rows, dim, "key", hot, "id")
    expected = rows.join(dim, "key", "left").select(joined.columns)
    assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()
    orphan = attach_attributes(rows, dim.where("key != 'hot'"), "key", hot, "id").where("key = 'hot' OR key IS NULL")
    assert orphan.where("size IS NOT NULL").isEmpty() and orphan.count() == rows.where("key = 'hot' OR key IS NULL").count()
    none = rows.limit(0)
    assert attach_attributes(none, dim, "key", hot_keys(none, ["key"])["key"], "id").isEmpty()
    assert attach_attributes(rows, dim.limit(0), "key", hot, "id").where("size IS NOT NULL").isEmpty()


def test_one_pass_for_several_keys(spark):
    rows = spark.createDataFrame([(1, "a", 7), (2, "a", 8), (3, None, 8), (4, "b", None)], "id INT, x STRING, y INT")
    hot = hot_keys(rows, ["x", "y"], limit=1)
    assert [[r[0] for r in hot[k].collect()] for k in ("x", "y")] == [["a"], ["8"]]
    counted = attach_group_count(rows, rows, "x", "id", "n")
    assert sorted((r.id, r.n) for r in counted.collect()) == [(1, 2), (2, 2), (3, None), (4, 1)]
