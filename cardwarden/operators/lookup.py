"""Counts and attributes by keys of which a few may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.sources.scratch import materialize_rows

HOT_KEYS = 1000


def attach_group_count(
    rows: DataFrame,
    source: DataFrame,
    key: str,
    counted: str,
    out: str,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Number of ``source`` rows with a ``counted`` value behind each row's key, as ``out``.

    Rows are counted per key once, before any shuffle, and the counts are written. The
    ``hot_keys`` most frequent keys are a table of that many rows at most, so their counts are
    broadcast. Their rows are done then: in the second join they carry a salt in place of the
    key, which meets no partner and spreads them over all tasks, however many there are. Every
    other key holds at most 1/``hot_keys`` of the rows. A NULL key gives a NULL count.

    The salt is part of the one join key on purpose: as a second key with a constant on the
    other side, the optimizer would turn it into a filter and shuffle by the bare key.
    """
    counts = source.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(counted).alias("_n"))
    counts = materialize_rows(counts, f"counts_{key}")
    hot = counts.orderBy(F.desc("_n"), key).limit(hot_keys)
    hot = hot.select(F.col(key).alias("_hot_key"), F.col("_n").alias("_hot_n"))
    tagged = F.concat(F.lit("="), F.col(key).cast("string"))
    cold = counts.select(tagged.alias("_cold_key"), F.col("_n").alias("_cold_n"))
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    salt = F.concat(F.lit("#"), F.xxhash64(counted).cast("string"))
    is_cold = F.col("_hot_key").isNull() & F.col(key).isNotNull()
    marked = marked.withColumn("_join_key", F.when(is_cold, tagged).otherwise(salt))
    joined = marked.join(cold, F.col("_join_key") == F.col("_cold_key"), "left")
    return joined.select(*rows.columns, F.coalesce("_hot_n", "_cold_n").alias(out))


def hot_keys(rows: DataFrame, keys: list[str], limit: int = HOT_KEYS) -> dict[str, DataFrame]:
    """The most frequent values of each key column, as text in ``_hot_key``: at most ``limit`` each.

    All columns are counted in one pass, per map task before the shuffle, and written once.
    """
    pairs = [F.struct(F.lit(k).alias("column_name"), F.col(k).cast("string").alias("_hot_key")) for k in keys]
    counts = rows.select(F.inline(F.array(*pairs))).where(F.col("_hot_key").isNotNull())
    counts = materialize_rows(counts.groupBy("column_name", "_hot_key").agg(F.count("*").alias("_n")), "key_counts")
    return {
        k: counts.where(F.col("column_name") == k).orderBy(F.desc("_n"), "_hot_key").limit(limit).select("_hot_key")
        for k in keys
    }


def attach_attributes(rows: DataFrame, dim: DataFrame, key: str, hot: DataFrame, spread: str) -> DataFrame:
    """Left join of ``rows`` with the other columns of ``dim`` by ``key``, whatever share one key holds.

    ``dim`` has one row a key. The attributes of the ``hot`` keys, at most as many as
    :func:`hot_keys` returns, are broadcast; their rows, and rows without a key, then carry a
    salt in place of the key, made of the column ``spread``, and meet no partner in the second
    join. Every other key holds at most one part in ``HOT_KEYS`` of the rows.
    """
    attributes = [c for c in dim.columns if c != key]
    packed = dim.select(F.col(key).cast("string").alias("_dim_key"), F.struct(*attributes).alias("_found"))
    known = hot.join(packed, F.col("_hot_key") == F.col("_dim_key"), "left").select("_hot_key", F.col("_found").alias("_hot_found"))
    marked = rows.join(F.broadcast(known), F.col(key).cast("string") == F.col("_hot_key"), "left")
    salt = F.concat(F.lit("#"), F.xxhash64(spread).cast("string"))
    is_cold = F.col("_hot_key").isNull() & F.col(key).isNotNull()
    marked = marked.withColumn("_join_key", F.when(is_cold, F.concat(F.lit("="), F.col(key).cast("string"))).otherwise(salt))
    cold = packed.select(F.concat(F.lit("="), "_dim_key").alias("_cold_key"), F.col("_found").alias("_cold_found"))
    joined = marked.join(cold, F.col("_join_key") == F.col("_cold_key"), "left")
    found = F.coalesce("_hot_found", "_cold_found")
    return joined.select(*rows.columns, *[found.getField(c).alias(c) for c in attributes])
