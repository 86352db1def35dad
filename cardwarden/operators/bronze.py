"""Keyed upsert into bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.operators.staging import PARTITION, bronze_partition, latest_version
from cardwarden.plans import ledger, publication
from cardwarden.plans.lease import writer_lease
from cardwarden.sources.scratch import materialize_measured

BRONZE_TABLE = "bronze.cartoes_pagamento"
KEY = "id"
#: Size of the bit map that tells which rows a load surely leaves alone.
KEY_BITS = 2**27


class EmptyLoadError(RuntimeError):
    """A load brought no record at all."""


class MissingKeyError(RuntimeError):
    """A load brought records without an id."""


def require_records(records: DataFrame, period: str = "") -> None:
    """Refuse an empty load before anything is written."""
    if records.isEmpty():
        raise EmptyLoadError(f"no record in the load {period}; bronze is left as it is")


def one_per_key(incoming: DataFrame) -> DataFrame:
    """The latest row per key within a load; equal loads are settled by content.

    Which keys occur more than once is found on the keys alone, so only their rows are shuffled.
    ``incoming`` is read several times and should be a written table.
    """
    counts = incoming.groupBy(F.col(KEY).alias("_repeated")).agg(F.count("*").alias("_n"))
    repeated, seen = materialize_measured(counts.where("_n > 1").select("_repeated"), "repeated", n=F.count("*"))
    if not seen["n"]:
        return incoming
    is_repeated = F.col(KEY).eqNullSafe(F.col("_repeated"))
    rest = [c for c in incoming.columns if c not in (KEY, "_dlt_load_id", "_dlt_id")]
    several = incoming.join(repeated, is_repeated, "left_semi")
    latest = latest_version(several, KEY, "_dlt_load_id", "_dlt_id", *rest)
    return incoming.join(repeated, is_repeated, "left_anti").unionByName(latest)


def split_by_keys(rows: DataFrame, keys: DataFrame, n_keys: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` that surely have none of the keys, and all others, without a shuffle of ``rows``.

    Hashes of the keys mark a bit map that is broadcast: 16 bits a key, and ``KEY_BITS`` (16 MB) at
    most. Beyond that more rows without a key are among the others, up to all of them.
    """
    bits = min(KEY_BITS, max(2**15, 2 ** (16 * max(n_keys, 1)).bit_length()))
    place = F.pmod(F.xxhash64(KEY), F.lit(bits))
    marks = keys.select(F.bitmap_bucket_number(place).alias("_part"), F.bitmap_bit_position(place).alias("_bit"))
    # dealt by part first: partial maps of every task would be larger than the marks
    maps = marks.repartition("_part").groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    bit = F.bitmap_bit_position(place)
    octet = F.conv(F.hex(F.substring("_map", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = rows.join(F.broadcast(maps), F.bitmap_bucket_number(place) == F.col("_part"), "left").withColumn(
        "_marked", F.coalesce(F.getbit(octet, (bit % 8).cast("int")) == 1, F.lit(False))
    )
    return tuple(marked.where(wanted).select(rows.columns) for wanted in (~F.col("_marked"), F.col("_marked")))


def merge(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Existing rows without an incoming one of their key, plus the incoming rows."""
    kept = existing.join(incoming.select(KEY).distinct(), KEY, "left_anti")
    return kept.select(existing.columns).unionByName(one_per_key(incoming))


def _months(df: DataFrame) -> set[str]:
    """Distinct months of a table: as many as it has partitions."""
    return {row[0] for row in df.select(PARTITION).distinct().collect()}


def _publish(spark: SparkSession, note: str, table: str) -> None:
    """Let the prepared version take over. Repeating it gives the same table."""
    publication.finish_release(spark, note, [table])


def recover(spark: SparkSession, table: str = BRONZE_TABLE) -> int:
    """Finish publications that a lost driver left half done."""
    return publication.recover(spark, table.split(".")[0], table)


def upsert(incoming: DataFrame, table: str = BRONZE_TABLE, load_id: str = "", once: bool = False) -> set[str]:
    """Replace or add the incoming rows by key, writing only the months they touch, once.

    Touched are the months of the load and the months in which an older version of one of
    its transactions lies; they are returned, and noted in the ledger before they change. Their
    new content is written to folders of its own, and the table's next version points to these
    and to the untouched months. Readers see the old version until that takes over the name.
    Rows of these months that the load surely leaves alone are copied by the tasks that read them;
    only the others are shuffled, and all rows of a month that lies in many small files.
    ``incoming`` is read several times and should be a written table. Writers wait for one another.
    With ``once``, a load whose id the ledger has as done is not taken again.
    """
    spark = incoming.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    incoming = incoming.withColumn(PARTITION, bronze_partition())
    low, high, keyless, n_rows = incoming.agg(
        F.min(KEY), F.max(KEY), F.count_if(F.col(KEY).isNull()), F.count("*")
    ).first()
    if keyless:
        raise MissingKeyError(f"{keyless} records of the load have no {KEY}")
    with writer_lease(spark, table):
        recover(spark, table)
        if once and ledger.is_done(spark, table, load_id):
            return set()
        loaded = _months(incoming)
        if not publication.is_by_months(spark, table):  # none yet, or one of an older layout
            current = [spark.table(table)] if spark.catalog.tableExists(table) else []
            merged = merge(current[0], incoming) if current else one_per_key(incoming)
            touched = loaded | (_months(current[0]) if current else set())
            months, settled = None, None
        else:
            current = spark.table(table)
            # older versions elsewhere: only ids are read, and only row groups in the load's id range
            elsewhere = (
                current.where(~F.col(PARTITION).isin(*loaded) & F.col(KEY).between(low, high))
                .select(KEY, PARTITION)
                .join(incoming.select(KEY).distinct(), KEY, "left_semi")
            )
            touched = months = loaded | _months(elsewhere)
            settled, others = split_by_keys(current.where(F.col(PARTITION).isin(*touched)), incoming, n_rows)
            if scattered := publication.scattered_months(spark, table) & touched:
                is_scattered = F.col(PARTITION).isin(*scattered)
                others = others.unionByName(settled.where(is_scattered))
                settled = settled.where(~is_scattered)
            merged = merge(others, incoming)
        publication.prepare_months(merged, table, months, KEY, gathered=settled)
        entry = ledger.begin(spark, table, load_id, touched)
        _publish(spark, publication.open_release(spark, [table]), table)
        ledger.finish(spark, table, entry, load_id)
    return touched
