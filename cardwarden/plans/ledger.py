"""What was loaded into bronze, which months it touched, and what silver has taken over of it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "entry STRING, load_id STRING, state STRING, months ARRAY<STRING>"
BEGUN, DONE = "begun", "done"
TAKEN = "entry STRING, cutoff STRING"
TAKEN_TABLE = "silver.loads_taken"  # of the same namespace as bronze


def ledger_table(bronze_table: str) -> str:
    return f"{bronze_table}__loads"


def _append(spark: SparkSession, table: str, rows: list[tuple], schema: str) -> None:
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").saveAsTable(table)


def begin(spark: SparkSession, bronze_table: str, load_id: str, months: set[str]) -> str:
    """Note a load before its months are published: silver may look at a month once too often, never once too little."""
    entry = uuid.uuid4().hex
    _append(spark, ledger_table(bronze_table), [(entry, load_id, BEGUN, sorted(months))], LEDGER)
    return entry


def finish(spark: SparkSession, bronze_table: str, entry: str, load_id: str) -> None:
    _append(spark, ledger_table(bronze_table), [(entry, load_id, DONE, [])], LEDGER)


def is_done(spark: SparkSession, bronze_table: str, load_id: str) -> bool:
    """Whether a load of this id was published to its end."""
    table = ledger_table(bronze_table)
    if not spark.catalog.tableExists(table):
        return False
    return not spark.table(table).where((F.col("state") == DONE) & (F.col("load_id") == load_id)).isEmpty()


def not_taken(spark: SparkSession, bronze_table: str, cutoff: str, taken_table: str = TAKEN_TABLE) -> DataFrame | None:
    """(entry, months) of loads that silver has not seen; None where silver must see everything."""
    ledger = ledger_table(bronze_table)
    if not (spark.catalog.tableExists(taken_table) and spark.catalog.tableExists(ledger)):
        return None
    taken = spark.table(taken_table)
    if taken.isEmpty() or not taken.where(F.col("cutoff") != cutoff).isEmpty():
        return None
    return spark.table(ledger).where(F.col("state") == BEGUN).join(taken, "entry", "left_anti").select("entry", "months")


def entries(spark: SparkSession, bronze_table: str) -> list[str]:
    """All loads noted so far: one row a load."""
    ledger = ledger_table(bronze_table)
    if not spark.catalog.tableExists(ledger):
        return []
    return [r.entry for r in spark.table(ledger).where(F.col("state") == BEGUN).select("entry").collect()]


def take(spark: SparkSession, found: list[str], cutoff: str, anew: bool, taken_table: str = TAKEN_TABLE) -> None:
    """Note that silver holds these loads; ``anew`` forgets the earlier ones."""
    if not found and not anew:
        return
    rows = spark.createDataFrame([(e, cutoff) for e in found], TAKEN).coalesce(1)
    rows.write.mode("overwrite" if anew else "append").saveAsTable(taken_table)


def pages_table(bronze_table: str) -> str:
    return f"{bronze_table}__pages"


def add_pages(report: DataFrame, bronze_table: str, load_id: str) -> None:
    """Note the pages of a load, (mes, pagina, n_rows, kept): also those behind a gap, which it dropped."""
    rows = report.select(F.lit(load_id).alias("load_id"), "mes", "pagina", "n_rows", "kept")
    rows.coalesce(1).write.mode("append").saveAsTable(pages_table(bronze_table))
