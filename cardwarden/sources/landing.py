"""Landed JSON pages, laid out as ``mes=YYYY-MM/pagina=N/``."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwarden.functions.periods import month_number, month_text, normalize_period
from cardwarden.sources.schemas import LANDING_PARTITIONS, RAW_RECORD
from cardwarden.sources.scratch import materialize_rows

log = logging.getLogger(__name__)


def month_plan(periods: DataFrame, first: str = "inicio", last: str = "fim") -> DataFrame:
    """One row per month of each (first, last) pair of period texts, both ends included.

    A pair whose first month lies after its last gives no rows.
    """
    normal = periods.withColumns({
        "_first": normalize_period(F.col(first), 1), "_last": normalize_period(F.col(last), 7)
    })
    ends = normal.withColumns({
        "_first": month_number(F.col("_first")), "_last": month_number(F.col("_last"))
    })
    span = F.when(F.col("_first") <= F.col("_last"), F.sequence("_first", "_last"))
    months = ends.withColumn("_month", F.explode(span))
    return months.withColumn("mes", month_text(F.col("_month"))).drop("_first", "_last", "_month")


def planned_months(spark: SparkSession, first: str, last: str) -> list[str]:
    """Months of one explicit period as ``YYYY-MM`` literals, for partition pruning."""
    period = spark.range(1).select(F.lit(first).alias("inicio"), F.lit(last).alias("fim"))
    return sorted(row.mes for row in month_plan(period).collect())


def read_pages(
    spark: SparkSession,
    root: str,
    months: list[str],
    max_pages: int | None = None,
    whole_files: bool = True,
) -> DataFrame:
    """Raw records of the planned months; all pages, or ``1..max_pages`` where a caller asks.

    Both filters are on partition columns, so other files are never opened.
    ``whole_files`` reads a file as one array or one object; otherwise one object a line,
    which lets Spark split large files.
    """
    pages = (
        spark.read.schema(f"{RAW_RECORD}, {LANDING_PARTITIONS}")
        .option("multiLine", whole_files)
        .json(root)
        .where(F.col("mes").isin(months) & (F.col("pagina") >= 1))
    )
    return pages if max_pages is None else pages.where(F.col("pagina") <= max_pages)


def page_report(records: DataFrame) -> DataFrame:
    """(mes, pagina, n_rows, kept) of every page with records, written.

    Kept are, per month, the pages 1, 2, … up to the first that holds no record: the page that
    is the n-th of its month has the number n. Records are counted before any shuffle.
    """
    pages = records.groupBy("mes", "pagina").agg(F.count("*").alias("n_rows"))
    place = F.row_number().over(W.partitionBy("mes").orderBy("pagina"))
    return materialize_rows(pages.withColumn("kept", F.col("pagina") == place), "pages")


def until_first_gap(records: DataFrame, report: DataFrame | None = None) -> DataFrame:
    """Drop, per month, everything after the first page that holds no record, and say so.

    A lost file hides the rest of its month: the pages and rows dropped are logged per month.
    """
    report = report or page_report(records)
    dropped = report.where("not kept").groupBy("mes").agg(
        F.count("*").alias("pages"), F.sum("n_rows").alias("rows")
    )
    for row in dropped.orderBy("mes").collect():  # one row a month of the plan
        log.warning("%s: %d pages with %d rows lie behind a gap and are dropped", row.mes, row.pages, row.rows)
    good = report.where("kept").select("mes", "pagina")
    return records.join(good, ["mes", "pagina"]).select(*records.columns)


def read_landing(
    spark: SparkSession,
    root: str,
    first: str,
    last: str,
    max_pages: int | None = None,
    whole_files: bool = True,
) -> DataFrame:
    """Records of a period as the paged source would give them.

    The files are read twice: for the list of pages, and for the rows of the good ones.
    """
    months = planned_months(spark, first, last)
    return until_first_gap(read_pages(spark, root, months, max_pages, whole_files))
