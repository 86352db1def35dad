"""Calendar dimension with its unknown member."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.fixed_values import (
    CALENDAR_END,
    CALENDAR_START,
    MONTH_NAMES,
    UNKNOWN_DATE,
    UNKNOWN_DATE_KEY,
    UNKNOWN_LABEL,
    UNKNOWN_MONTH,
)
from cardwarden.functions.dates import date_key


def describe_dates(days: DataFrame) -> DataFrame:
    """Calendar attributes of a ``dt_data`` column; Sunday is weekday 1."""
    d = F.col("dt_data")
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    return days.select(
        date_key(d).alias("sk_data"),
        d,
        F.year(d).alias("ano"),
        F.quarter(d).alias("trimestre"),
        F.month(d).alias("mes"),
        F.date_format(d, "yyyy-MM").alias("ano_mes"),
        F.date_format(d, "MM/yyyy").alias("mes_ano"),
        F.element_at(names, F.month(d)).alias("nome_mes"),
        F.dayofmonth(d).alias("dia"),
        F.dayofweek(d).alias("dia_semana"),
        F.dayofweek(d).isin(1, 7).cast("int").alias("fl_fim_semana"),
    )


def unknown_date(spark: SparkSession) -> DataFrame:
    """The member that stands for a date nobody knows."""
    zero = F.lit(0)
    return spark.range(1).select(
        F.lit(UNKNOWN_DATE_KEY).alias("sk_data"),
        F.lit(UNKNOWN_DATE).cast("date").alias("dt_data"),
        F.lit(1900).alias("ano"),
        zero.alias("trimestre"),
        zero.alias("mes"),
        F.lit(UNKNOWN_MONTH).alias("ano_mes"),
        F.lit(UNKNOWN_LABEL).alias("mes_ano"),
        F.lit(UNKNOWN_LABEL).alias("nome_mes"),
        zero.alias("dia"),
        zero.alias("dia_semana"),
        zero.alias("fl_fim_semana"),
    )


def calendar(
    spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END
) -> DataFrame:
    """Every day of ``start..end`` plus the unknown member.

    Days come from ``range``, whose size Spark knows, so it broadcasts the calendar by its
    own size check.
    """
    n_days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    days = spark.range(max(n_days, 0)).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("dt_data")
    )
    return describe_dates(days).unionByName(unknown_date(spark))
