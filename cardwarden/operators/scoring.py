"""From raw degrees to scaled scores, flags, reasons and the run summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.fixed_values import (
    EXPLAIN_RARE_AMOUNT,
    EXPLAIN_RARE_SUPPLIER,
    EXPLAIN_Z,
    MODEL_VERSION,
    REASON_NONE,
    REASON_P95,
    REASON_P99,
    REASON_RARE,
    REASON_WEEKEND,
    REASON_Z,
)
from cardwarden.functions.numbers import round4_even


#: What :func:`flag` reads of a scored row.
FLAGGED = [
    "id_transacao", "anomaly_score", "fl_fim_semana", "z_score", "freq_favorecido", "vl_transacao",
]


def scale_scores(rows: DataFrame, span: tuple[float, float] | None = None) -> DataFrame:
    """Raw scores between 0 and 1 in four decimals; all equal gives 0.0 throughout.

    Least and greatest score are looked up unless they are known as ``span``.
    """
    if span is None:
        found = rows.agg(
            F.struct(F.min("raw_score").alias("low"), F.max("raw_score").alias("high"))
        ).scalar()
        low, high = found.getField("low"), found.getField("high")
    else:
        low, high = F.lit(span[0]), F.lit(span[1])
    scaled = F.coalesce(F.try_divide(F.col("raw_score") - low, high - low), F.lit(0.0))
    return rows.withColumn("anomaly_score", round4_even(scaled))


def score_histogram(scored: DataFrame) -> DataFrame:
    """Rows per score: 10 001 values at most, whatever the number of rows."""
    return scored.groupBy("anomaly_score").agg(F.count("*").alias("n"))


def score_limits(scored: DataFrame) -> DataFrame:
    """Exact, interpolated P95 and P99, from the histogram instead of all rows in one task."""
    return score_histogram(scored).agg(
        F.percentile("anomaly_score", 0.95, F.col("n")).alias("p95"),
        F.percentile("anomaly_score", 0.99, F.col("n")).alias("p99"),
    )


def reasons(p95: Column, p99: Column) -> Column:
    """Why a flagged row is odd; the values are those before the model's zero filling."""
    found = F.concat_ws(
        " | ",
        F.when(F.col("fl_fim_semana") == 1, REASON_WEEKEND),
        F.when(F.nanvl("z_score", F.lit(0.0)) >= EXPLAIN_Z, REASON_Z),
        F.when(
            (F.col("freq_favorecido") <= EXPLAIN_RARE_SUPPLIER)
            & (F.col("vl_transacao") > EXPLAIN_RARE_AMOUNT),
            REASON_RARE,
        ),
    )
    known = F.nullif(found, F.lit(""))
    return (
        F.when(p99 == 1, F.coalesce(known, F.lit(REASON_P99)))
        .when(p95 == 1, F.coalesce(known, F.lit(REASON_P95)))
        .otherwise(F.lit(REASON_NONE))
    )


def flag(scored: DataFrame, run_ts: datetime, version: str = MODEL_VERSION) -> DataFrame:
    """Flags from the percentile limits (ties included), reason, time and model version."""
    limits = score_limits(scored).select(F.struct("p95", "p99")).scalar()
    flagged = scored.withColumns({
        "is_anomaly_p95": (F.col("anomaly_score") >= limits.getField("p95")).cast("int"),
        "is_anomaly_p99": (F.col("anomaly_score") >= limits.getField("p99")).cast("int"),
    })
    return flagged.select(
        "id_transacao",
        "anomaly_score",
        "is_anomaly_p95",
        "is_anomaly_p99",
        reasons(F.col("is_anomaly_p95"), F.col("is_anomaly_p99")).alias("motivo_anomalia"),
        F.lit(run_ts).cast("timestamp").alias("dt_processamento"),
        F.lit(version).alias("model_version"),
    )


def run_summary(flagged: DataFrame) -> DataFrame:
    """Totals, flag counts and the spread of the scores, in one row.

    Reduced to one row per (score, flags) first, so the exact median and percentiles work
    on a bounded histogram.
    """
    histogram = flagged.groupBy("anomaly_score", "is_anomaly_p95", "is_anomaly_p99").agg(
        F.count("*").alias("n")
    )
    return histogram.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_processado"),
        F.coalesce(F.sum(F.col("n") * F.col("is_anomaly_p95")), F.lit(0)).alias("anomalias_p95"),
        F.coalesce(F.sum(F.col("n") * F.col("is_anomaly_p99")), F.lit(0)).alias("anomalias_p99"),
        F.min("anomaly_score").alias("score_min"),
        F.percentile("anomaly_score", 0.5, F.col("n")).alias("score_mediana"),
        F.percentile("anomaly_score", 0.95, F.col("n")).alias("score_p95"),
        F.percentile("anomaly_score", 0.99, F.col("n")).alias("score_p99"),
        F.max("anomaly_score").alias("score_max"),
    )
