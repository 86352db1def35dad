"""Features of the anomaly model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.fixed_values import FEATURES
from cardwarden.functions.numbers import clean_double
from cardwarden.operators.lookup import attach_group_count

MODEL_PREFIX = "x_"


def gold_features(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact rows with an amount, and the weekday of their date where the calendar has it."""
    days = dates.select("sk_data", "dia_semana", "fl_fim_semana")
    return (
        fact.where(F.col("vl_transacao").isNotNull())
        .join(days, "sk_data", "left")
        .select(
            "id_transacao",
            "sk_data",
            "sk_orgao",
            "sk_favorecido",
            "sk_portador",
            F.col("vl_transacao").cast("double").alias("vl_transacao"),
            F.col("media_orgao").cast("double").alias("media_orgao"),
            F.col("z_score").cast("double").alias("z_score"),
            F.coalesce("dia_semana", F.lit(1)).alias("dia_semana"),
            F.coalesce("fl_fim_semana", F.lit(0)).alias("fl_fim_semana"),
        )
    )


def feature_frame(gold: DataFrame, overall_mean: float | None = None) -> DataFrame:
    """Ratio to the agency mean and the frequencies of supplier and bearer.

    A mean that is 0 or missing is replaced by the overall mean, a ratio that still cannot
    be formed by 1.0. ``gold`` is read several times and should be a written table; pass its mean
    amount as ``overall_mean`` if it is known from writing it.
    """
    overall = gold.agg(F.avg("vl_transacao")).scalar() if overall_mean is None else F.lit(overall_mean)
    safe_mean = F.coalesce(F.nullif(F.col("media_orgao"), F.lit(0.0)), overall)
    ratio = F.coalesce(F.try_divide(F.col("vl_transacao"), safe_mean), F.lit(1.0))
    rows = gold.withColumn("razao_media_orgao", ratio)
    rows = attach_group_count(rows, gold, "sk_favorecido", "id_transacao", "freq_favorecido")
    return attach_group_count(rows, gold, "sk_portador", "id_transacao", "freq_portador")


def model_matrix(features: DataFrame) -> DataFrame:
    """The features once more as clean doubles (``x_…``), beside the untouched values."""
    return features.select(
        "*", *[clean_double(F.col(c)).alias(MODEL_PREFIX + c) for c in FEATURES]
    )
