"""Agency, supplier, bearer and alert-level dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.fixed_values import ALERT_LEVELS
from cardwarden.functions.keys import agency_key, bearer_identity, bearer_key, supplier_key

ORGAO_KEYS = ["cod_orgao_superior", "cod_orgao_vinculado", "cod_unidade_gestora"]
ORGAO_NAMES = ["nome_orgao_superior", "nome_orgao_vinculado", "nome_unidade_gestora"]


def latest_per_key(
    staging: DataFrame, keys: dict[str, Column], attributes: list[str]
) -> DataFrame:
    """Attributes of the latest load per key; ties within a load go to the greatest values.

    Rows are first reduced to their distinct (key, load, attributes) by hashing, inside each
    map task. The pick then only sorts that small remainder, so neither the number of rows
    behind one key nor their total reaches the sort.
    """
    versions = staging.select(
        *[c.alias(k) for k, c in keys.items()],
        F.col("_dlt_load_id").alias("_load"),
        *[F.col(a).alias(f"_{a}") for a in attributes],
    ).distinct()
    best = versions.groupBy(*keys).agg(
        F.max(F.struct("_load", *[f"_{a}" for a in attributes])).alias("_best")
    )
    return best.select(*keys, *[F.col(f"_best._{a}").alias(a) for a in attributes])


def dim_orgaos(staging: DataFrame) -> DataFrame:
    """One row per (superior, linked, unit) code triple."""
    latest = latest_per_key(staging, {k: F.col(k) for k in ORGAO_KEYS}, ORGAO_NAMES)
    pairs = [c for pair in zip(ORGAO_KEYS, ORGAO_NAMES) for c in pair]
    return latest.select(agency_key().alias("sk_orgao"), *pairs)


def dim_favorecidos(staging: DataFrame) -> DataFrame:
    """One row per supplier name, with the root of its latest tax id."""
    latest = latest_per_key(
        staging, {"nome_favorecido": F.col("nome_favorecido")}, ["cgc_favorecido"]
    )
    return latest.select(
        supplier_key().alias("sk_favorecido"),
        "nome_favorecido",
        F.substring_index("cgc_favorecido", "/", 1).alias("cnpj_raiz"),
        F.col("cgc_favorecido").alias("cgc_exemplo_filial"),
    )


def dim_portadores(staging: DataFrame) -> DataFrame:
    """One row per bearer: by masked tax id, or by name where there is none."""
    latest = latest_per_key(
        staging, {"_identidade": bearer_identity()}, ["nome_portador", "cpf_portador"]
    )
    return latest.select(bearer_key().alias("sk_portador"), "nome_portador", "cpf_portador")


def without_documents(dim: DataFrame, key: str, name: str) -> DataFrame:
    """Gold form of a dimension: key and name only, no tax id."""
    return dim.select(key, name)


def dim_nivel_alerta(spark: SparkSession) -> DataFrame:
    """The static alert levels."""
    levels = [
        F.struct(
            F.lit(order).alias("ordem_severidade"),
            F.lit(level).alias("nivel_alerta"),
            F.lit(reason).alias("motivo_alerta"),
        )
        for order, level, reason in ALERT_LEVELS
    ]
    return spark.range(1).select(F.inline(F.array(*levels)))
