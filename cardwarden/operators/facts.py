"""Silver fact, agency statistics, and the gold fact with z-score and severity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.fixed_values import (
    CRITICAL_AMOUNT,
    CRITICAL_Z,
    MODERATE_AMOUNT,
    MODERATE_Z,
)
from cardwarden.functions.dates import date_key
from cardwarden.functions.keys import agency_key, bearer_key, supplier_key
from cardwarden.functions.numbers import MONEY
from cardwarden.operators.lookup import attach_attributes, hot_keys
from cardwarden.operators.staging import MONTH


#: So many agencies can be sent to all executors: some 10 MB.
FEW_AGENCIES = 50_000


def _partition(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c == MONTH]


def fact_silver(staging: DataFrame) -> DataFrame:
    """Transactions with hashed foreign keys, and the month they are stored under if there is one."""
    return staging.select(
        "id_transacao",
        date_key(F.col("dt_transacao")).alias("sk_data"),
        agency_key().alias("sk_orgao"),
        supplier_key().alias("sk_favorecido"),
        bearer_key().alias("sk_portador"),
        "vl_transacao",
        "desc_tipo_cartao",
        "_dlt_load_id",
        *_partition(staging),
    )


def broadcast_if_few(*dims: DataFrame) -> tuple[bool, list[DataFrame]]:
    """Whether the agencies, the first of the written tables, are few, and then all tables marked for a broadcast.

    The other tables have no more rows than there are agencies.
    """
    few = dims[0].limit(FEW_AGENCIES + 1).count() <= FEW_AGENCIES
    return few, [F.broadcast(dim) if few else dim for dim in dims]


def with_agency_name(fact: DataFrame, orgaos: DataFrame) -> DataFrame:
    """Fact rows that have an agency, with the name of its superior agency."""
    return fact.join(orgaos.select("sk_orgao", "nome_orgao_superior"), "sk_orgao")


def agency_stats(named: DataFrame) -> DataFrame:
    """Mean and sample deviation of the amount per superior-agency name.

    An aggregate joined back, not a window: a few agencies hold most rows, and only an
    aggregate reduces them before the shuffle.
    """
    return named.groupBy("nome_orgao_superior").agg(
        F.avg("vl_transacao").alias("media_gasto_orgao"),
        F.stddev_samp("vl_transacao").alias("stddev_gasto_orgao"),
    )


def z_score(amount: Column, mean: Column, deviation: Column) -> Column:
    """Deviations from the mean in two decimals; 0.0 where there is no spread."""
    z = (amount.cast("double") - mean.cast("double")) / F.nullif(deviation, F.lit(0.0))
    return F.when(F.coalesce(deviation, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(F.round(z, 2))


def severity(z: Column, amount: Column) -> Column:
    """Alert level 1..3; a row without z and amount is normal."""
    return (
        F.when((z >= CRITICAL_Z) | (amount >= CRITICAL_AMOUNT), 3)
        .when((z >= MODERATE_Z) | (amount >= MODERATE_AMOUNT), 2)
        .otherwise(1)
    )


def fact_gold(named: DataFrame, stats: DataFrame) -> DataFrame:
    """Fact rows with their agency's mean, their z-score and severity.

    No join side is hinted: pass ``stats`` and the agencies as written tables, and Spark
    broadcasts them by their real size, or splits the skewed agencies when they are too big.
    """
    mean, deviation = F.col("media_gasto_orgao"), F.col("stddev_gasto_orgao")
    scored = named.join(stats, "nome_orgao_superior").select(
        "id_transacao",
        "sk_data",
        "sk_orgao",
        "sk_favorecido",
        "sk_portador",
        F.col("vl_transacao").cast(MONEY).alias("vl_transacao"),
        mean.cast(MONEY).alias("media_orgao"),
        z_score(F.col("vl_transacao"), mean, deviation).alias("z_score"),
        *_partition(named),
    )
    return scored.withColumn(
        "ordem_severidade", severity(F.col("z_score"), F.col("vl_transacao"))
    )


def star_view(
    fact: DataFrame,
    dates: DataFrame,
    orgaos: DataFrame,
    favorecidos: DataFrame,
    portadores: DataFrame,
    levels: DataFrame,
    scores: DataFrame | None = None,
) -> DataFrame:
    """Fact with the attributes of its dimensions, and its score where one is given.

    Suppliers and bearers are many and a few of them hold much of the fact, so these two joins
    split hot keys by themselves; for the others Spark decides by the size of the dimension.
    ``fact`` is read twice and should be a written table.
    """
    wide = (
        fact.join(dates, "sk_data", "left")
        .join(orgaos, "sk_orgao", "left")
        .join(levels, "ordem_severidade", "left")
    )
    hot = hot_keys(fact, ["sk_favorecido", "sk_portador"])
    for key, dim in (("sk_favorecido", favorecidos), ("sk_portador", portadores)):
        wide = attach_attributes(wide, dim, key, hot[key], "id_transacao")
    return wide if scores is None else wide.join(scores, "id_transacao", "left")
