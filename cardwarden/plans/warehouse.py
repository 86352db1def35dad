"""Layers, table names and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden.operators.quality import union_all
from cardwarden.sources.schemas import SCORES
from cardwarden.sources.scratch import CODEC, materialize_measured

LAYERS = ["bronze", "silver", "gold"]
# fixed values: table of each model; gold models lose their prefix
TABLES = {
    "stg_cpgf_despesas": "silver.stg_cpgf_despesas",
    "dim_data": "silver.dim_data",
    "dim_orgaos": "silver.dim_orgaos",
    "dim_favorecidos": "silver.dim_favorecidos",
    "dim_portadores": "silver.dim_portadores",
    "fct_gastos_cartao": "silver.fct_gastos_cartao",
    "gold_dim_data": "gold.dim_data",
    "gold_dim_orgaos": "gold.dim_orgaos",
    "gold_dim_favorecidos": "gold.dim_favorecidos",
    "gold_dim_portadores": "gold.dim_portadores",
    "gold_dim_nivel_alerta": "gold.dim_nivel_alerta",
    "gold_fct_gastos_cartao": "gold.fct_gastos_cartao",
}
#: Models kept by month of statement; the others are small and replaced whole.
BY_MONTHS = ["stg_cpgf_despesas", "fct_gastos_cartao", "gold_fct_gastos_cartao"]
#: Statistics behind the gold fact, kept to see which agencies moved.
STATS_TABLE = "silver.agency_stats"
SCORE_TABLE = "gold.score_anomalia_cartao"
STAGING_VIEW = "stg_cpgf_despesas"
SUMMARY_TABLES = [
    "gold.fct_gastos_cartao",
    "gold.dim_data",
    "gold.dim_orgaos",
    "gold.dim_favorecidos",
    "gold.dim_portadores",
    "gold.dim_nivel_alerta",
    SCORE_TABLE,
]


class EmptyFactError(RuntimeError):
    """The gold fact holds no rows."""


def create_layers(spark: SparkSession, namespace: str = "") -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}{layer}")


def publish(df: DataFrame, table: str) -> DataFrame:
    """Replace a table by ``df``: written beside it whole, then swapped in by renaming.

    Readers find the old table until the new one is complete. A swap that a lost driver left
    half done is finished, or the old table put back, by :func:`recover` at the next publication.
    """
    spark = df.sparkSession
    recover(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {table}__next")
    df.write.options(**CODEC).saveAsTable(f"{table}__next")
    _swap(spark, table)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def _swap(spark: SparkSession, table: str) -> None:
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE IF EXISTS {table}__last")
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}__last")
    spark.sql(f"ALTER TABLE {table}__next RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {table}__last")


def recover(spark: SparkSession, table: str) -> None:
    """Undo a swap that was cut off between its two renames."""
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(f"{table}__last"):
        spark.sql(f"ALTER TABLE {table}__last RENAME TO {table}")


def save_scores(scores: DataFrame, table: str = SCORE_TABLE) -> int:
    """Overwrite the score table; an empty result leaves the old one alone.

    The result is complete in the scratch folder before the table is touched.
    """
    schema = T.StructType.fromDDL(SCORES)
    ready, seen = materialize_measured(
        scores.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), "scores", n=F.count("*")
    )
    if seen["n"]:
        publish(ready, table)
    return seen["n"]


def count_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """One (table_name, n_rows) row per table."""
    return union_all([
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"))
        for name, df in tables.items()
    ])


def layer_summary(spark: SparkSession, tables: list[str] | None = None, namespace: str = "") -> DataFrame:
    """Row counts of the gold tables that exist; the scores may not exist yet."""
    at = {t: namespace + t for t in tables or SUMMARY_TABLES}
    names = [t for t in at if t != SCORE_TABLE or spark.catalog.tableExists(at[t])]
    return count_rows({t: spark.table(at[t]) for t in names})


def require_fact(spark: SparkSession, table: str = "gold.fct_gastos_cartao") -> int:
    """Number of rows of the gold fact; none at all is an error."""
    count = spark.table(table).count()
    if count == 0:
        raise EmptyFactError(f"{table} holds no rows; the refresh cannot count as done")
    return count
