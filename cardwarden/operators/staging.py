"""Bronze rows to typed, trimmed rows: one per transaction, within the period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cardwarden.fixed_values import (
    AGENCY_UNKNOWN,
    CARD_TYPE_STAGED,
    CODE_UNKNOWN,
    MONTH_CUTOFF,
    NOT_INFORMED,
)
from cardwarden.functions.dates import transaction_date
from cardwarden.functions.numbers import brazilian_amount
from cardwarden.functions.periods import statement_month
from cardwarden.functions.text import blank_trimmed

PARTITION = "mes"
#: The partition under which staging and the facts keep a row; the calendar has a column ``mes``.
MONTH = "mes_extrato"
NO_MONTH = "outros"


def bronze_partition() -> Column:
    """Partition value of a bronze row: its month 01..12, or one bucket for texts that are none.

    The bucket sorts after every month, so a lower bound on it never prunes such rows.
    """
    month = statement_month(F.col("mes_extrato"))
    return F.when(month.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), month).otherwise(F.lit(NO_MONTH))


def parse(bronze: DataFrame) -> DataFrame:
    """Typed and trimmed columns of every bronze row with an id, and its partition if it has one."""

    def text(column: str, default: str):
        return blank_trimmed(F.col(column), default)

    def name(column: str, default: str):
        return F.upper(text(column, default))

    return bronze.where(F.col("id").isNotNull()).select(
        F.col("id").alias("id_transacao"),
        statement_month(F.col("mes_extrato")).alias("ano_mes_extrato"),
        transaction_date(F.col("data_transacao"), F.col("mes_extrato")).alias("dt_transacao"),
        brazilian_amount(F.col("valor_transacao")).alias("vl_transacao"),
        name("estabelecimento__nome", NOT_INFORMED).alias("nome_favorecido"),
        text("estabelecimento__cgc", NOT_INFORMED).alias("cgc_favorecido"),
        name("portador__nome", NOT_INFORMED).alias("nome_portador"),
        text("portador__cpf", NOT_INFORMED).alias("cpf_portador"),
        text("orgao_superior__codigo", CODE_UNKNOWN).alias("cod_orgao_superior"),
        name("orgao_superior__nome", AGENCY_UNKNOWN).alias("nome_orgao_superior"),
        text("orgao_vinculado__codigo", CODE_UNKNOWN).alias("cod_orgao_vinculado"),
        name("orgao_vinculado__nome", AGENCY_UNKNOWN).alias("nome_orgao_vinculado"),
        text("unidade_gestora__codigo", CODE_UNKNOWN).alias("cod_unidade_gestora"),
        name("unidade_gestora__nome", AGENCY_UNKNOWN).alias("nome_unidade_gestora"),
        name("tipo_cartao__descricao", CARD_TYPE_STAGED).alias("desc_tipo_cartao"),
        "_dlt_load_id",
        "_dlt_id",
        *[F.col(c).alias(MONTH) for c in bronze.columns if c == PARTITION],
    )


def latest_version(rows: DataFrame, key: str, *newest_first: str) -> DataFrame:
    """One row per key, the greatest by the given columns.

    Spark cuts every map task to its own best row per key before the shuffle, so a key with
    very many versions does not travel whole to one task.
    """
    order = [F.col(c).desc_nulls_last() for c in newest_first]
    ranked = rows.withColumn("_rn", F.row_number().over(W.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def stage(bronze: DataFrame, cutoff: str = MONTH_CUTOFF, one_version: bool = False) -> DataFrame:
    """Typed rows from ``cutoff`` on, the latest load of each transaction.

    The period is cut before the latest load is picked: an older version inside the period
    outlives a newer one outside it. Rows equal in load and row id are settled by all their
    columns, so the input's order never decides. ``one_version`` says that there is one row an
    id already, as in the bronze table, and leaves out the shuffle of all rows by id.
    """
    if PARTITION in bronze.columns:
        bronze = bronze.where(F.col(PARTITION) >= cutoff)
    rows = parse(bronze).where(F.col("ano_mes_extrato") >= cutoff)
    if one_version:
        return rows
    newest = ["_dlt_load_id", "_dlt_id", "ano_mes_extrato", "dt_transacao", "vl_transacao"]
    rest = [c for c in rows.columns if c not in newest and c != "id_transacao"]
    return latest_version(rows, "id_transacao", *newest, *rest)
