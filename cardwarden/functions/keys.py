"""Surrogate keys shared by the dimensions and the facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardwarden.fixed_values import KEY_NULL, NOT_INFORMED


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the parts joined by ``-``, with a marker for NULL."""
    texts = [F.coalesce(p.cast("string"), F.lit(KEY_NULL)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def bearer_identity() -> Column:
    """Masked tax id of the bearer, or the name where there is none."""
    return F.coalesce(
        F.nullif(F.col("cpf_portador"), F.lit(NOT_INFORMED)), F.col("nome_portador")
    )


def agency_key() -> Column:
    return surrogate_key(
        F.col("cod_orgao_superior"), F.col("cod_orgao_vinculado"), F.col("cod_unidade_gestora")
    )


def supplier_key() -> Column:
    return surrogate_key(F.col("nome_favorecido"))


def bearer_key() -> Column:
    return surrogate_key(bearer_identity())
