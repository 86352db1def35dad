"""Raw API records to defaulted records, and those to flat bronze columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden.fixed_values import (
    CARD_TYPE_ID_DEFAULT,
    CARD_TYPE_NORMALISED,
    CODE_UNKNOWN,
    NOT_INFORMED,
    POWER_DEFAULT,
)
from cardwarden.functions.text import first_present, present, sanitize_name, snake_case

def _technical(df: DataFrame) -> list[str]:
    """Columns that travel along without being part of the record, such as ``_load``."""
    return [c for c in df.columns if c.startswith("_")]


def _either(nested: str, top: str, fields: list[str]) -> Column:
    """The nested object if it has any value, else the top-level one."""
    filled = F.coalesce(*[F.col(f"{nested}.{f}") for f in fields]).isNotNull()
    return F.when(filled, F.col(nested)).otherwise(F.col(top))


def resolve_paths(raw: DataFrame) -> DataFrame:
    """Agency objects picked from their alternate places, and the cleaned names.

    A projection of its own: what the next one reads several times is computed once. The three
    names go through one array function, so the patterns are in the plan once, not three times;
    inlined they make a method too long for the JVM to compile.
    """
    names = F.array("estabelecimento.nome", "estabelecimento.razaoSocialReceita",
                    "estabelecimento.nomeFantasiaReceita")
    linked = ["codigoSIAFI", "codigo", "cnpj", "sigla", "nome"]
    superior = ["codigo", "sigla", "nome"]
    return raw.withColumns({
        "orgaoVinculado": _either("unidadeGestora.orgaoVinculado", "orgaoVinculado", linked),
        "orgaoSuperior": _either("unidadeGestora.orgaoMaximo", "orgaoSuperior", superior),
        "_nomes": F.transform(names, sanitize_name),
    })


def normalize_records(raw: DataFrame) -> DataFrame:
    """Defaults in every leaf, documents cut out of names, alternate agency paths resolved."""
    card_id = F.coalesce(
        F.nullif(F.col("tipoCartao.id"), F.lit(0)), F.lit(CARD_TYPE_ID_DEFAULT)
    ).cast("bigint")
    name, legal_name, trade_name = [F.element_at("_nomes", i) for i in (1, 2, 3)]
    has_legal_name = present(F.col("estabelecimento.razaoSocialReceita")).isNotNull()
    cnpj = F.col("estabelecimento.cnpjFormatado")
    cpf = F.col("estabelecimento.cpfFormatado")
    bearer_cpf = first_present(
        F.col("portador.cpfFormatado"), F.col("portador.cpf"), default=NOT_INFORMED
    )
    return resolve_paths(raw).select(
        "id",
        "mesExtrato",
        "dataTransacao",
        "valorTransacao",
        F.struct(
            card_id.alias("id"),
            F.coalesce(present(F.col("tipoCartao.codigo")), card_id.cast("string")).alias("codigo"),
            first_present(
                F.col("tipoCartao.descricao"), default=CARD_TYPE_NORMALISED
            ).alias("descricao"),
        ).alias("tipoCartao"),
        F.struct(
            F.col("estabelecimento.id").alias("id"),
            name.alias("nome"),
            F.when(has_legal_name, legal_name).otherwise(name).alias("razaoSocialReceita"),
            trade_name.alias("nomeFantasiaReceita"),
            first_present(cnpj, default="").alias("cnpjFormatado"),
            first_present(cpf, default="").alias("cpfFormatado"),
            first_present(
                cnpj, cpf, F.col("estabelecimento.cgc"), default=NOT_INFORMED
            ).alias("cgc"),
            first_present(F.col("estabelecimento.tipo"), default=NOT_INFORMED).alias("tipo"),
            first_present(F.col("estabelecimento.numeroInscricaoSocial"), default="").alias(
                "numeroInscricaoSocial"
            ),
        ).alias("estabelecimento"),
        F.struct(
            first_present(F.col("portador.nome"), default=NOT_INFORMED).alias("nome"),
            bearer_cpf.alias("cpf"),
            bearer_cpf.alias("cpfFormatado"),
            first_present(F.col("portador.nis"), default="").alias("nis"),
        ).alias("portador"),
        F.struct(
            first_present(F.col("unidadeGestora.codigo"), default=CODE_UNKNOWN).alias("codigo"),
            first_present(F.col("unidadeGestora.nome"), default=NOT_INFORMED).alias("nome"),
            first_present(
                F.col("unidadeGestora.descricaoPoder"), default=POWER_DEFAULT
            ).alias("descricaoPoder"),
        ).alias("unidadeGestora"),
        F.struct(
            first_present(
                F.col("orgaoVinculado.codigoSIAFI"),
                F.col("orgaoVinculado.codigo"),
                default=CODE_UNKNOWN,
            ).alias("codigo"),
            first_present(F.col("orgaoVinculado.nome"), default=NOT_INFORMED).alias("nome"),
            first_present(F.col("orgaoVinculado.sigla"), default="").alias("sigla"),
            first_present(F.col("orgaoVinculado.cnpj"), default="").alias("cnpj"),
        ).alias("orgaoVinculado"),
        F.struct(
            first_present(F.col("orgaoSuperior.codigo"), default=CODE_UNKNOWN).alias("codigo"),
            first_present(F.col("orgaoSuperior.nome"), default=NOT_INFORMED).alias("nome"),
            first_present(F.col("orgaoSuperior.sigla"), default="").alias("sigla"),
        ).alias("orgaoSuperior"),
        *_technical(raw),
    )


def _leaves(schema: T.StructType, path: str = "") -> list[str]:
    """Dotted paths of all fields that are not themselves objects."""
    found = []
    for field in schema.fields:
        here = f"{path}{field.name}"
        if isinstance(field.dataType, T.StructType):
            found += _leaves(field.dataType, f"{here}.")
        else:
            found.append(here)
    return found


def flatten(
    records: DataFrame, load_id: str | Column, keep: list[str] | None = None
) -> DataFrame:
    """Nested fields as ``outer__inner`` snake_case columns, plus load id and row id.

    Technical columns are dropped unless named in ``keep``.
    """
    load = F.lit(load_id) if isinstance(load_id, str) else load_id
    columns = [
        F.col(path).alias("__".join(snake_case(p) for p in path.split(".")))
        for path in _leaves(records.drop(*_technical(records)).schema)
    ]
    return records.select(
        *columns,
        *(keep or []),
        load.alias("_dlt_load_id"),
        F.md5(F.concat(load, F.lit("|"), F.col("id").cast("string"))).alias("_dlt_id"),
    )
