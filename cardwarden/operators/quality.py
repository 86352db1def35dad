"""Declared data checks. Every report has (check, table_name, column_name, failures)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.fixed_values import ALERT_LEVELS

# fixed values: the declared checks, by model
NOT_NULL = {
    "stg_cpgf_despesas": ["id_transacao"],
    "dim_data": ["sk_data"],
    "dim_orgaos": ["sk_orgao"],
    "dim_favorecidos": ["sk_favorecido"],
    "dim_portadores": ["sk_portador"],
    "fct_gastos_cartao": [
        "id_transacao", "vl_transacao", "sk_data", "sk_orgao", "sk_favorecido", "sk_portador",
    ],
    "gold_dim_data": ["sk_data"],
    "gold_dim_orgaos": ["sk_orgao"],
    "gold_dim_favorecidos": ["sk_favorecido"],
    "gold_dim_portadores": ["sk_portador"],
    "gold_dim_nivel_alerta": ["ordem_severidade", "nivel_alerta", "motivo_alerta"],
    "gold_fct_gastos_cartao": [
        "id_transacao", "sk_data", "sk_orgao", "sk_favorecido", "sk_portador",
        "ordem_severidade", "vl_transacao", "z_score",
    ],
}
UNIQUE = {
    "stg_cpgf_despesas": "id_transacao",
    "dim_data": "sk_data",
    "dim_orgaos": "sk_orgao",
    "dim_favorecidos": "sk_favorecido",
    "dim_portadores": "sk_portador",
    "fct_gastos_cartao": "id_transacao",
    "gold_dim_data": "sk_data",
    "gold_dim_orgaos": "sk_orgao",
    "gold_dim_favorecidos": "sk_favorecido",
    "gold_dim_portadores": "sk_portador",
    "gold_dim_nivel_alerta": "ordem_severidade",
    "gold_fct_gastos_cartao": "id_transacao",
}
RELATIONSHIPS = {
    "fct_gastos_cartao": {
        "sk_data": "dim_data",
        "sk_orgao": "dim_orgaos",
        "sk_favorecido": "dim_favorecidos",
        "sk_portador": "dim_portadores",
    },
    "gold_fct_gastos_cartao": {
        "sk_data": "gold_dim_data",
        "sk_orgao": "gold_dim_orgaos",
        "sk_favorecido": "gold_dim_favorecidos",
        "sk_portador": "gold_dim_portadores",
        "ordem_severidade": "gold_dim_nivel_alerta",
    },
}
ACCEPTED = {"gold_dim_nivel_alerta": {"nivel_alerta": [level for _, level, _ in ALERT_LEVELS]}}
NON_EMPTY_FACT = ["gold_fct_gastos_cartao"]
NON_EMPTY_DIMENSIONS = ["gold_dim_orgaos", "gold_dim_favorecidos", "gold_dim_portadores"]


class QualityError(RuntimeError):
    """At least one declared check failed."""


def _report(counted: DataFrame, check: str, table: str, columns: list[str]) -> DataFrame:
    """A one-row frame of counts, one column per checked column, as report rows."""
    rows = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")).alias("failures"),
        )
        for c in columns
    ]
    return counted.select(F.inline(F.array(*rows)))


def check_not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows without a value, for all columns of a table in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _report(counted, "not_null", table, columns)


def check_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values that occur more than once; NULL is not a value."""
    groups = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    counted = groups.where(F.col("_n") > 1).agg(F.count("*").alias(column))
    return _report(counted, "unique", table, [column])


def check_relationship(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str | None = None
) -> DataFrame:
    """Child rows whose key has no parent.

    Child rows are counted per key first, so the anti join sees each key once and a key that
    holds most rows weighs no more than any other.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    parents = parent.select(F.col(parent_column or column).alias(column))
    counted = keys.join(parents, column, "left_anti").agg(F.sum("_n").alias(column))
    return _report(counted, "relationships", table, [column])


def check_accepted(df: DataFrame, table: str, column: str, accepted: list[str]) -> DataFrame:
    """Distinct values outside the accepted ones."""
    others = df.where(~F.col(column).isin(accepted)).select(column).distinct()
    return _report(others.agg(F.count("*").alias(column)), "accepted_values", table, [column])


def check_non_empty(df: DataFrame, table: str) -> DataFrame:
    """One failure for a table without rows: the other checks pass on an empty table."""
    return df.limit(1).agg(
        F.lit("non_empty").alias("check"),
        F.lit(table).alias("table_name"),
        F.lit("*").alias("column_name"),
        (F.count("*") == 0).cast("bigint").alias("failures"),
    )


def union_all(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def check_rows(df: DataFrame, table: str) -> DataFrame:
    """Missing values, and emptiness where it is declared, in one pass over a table."""
    columns = NOT_NULL.get(table, [])
    counted = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    empty = table in NON_EMPTY_FACT + NON_EMPTY_DIMENSIONS
    totals = df.agg(*counted, (F.count("*") == 0).cast("bigint").alias("*"))
    rows = [("not_null", c) for c in columns] + [("non_empty", "*")] * empty
    found = [
        F.struct(
            F.lit(check).alias("check"), F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
            F.col(f"`{c}`").cast("bigint").alias("failures"),
        )
        for check, c in rows
    ]
    return totals.select(F.inline(F.array(*found)))


def check_relationships(child: DataFrame, table: str, parents: dict[str, DataFrame]) -> DataFrame:
    """Child rows whose key has no parent, for all foreign keys in one pass.

    Rows are counted per column and key before the anti join, as in :func:`check_relationship`.
    """
    def keys(df: DataFrame, columns: list[str]) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("key")) for c in columns]
        return df.select(F.inline(F.array(*pairs))).where(F.col("key").isNotNull())

    used = keys(child, list(parents)).groupBy("column_name", "key").agg(F.count("*").alias("n"))
    known = union_all([keys(parent, [c]) for c, parent in parents.items()])
    orphans = used.join(known, ["column_name", "key"], "left_anti").groupBy("column_name").agg(
        F.sum("n").alias("failures")
    )
    declared = child.sparkSession.createDataFrame([(c,) for c in parents], "column_name STRING")
    return declared.join(F.broadcast(orphans), "column_name", "left").select(  # a row a foreign key
        F.lit("relationships").alias("check"), F.lit(table).alias("table_name"), "column_name",
        F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"),
    )


def run_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """All 50 declared checks over the given models, in 52 rows: the check that three
    dimensions are not empty is reported per dimension. A fact is read three times: for its
    values, for its uniqueness and for its foreign keys."""
    reports = [check_rows(tables[t], t) for t in NOT_NULL]
    reports += [check_unique(tables[t], t, column) for t, column in UNIQUE.items()]
    reports += [
        check_relationships(tables[t], t, {c: tables[parent] for c, parent in parents.items()})
        for t, parents in RELATIONSHIPS.items()
    ]
    reports += [
        check_accepted(tables[t], t, column, values)
        for t, columns in ACCEPTED.items()
        for column, values in columns.items()
    ]
    return union_all(reports)


def require_passed(report: DataFrame) -> None:
    """Raise with the failed checks, if there are any."""
    failed = report.where(F.col("failures") > 0).collect()
    if failed:
        raise QualityError("; ".join(
            f"{r.check} {r.table_name}.{r.column_name}: {r.failures}" for r in failed
        ))
