"""Stages of a refresh: landing to bronze, bronze to gold, gold to scores, checks."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.fixed_values import (
    CALENDAR_END,
    CALENDAR_START,
    MODEL_VERSION,
    MONTH_CUTOFF,
    MONTHS_BACK,
)
from cardwarden.functions.periods import chosen_window
from cardwarden.operators import bronze, calendar, dimensions, facts, iforest, quality, scoring
from cardwarden.operators.features import feature_frame, gold_features, model_matrix
from cardwarden.operators.normalize import flatten, normalize_records
from cardwarden.operators.staging import MONTH, PARTITION, stage
from cardwarden.plans import ledger, publication, warehouse
from cardwarden.plans.lease import writer_lease
from cardwarden.sources.landing import page_report, planned_months, read_pages, until_first_gap
from cardwarden.sources.sample import read_sample
from cardwarden.sources.scratch import materialize_measured, materialize_rows, scratch_run

log = logging.getLogger(__name__)

#: One refresh at a time writes silver and gold.
REFRESH_LEASE = "silver.refresh"
STATS_TOLERANCE = 1e-9


@dataclass(frozen=True)
class Settings:
    """What a refresh depends on. Nothing below reads the clock."""

    load_id: str
    as_of: date
    run_ts: datetime
    first_month: str = ""
    last_month: str = ""
    months_back: int = MONTHS_BACK
    max_pages: int | None = None
    whole_files: bool = True
    cutoff: str = MONTH_CUTOFF
    calendar_start: str = CALENDAR_START
    calendar_end: str = CALENDAR_END
    forest: iforest.ForestSpec = field(default_factory=iforest.ForestSpec)
    model_version: str = MODEL_VERSION
    #: Put before the names of the three databases, so that several warehouses can share a catalog.
    namespace: str = ""

    def at(self, table: str) -> str:
        return self.namespace + table


def window(spark: SparkSession, settings: Settings) -> tuple[str, str]:
    """First and last statement month of the load."""
    first, last = chosen_window(
        F.lit(settings.first_month),
        F.lit(settings.last_month),
        F.lit(settings.as_of),
        settings.months_back,
    )
    row = spark.range(1).select(first.alias("first"), last.alias("last")).first()
    return row["first"], row["last"]


def ingest_landing(spark: SparkSession, root: str, settings: Settings) -> None:
    """Upsert the landed pages of the window into bronze.

    Each file is parsed once: its records are normalised and written with their page, and the
    gap search and the upsert read that copy. The pages found, with their rows and whether they
    were kept, are added to the page ledger.
    """
    first, last = window(spark, settings)
    months = planned_months(spark, first, last)
    pages = read_pages(spark, root, months, settings.max_pages, settings.whole_files)
    page = {"_mes": "mes", "_pagina": "pagina"}  # a leading _ lets columns travel along
    raw = pages.withColumnsRenamed({name: carried for carried, name in page.items()})
    flat = flatten(normalize_records(raw), settings.load_id, keep=list(page)).withColumnsRenamed(page)
    landed = materialize_rows(flat, "landed")
    report = page_report(landed)
    good = until_first_gap(landed, report).drop("mes", "pagina")
    bronze.require_records(good, f"{first} to {last}")
    bronze.upsert(good, settings.at(bronze.BRONZE_TABLE), settings.load_id)
    ledger.add_pages(report, settings.at(bronze.BRONZE_TABLE), settings.load_id)


def ingest_sample(spark: SparkSession, settings: Settings) -> None:
    """Upsert the built-in sample; its records are not normalised."""
    rows = materialize_rows(flatten(read_sample(spark), settings.load_id), "sample")
    bronze.upsert(rows, settings.at(bronze.BRONZE_TABLE), settings.load_id)


@dataclass(frozen=True)
class Build:
    """Prepared next versions of the models: readable, but not yet under their names."""

    models: dict[str, DataFrame]
    tables: list[str]
    #: Months that were restaged, None for all, and the loads they came from.
    months: set[str] | None
    loads: list[str]


def _months_to_restage(spark: SparkSession, settings: Settings) -> tuple[set[str] | None, list[str]]:
    """Months that loads touched since the last release, and these loads."""
    source = settings.at(bronze.BRONZE_TABLE)
    fresh = ledger.not_taken(spark, source, settings.cutoff, settings.at(ledger.TAKEN_TABLE))
    tables = [warehouse.TABLES[m] for m in warehouse.BY_MONTHS] + [warehouse.STATS_TABLE]
    if fresh is None or not all(spark.catalog.tableExists(settings.at(t)) for t in tables):
        return None, ledger.entries(spark, source)
    rows = fresh.collect()  # one a load
    return {m for row in rows for m in row.months}, [row.entry for row in rows]


def _months_of_changed_agencies(named: DataFrame, stats: DataFrame, last: DataFrame) -> set[str]:
    """Months with rows of agencies whose mean or deviation moved since the last release.

    A late row moves the mean of its agency, and so the z-scores of that agency in every month.
    Sums of doubles depend on their order, so a relative difference of 1e-9 counts as none.
    """
    agency = "nome_orgao_superior"
    now, last = stats.alias("now"), last.alias("last")

    def stays(column: str) -> Column:
        a, b = F.col(f"now.{column}").cast("double"), F.col(f"last.{column}").cast("double")
        return a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= F.abs(b) * STATS_TOLERANCE, F.lit(False))

    known = now.join(last, F.col(f"now.{agency}").eqNullSafe(F.col(f"last.{agency}")), "left")
    moved = known.where(
        F.col(f"last.{agency}").isNull() | ~(stays("media_gasto_orgao") & stays("stddev_gasto_orgao"))
    )
    months = named.join(moved.select(F.col(f"now.{agency}").alias(agency)), agency, "left_semi").select(MONTH)
    return {row[0] for row in months.distinct().collect()}  # one a month


def build(spark: SparkSession, settings: Settings) -> Build:
    """Prepare silver and gold from bronze, whole where they are small, by months where they are not.

    Staging and both facts are kept by month of statement: only months that loads touched are
    staged again, and in the gold fact also months with rows of an agency whose statistics moved.
    The upsert leaves one row an id in bronze, which the unique check on staging guards.
    """
    warehouse.create_layers(spark, settings.namespace)
    for layer in ("silver", "gold"):
        publication.recover(spark, settings.at(layer))
    months, loads = _months_to_restage(spark, settings)
    tables: list[str] = []

    def coming(model: str, df: DataFrame) -> DataFrame:
        tables.append(settings.at(warehouse.TABLES.get(model, model)))
        return publication.prepare(df, tables[-1])

    def coming_months(
        model: str, df: DataFrame | None, only: set[str] | None, *order: str, gathered: DataFrame | None = None
    ) -> DataFrame:
        tables.append(settings.at(warehouse.TABLES[model]))
        return publication.prepare_months(df, tables[-1], only, *order, column=MONTH, gathered=gathered)

    def touched(df: DataFrame, only: set[str] | None, column: str = MONTH) -> DataFrame:
        return df if only is None else df.where(F.col(column).isin(*only))

    source = touched(spark.table(settings.at(bronze.BRONZE_TABLE)), months, PARTITION)
    # staging and facts keep their source's months and shuffle nothing, unless the agencies are too many to broadcast
    staged = stage(source, settings.cutoff, one_version=True)
    staging = coming_months("stg_cpgf_despesas", None, months, "id_transacao", gathered=staged)
    models = {"stg_cpgf_despesas": staging}
    silver = {
        "dim_data": calendar.calendar(spark, settings.calendar_start, settings.calendar_end),
        "dim_orgaos": dimensions.dim_orgaos(staging),
        "dim_favorecidos": dimensions.dim_favorecidos(staging),
        "dim_portadores": dimensions.dim_portadores(staging),
    }
    models.update({name: coming(name, df) for name, df in silver.items()})
    fact = facts.fact_silver(touched(staging, months))
    models["fct_gastos_cartao"] = coming_months("fct_gastos_cartao", None, months, "sk_data", gathered=fact)
    gold = {
        "gold_dim_data": models["dim_data"],
        "gold_dim_orgaos": models["dim_orgaos"],
        "gold_dim_favorecidos": dimensions.without_documents(
            models["dim_favorecidos"], "sk_favorecido", "nome_favorecido"
        ),
        "gold_dim_portadores": dimensions.without_documents(
            models["dim_portadores"], "sk_portador", "nome_portador"
        ),
        "gold_dim_nivel_alerta": dimensions.dim_nivel_alerta(spark),
    }
    models.update({name: coming(name, df) for name, df in gold.items()})
    named = facts.with_agency_name(models["fct_gastos_cartao"], models["gold_dim_orgaos"])
    stats = coming(warehouse.STATS_TABLE, facts.agency_stats(named))
    gold_months = months
    if months is not None:
        gold_months = months | _months_of_changed_agencies(named, stats, spark.table(settings.at(warehouse.STATS_TABLE)))
    few, (agencies, means) = facts.broadcast_if_few(models["gold_dim_orgaos"], stats)
    gold_source = touched(models["fct_gastos_cartao"], gold_months)
    gold_fact = facts.fact_gold(facts.with_agency_name(gold_source, agencies), means)
    models["gold_fct_gastos_cartao"] = coming_months(
        "gold_fct_gastos_cartao", None if few else gold_fact, gold_months, "sk_data", gathered=gold_fact if few else None
    )
    return Build(models, tables, months, loads)


def publish(spark: SparkSession, settings: Settings, built: Build) -> dict[str, DataFrame]:
    """Let the prepared models take over their names, all of them or, after a lost driver, at the next run."""
    publication.release(spark, built.tables)
    ledger.take(spark, built.loads, settings.cutoff, built.months is None, settings.at(ledger.TAKEN_TABLE))
    models = {model: spark.table(settings.at(warehouse.TABLES[model])) for model in built.models}
    models["stg_cpgf_despesas"].createOrReplaceTempView(settings.at(warehouse.STAGING_VIEW))
    return models


def transform(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """Refresh silver and gold from bronze without checks; every model reads written tables."""
    warehouse.create_layers(spark, settings.namespace)
    with writer_lease(spark, settings.at(REFRESH_LEASE)):
        return publish(spark, settings, build(spark, settings))


def audited_transform(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """Refresh silver and gold; the declared checks run on the prepared versions.

    A failing check raises and leaves all tables as they were. The prepared versions stay beside
    them as ``…__next``, to look into, until the next run replaces them.
    """
    warehouse.create_layers(spark, settings.namespace)
    with writer_lease(spark, settings.at(REFRESH_LEASE)):
        built = build(spark, settings)
        quality.require_passed(quality.run_checks(built.models))
        return publish(spark, settings, built)


def score_features(features: DataFrame, settings: Settings, n_rows: int | None = None) -> DataFrame | None:
    """Scores of a written feature table, or None where it is empty; its rows are counted unless known."""
    n_rows = features.count() if n_rows is None else n_rows
    if n_rows == 0:
        return None
    matrix = model_matrix(features)
    forest = iforest.fit(matrix, n_rows, settings.forest)
    raw, span = materialize_measured(
        iforest.score(matrix, forest).drop(*iforest.MODEL_COLUMNS), "raw_scores",
        low=F.min("raw_score"), high=F.max("raw_score"),
    )
    scaled = scoring.scale_scores(raw, (span["low"], span["high"]))
    return scoring.flag(scaled, settings.run_ts, settings.model_version)


def detect_anomalies(spark: SparkSession, settings: Settings) -> dict:
    """Score the gold fact into the satellite table.

    Mean amount, number of rows and span of the scores are taken while the copies are written.
    """
    fact, days = (spark.table(settings.at(warehouse.TABLES[m])) for m in ("gold_fct_gastos_cartao", "gold_dim_data"))
    gold, amounts = materialize_measured(gold_features(fact, days), "gold_features", mean=F.avg("vl_transacao"))
    features, rows = materialize_measured(feature_frame(gold, amounts["mean"]), "features", n=F.count("*"))
    scores = score_features(features, settings, rows["n"])
    if scores is None:
        return {"status": "skipped", "count": 0}
    warehouse.save_scores(scores, settings.at(warehouse.SCORE_TABLE))
    totals = scoring.run_summary(spark.table(settings.at(warehouse.SCORE_TABLE))).first()
    return {
        "status": "success",
        "total_processado": totals["total_processado"],
        "anomalias_p95": totals["anomalias_p95"],
        "anomalias_p99": totals["anomalias_p99"],
    }


def refresh(spark: SparkSession, settings: Settings, landing: str | None = None) -> DataFrame:
    """One whole refresh; without a landing folder it runs on the built-in sample.

    A failing check stops the refresh before any model changes, an empty fact after. A failing
    anomaly run is logged and stops nothing. Returns the summary of the gold layer. Intermediate
    copies are removed at the end, also on failure.
    """
    with scratch_run(spark):
        if landing is None:
            ingest_sample(spark, settings)
        else:
            ingest_landing(spark, landing, settings)
        audited_transform(spark, settings)
        try:
            log.info("anomalies: %s", detect_anomalies(spark, settings))
        except Exception:
            log.exception("anomaly detection failed; the refresh goes on without new scores")
        warehouse.require_fact(spark, settings.at(warehouse.TABLES["gold_fct_gastos_cartao"]))
    return warehouse.layer_summary(spark, namespace=settings.namespace)
