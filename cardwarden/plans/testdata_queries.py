"""Every operator as a query over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.functions.dates import transaction_date
from cardwarden.functions.numbers import brazilian_amount
from cardwarden.functions.periods import chosen_window, normalize_period, statement_month
from cardwarden.functions.text import sanitize_name
from cardwarden.operators import calendar as cal
from cardwarden.operators import dimensions, facts, iforest, quality, scoring
from cardwarden.operators.bronze import BRONZE_TABLE, EmptyLoadError, merge, require_records, upsert
from cardwarden.operators.features import feature_frame, gold_features, model_matrix
from cardwarden.operators.normalize import flatten, normalize_records
from cardwarden.operators.staging import MONTH, PARTITION, bronze_partition, stage
from cardwarden.plans import publication
from cardwarden.plans.refresh import Settings, transform
from cardwarden.plans.warehouse import (
    LAYERS,
    SCORE_TABLE,
    STAGING_VIEW,
    TABLES,
    EmptyFactError,
    count_rows,
    layer_summary,
    publish,
    require_fact,
    save_scores,
)
from cardwarden.sources.landing import month_plan, read_landing
from cardwarden.sources.scratch import materialize_measured, materialize_rows, scratch_path
from cardwarden.sources.testdata import (
    CALENDAR_END,
    CALENDAR_START,
    CUTOFF,
    LOADS,
    raw_records,
    table,
)
from cardwarden.streaming.late_data import stream_landing

RUN_TS = datetime(2026, 9, 30, 12, 0, 0)
#: A forest of two trees: tree, node (children of n are 2n + 1 and 2n + 2), feature or -1, cut, path, rows.
GIVEN_FOREST = [
    (0, 0, 0, 2000.5, 0.0, 256), (0, 1, -1, 0.0, 6.25, 256), (0, 2, 1, 1.005, 0.0, 256),
    (0, 5, -1, 0.0, 4.5, 256), (0, 6, -1, 0.0, 2.75, 256),
    (1, 0, 5, 20.5, 0.0, 256), (1, 1, 2, 1.2500005, 0.0, 256), (1, 2, -1, 0.0, 5.5, 256),
    (1, 3, -1, 0.0, 7.125, 256), (1, 4, 3, 5.5, 0.0, 256), (1, 9, -1, 0.0, 3.5, 256), (1, 10, -1, 0.0, 2.25, 256),
]


@contextmanager
def throw_away_database(spark: SparkSession) -> Iterator[str]:
    """A database for one query; what is to outlive it must be written elsewhere."""
    name = f"cardwarden_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


# -- building blocks ---------------------------------------------------------------------


def bronze(spark: SparkSession, sf_dir: str, loads: tuple = LOADS) -> DataFrame:
    records = normalize_records(raw_records(spark, sf_dir, loads))
    return flatten(records, F.col("_load"))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(bronze(spark, sf_dir), CUTOFF)


def written_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging written once, for the queries that read it more than once."""
    return materialize_rows(staged(spark, sf_dir), "staging")


def feed_calendar(spark: SparkSession) -> DataFrame:
    return cal.calendar(spark, CALENDAR_START, CALENDAR_END)


def gold_fact(staging: DataFrame, orgaos: DataFrame | None = None) -> DataFrame:
    orgaos = orgaos or materialize_rows(dimensions.dim_orgaos(staging), "orgaos")
    named = facts.with_agency_name(facts.fact_silver(staging), orgaos)
    return facts.fact_gold(named, materialize_rows(facts.agency_stats(named), "agency_stats"))


def gold_rows(spark: SparkSession, sf_dir: str, fact: DataFrame | None = None) -> DataFrame:
    """Gold rows ready for features; some agency means are blanked to use the overall mean."""
    fact = fact or gold_fact(written_staging(spark, sf_dir))
    rows = gold_features(fact, feed_calendar(spark))
    k = F.col("id_transacao")
    mean = F.when(k % 103 == 0, F.lit(0.0)).when(k % 101 != 0, F.col("media_orgao"))
    return materialize_rows(rows.withColumn("media_orgao", mean), "gold_rows")


def given_scores(features: DataFrame) -> DataFrame:
    """A stand-in for the forest's output that any engine can compute: a hash-like spread
    with ties, highest for some weekend and high-z rows."""
    k = F.col("id_transacao")
    return features.withColumn(
        "raw_score", ((k * 7919) % 10007) / F.lit(10007.0) + F.col("fl_fim_semana") * 0.25
    )


def flagged_rows(spark: SparkSession, sf_dir: str, fact: DataFrame | None = None) -> DataFrame:
    """Scores and flags of the feed's gold fact, or of one that is written already."""
    features = feature_frame(gold_rows(spark, sf_dir, fact))
    scored = materialize_rows(scoring.scale_scores(given_scores(features)).select(scoring.FLAGGED), "scored")
    return scoring.flag(scored, RUN_TS)


# -- periods, landing, normalisation -----------------------------------------------------


def q_month_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months each customer was active in, from period texts of several shapes (A2, A5)."""
    spans = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b")
    )
    shape = """case o_custkey % 4 when 0 then date_format({0}, 'M/yyyy')
                                  when 1 then date_format({0}, 'yyyyMM')
                                  when 2 then date_format({0}, 'yyyy')
                                  else date_format({0}, 'MM/yyyy') end"""
    periods = spans.select(
        F.expr(shape.format("if(o_custkey % 10 = 9, b, a)")).alias("inicio"),
        F.expr(shape.format("if(o_custkey % 10 = 9, a, b)")).alias("fim"),
    )
    return month_plan(periods).groupBy("mes").agg(F.count("*").alias("n_clientes"))


def q_period_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free period texts as MM/YYYY (A5)."""
    text = F.expr("""case o_orderkey % 7
        when 0 then date_format(o_orderdate, 'M/yyyy')
        when 1 then concat(' ', date_format(o_orderdate, 'yyyyMM'), ' ')
        when 2 then date_format(o_orderdate, 'yyyy')
        when 3 then 'sem periodo'
        when 4 then 'a/b/c'
        when 5 then date_format(o_orderdate, 'MM/yyyy') end""")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", normalize_period(text, default_month=7).alias("periodo")
    )


def q_rolling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window as of each order date, with an explicit one for some (A3, A4)."""
    first = F.when(F.col("o_orderkey") % 5 <= 1, F.lit("01/1999")).otherwise(F.lit(" "))
    last = F.when(F.col("o_orderkey") % 5 == 0, F.lit("03/1999")).otherwise(F.lit(""))
    begin, end = chosen_window(first, last, F.to_date("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", begin.alias("inicio"), end.alias("fim")
    )


def landed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first load with month and page; some months lack a page in the middle or the first."""
    month = F.substring("mes", 6, 2).cast("int")
    return (
        raw_records(spark, sf_dir, (1,))
        .drop("_load")
        .withColumn("mes", statement_month(F.col("mesExtrato")))
        .withColumn("pagina", (F.col("id") % 7 + 1).cast("int"))
        .where(~((month % 4 == 0) & (F.col("pagina") == 4)))
        .where(~((month % 4 == 1) & (F.col("pagina") == 1)))
    )


#: A landed file is packed, and so read by one task; it holds so many records at most.
PAGE_ROWS = 100_000


def land_pages(spark: SparkSession, sf_dir: str) -> str:
    """The first load as landed pages, one object a line."""
    path = scratch_path(spark, "landing")
    by_page = landed_records(spark, sf_dir).hint("rebalance", F.col("mes"), F.col("pagina"))
    files = by_page.write.partitionBy("mes", "pagina").option("maxRecordsPerFile", PAGE_ROWS)
    files.json(path, compression="gzip")
    return path


def q_landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed JSON of a period, pages up to the cap and the first gap."""
    path = land_pages(spark, sf_dir)
    rows = read_landing(spark, path, "1/1997", "199912", max_pages=6, whole_files=False)
    return rows.select(
        "mes", "pagina", "id", "mesExtrato", "dataTransacao", "valorTransacao",
        F.col("tipoCartao.codigo").alias("tipo_codigo"),
        F.col("estabelecimento.nome").alias("nome"),
        F.col("unidadeGestora.orgaoVinculado.codigoSIAFI").alias("codigo_siafi"),
    )


def q_landing_all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per landed page without a cap: only a gap ends a month."""
    rows = read_landing(spark, land_pages(spark, sf_dir), "1/1997", "199912", whole_files=False)
    return rows.groupBy("mes", "pagina").agg(F.count("*").alias("n"), F.min("id").alias("menor_id"))


ARRAY_ROWS = 3000


def land_arrays(spark: SparkSession, sf_dir: str) -> str:
    """The same pages as files that each hold one array, or one object where there is one record.

    A page's first record is a file of its own; the others are dealt by a hash of their id into
    files of about ``ARRAY_ROWS`` records, so their number follows the rows and not the ids' range.
    """
    rows = materialize_rows(landed_records(spark, sf_dir), "records")
    pages = materialize_rows(rows.groupBy("mes", "pagina").agg(
        F.min("id").alias("_first"), F.ceil(F.count("*") / ARRAY_ROWS).alias("_files")
    ), "page_sizes")
    file = F.when(F.col("id") > F.col("_first"), F.pmod(F.xxhash64("id"), F.col("_files"))).otherwise(-1)
    record = F.to_json(F.struct(*[c for c in rows.columns if c not in ("mes", "pagina")]))
    texts = rows.join(pages, ["mes", "pagina"]).groupBy("mes", "pagina", file).agg(F.collect_list(record).alias("texts"))
    whole = F.when(F.size("texts") == 1, F.element_at("texts", 1)).otherwise(
        F.concat(F.lit("[\n"), F.array_join("texts", ",\n"), F.lit("]"))
    )
    path = scratch_path(spark, "arrays")
    files = texts.select("mes", "pagina", whole.alias("value"))
    files.write.partitionBy("mes", "pagina").option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)
    return path


def q_landing_pages_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files that are whole arrays or single objects."""
    rows = read_landing(spark, land_arrays(spark, sf_dir), "1/1997", "199912")
    return rows.select(
        "mes", "pagina", "id", "mesExtrato", "valorTransacao", F.col("tipoCartao.codigo").alias("tipo_codigo"),
        F.col("estabelecimento.nome").alias("nome"),
    )


def q_volume_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A period without records is refused and leaves bronze alone; the next one is taken."""
    with throw_away_database(spark) as database:
        pages, name = land_pages(spark, sf_dir), f"{database}.cartoes"
        states = []
        for first, last in (("1/1997", "199812"), ("1/2030", "3/2030"), ("1/1999", "199912")):
            landed = read_landing(spark, pages, first, last, whole_files=False).drop("mes", "pagina")
            rows = materialize_rows(flatten(normalize_records(landed), first), "landed")
            refused = False
            try:
                require_records(rows, f"{first} to {last}")
                upsert(rows, name, first)
            except EmptyLoadError:
                refused = True
            state = spark.table(name).agg(F.count("*").alias("n_bronze"), F.count_distinct("mes").alias("n_meses"))
            state = state.select(F.lit(first).alias("inicio"), F.lit(refused).alias("recusada"), "*")
            states.append(materialize_rows(state, "state"))
        return quality.union_all(states)


def q_normalize_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults, document precedence and alternate agency paths."""
    r = normalize_records(raw_records(spark, sf_dir, (1,)))
    picks = {
        "tipo_id": "tipoCartao.id", "tipo_codigo": "tipoCartao.codigo",
        "tipo_descricao": "tipoCartao.descricao", "nome": "estabelecimento.nome",
        "razao_social": "estabelecimento.razaoSocialReceita",
        "nome_fantasia": "estabelecimento.nomeFantasiaReceita",
        "cnpj": "estabelecimento.cnpjFormatado", "cpf": "estabelecimento.cpfFormatado",
        "cgc": "estabelecimento.cgc", "tipo": "estabelecimento.tipo",
        "inscricao": "estabelecimento.numeroInscricaoSocial", "portador": "portador.nome",
        "portador_cpf": "portador.cpf", "portador_cpf_formatado": "portador.cpfFormatado",
        "nis": "portador.nis", "ug_codigo": "unidadeGestora.codigo",
        "ug_nome": "unidadeGestora.nome", "poder": "unidadeGestora.descricaoPoder",
        "vinculado_codigo": "orgaoVinculado.codigo", "vinculado_nome": "orgaoVinculado.nome",
        "vinculado_sigla": "orgaoVinculado.sigla", "vinculado_cnpj": "orgaoVinculado.cnpj",
        "superior_codigo": "orgaoSuperior.codigo", "superior_nome": "orgaoSuperior.nome",
        "superior_sigla": "orgaoSuperior.sigla",
    }
    return r.select("id", *[F.col(path).alias(name) for name, path in picks.items()])


def q_sanitize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut out of supplier names."""
    return raw_records(spark, sf_dir, (1,)).select(
        "id", sanitize_name(F.col("estabelecimento.nome")).alias("nome")
    )


def q_flatten_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat bronze columns with load id and row id."""
    return bronze(spark, sf_dir)


UPSERT_COLUMNS = [
    "id", "mes_extrato", "valor_transacao", "estabelecimento__nome", "unidade_gestora__nome",
    "_dlt_load_id", "_dlt_id",
]


def q_bronze_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two later loads merged by key into the first."""
    incoming = materialize_rows(bronze(spark, sf_dir, (2, 3)), "incoming")
    return merge(bronze(spark, sf_dir, (1,)), incoming).select(UPSERT_COLUMNS)


def q_upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three loads through the real upsert into a table, read back."""
    with throw_away_database(spark) as database:
        for load in LOADS:
            rows = materialize_rows(bronze(spark, sf_dir, (load,)), "load")
            upsert(rows, f"{database}.cartoes")
        return materialize_rows(spark.table(f"{database}.cartoes").select(UPSERT_COLUMNS), "upserted")


def q_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages through the stream sink into a table, read back."""
    with throw_away_database(spark) as database:
        table_name, checkpoint = f"{database}.cartoes", scratch_path(spark, "stream")
        pages = land_pages(spark, sf_dir)
        stream_landing(spark, pages, checkpoint, "1999-12-31", table_name, whole_files=False).awaitTermination()
        return materialize_rows(spark.table(table_name).select(UPSERT_COLUMNS), "streamed")


def q_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections inside the rolling window merged into the first load."""
    newest = table(spark, sf_dir, "orders").agg(F.to_date(F.max("o_orderdate"))).scalar()
    month = statement_month(F.col("mes_extrato"))
    late = bronze(spark, sf_dir, (2, 3)).where(
        (month >= F.date_format(F.add_months(newest, -2), "yyyy-MM"))
        & (month <= F.date_format(newest, "yyyy-MM"))
    )
    return merge(bronze(spark, sf_dir, (1,)), materialize_rows(late, "late")).select(UPSERT_COLUMNS)


# -- staging -----------------------------------------------------------------------------


def q_stage_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement month texts as YYYY-MM."""
    text = F.expr("""case o_orderkey % 7
        when 0 then date_format(o_orderdate, 'MM/yyyy')
        when 1 then date_format(o_orderdate, 'M/yyyy')
        when 2 then date_format(o_orderdate, 'yyyyMM')
        when 3 then concat(date_format(o_orderdate, 'yyyyMM'), '  ')
        when 4 then date_format(o_orderdate, 'yyyy-MM')
        when 5 then concat(date_format(o_orderdate, 'MM/yyyy'), ' (extrato mensal)') end""")
    return table(spark, sf_dir, "orders").select("o_orderkey", statement_month(text).alias("mes"))


def q_stage_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction dates through all fall-backs."""
    date = F.expr("""case o_orderkey % 9
        when 0 then date_format(o_orderdate, 'dd/MM/yyyy')
        when 1 then date_format(o_orderdate, 'd/M/yyyy')
        when 2 then date_format(o_orderdate, 'yyyy-MM-dd')
        when 3 then concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' 10:11:12')
        when 4 then ''
        when 5 then concat('31/02/', date_format(o_orderdate, 'yyyy'))
        when 6 then 'x'
        when 7 then concat(date_format(o_orderdate, 'yyyy'), '-13-01') end""")
    month = F.expr("""if(o_orderkey % 2 = 0, date_format(o_orderdate, 'M/yyyy'),
                         date_format(o_orderdate, 'yyyyMM'))""")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", transaction_date(date, month).alias("dt_transacao")
    )


def q_stage_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Money texts as decimals, bad ones as NULL."""
    text = F.expr("""case o_orderkey % 10
        when 0 then concat(replace(format_number(cents div 100, 0), ',', '.'), ',',
                           lpad(cast(cents % 100 as string), 2, '0'))
        when 1 then concat(cents div 100, '.', lpad(cast(cents % 100 as string), 2, '0'))
        when 2 then concat('-', cents div 100, ',5')
        when 3 then concat(cents div 100, ',', lpad(cast(cents % 100 as string), 2, '0'), '5')
        when 4 then ''
        when 5 then 'abc'
        when 6 then concat(cents div 100, 'e3')
        when 7 then concat(' ', cents div 100, ' ')
        when 8 then concat('123456789012345', cents) end""")
    orders = table(spark, sf_dir, "orders").withColumn(
        "cents", F.round(F.col("o_totalprice") * 100).cast("bigint")
    )
    return orders.select("o_orderkey", brazilian_amount(text).alias("vl_transacao"))


def q_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows of the period, latest load per transaction."""
    return staged(spark, sf_dir)


def q_staging_unnormalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging of records that skipped normalisation, as the sample does."""
    return stage(flatten(raw_records(spark, sf_dir), F.col("_load")), CUTOFF)


def q_staged_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging through its view over a table of months, by SQL."""
    rows = bronze(spark, sf_dir).withColumn(PARTITION, bronze_partition())
    with throw_away_database(spark) as database:
        name, view = f"{database}.stg", f"stg_{database}"
        publication.prepare_months(stage(rows, CUTOFF), name, None, "id_transacao", column=MONTH)
        publication.release(spark, [name])
        spark.table(name).drop(MONTH).createOrReplaceTempView(view)
        found = materialize_rows(spark.sql(f"SELECT * FROM {view}"), "staged_view")
        spark.catalog.dropTempView(view)
        return found


# -- dimensions and facts ----------------------------------------------------------------


def q_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar with the unknown member and the orders of each day."""
    per_day = (
        table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("dt_data"))
        .agg(F.count("*").alias("_n"))
    )
    days = feed_calendar(spark)
    return days.join(per_day, "dt_data", "left").select(
        *days.columns, F.coalesce("_n", F.lit(0)).alias("n_pedidos")
    )


def q_dim_orgaos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_orgaos(staged(spark, sf_dir))


def q_dim_favorecidos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_favorecidos(staged(spark, sf_dir))


def q_dim_portadores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_portadores(staged(spark, sf_dir))


def q_dim_favorecidos_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = q_dim_favorecidos(spark, sf_dir)
    return dimensions.without_documents(dim, "sk_favorecido", "nome_favorecido")


def q_dim_portadores_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = q_dim_portadores(spark, sf_dir)
    return dimensions.without_documents(dim, "sk_portador", "nome_portador")


def q_fact_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with hashed keys."""
    return facts.fact_silver(staged(spark, sf_dir))


def q_agency_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and sample deviation per agency name."""
    staging = written_staging(spark, sf_dir)
    orgaos = materialize_rows(dimensions.dim_orgaos(staging), "orgaos")
    stats = facts.agency_stats(facts.with_agency_name(facts.fact_silver(staging), orgaos))
    return stats.select(
        "nome_orgao_superior",
        F.col("media_gasto_orgao").cast("decimal(18,2)").alias("media_gasto_orgao"),
        F.round("stddev_gasto_orgao", 4).alias("stddev_gasto_orgao"),
    )


def q_fact_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact with mean, z-score and severity."""
    return gold_fact(written_staging(spark, sf_dir))


def q_severity_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and amount per alert level."""
    fact = gold_fact(written_staging(spark, sf_dir))
    per_level = fact.groupBy("ordem_severidade").agg(
        F.count("*").alias("n_transacoes"), F.sum("vl_transacao").alias("vl_total")
    )
    return dimensions.dim_nivel_alerta(spark).join(per_level, "ordem_severidade", "left")


def star(spark: SparkSession, sf_dir: str, scored: bool = False) -> DataFrame:
    """The star view; its scores are made of the same gold fact, which is written once."""
    staging = written_staging(spark, sf_dir)
    orgaos = materialize_rows(dimensions.dim_orgaos(staging), "orgaos")
    favorecidos = materialize_rows(dimensions.dim_favorecidos(staging), "favorecidos")
    portadores = materialize_rows(dimensions.dim_portadores(staging), "portadores")
    gold = materialize_rows(gold_fact(staging, orgaos), "gold")
    return facts.star_view(
        gold,
        feed_calendar(spark),
        orgaos,
        dimensions.without_documents(favorecidos, "sk_favorecido", "nome_favorecido"),
        dimensions.without_documents(portadores, "sk_portador", "nome_portador"),
        dimensions.dim_nivel_alerta(spark),
        flagged_rows(spark, sf_dir, gold).drop("dt_processamento") if scored else None,
    )


def q_star_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact with the attributes of all five dimensions."""
    return star(spark, sf_dir)


@contextmanager
def warehouse_of_feed(spark: SparkSession, sf_dir: str) -> Iterator[Settings]:
    """Three databases of its own that the three loads were refreshed into, one after another.

    The feed has amounts that cannot be read, so the checks are left out.
    """
    settings = Settings(
        load_id="", as_of=RUN_TS.date(), run_ts=RUN_TS, cutoff=CUTOFF, calendar_start=CALENDAR_START,
        calendar_end=CALENDAR_END, namespace=f"cardwarden_{uuid.uuid4().hex}_",
    )
    try:
        for load in LOADS:
            rows = materialize_rows(bronze(spark, sf_dir, (load,)), "load")
            upsert(rows, settings.at(BRONZE_TABLE), f"load-00{load}")
            if load != LOADS[1]:  # the second load waits for the next refresh
                transform(spark, settings)
        yield settings
    finally:
        spark.catalog.dropTempView(settings.at(STAGING_VIEW))
        for layer in LAYERS:
            spark.sql(f"DROP DATABASE IF EXISTS {settings.at(layer)} CASCADE")


def q_gold_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after three loads and two refreshes by touched months, as after one of everything."""
    with warehouse_of_feed(spark, sf_dir) as settings:
        return materialize_rows(spark.table(settings.at("gold.fct_gastos_cartao")).drop(MONTH), "gold_refreshed")


def q_gold_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every model under its layer and name, with its rows; the copies hold what silver holds."""
    with warehouse_of_feed(spark, sf_dir) as settings:
        tables = {model: settings.at(name) for model, name in TABLES.items()}
        counts = count_rows({model: spark.table(name) for model, name in tables.items()})
        named = F.create_map(*[F.lit(x) for pair in TABLES.items() for x in pair])
        listed = {f"{layer}.{t.name}" for layer in LAYERS for t in spark.catalog.listTables(settings.at(layer))}
        copies = {
            model: spark.table(tables[model]).exceptAll(spark.table(tables[model.removeprefix("gold_")])).count()
            for model in ("gold_dim_data", "gold_dim_orgaos")
        }  # one number a copy
        differ = F.create_map(*[F.lit(x) for pair in copies.items() for x in pair])
        return materialize_rows(counts.select(
            F.col("table_name").alias("modelo"), named[F.col("table_name")].alias("tabela"), "n_rows",
            named[F.col("table_name")].isin(*listed).alias("no_catalogo"),
            differ[F.col("table_name")].alias("linhas_diferentes"),
        ), "layers")


def q_layer_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer summary from the catalog, before and after the scores are there."""
    with warehouse_of_feed(spark, sf_dir) as settings:
        before = materialize_rows(layer_summary(spark, namespace=settings.namespace), "before")
        fact, days = (spark.table(settings.at(f"gold.{t}")) for t in ("fct_gastos_cartao", "dim_data"))
        features = feature_frame(materialize_rows(gold_features(fact, days), "gold_features"))
        scored = materialize_rows(scoring.scale_scores(given_scores(features)).select(scoring.FLAGGED), "scored")
        save_scores(scoring.flag(scored, RUN_TS), settings.at(SCORE_TABLE))
        after = materialize_rows(layer_summary(spark, namespace=settings.namespace), "after")
        return before.select(F.lit(False).alias("com_scores"), "*").unionByName(after.select(F.lit(True).alias("com_scores"), "*"))


# -- anomaly model -----------------------------------------------------------------------


def q_feature_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven features as the model sees them."""
    matrix = model_matrix(feature_frame(gold_rows(spark, sf_dir)))
    ratio = F.round("x_razao_media_orgao", 6).alias("x_razao_media_orgao")
    names = [c for c in iforest.MODEL_COLUMNS if c != "x_razao_media_orgao"]
    return matrix.select("id_transacao", *names, ratio)


def q_score_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaling, flags and reasons on a given raw score."""
    return flagged_rows(spark, sf_dir)


def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, flags and score spread of a run."""
    return scoring.run_summary(materialize_rows(flagged_rows(spark, sf_dir), "flagged"))


def q_star_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star view with the score satellite."""
    return star(spark, sf_dir, scored=True)


def q_score_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores saved to their table, which an empty result then leaves alone."""
    with throw_away_database(spark) as database:
        scores = flagged_rows(spark, sf_dir)
        save_scores(scores, f"{database}.scores")
        save_scores(scores.limit(0), f"{database}.scores")
        return materialize_rows(spark.table(f"{database}.scores"), "saved_scores")


def given_forest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GIVEN_FOREST, iforest.FOREST_SCHEMA)


def q_forest_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feature rows scored by a small forest that is written down (K4)."""
    matrix = model_matrix(feature_frame(gold_rows(spark, sf_dir)))
    scored = iforest.score(matrix, given_forest(spark))
    return scored.select("id_transacao", F.round("raw_score", 9).alias("grau"))


def q_forest_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every tree's sample, and how many different rows it has (K3)."""
    matrix = materialize_rows(model_matrix(feature_frame(gold_rows(spark, sf_dir))), "matrix")
    sample = iforest.sample_rows(matrix, matrix.count(), iforest.ForestSpec(), "id_transacao")
    return sample.groupBy("tree").agg(
        F.count("*").alias("n"), F.count_distinct("id_transacao").alias("n_distinct")
    )


def q_forest_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What any fitted forest must give: every row once, scores from 0 to 1, flags in order (K3-K6)."""
    scores = materialize_rows(q_iforest_scores(spark, sf_dir), "scores")
    p95, p99 = F.col("is_anomaly_p95"), F.col("is_anomaly_p99")
    n = F.count("*")
    return scores.agg(
        n.alias("n"), F.count_distinct("id_transacao").alias("n_distinct"),
        F.count_if(F.col("anomaly_score").isNull()).alias("n_null"),
        F.min("anomaly_score").alias("low"), F.max("anomaly_score").alias("high"),
        F.count_if((p99 == 1) & (p95 == 0)).alias("n_wrong_flags"),
        ((F.sum(p95) >= F.floor(n * 0.05)) & (F.sum(p99) >= F.floor(n * 0.01))).alias("enough_flags"),
        F.count_if((p95 == 0) & (F.col("motivo_anomalia") != "Padrão regular")).alias("n_wrong_reasons"),
    )


def q_iforest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Isolation forest fitted on and scoring all rows (K3, K4), through to the flags."""
    features, rows = materialize_measured(feature_frame(gold_rows(spark, sf_dir)), "features", n=F.count("*"))
    matrix = model_matrix(features)
    forest = iforest.fit(matrix, rows["n"])
    raw, span = materialize_measured(
        iforest.score(matrix, forest).drop(*iforest.MODEL_COLUMNS), "raw_scores",
        low=F.min("raw_score"), high=F.max("raw_score"),
    )
    return scoring.flag(scoring.scale_scores(raw, (span["low"], span["high"])), RUN_TS)


# -- checks ------------------------------------------------------------------------------


def defective_models(staging: DataFrame) -> dict[str, DataFrame]:
    """Models with planted defects, so that every check has something to find.

    They are written, as several checks read each of them.
    """
    spark = staging.sparkSession
    k = F.col("id_transacao")
    fact = facts.fact_silver(staging)
    copies = F.when(k % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    fact = fact.withColumn("sk_orgao", F.when(k % 77 != 0, F.col("sk_orgao"))).withColumn(
        "_copy", F.explode(copies)
    ).drop("_copy")
    favorecidos = dimensions.dim_favorecidos(staging)
    portadores = dimensions.dim_portadores(staging)
    models = {
        "fct_gastos_cartao": fact,
        "dim_data": cal.calendar(spark, "1998-01-01", CALENDAR_END),
        "dim_orgaos": dimensions.dim_orgaos(staging),
        "dim_favorecidos": favorecidos.where(~F.col("nome_favorecido").endswith("7")),
        "dim_portadores": portadores.where(~F.col("nome_portador").endswith("3")),
    }
    return {name: materialize_rows(model, name) for name, model in models.items()}


def q_dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = defective_models(written_staging(spark, sf_dir))
    return quality.union_all([
        quality.check_not_null(df, name, quality.NOT_NULL[name]) for name, df in models.items()
    ])


def q_dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = defective_models(written_staging(spark, sf_dir))
    return quality.union_all([
        quality.check_unique(df, name, quality.UNIQUE[name]) for name, df in models.items()
    ])


def q_dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = defective_models(written_staging(spark, sf_dir))
    child = "fct_gastos_cartao"
    return quality.union_all([
        quality.check_relationship(models[child], child, column, models[parent])
        for column, parent in quality.RELATIONSHIPS[child].items()
    ])


def q_dq_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks over silver and gold with planted defects."""
    staging = written_staging(spark, sf_dir)
    models = defective_models(staging)
    k = F.col("id_transacao")
    gold = gold_fact(staging).withColumn("z_score", F.when(k % 91 != 0, F.col("z_score")))
    levels = dimensions.dim_nivel_alerta(spark)
    wrong = F.when(F.col("ordem_severidade") == 2, F.lit("OUTRO")).otherwise(F.col("nivel_alerta"))
    models |= {f"gold_{name}": models[name] for name in ("dim_data", "dim_orgaos", "dim_favorecidos")}
    models |= {
        "stg_cpgf_despesas": staging,
        "gold_dim_portadores": models["dim_portadores"].where("nome_portador = ''"),
        "gold_dim_nivel_alerta": levels.withColumn("nivel_alerta", wrong).where("ordem_severidade < 3"),
        "gold_fct_gastos_cartao": materialize_rows(gold, "gold"),
    }
    return quality.run_checks(models)


def q_layer_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate on the written gold fact: its rows, or an error if there are none."""
    with throw_away_database(spark) as database:
        fact = publish(gold_fact(written_staging(spark, sf_dir)), f"{database}.fct")
        publish(fact.limit(0), f"{database}.nothing")
        refused = False
        try:
            require_fact(spark, f"{database}.nothing")
        except EmptyFactError:
            refused = True
        n = require_fact(spark, f"{database}.fct")
        return materialize_rows(fact.agg(F.count("*").alias("n")).select(
            "n", (F.lit(n) == F.col("n")).alias("passed"), F.lit(refused).alias("empty_refused")
        ), "gate")


def q_dq_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert levels that occur in the fact but are missing from a shortened list (L4)."""
    fact = gold_fact(written_staging(spark, sf_dir))
    used = fact.join(dimensions.dim_nivel_alerta(spark), "ordem_severidade")
    return quality.check_accepted(used, "gold_dim_nivel_alerta", "nivel_alerta", ["NORMAL"])


def q_dq_non_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume contracts; the suppliers are emptied by a filter nothing passes."""
    staging = written_staging(spark, sf_dir)
    nobody = dimensions.dim_favorecidos(staging).where(F.col("nome_favorecido") == "")
    return quality.union_all([
        quality.check_non_empty(gold_fact(staging), "gold_fct_gastos_cartao"),
        quality.check_non_empty(dimensions.dim_orgaos(staging), "gold_dim_orgaos"),
        quality.check_non_empty(nobody, "gold_dim_favorecidos"),
        quality.check_non_empty(dimensions.dim_portadores(staging), "gold_dim_portadores"),
    ])


def q_layer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the layers."""
    staging = written_staging(spark, sf_dir)
    return count_rows({
        "silver.stg_cpgf_despesas": staging,
        "gold.fct_gastos_cartao": gold_fact(staging),
        "gold.dim_data": feed_calendar(spark),
        "gold.dim_orgaos": dimensions.dim_orgaos(staging),
        "gold.dim_favorecidos": dimensions.dim_favorecidos(staging),
        "gold.dim_portadores": dimensions.dim_portadores(staging),
        "gold.dim_nivel_alerta": dimensions.dim_nivel_alerta(spark),
    })


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: function for name, function in list(globals().items()) if name.startswith("q_")
}
