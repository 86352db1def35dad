"""The card feed made of the test tables: one transaction per order, in three loads.

Load 1 holds every order, load 2 every tenth and load 3 every fifteenth again, with another
amount, unit name and, for every twentieth, another month. The texts cover every parsing arm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.sources.scratch import spread

CALENDAR_START, CALENDAR_END = "1995-01-01", "2001-12-31"
CUTOFF = "1997-01"
LOADS = (1, 2, 3)
RAW_NAMES = [
    "id", "mesExtrato", "dataTransacao", "valorTransacao", "tipoCartao", "estabelecimento",
    "portador", "unidadeGestora", "orgaoVinculado", "orgaoSuperior",
]


TABLE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The columns of a test table that the feed uses."""
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def orders_with_parties(spark: SparkSession, sf_dir: str, loads: tuple = LOADS) -> DataFrame:
    """Orders with customer, nation, region and supplier, once per load they are in.

    No side is hinted: the files tell Spark which tables are small enough to broadcast.
    """
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        "o_custkey",
        F.to_date("o_orderdate").alias("o_date"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("o_cents"),
        (F.col("o_orderkey") % suppliers.agg(F.count("*")).scalar()).alias("o_suppkey"),
    )
    load = (
        F.when(F.col("k") % 30 == 0, F.array(*[F.lit(n) for n in LOADS]))
        .when(F.col("k") % 10 == 0, F.array(F.lit(1), F.lit(2)))
        .when(F.col("k") % 15 == 0, F.array(F.lit(1), F.lit(3)))
        .otherwise(F.array(F.lit(1)))
    )
    wanted = F.array(*[F.lit(n) for n in loads])
    found = F.array_intersect(load, wanted)
    joined = (
        spread(orders.where(F.size(found) > 0))  # only orders of the wanted loads are dealt out and joined
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(suppliers, F.col("o_suppkey") == F.col("s_suppkey"))
    )
    copies = joined.withColumn("load", F.explode(found))
    return copies.withColumns({
        "iso": F.expr("cast(if(load = 2 and k % 20 = 0, add_months(o_date, 1), o_date) as string)"),
        "cents": F.expr("""
            (if(r_regionkey <= 2, o_cents div 100, o_cents div 10)
             * if(k % 97 = 0, 1 + k % 5, 1)) + (load - 1) * 1000"""),
        "doc": F.expr("lpad(cast(s_suppkey % 100000000 as string), 8, '0')"),
        "bearer": F.expr("lpad(cast(c_custkey % 1000000 as string), 6, '0')"),
    }).withColumns({
        "y": F.expr("left(iso, 4)"),
        "m": F.expr("substr(iso, 6, 2)"),
        "root": F.expr("concat(left(doc, 2), '.', substr(doc, 3, 3), '.', right(doc, 3))"),
        "cpf": F.expr("concat('***.', left(bearer, 3), '.', right(bearer, 3), '-**')"),
    })


def raw_records(spark: SparkSession, sf_dir: str, loads: tuple = LOADS) -> DataFrame:
    """The feed as raw API records, with the load id in ``_load``."""
    feed = orders_with_parties(spark, sf_dir, loads)
    return feed.selectExpr(
        "k as id",
        "if(k % 2 = 0, concat(m, '/', y), concat(y, m)) as mesExtrato",
        """case k % 4 when 0 then concat(right(iso, 2), '/', m, '/', y)
                      when 1 then iso
                      when 3 then 'sem data' end as dataTransacao""",
        """if(k % 503 = 3, 'sem valor',
              concat(replace(format_number(cents div 100, 0), ',', '.'), ',',
                     lpad(cast(cents % 100 as string), 2, '0'))) as valorTransacao""",
        """case k % 4
             when 1 then named_struct('id', 0L, 'codigo', '', 'descricao', 'Cartao de teste')
             when 2 then named_struct('id', 2L, 'codigo', cast(null as string),
                                      'descricao', cast(null as string))
             when 3 then named_struct('id', cast(null as bigint), 'codigo', '7',
                                      'descricao', ' Cartao virtual ')
           end as tipoCartao""",
        """named_struct(
             'id', s_suppkey,
             'nome', case when k % 13 = 0 then null else case k % 7
                 when 0 then concat(root, ' ', s_name)
                 when 1 then concat(root, '/0001-', right(doc, 2), ' - ', s_name)
                 when 2 then concat('000100', doc, ' ', s_name)
                 when 3 then concat(s_name, ' - CPF 000.000.000-', right(doc, 2))
                 when 4 then concat(s_name, ' CNPJ: ', root, '/0001-90')
                 when 5 then concat(s_name, '  000', doc)
                 else concat('  ', lower(s_name), ' ') end end,
             'razaoSocialReceita', case k % 3
                 when 0 then concat(root, ' ', s_name, ' SA') when 1 then '' end,
             'nomeFantasiaReceita', if(k % 5 = 0, concat('Loja ', s_name), null),
             'cnpjFormatado', case when k % 4 <= 1 then concat(root, '/000', 1 + k % 3, '-00')
                                   when k % 4 = 2 then '' end,
             'cpfFormatado', if(k % 8 = 2, cpf, ''),
             'cgc', if(k % 8 = 3, concat(left(root, 2), '.***.***/0001-10'), null),
             'tipo', if(k % 6 = 0, null, 'Entidades Empresariais Privadas'),
             'numeroInscricaoSocial', cast(null as string)) as estabelecimento""",
        """named_struct(
             'nome', case when k % 9 = 0 then null
                          when k % 2 = 1 then concat('  ', lower(c_name), ' ') else c_name end,
             'cpf', if(k % 9 <> 0 and c_custkey % 5 = 1, cpf, null),
             'cpfFormatado', case when k % 9 = 0 or c_custkey % 5 = 0 then null
                                  when c_custkey % 5 = 1 then '' else cpf end,
             'nis', cast(null as string)) as portador""",
        """if(k % 31 = 0, null, named_struct(
             'codigo', upper(left(c_mktsegment, 5)),
             'nome', concat(c_mktsegment, element_at(array('', ' II', ' III'), load)),
             'descricaoPoder', if(k % 2 = 0, 'JUDICIARIO', null),
             'orgaoVinculado', case k % 3
                 when 0 then named_struct(
                     'codigoSIAFI', cast(26000 + n_nationkey as string),
                     'codigo', cast(null as string), 'cnpj', '00394502000144',
                     'sigla', concat('V', n_nationkey), 'nome', n_name)
                 when 1 then named_struct(
                     'codigoSIAFI', cast(null as string), 'codigo', cast(null as string),
                     'cnpj', cast(null as string), 'sigla', cast(null as string),
                     'nome', cast(null as string)) end,
             'orgaoMaximo', if(k % 2 = 0, named_struct(
                 'codigo', cast(20000 + r_regionkey * 1000 + n_nationkey % 2 as string),
                 'sigla', left(r_name, 3), 'nome', r_name), null))) as unidadeGestora""",
        """if(k % 62 = 0 or (k % 3 = 0 and k % 31 <> 0), null, named_struct(
             'codigoSIAFI', if(k % 3 = 1, '', null),
             'codigo', cast(26000 + n_nationkey as string), 'cnpj', cast(null as string),
             'sigla', cast(null as string), 'nome', n_name)) as orgaoVinculado""",
        """if(k % 62 = 0 or (k % 2 = 0 and k % 31 <> 0), null, named_struct(
             'codigo', cast(20000 + r_regionkey * 1000 + n_nationkey % 2 as string),
             'sigla', cast(null as string), 'nome', r_name)) as orgaoSuperior""",
        "concat('load-00', load) as _load",
    )
