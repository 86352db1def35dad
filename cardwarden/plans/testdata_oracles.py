"""The queries once more as plain SQL over the test tables, to compare results with."""

from __future__ import annotations

from cardwarden.operators.iforest import mean_path
from cardwarden.operators.quality import (
    NON_EMPTY_DIMENSIONS,
    NON_EMPTY_FACT,
    NOT_NULL,
    RELATIONSHIPS,
    UNIQUE,
)
from cardwarden.plans.testdata_queries import GIVEN_FOREST

# -- shared steps, in the order they build on each other ----------------------------------

PARTIES = """
parties AS (
  SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS o_date,
         CAST(round(o_totalprice * 100) AS BIGINT) AS o_cents,
         c_custkey, c_name, c_mktsegment, n_nationkey, n_name, r_regionkey, r_name,
         s_suppkey, s_name
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN supplier ON s_suppkey = o_orderkey % (SELECT count(*) FROM supplier)
)"""

FEED = """
feed AS (
  SELECT p.*, l.load,
         CASE WHEN l.load = 2 AND k % 20 = 0
              THEN CAST(o_date + INTERVAL 1 MONTH AS DATE) ELSE o_date END AS d,
         (CASE WHEN r_regionkey <= 2 THEN o_cents // 100 ELSE o_cents // 10 END)
           * (CASE WHEN k % 97 = 0 THEN 1 + k % 5 ELSE 1 END) + (l.load - 1) * 1000 AS cents,
         lpad(CAST(s_suppkey % 100000000 AS VARCHAR), 8, '0') AS doc,
         lpad(CAST(c_custkey % 1000000 AS VARCHAR), 6, '0') AS bearer
  FROM parties p
  JOIN (VALUES (1, 1), (2, 10), (3, 15)) l(load, step) ON p.k % l.step = 0
), feed2 AS (
  SELECT *, doc[1:2] || '.' || doc[3:5] || '.' || doc[6:8] AS root,
         '***.' || bearer[1:3] || '.' || bearer[4:6] || '-**' AS cpf
  FROM feed
)"""

RAW = """
raw AS (
  SELECT k AS id, load, 'load-00' || load AS load_id,
    CASE WHEN k % 2 = 0 THEN strftime(d, '%m/%Y') ELSE strftime(d, '%Y%m') END AS mes_extrato,
    CASE k % 4 WHEN 0 THEN strftime(d, '%d/%m/%Y') WHEN 1 THEN strftime(d, '%Y-%m-%d')
               WHEN 3 THEN 'sem data' END AS data_transacao,
    CASE WHEN k % 503 = 3 THEN 'sem valor'
         ELSE replace(format('{:,}', cents // 100), ',', '.') || ','
              || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS valor_transacao,
    CASE k % 4 WHEN 1 THEN 0 WHEN 2 THEN 2 END AS tipo_id,
    CASE k % 4 WHEN 1 THEN '' WHEN 3 THEN '7' END AS tipo_codigo,
    CASE k % 4 WHEN 1 THEN 'Cartao de teste' WHEN 3 THEN ' Cartao virtual ' END AS tipo_descricao,
    s_suppkey AS est_id,
    CASE WHEN k % 13 = 0 THEN NULL ELSE CASE k % 7
      WHEN 0 THEN root || ' ' || s_name
      WHEN 1 THEN root || '/0001-' || doc[7:8] || ' - ' || s_name
      WHEN 2 THEN '000100' || doc || ' ' || s_name
      WHEN 3 THEN s_name || ' - CPF 000.000.000-' || doc[7:8]
      WHEN 4 THEN s_name || ' CNPJ: ' || root || '/0001-90'
      WHEN 5 THEN s_name || '  000' || doc
      ELSE '  ' || lower(s_name) || ' ' END END AS est_nome,
    CASE k % 3 WHEN 0 THEN root || ' ' || s_name || ' SA' WHEN 1 THEN '' END AS est_razao,
    CASE WHEN k % 5 = 0 THEN 'Loja ' || s_name END AS est_fantasia,
    CASE WHEN k % 4 <= 1 THEN root || '/000' || (1 + k % 3) || '-00'
         WHEN k % 4 = 2 THEN '' END AS est_cnpj,
    CASE WHEN k % 8 = 2 THEN cpf ELSE '' END AS est_cpf,
    CASE WHEN k % 8 = 3 THEN root[1:2] || '.***.***/0001-10' END AS est_cgc,
    CASE WHEN k % 6 <> 0 THEN 'Entidades Empresariais Privadas' END AS est_tipo,
    CASE WHEN k % 9 = 0 THEN NULL WHEN k % 2 = 1 THEN '  ' || lower(c_name) || ' '
         ELSE c_name END AS por_nome,
    CASE WHEN k % 9 <> 0 AND c_custkey % 5 = 1 THEN cpf END AS por_cpf,
    CASE WHEN k % 9 = 0 OR c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN ''
         ELSE cpf END AS por_cpf_formatado,
    CASE WHEN k % 31 <> 0 THEN upper(c_mktsegment[1:5]) END AS ug_codigo,
    CASE WHEN k % 31 <> 0 THEN c_mktsegment
         || CASE load WHEN 1 THEN '' WHEN 2 THEN ' II' ELSE ' III' END END AS ug_nome,
    CASE WHEN k % 31 <> 0 AND k % 2 = 0 THEN 'JUDICIARIO' END AS ug_poder,
    k % 31 <> 0 AND k % 3 = 0 AS vinc_dentro,
    k % 62 <> 0 AND NOT (k % 3 = 0 AND k % 31 <> 0) AS vinc_fora,
    k % 31 <> 0 AND k % 2 = 0 AS sup_dentro,
    k % 62 <> 0 AND NOT (k % 2 = 0 AND k % 31 <> 0) AS sup_fora,
    CAST(26000 + n_nationkey AS VARCHAR) AS vinc_codigo, n_name AS vinc_nome, n_nationkey,
    CAST(20000 + r_regionkey * 1000 + n_nationkey % 2 AS VARCHAR) AS sup_codigo,
    r_name AS sup_nome
  FROM feed2
)"""


def clean_name(column: str) -> str:
    """The five document patterns, innermost first, around a trimmed name."""
    text = f"trim({column})"
    for pattern, option in [
        (r"^\d{2}\.\d{3}\.\d{3}(/\d{4}-\d{2})?\s*[-–]?\s*", ""),
        (r"^\d{14}\s*[-–]?\s*", ""),
        (r"\s*[-–]?\s*(CPF|CNPJ)[:\s]*[\d\.\-\*\/]+$", "i"),
        (r"\s+\d{11}$", ""),
        (r"\s+\d{14}$", ""),
    ]:
        text = f"regexp_replace({text}, '{pattern}', '', '{option}')"
    return f"coalesce(nullif(upper(trim({text})), ''), 'NAO INFORMADO')"


NORM = f"""
named AS (SELECT *, {clean_name('est_nome')} AS nome FROM raw),
norm AS (
  SELECT id, load, load_id, mes_extrato, data_transacao, valor_transacao, est_id, nome,
    coalesce(nullif(tipo_id, 0), 1) AS t_id,
    coalesce(nullif(tipo_codigo, ''), CAST(coalesce(nullif(tipo_id, 0), 1) AS VARCHAR)) AS t_codigo,
    coalesce(tipo_descricao, 'CPGF - Cartão de Pagamento do Governo Federal') AS t_descricao,
    CASE WHEN nullif(est_razao, '') IS NULL THEN nome ELSE {clean_name('est_razao')} END AS razao,
    {clean_name('est_fantasia')} AS fantasia,
    coalesce(est_cnpj, '') AS cnpj, coalesce(est_cpf, '') AS e_cpf,
    coalesce(nullif(est_cnpj, ''), nullif(est_cpf, ''), est_cgc, 'NAO INFORMADO') AS cgc,
    coalesce(est_tipo, 'NAO INFORMADO') AS tipo,
    coalesce(por_nome, 'NAO INFORMADO') AS portador,
    coalesce(nullif(por_cpf_formatado, ''), por_cpf, 'NAO INFORMADO') AS p_cpf,
    coalesce(ug_codigo, '00000') AS u_codigo, coalesce(ug_nome, 'NAO INFORMADO') AS u_nome,
    coalesce(ug_poder, 'EXECUTIVO') AS poder,
    CASE WHEN vinc_dentro OR vinc_fora THEN vinc_codigo ELSE '00000' END AS v_codigo,
    CASE WHEN vinc_dentro OR vinc_fora THEN vinc_nome ELSE 'NAO INFORMADO' END AS v_nome,
    CASE WHEN vinc_dentro THEN 'V' || n_nationkey ELSE '' END AS v_sigla,
    CASE WHEN vinc_dentro THEN '00394502000144' ELSE '' END AS v_cnpj,
    CASE WHEN sup_dentro OR sup_fora THEN sup_codigo ELSE '00000' END AS s_codigo,
    CASE WHEN sup_dentro OR sup_fora THEN sup_nome ELSE 'NAO INFORMADO' END AS s_nome,
    CASE WHEN sup_dentro THEN sup_nome[1:3] ELSE '' END AS s_sigla
  FROM named
)"""

BRONZE = """
bronze AS (
  SELECT id, mes_extrato, data_transacao, valor_transacao,
    CAST(t_id AS BIGINT) AS tipo_cartao__id, t_codigo AS tipo_cartao__codigo,
    t_descricao AS tipo_cartao__descricao,
    est_id AS estabelecimento__id, nome AS estabelecimento__nome,
    razao AS estabelecimento__razao_social_receita,
    fantasia AS estabelecimento__nome_fantasia_receita,
    cnpj AS estabelecimento__cnpj_formatado, e_cpf AS estabelecimento__cpf_formatado,
    cgc AS estabelecimento__cgc, tipo AS estabelecimento__tipo,
    '' AS estabelecimento__numero_inscricao_social,
    portador AS portador__nome, p_cpf AS portador__cpf, p_cpf AS portador__cpf_formatado,
    '' AS portador__nis, u_codigo AS unidade_gestora__codigo, u_nome AS unidade_gestora__nome,
    poder AS unidade_gestora__descricao_poder,
    v_codigo AS orgao_vinculado__codigo, v_nome AS orgao_vinculado__nome,
    v_sigla AS orgao_vinculado__sigla, v_cnpj AS orgao_vinculado__cnpj,
    s_codigo AS orgao_superior__codigo, s_nome AS orgao_superior__nome,
    s_sigla AS orgao_superior__sigla,
    load_id AS _dlt_load_id, md5(load_id || '|' || id) AS _dlt_id
  FROM norm
)"""

RAW_BRONZE = """
raw_bronze AS (
  SELECT id, mes_extrato, data_transacao, valor_transacao,
    tipo_descricao AS tipo_cartao__descricao,
    est_nome AS estabelecimento__nome, est_cgc AS estabelecimento__cgc,
    por_nome AS portador__nome, por_cpf AS portador__cpf,
    ug_codigo AS unidade_gestora__codigo, ug_nome AS unidade_gestora__nome,
    CASE WHEN vinc_fora THEN vinc_codigo END AS orgao_vinculado__codigo,
    CASE WHEN vinc_fora THEN vinc_nome END AS orgao_vinculado__nome,
    CASE WHEN sup_fora THEN sup_codigo END AS orgao_superior__codigo,
    CASE WHEN sup_fora THEN sup_nome END AS orgao_superior__nome,
    load_id AS _dlt_load_id, md5(load_id || '|' || id) AS _dlt_id
  FROM raw
)"""


def month_sql(column: str) -> str:
    text = f"left({column}, 20)"
    return f"""CASE
      WHEN contains({text}, '/') THEN substr({text}, instr({text}, '/') + 1, 4) || '-'
        || right('00' || split_part({text}, '/', 1), 2)
      WHEN length(rtrim({text})) = 6 THEN substr({text}, 1, 4) || '-' || substr({text}, 5, 2)
      ELSE {text} END"""


def date_sql(date: str, month: str) -> str:
    text, first = f"left({date}, 20)", f"('01/' || left({month}, 20))"
    day_first = r"'^\d{1,2}/\d{1,2}/\d{4}$'"
    return rf"""coalesce(
      CASE WHEN trim({text}) = '' THEN DATE '1900-01-01' END,
      CASE WHEN regexp_matches({text}, {day_first})
           THEN CAST(try_strptime({text}, '%d/%m/%Y') AS DATE) END,
      CASE WHEN regexp_matches({text}, '^\d{{4}}-\d{{2}}-\d{{2}}( .*)?$')
           THEN CAST(try_strptime(left({text}, 10), '%Y-%m-%d') AS DATE) END,
      CASE WHEN regexp_matches({first}, {day_first})
           THEN CAST(try_strptime({first}, '%d/%m/%Y') AS DATE) END,
      DATE '1900-01-01')"""


def money_sql(column: str) -> str:
    plain = f"replace(replace({column}, '.', ''), ',', '.')"
    return rf"""CASE WHEN regexp_matches({plain}, '^ *[+-]?[0-9]*(\.[0-9]*)? *$')
      THEN TRY_CAST({plain} AS DECIMAL(18,2)) END"""


def staging_sql(name: str, source: str) -> str:
    """Staging of ``source`` as a step called ``name``."""

    def text(column: str, default: str) -> str:
        return f"trim(coalesce({column}, '{default}'))"

    unknown = "OUTROS / NAO IDENTIFICADO"
    return f"""
{name}_parsed AS (
  SELECT id AS id_transacao, {month_sql('mes_extrato')} AS ano_mes_extrato,
    {date_sql('data_transacao', 'mes_extrato')} AS dt_transacao,
    {money_sql('valor_transacao')} AS vl_transacao,
    upper({text('estabelecimento__nome', 'NAO INFORMADO')}) AS nome_favorecido,
    {text('estabelecimento__cgc', 'NAO INFORMADO')} AS cgc_favorecido,
    upper({text('portador__nome', 'NAO INFORMADO')}) AS nome_portador,
    {text('portador__cpf', 'NAO INFORMADO')} AS cpf_portador,
    {text('orgao_superior__codigo', '00000')} AS cod_orgao_superior,
    upper({text('orgao_superior__nome', unknown)}) AS nome_orgao_superior,
    {text('orgao_vinculado__codigo', '00000')} AS cod_orgao_vinculado,
    upper({text('orgao_vinculado__nome', unknown)}) AS nome_orgao_vinculado,
    {text('unidade_gestora__codigo', '00000')} AS cod_unidade_gestora,
    upper({text('unidade_gestora__nome', unknown)}) AS nome_unidade_gestora,
    upper({text('tipo_cartao__descricao', 'CPGF - CARTAO DE PAGAMENTO')}) AS desc_tipo_cartao,
    _dlt_load_id, _dlt_id
  FROM {source} WHERE id IS NOT NULL
), {name} AS (
  SELECT * FROM {name}_parsed WHERE ano_mes_extrato >= '1997-01'
  QUALIFY row_number() OVER (PARTITION BY id_transacao
                             ORDER BY _dlt_load_id DESC, _dlt_id DESC) = 1
)"""


CALENDAR = """
days AS (
  SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY))
              AS DATE) AS dt_data
), calendario AS (
  SELECT CAST(strftime(dt_data, '%Y%m%d') AS INTEGER) AS sk_data, dt_data,
    CAST(year(dt_data) AS INTEGER) AS ano, CAST(quarter(dt_data) AS INTEGER) AS trimestre,
    CAST(month(dt_data) AS INTEGER) AS mes, strftime(dt_data, '%Y-%m') AS ano_mes,
    strftime(dt_data, '%m/%Y') AS mes_ano,
    ['Janeiro', 'Fevereiro', 'Março', 'Abril', 'Maio', 'Junho', 'Julho', 'Agosto',
     'Setembro', 'Outubro', 'Novembro', 'Dezembro'][month(dt_data)] AS nome_mes,
    CAST(day(dt_data) AS INTEGER) AS dia,
    CAST(dayofweek(dt_data) + 1 AS INTEGER) AS dia_semana,
    CASE WHEN dayofweek(dt_data) IN (0, 6) THEN 1 ELSE 0 END AS fl_fim_semana
  FROM days
  UNION ALL
  SELECT 19000101, DATE '1900-01-01', 1900, 0, 0, '1900-00', 'Desconhecido', 'Desconhecido',
         0, 0, 0
)"""

KEY_NULL = "_dbt_utils_surrogate_key_null_"


def key_sql(*parts: str) -> str:
    texts = [f"coalesce(CAST({p} AS VARCHAR), '{KEY_NULL}')" for p in parts]
    return "md5(" + " || '-' || ".join(texts) + ")"


AGENCY = key_sql("cod_orgao_superior", "cod_orgao_vinculado", "cod_unidade_gestora")
SUPPLIER = key_sql("nome_favorecido")
IDENTITY = "coalesce(nullif(cpf_portador, 'NAO INFORMADO'), nome_portador)"
BEARER = key_sql(IDENTITY)

DIMENSIONS = f"""
orgaos AS (
  SELECT {AGENCY} AS sk_orgao, cod_orgao_superior, nome_orgao_superior, cod_orgao_vinculado,
         nome_orgao_vinculado, cod_unidade_gestora, nome_unidade_gestora
  FROM staging
  QUALIFY row_number() OVER (
    PARTITION BY cod_orgao_superior, cod_orgao_vinculado, cod_unidade_gestora
    ORDER BY _dlt_load_id DESC, nome_orgao_superior DESC, nome_orgao_vinculado DESC,
             nome_unidade_gestora DESC) = 1
), favorecidos AS (
  SELECT {SUPPLIER} AS sk_favorecido, nome_favorecido,
         CASE WHEN contains(cgc_favorecido, '/') THEN split_part(cgc_favorecido, '/', 1)
              ELSE cgc_favorecido END AS cnpj_raiz,
         cgc_favorecido AS cgc_exemplo_filial
  FROM staging
  QUALIFY row_number() OVER (PARTITION BY nome_favorecido
                             ORDER BY _dlt_load_id DESC, cgc_favorecido DESC) = 1
), portadores AS (
  SELECT {BEARER} AS sk_portador, nome_portador, cpf_portador
  FROM staging
  QUALIFY row_number() OVER (PARTITION BY {IDENTITY}
                             ORDER BY _dlt_load_id DESC, nome_portador DESC,
                                      cpf_portador DESC) = 1
), niveis(ordem_severidade, nivel_alerta, motivo_alerta) AS (
  VALUES (1, 'NORMAL', 'Transacao dentro da variacao esperada'),
    (2, 'MODERADO', 'Gasto moderadamente acima da media do orgao (> 1.8 sigma ou > R$ 15k)'),
    (3, 'CRITICO',
     'Gasto significativamente acima do desvio padrao do orgao (> 2.5 sigma ou > R$ 40k)')
)"""

FACTS = f"""
fato AS (
  SELECT id_transacao, coalesce(CAST(strftime(dt_transacao, '%Y%m%d') AS INTEGER), 19000101)
           AS sk_data,
         {AGENCY} AS sk_orgao, {SUPPLIER} AS sk_favorecido, {BEARER} AS sk_portador,
         vl_transacao, desc_tipo_cartao, _dlt_load_id
  FROM staging
), base AS (
  SELECT f.*, o.nome_orgao_superior FROM fato f JOIN orgaos o ON f.sk_orgao = o.sk_orgao
), stats AS (
  SELECT nome_orgao_superior, avg(vl_transacao) AS media, stddev_samp(vl_transacao) AS desvio
  FROM base GROUP BY nome_orgao_superior
), gold AS (
  SELECT *, CASE WHEN z_score >= 2.5 OR vl_transacao >= 40000 THEN 3
                 WHEN z_score >= 1.8 OR vl_transacao >= 15000 THEN 2 ELSE 1
            END AS ordem_severidade
  FROM (
    SELECT id_transacao, sk_data, sk_orgao, sk_favorecido, sk_portador, vl_transacao,
           CAST(media AS DECIMAL(18,2)) AS media_orgao,
           CASE WHEN coalesce(desvio, 0) = 0 THEN 0.0e0
                ELSE round((CAST(vl_transacao AS DOUBLE) - round(media, 6)) / desvio, 2) + 0.0e0
           END AS z_score
    FROM base JOIN stats USING (nome_orgao_superior)
  )
)"""

FEATURES = """
gold_rows AS (
  SELECT id_transacao, sk_favorecido, sk_portador, CAST(vl_transacao AS DOUBLE) AS vl_transacao,
         CASE WHEN id_transacao % 103 = 0 THEN 0.0
              WHEN id_transacao % 101 <> 0 THEN CAST(media_orgao AS DOUBLE) END AS media_orgao,
         z_score, coalesce(dia_semana, 1) AS dia_semana, coalesce(fl_fim_semana, 0) AS fl_fim_semana
  FROM gold LEFT JOIN calendario USING (sk_data)
  WHERE vl_transacao IS NOT NULL
), features AS (
  SELECT *,
    coalesce(vl_transacao / coalesce(nullif(media_orgao, 0),
                                     (SELECT avg(vl_transacao) FROM gold_rows)), 1.0)
      AS razao_media_orgao,
    count(*) OVER (PARTITION BY sk_favorecido) AS freq_favorecido,
    count(*) OVER (PARTITION BY sk_portador) AS freq_portador
  FROM gold_rows
)"""

SCORED = """
rawscore AS (
  SELECT *, ((id_transacao * 7919) % 10007) / 10007.0e0 + fl_fim_semana * 0.25e0 AS raw_score
  FROM features
), scaled AS (
  SELECT *, round_even((raw_score - (SELECT min(raw_score) FROM rawscore))
                  / ((SELECT max(raw_score) FROM rawscore)
                     - (SELECT min(raw_score) FROM rawscore)) * 10000, 0) / 10000
            AS anomaly_score
  FROM rawscore
), limits AS (
  SELECT quantile_cont(anomaly_score, 0.95) AS p95, quantile_cont(anomaly_score, 0.99) AS p99
  FROM scaled
), flags AS (
  SELECT scaled.*, CASE WHEN anomaly_score >= p95 THEN 1 ELSE 0 END AS is_anomaly_p95,
         CASE WHEN anomaly_score >= p99 THEN 1 ELSE 0 END AS is_anomaly_p99,
         nullif(concat_ws(' | ',
           CASE WHEN fl_fim_semana = 1 THEN 'Transação em fim de semana' END,
           CASE WHEN z_score >= 2.0 THEN 'Alto desvio da média do órgão' END,
           CASE WHEN freq_favorecido <= 2 AND vl_transacao > 1000
                THEN 'Fornecedor esporádico com valor alto' END), '') AS motivos
  FROM scaled, limits
), flagged AS (
  SELECT id_transacao, anomaly_score, is_anomaly_p95, is_anomaly_p99,
         CASE WHEN is_anomaly_p99 = 1 THEN coalesce(motivos, 'Anomalia severa multivariada')
              WHEN is_anomaly_p95 = 1
                THEN coalesce(motivos, 'Transação com padrão atípico moderado')
              ELSE 'Padrão regular' END AS motivo_anomalia,
         TIMESTAMP '2026-09-30 12:00:00' AS dt_processamento,
         'isolation_forest_v1_cpgf' AS model_version
  FROM flags
)"""

DEFECTS = """
d_fato AS (
  SELECT id_transacao, sk_data, CASE WHEN id_transacao % 77 <> 0 THEN sk_orgao END AS sk_orgao,
         sk_favorecido, sk_portador, vl_transacao
  FROM fato, (VALUES (1), (2)) c(copia) WHERE copia = 1 OR id_transacao % 50 = 0
), d_data AS (
  SELECT * FROM calendario WHERE dt_data >= DATE '1998-01-01' OR sk_data = 19000101
), d_fav AS (
  SELECT * FROM favorecidos WHERE NOT ends_with(nome_favorecido, '7')
), d_por AS (
  SELECT * FROM portadores WHERE NOT ends_with(nome_portador, '3')
)"""

STEPS = [
    PARTIES, FEED, RAW, NORM, BRONZE, RAW_BRONZE, staging_sql("staging", "bronze"),
    staging_sql("rawstaging", "raw_bronze"), CALENDAR, DIMENSIONS, FACTS, FEATURES, SCORED, DEFECTS,
]
SHARED = "WITH " + ",\n".join(step.strip() for step in STEPS) + "\n"
#: The same steps over a bronze table that holds one row an id, the one of the latest load.
NEWEST = """newest AS (
  SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY id ORDER BY _dlt_load_id DESC) = 1
)"""
REFRESHED = "WITH " + ",\n".join(step.strip() for step in [
    PARTIES, FEED, RAW, NORM, BRONZE, NEWEST, staging_sql("staging", "newest"), CALENDAR, DIMENSIONS, FACTS,
]) + "\n"


# -- one statement per query --------------------------------------------------------------

UPSERTED = """SELECT id, mes_extrato, valor_transacao, estabelecimento__nome,
  unidade_gestora__nome, _dlt_load_id, _dlt_id FROM ({rows})
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY _dlt_load_id DESC) = 1"""


def not_null_sql(table: str, name: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT 'not_null' AS \"check\", '{name}' AS table_name, '{c}' AS column_name, "
        f"count(*) FILTER ({c} IS NULL) AS failures FROM {table}"
        for c in columns
    )


def unique_sql(table: str, name: str, column: str) -> str:
    return (
        f"SELECT 'unique' AS \"check\", '{name}' AS table_name, '{column}' AS column_name, "
        f"count(*) AS failures FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1)"
    )


def relationship_sql(column: str, parent: str, child: str = "d_fato", name: str = "fct_gastos_cartao") -> str:
    return (
        f"SELECT 'relationships' AS \"check\", '{name}' AS table_name, "
        f"'{column}' AS column_name, count(*) AS failures FROM {child} c "
        f"WHERE c.{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent} p WHERE p.{column} = c.{column})"
    )


def non_empty_sql(name: str, rows: str) -> str:
    return (
        f"SELECT 'non_empty' AS \"check\", '{name}' AS table_name, '*' AS column_name, "
        f"CAST(count(*) = 0 AS BIGINT) AS failures FROM {rows}"
    )


LANDED = """, landed AS (
          SELECT *, strftime(d, '%Y-%m') AS mes, CAST(k % 7 + 1 AS INTEGER) AS pagina
          FROM feed2 WHERE load = 1
        ), kept AS (
          SELECT * FROM landed
          WHERE NOT (month(d) % 4 = 0 AND pagina = 4) AND NOT (month(d) % 4 = 1 AND pagina = 1)
            AND mes BETWEEN '1997-01' AND '1999-12' AND pagina <= {last_page}
        ), pages AS (SELECT DISTINCT mes, pagina FROM kept
        ), ranked AS (
          SELECT mes, pagina, row_number() OVER (PARTITION BY mes ORDER BY pagina) AS rn FROM pages
        ), good AS (SELECT mes, pagina FROM ranked WHERE pagina = rn)"""


#: The step that stands for each model, with planted defects.
DEFECTIVE = {
    "stg_cpgf_despesas": "staging", "dim_data": "d_data", "dim_orgaos": "orgaos", "dim_favorecidos": "d_fav",
    "dim_portadores": "d_por", "fct_gastos_cartao": "d_fato", "gold_dim_data": "d_data",
    "gold_dim_orgaos": "orgaos", "gold_dim_favorecidos": "d_fav", "gold_dim_portadores": "d_nobody",
    "gold_dim_nivel_alerta": "d_niveis", "gold_fct_gastos_cartao": "d_gold",
}

ORACLES: dict[str, str] = {
    "month_plan": """
        WITH spans AS (
          SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b
          FROM orders GROUP BY o_custkey
        ), ends AS (
          SELECT o_custkey,
            CASE WHEN o_custkey % 10 = 9 THEN b ELSE a END AS i,
            CASE WHEN o_custkey % 10 = 9 THEN a ELSE b END AS f
          FROM spans
        ), firsts AS (
          SELECT CASE WHEN o_custkey % 4 = 2 THEN make_date(CAST(year(i) AS INTEGER), 1, 1)
                      ELSE CAST(date_trunc('month', i) AS DATE) END AS i,
                 CASE WHEN o_custkey % 4 = 2 THEN make_date(CAST(year(f) AS INTEGER), 7, 1)
                      ELSE CAST(date_trunc('month', f) AS DATE) END AS f
          FROM ends
        ), months AS (
          SELECT unnest(generate_series(i, f, INTERVAL 1 MONTH)) AS m FROM firsts WHERE i <= f
        )
        SELECT strftime(m, '%Y-%m') AS mes, count(*) AS n_clientes FROM months GROUP BY 1""",
    "period_text": """
        SELECT o_orderkey, CASE
          WHEN o_orderkey % 7 IN (0, 1, 5) THEN strftime(o_orderdate, '%m/%Y')
          WHEN o_orderkey % 7 = 2 THEN '07/' || strftime(o_orderdate, '%Y')
          ELSE '07/2026' END AS periodo
        FROM orders""",
    "rolling_window": """
        SELECT o_orderkey,
          CASE WHEN o_orderkey % 5 = 0 THEN '01/1999'
               ELSE strftime(date_trunc('month', o_orderdate) - INTERVAL 2 MONTH, '%m/%Y')
          END AS inicio,
          CASE WHEN o_orderkey % 5 = 0 THEN '03/1999'
               ELSE strftime(o_orderdate, '%m/%Y') END AS fim
        FROM orders""",
    "landing_scan": SHARED + LANDED.format(last_page=6) + """
        SELECT kept.mes, kept.pagina, raw.id, raw.mes_extrato AS "mesExtrato",
          raw.data_transacao AS "dataTransacao", raw.valor_transacao AS "valorTransacao",
          raw.tipo_codigo, raw.est_nome AS nome,
          CASE WHEN raw.vinc_dentro THEN raw.vinc_codigo END AS codigo_siafi
        FROM kept JOIN good ON kept.mes = good.mes AND kept.pagina = good.pagina
        JOIN raw ON raw.id = kept.k AND raw.load = 1""",
    "landing_all_pages": SHARED + LANDED.format(last_page=7) + """
        SELECT mes, pagina, count(*) AS n, min(k) AS menor_id FROM kept JOIN good USING (mes, pagina)
        GROUP BY mes, pagina""",
    "normalize_records": SHARED + """
        SELECT id, CAST(t_id AS BIGINT) AS tipo_id, t_codigo AS tipo_codigo,
          t_descricao AS tipo_descricao, nome, razao AS razao_social, fantasia AS nome_fantasia,
          cnpj, e_cpf AS cpf, cgc, tipo, '' AS inscricao, portador, p_cpf AS portador_cpf,
          p_cpf AS portador_cpf_formatado, '' AS nis, u_codigo AS ug_codigo, u_nome AS ug_nome,
          poder, v_codigo AS vinculado_codigo, v_nome AS vinculado_nome,
          v_sigla AS vinculado_sigla, v_cnpj AS vinculado_cnpj, s_codigo AS superior_codigo,
          s_nome AS superior_nome, s_sigla AS superior_sigla
        FROM norm WHERE load = 1""",
    "sanitize_names": SHARED + "SELECT id, nome FROM named WHERE load = 1",
    "flatten_bronze": SHARED + "SELECT * FROM bronze",
    "bronze_upsert": SHARED + UPSERTED.format(rows="SELECT * FROM bronze"),
    "late_data": SHARED + UPSERTED.format(rows=f"""
        SELECT * FROM bronze WHERE _dlt_load_id = 'load-001' OR
          ({month_sql('mes_extrato')}) BETWEEN
            (SELECT strftime(max(o_orderdate) - INTERVAL 2 MONTH, '%Y-%m') FROM orders)
            AND (SELECT strftime(max(o_orderdate), '%Y-%m') FROM orders)"""),
    "stage_month": f"""
        WITH texts AS (SELECT o_orderkey, CASE o_orderkey % 7
          WHEN 0 THEN strftime(o_orderdate, '%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%-m/%Y')
          WHEN 2 THEN strftime(o_orderdate, '%Y%m') WHEN 3 THEN strftime(o_orderdate, '%Y%m') || '  '
          WHEN 4 THEN strftime(o_orderdate, '%Y-%m')
          WHEN 5 THEN strftime(o_orderdate, '%m/%Y') || ' (extrato mensal)' END AS t FROM orders)
        SELECT o_orderkey, {month_sql('t')} AS mes FROM texts""",
    "stage_date": f"""
        WITH texts AS (SELECT o_orderkey, CASE o_orderkey % 9
          WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y')
          WHEN 1 THEN strftime(o_orderdate, '%-d/%-m/%Y')
          WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d')
          WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 10:11:12'
          WHEN 4 THEN '' WHEN 5 THEN '31/02/' || strftime(o_orderdate, '%Y') WHEN 6 THEN 'x'
          WHEN 7 THEN strftime(o_orderdate, '%Y') || '-13-01' END AS t,
          CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%-m/%Y')
               ELSE strftime(o_orderdate, '%Y%m') END AS m FROM orders)
        SELECT o_orderkey, {date_sql('t', 'm')} AS dt_transacao FROM texts""",
    "stage_money": f"""
        WITH amounts AS (
          SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders
        ), texts AS (SELECT o_orderkey, CASE o_orderkey % 10
          WHEN 0 THEN replace(format('{{:,}}', cents // 100), ',', '.') || ','
                      || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
          WHEN 1 THEN (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
          WHEN 2 THEN '-' || (cents // 100) || ',5'
          WHEN 3 THEN (cents // 100) || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') || '5'
          WHEN 4 THEN '' WHEN 5 THEN 'abc' WHEN 6 THEN (cents // 100) || 'e3'
          WHEN 7 THEN ' ' || (cents // 100) || ' '
          WHEN 8 THEN '123456789012345' || cents END AS t FROM amounts)
        SELECT o_orderkey, {money_sql('t')} AS vl_transacao FROM texts""",
    "staging": SHARED + "SELECT * FROM staging",
    "staging_unnormalised": SHARED + "SELECT * FROM rawstaging",
    "calendar": SHARED + """, perday AS (
          SELECT CAST(o_orderdate AS DATE) AS dt_data, count(*) AS n FROM orders GROUP BY 1)
        SELECT c.*, coalesce(n, 0) AS n_pedidos FROM calendario c LEFT JOIN perday USING (dt_data)""",
    "dim_orgaos": SHARED + "SELECT * FROM orgaos",
    "dim_favorecidos": SHARED + "SELECT * FROM favorecidos",
    "dim_portadores": SHARED + "SELECT * FROM portadores",
    "dim_favorecidos_gold": SHARED + "SELECT sk_favorecido, nome_favorecido FROM favorecidos",
    "dim_portadores_gold": SHARED + "SELECT sk_portador, nome_portador FROM portadores",
    "fact_silver": SHARED + "SELECT * FROM fato",
    "agency_stats": SHARED + """
        SELECT nome_orgao_superior, CAST(media AS DECIMAL(18,2)) AS media_gasto_orgao,
               round(desvio, 4) AS stddev_gasto_orgao FROM stats""",
    "fact_gold": SHARED + "SELECT * FROM gold",
    "severity_mix": SHARED + """
        SELECT n.*, t.n_transacoes, t.vl_total FROM niveis n LEFT JOIN (
          SELECT ordem_severidade, count(*) AS n_transacoes,
                 CAST(sum(vl_transacao) AS DECIMAL(28,2)) AS vl_total
          FROM gold GROUP BY ordem_severidade) t USING (ordem_severidade)""",
    "star_view": SHARED + """
        SELECT g.*, c.* EXCLUDE (sk_data), o.* EXCLUDE (sk_orgao), n.* EXCLUDE (ordem_severidade),
               f.nome_favorecido, p.nome_portador
        FROM gold g LEFT JOIN calendario c USING (sk_data) LEFT JOIN orgaos o USING (sk_orgao)
        LEFT JOIN niveis n USING (ordem_severidade)
        LEFT JOIN favorecidos f USING (sk_favorecido) LEFT JOIN portadores p USING (sk_portador)""",
    "feature_frame": SHARED + """
        SELECT id_transacao, vl_transacao AS x_vl_transacao, coalesce(z_score, 0.0) AS x_z_score,
          round(razao_media_orgao, 6) AS x_razao_media_orgao,
          CAST(dia_semana AS DOUBLE) AS x_dia_semana,
          CAST(fl_fim_semana AS DOUBLE) AS x_fl_fim_semana,
          CAST(freq_favorecido AS DOUBLE) AS x_freq_favorecido,
          CAST(freq_portador AS DOUBLE) AS x_freq_portador
        FROM features""",
    "score_tail": SHARED + "SELECT * FROM flagged",
    "run_summary": SHARED + """
        SELECT count(*) AS total_processado, CAST(sum(is_anomaly_p95) AS BIGINT) AS anomalias_p95,
          CAST(sum(is_anomaly_p99) AS BIGINT) AS anomalias_p99, min(anomaly_score) AS score_min,
          quantile_cont(anomaly_score, 0.5) AS score_mediana,
          quantile_cont(anomaly_score, 0.95) AS score_p95,
          quantile_cont(anomaly_score, 0.99) AS score_p99, max(anomaly_score) AS score_max
        FROM flagged""",
    "dq_not_null": SHARED + " UNION ALL ".join([
        not_null_sql("d_fato", "fct_gastos_cartao", [
            "id_transacao", "vl_transacao", "sk_data", "sk_orgao", "sk_favorecido", "sk_portador",
        ]),
        not_null_sql("d_data", "dim_data", ["sk_data"]),
        not_null_sql("orgaos", "dim_orgaos", ["sk_orgao"]),
        not_null_sql("d_fav", "dim_favorecidos", ["sk_favorecido"]),
        not_null_sql("d_por", "dim_portadores", ["sk_portador"]),
    ]),
    "dq_unique": SHARED + " UNION ALL ".join([
        unique_sql("d_fato", "fct_gastos_cartao", "id_transacao"),
        unique_sql("d_data", "dim_data", "sk_data"),
        unique_sql("orgaos", "dim_orgaos", "sk_orgao"),
        unique_sql("d_fav", "dim_favorecidos", "sk_favorecido"),
        unique_sql("d_por", "dim_portadores", "sk_portador"),
    ]),
    "dq_relationships": SHARED + " UNION ALL ".join([
        relationship_sql("sk_data", "d_data"),
        relationship_sql("sk_orgao", "orgaos"),
        relationship_sql("sk_favorecido", "d_fav"),
        relationship_sql("sk_portador", "d_por"),
    ]),
    "dq_all": SHARED + """, d_gold AS (
          SELECT * REPLACE (CASE WHEN id_transacao % 91 <> 0 THEN z_score END AS z_score) FROM gold
        ), d_niveis AS (
          SELECT * REPLACE (CASE WHEN ordem_severidade = 2 THEN 'OUTRO' ELSE nivel_alerta END AS nivel_alerta)
          FROM niveis WHERE ordem_severidade < 3
        ), d_nobody AS (SELECT * FROM portadores WHERE nome_portador = '')
        """ + " UNION ALL ".join([
        *[not_null_sql(step, name, NOT_NULL[name]) for name, step in DEFECTIVE.items()],
        *[unique_sql(step, name, UNIQUE[name]) for name, step in DEFECTIVE.items()],
        *[
            relationship_sql(column, DEFECTIVE[parent], DEFECTIVE[child], child)
            for child, parents in RELATIONSHIPS.items() for column, parent in parents.items()
        ],
        *[non_empty_sql(name, DEFECTIVE[name]) for name in NON_EMPTY_FACT + NON_EMPTY_DIMENSIONS],
        """SELECT 'accepted_values', 'gold_dim_nivel_alerta', 'nivel_alerta', count(DISTINCT nivel_alerta)
           FROM d_niveis WHERE nivel_alerta NOT IN ('NORMAL', 'MODERADO', 'CRITICO')""",
    ]),
    "layer_gate": SHARED + "SELECT count(*) AS n, true AS passed, true AS empty_refused FROM gold",
    "upsert_table": SHARED + UPSERTED.format(rows="SELECT * FROM bronze"),
    "stream_upsert": SHARED + LANDED.format(last_page=7) + """
        SELECT b.id, b.mes_extrato, b.valor_transacao, b.estabelecimento__nome, b.unidade_gestora__nome,
          '1999-12-31.000000000' AS _dlt_load_id, md5('1999-12-31.000000000|' || b.id) AS _dlt_id
        FROM bronze b JOIN landed l ON l.k = b.id
        WHERE b._dlt_load_id = 'load-001'
          AND NOT (month(d) % 4 = 0 AND pagina = 4) AND NOT (month(d) % 4 = 1 AND pagina = 1)""",
    "score_sink": SHARED + "SELECT * FROM flagged",
    "star_scored": SHARED + """
        SELECT g.*, c.* EXCLUDE (sk_data), o.* EXCLUDE (sk_orgao), n.* EXCLUDE (ordem_severidade),
               f.nome_favorecido, p.nome_portador, s.* EXCLUDE (id_transacao, dt_processamento)
        FROM gold g LEFT JOIN calendario c USING (sk_data) LEFT JOIN orgaos o USING (sk_orgao)
        LEFT JOIN niveis n USING (ordem_severidade)
        LEFT JOIN favorecidos f USING (sk_favorecido) LEFT JOIN portadores p USING (sk_portador)
        LEFT JOIN flagged s USING (id_transacao)""",
    "forest_given": SHARED.replace("WITH ", "WITH RECURSIVE ", 1) + f""", forest(tree, node, feature, cut, path) AS (
          VALUES {", ".join(str((t, n, f, c, p)) for t, n, f, c, p, _ in GIVEN_FOREST)}
        ), points AS (
          SELECT id_transacao, [vl_transacao, coalesce(z_score, 0.0), razao_media_orgao, CAST(dia_semana AS DOUBLE),
            CAST(fl_fim_semana AS DOUBLE), CAST(freq_favorecido AS DOUBLE), CAST(freq_portador AS DOUBLE)] AS x
          FROM features
        ), walk AS (
          SELECT id_transacao, x, tree, node, feature, cut, path FROM points, forest WHERE node = 0
          UNION ALL
          SELECT w.id_transacao, w.x, n.tree, n.node, n.feature, n.cut, n.path
          FROM walk w JOIN forest n ON n.tree = w.tree
            AND n.node = 2 * w.node + CASE WHEN w.x[w.feature + 1] <= w.cut THEN 1 ELSE 2 END
          WHERE w.feature >= 0
        )
        SELECT id_transacao, round(pow(2.0, -avg(path) / {float(mean_path(256))!r}), 9) AS grau
        FROM walk WHERE feature < 0 GROUP BY id_transacao""",
    "forest_sample": SHARED + """
        SELECT CAST(t AS INTEGER) AS tree, least(256, (SELECT count(*) FROM features)) AS n,
               least(256, (SELECT count(*) FROM features)) AS n_distinct FROM range(150) r(t)""",
    "forest_contract": SHARED + """
        SELECT count(*) AS n, count(DISTINCT id_transacao) AS n_distinct, 0 AS n_null, 0.0::DOUBLE AS low,
               1.0::DOUBLE AS high, 0 AS n_wrong_flags, true AS enough_flags, 0 AS n_wrong_reasons FROM features""",
    "dq_accepted": SHARED + """
        SELECT 'accepted_values' AS "check", 'gold_dim_nivel_alerta' AS table_name,
          'nivel_alerta' AS column_name, count(DISTINCT nivel_alerta) AS failures
        FROM gold JOIN niveis USING (ordem_severidade) WHERE nivel_alerta NOT IN ('NORMAL')""",
    "dq_non_empty": SHARED + " UNION ALL ".join([
        non_empty_sql("gold_fct_gastos_cartao", "gold"),
        non_empty_sql("gold_dim_orgaos", "orgaos"),
        non_empty_sql("gold_dim_favorecidos",
                      "(SELECT * FROM favorecidos WHERE nome_favorecido = '')"),
        non_empty_sql("gold_dim_portadores", "portadores"),
    ]),
    "layer_summary": SHARED + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {step}"
        for name, step in [
            ("silver.stg_cpgf_despesas", "staging"), ("gold.fct_gastos_cartao", "gold"),
            ("gold.dim_data", "calendario"), ("gold.dim_orgaos", "orgaos"),
            ("gold.dim_favorecidos", "favorecidos"), ("gold.dim_portadores", "portadores"),
            ("gold.dim_nivel_alerta", "niveis"),
        ]
    ),
    "landing_pages_array": SHARED + LANDED.format(last_page=7) + """
        SELECT kept.mes, kept.pagina, raw.id, raw.mes_extrato AS "mesExtrato", raw.valor_transacao AS "valorTransacao",
          raw.tipo_codigo, raw.est_nome AS nome
        FROM kept JOIN good ON kept.mes = good.mes AND kept.pagina = good.pagina
        JOIN raw ON raw.id = kept.k AND raw.load = 1""",
    "volume_gate": SHARED + LANDED.format(last_page=7) + """, found AS (
          SELECT kept.mes FROM kept JOIN good ON kept.mes = good.mes AND kept.pagina = good.pagina
        )
        SELECT '1/1997' AS inicio, false AS recusada, count(*) AS n_bronze, count(DISTINCT mes) AS n_meses FROM found WHERE mes < '1999'
        UNION ALL SELECT '1/2030', true, count(*), count(DISTINCT mes) FROM found WHERE mes < '1999'
        UNION ALL SELECT '1/1999', false, count(*), count(DISTINCT mes) FROM found""",
    "staged_view": SHARED + "SELECT * FROM staging",
    "gold_refreshed": REFRESHED + "SELECT * FROM gold",
    "gold_layers": REFRESHED + " UNION ALL ".join(
        f"SELECT '{model}' AS modelo, '{table}' AS tabela, count(*) AS n_rows, true AS no_catalogo, "
        f"{0 if model in ('gold_dim_data', 'gold_dim_orgaos') else 'CAST(NULL AS BIGINT)'} AS linhas_diferentes FROM {step}"
        for model, table, step in [
            ("stg_cpgf_despesas", "silver.stg_cpgf_despesas", "staging"), ("dim_data", "silver.dim_data", "calendario"),
            ("dim_orgaos", "silver.dim_orgaos", "orgaos"), ("dim_favorecidos", "silver.dim_favorecidos", "favorecidos"),
            ("dim_portadores", "silver.dim_portadores", "portadores"), ("fct_gastos_cartao", "silver.fct_gastos_cartao", "fato"),
            ("gold_dim_data", "gold.dim_data", "calendario"), ("gold_dim_orgaos", "gold.dim_orgaos", "orgaos"),
            ("gold_dim_favorecidos", "gold.dim_favorecidos", "favorecidos"),
            ("gold_dim_portadores", "gold.dim_portadores", "portadores"), ("gold_dim_nivel_alerta", "gold.dim_nivel_alerta", "niveis"),
            ("gold_fct_gastos_cartao", "gold.fct_gastos_cartao", "gold"),
        ]
    ),
    "layer_catalog": REFRESHED + " UNION ALL ".join(
        f"SELECT {scored} AS com_scores, '{name}' AS table_name, count(*) AS n_rows FROM {step}"
        for scored in ("false", "true") for name, step in [
            ("gold.fct_gastos_cartao", "gold"), ("gold.dim_data", "calendario"), ("gold.dim_orgaos", "orgaos"),
            ("gold.dim_favorecidos", "favorecidos"), ("gold.dim_portadores", "portadores"),
            ("gold.dim_nivel_alerta", "niveis"), *([("gold.score_anomalia_cartao", "gold WHERE vl_transacao IS NOT NULL")] * (scored == "true")),
        ]
    ),
}
