"""Explicit schemas; nothing is ever inferred from the data."""

from __future__ import annotations

RAW_RECORD = """
    id BIGINT,
    mesExtrato STRING,
    dataTransacao STRING,
    valorTransacao STRING,
    tipoCartao STRUCT<id: BIGINT, codigo: STRING, descricao: STRING>,
    estabelecimento STRUCT<
        id: BIGINT, nome: STRING, razaoSocialReceita: STRING, nomeFantasiaReceita: STRING,
        cnpjFormatado: STRING, cpfFormatado: STRING, cgc: STRING, tipo: STRING,
        numeroInscricaoSocial: STRING>,
    portador STRUCT<nome: STRING, cpf: STRING, cpfFormatado: STRING, nis: STRING>,
    unidadeGestora STRUCT<
        codigo: STRING, nome: STRING, descricaoPoder: STRING,
        orgaoVinculado: STRUCT<
            codigoSIAFI: STRING, codigo: STRING, cnpj: STRING, sigla: STRING, nome: STRING>,
        orgaoMaximo: STRUCT<codigo: STRING, sigla: STRING, nome: STRING>>,
    orgaoVinculado STRUCT<
        codigoSIAFI: STRING, codigo: STRING, cnpj: STRING, sigla: STRING, nome: STRING>,
    orgaoSuperior STRUCT<codigo: STRING, sigla: STRING, nome: STRING>
"""

LANDING_PARTITIONS = "mes STRING, pagina INT"

SCORES = """
    id_transacao BIGINT NOT NULL,
    anomaly_score DOUBLE NOT NULL,
    is_anomaly_p95 INT NOT NULL,
    is_anomaly_p99 INT NOT NULL,
    motivo_anomalia STRING NOT NULL,
    dt_processamento TIMESTAMP NOT NULL,
    model_version STRING NOT NULL
"""
