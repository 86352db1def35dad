"""The built-in sample: invented records in raw shape, read without normalisation."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.sources.schemas import RAW_RECORD

FIRST_ID = 7_000_001
YEAR = 2026
#: Agencies by letter: code, and code of the unit that spends.
AGENCIES = {"A": ("11100", "11170"), "B": ("24200", "24260"), "C": ("37300", "37350"), "D": ("58400", "58440")}
#: (day, month, amount text, agency, supplier) of each transaction.
TRANSACTIONS = [
    (6, 1, "912,40", "A", "PAPELARIA"), (9, 1, "41.005,00", "B", "OFICINA"),
    (17, 1, "77,05", "C", "CAFE"), (23, 1, "2.048,00", "D", "GRAFICA"),
    (3, 2, "1.003,99", "A", "CAFE"), (11, 2, "16.384,25", "C", "TRANSPORTE"),
    (14, 2, "640,00", "B", "PAPELARIA"), (25, 2, "333,33", "A", "GRAFICA"),
    (4, 3, "5.120,10", "B", "OFICINA"), (8, 3, "90,00", "C", "CAFE"),
    (19, 3, "27.500,75", "A", "TRANSPORTE"), (31, 3, "1.111,11", "C", "LIVRARIA"),
    (7, 4, "808,08", "B", "LIVRARIA"), (12, 4, "450,00", "A", "CAFE"),
    (2, 5, "3.600,60", "C", "OFICINA"), (21, 5, "7.250,00", "B", "GRAFICA"),
    (13, 6, "120,90", "A", "CAFE"), (28, 6, "9.999,99", "C", "TRANSPORTE"),
    (10, 7, "2.345,67", "A", "PAPELARIA"), (26, 7, "15.750,00", "B", "TRANSPORTE"),
    (5, 8, "68,50", "C", "CAFE"), (29, 8, "6.006,00", "A", "OFICINA"),
]


def sample_json() -> list[str]:
    """The sample as JSON texts; people, firms and agencies carry placeholder names."""
    suppliers = sorted({t[4] for t in TRANSACTIONS})
    texts = []
    for number, (day, month, amount, letter, supplier) in enumerate(TRANSACTIONS):
        agency, unit = AGENCIES[letter]
        owner = {"codigo": agency, "nome": f"ORGAO {letter}"}
        texts.append(json.dumps({
            "id": FIRST_ID + number,
            "mesExtrato": f"{YEAR}{month:02d}",
            "dataTransacao": f"{day:02d}/{month:02d}/{YEAR}",
            "valorTransacao": amount,
            "tipoCartao": {"codigo": 1, "descricao": "Cartao de teste"},
            "estabelecimento": {"nome": supplier, "cgc": f"{suppliers.index(supplier):02d}.***.***/0001-00"},
            "portador": {"nome": f"PORTADOR {letter}", "cpf": f"***.{unit[:3]}.000-**"},
            "unidadeGestora": {"codigo": unit, "nome": f"UNIDADE {letter}"},
            "orgaoVinculado": owner,
            "orgaoSuperior": owner,
        }))
    return texts


def read_sample(spark: SparkSession) -> DataFrame:
    """The sample as raw records, parsed with the same schema as landed pages."""
    texts = spark.createDataFrame([(t,) for t in sample_json()], "texto STRING")
    return texts.select(F.from_json("texto", RAW_RECORD).alias("r")).select("r.*")
