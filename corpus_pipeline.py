"""From raw documents to token records: five corpus operators, one after another.

Each stage reads what the one before has kept. All but the last return documents with their own
columns; the last writes the records and returns what they hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardwarden.llm.common import table
from cardwarden.llm.decontaminate import clean_documents
from cardwarden.llm.mixing import mixed_documents
from cardwarden.llm.quality import good_documents
from cardwarden.llm.queries import tokenizer
from cardwarden.llm.records import binary_output
from cardwarden.llm.simhash import one_of_each
from cardwarden.sources.scratch import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier samples."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return one_of_each(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the written records hold: doc_id, start, n_tokens, ids_crc32, one row a record."""
    found = binary_output(docs, tokenizer("word_bpe_49k.json"), end_id=1)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("records", records),
]

#: A classifier and a tokenizer are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each but the last written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
