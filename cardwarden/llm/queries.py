"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.common import table
from cardwarden.llm.decontaminate import benchmark_matches
from cardwarden.llm.licenses import BASE, license_scan
from cardwarden.llm.lm import language_scores
from cardwarden.llm.mixing import mix
from cardwarden.llm.neighbours import nearest
from cardwarden.llm.ngram_join import jaccard_components
from cardwarden.llm.oracles import NGRAM_JOIN, PREFIX_TRIE, REPAIR
from cardwarden.llm.prefix_trie import prefix_trie, rebuilt_keys
from cardwarden.llm.quality import quality_keys
from cardwarden.llm.records import binary_output
from cardwarden.llm.repair import damaged_and_repaired
from cardwarden.llm.simhash import near_duplicates
from cardwarden.llm.suffixes import repeated_bytes
from cardwarden.llm.tokens import token_counts


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_keys(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    base_names = F.array(*[F.lit(label) for label, _ in BASE])
    base = F.filter("matches", lambda m: (m["edits"] == 0) & F.array_contains(base_names, m["label"]))
    starts = F.transform("base", lambda m: m["first_word"])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda m: m["label"]))), ",")
    return found.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined("base").alias("base_labels"), joined("matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
    )


def op8_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = binary_output(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op10_language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return language_scores(table(spark, sf_dir, "documents"), held_out)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt_keys(table(spark, sf_dir, "conversations")))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), shingle=4, percent=85)


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_and_repaired(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_repeated_bytes": op1_repeated_bytes,
    "op2_neighbours": op2_neighbours,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_mixing": op5_mixing,
    "op6_token_counts": op6_token_counts,
    "op7_license_scan": op7_license_scan,
    "op8_binary_output": op8_binary_output,
    "op9_simhash": op9_simhash,
    "op10_language_scores": op10_language_scores,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_ngram_join": op12_ngram_join,
    "op13_repair": op13_repair,
}

# fixed values: weights in turn, share of the budget, repeats and seed are those of mixing.py
ORACLES = {
    "op5_mixing": """
WITH rows_ AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(concat(coalesce(CAST(doc_id AS VARCHAR), 'null'), ':7')) AS ord
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size) AS DOUBLE) * 2 AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w
  FROM rows_ GROUP BY source
), filled AS (
  SELECT *, sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws
  FROM per
), targets AS (
  SELECT source, source_size, least(cap, max(rest / ws) OVER () * w) AS target FROM filled
), queued AS (
  SELECT r.*, t.source_size, t.target,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY r.ord, r.doc_id ROWS UNBOUNDED PRECEDING) AS cum
  FROM rows_ r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT q.*, k, CAST(cum + k * source_size AS DOUBLE) / target AS finish
  FROM queued q CROSS JOIN (VALUES (0), (1)) c(k) WHERE size > 0 AND target > 0
), summed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS FIRST, k, ord, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM copies
), taken AS (
  SELECT doc_id, ord, sum(size) AS taken FROM summed
  WHERE upto <= (SELECT floor(1.5::DOUBLE * sum(size)) FROM rows_) GROUP BY doc_id, ord
)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN taken t ON t.doc_id = q.doc_id
""",
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_ngram_join": NGRAM_JOIN,
    "op13_repair": REPAIR,
}
