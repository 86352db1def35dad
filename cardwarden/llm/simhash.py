"""SimHash near-duplicates, linked by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwarden.llm.common import byte_words, texts_of, unpacked_rows, whole_row
from cardwarden.llm.components import components
from cardwarden.sources.scratch import materialize

BITS = 64
SEED = 42
BLOCK = 1 << 16


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, repeats included; shorter texts are one run."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        runs, n = [b" ".join(words)], 1
    else:
        runs, n = map(b" ".join, zip(*(words[i:] for i in range(size)))), len(words) - size + 1
    return np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), np.uint64, n)


def simhash(hashes: np.ndarray) -> int:
    """Bits set in over half the hashes; 0 without hashes."""
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), BLOCK):
        block = hashes[start:start + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp, text_hash): the signed 64-bit fingerprint of each whole text; NULL is empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def prints(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [simhash(shingle_hashes(byte_words(t), shingle)) for t in texts_of(frame, "text")]
            yield pd.DataFrame({"id": frame["id"], "fp": np.array(found, np.int64), "text_hash": frame["text_hash"]})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_hash"))
    return rows.mapInPandas(prints, f"id {kind}, fp bigint, text_hash bigint")


def ball_masks(radius: int) -> list[int]:
    """Signed XOR masks of all changes of at most ``radius`` bits."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(BITS), r)]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]


def fingerprint_links(distinct: DataFrame, max_bits: int, fp: str = "fp") -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``max_bits`` of each other.

    Every fingerprint emits all variants within half the radius. Two fingerprints within the
    radius meet at a variant; at one variant at most all fingerprints of its ball meet (65 for
    radius 2), so no key is hot. The fingerprints at a variant are linked to the smallest near
    one there instead of pair by pair, which connects the same fingerprints: for an odd radius
    a near one lies within the smaller half, so that it is close enough to all others.
    """
    far, near = (max_bits + 1) // 2, max_bits // 2
    inner = len(ball_masks(near))
    masks = F.array(*[F.lit(m).cast("bigint") for m in ball_masks(far)])
    at = W.partitionBy("variant")
    met = (
        distinct.select(fp, F.posexplode(masks).alias("_n", "_mask"))
        .select(F.col(fp).alias("a"), F.col(fp).bitwiseXOR(F.col("_mask")).alias("variant"),
                (F.col("_n") < inner).alias("_near"))
        .select("a", F.min(F.when(F.col("_near"), F.col("a"))).over(at).alias("b"))
    )
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return met.where((F.col("a") != F.col("b")) & (apart <= max_bits)).distinct()


def grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """(id, fp, text_hash, root) for each row; rows that can reach each other share a root."""
    prints = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = materialize(prints.select("fp").distinct(), "distinct")
    roots = components(fingerprint_links(distinct, max_bits))
    joined = prints.join(roots, prints["fp"] == roots["node"], "left")
    return joined.select("id", "fp", "text_hash", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """One row (id, ``fingerprint``, ``component_id``) for each row of ``docs``.

    Rows link where their fingerprints differ in at most ``max_bits`` bits; the component id is
    the smallest id that can be reached over links, the row's own included. NULL and empty texts
    have fingerprint zero and link like any other. Rows with a NULL id are returned and link too;
    their id stands for nothing, so the component id is NULL only if all rows of it have none.
    Repeated rows are each returned. An empty table gives no rows. Other columns are ignored.

    Copies share a fingerprint and are reduced to one before linking. What the links are made
    of grows with distinct fingerprints only.
    """
    rows = materialize(grouped(docs, id_col, text_col, shingle, max_bits), "grouped")
    least = rows.groupBy("root").agg(F.min("id").alias("component_id"))
    return rows.join(materialize(least, "least"), "root").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """One document of each group of near-duplicates, with its own columns.

    It is the one with the smallest id (NULL last, ties by a hash of the text). Of repeated rows
    one stays.
    """
    rows = materialize(grouped(docs, id_col, text_col, shingle, max_bits), "grouped")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first")
    chosen = rows.groupBy("root").agg(first).select("first.id", "first.text_hash")
    times = rows.groupBy("id", "text_hash").agg(F.count("*").alias("n"))
    keys = ["id", "text_hash"]
    pick = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    chosen = chosen.alias("c").join(times.alias("t"), pick("c", "t")).select("c.*", "t.n")
    chosen = materialize(chosen, "chosen").alias("c")
    keyed = docs.select(whole_row(docs), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash")).alias("d")
    kept = keyed.join(chosen, pick("d", "c")).select("d.*", "c.n")
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(F.lit(1)))
    repeated = kept.where("n > 1").withColumn("nth", nth).where("nth = 1").select("row")
    return unpacked_rows(kept.where("n = 1").select("row").unionByName(repeated), docs)
