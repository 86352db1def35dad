"""Quality classifier by importance resampling: hashed n-gram models, Gumbel top-k."""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import CACHE_WORD_BYTES, byte_words, kept_cache, parts_of, texts_of, unpacked_rows, whole_row
from cardwarden.llm.selection import literal, prefix_end
from cardwarden.sources.scratch import materialize


@dataclass(frozen=True)
class QualitySpec:
    """Parameters. ``labelled`` bounds the labelled rows used, three quarters to fit and the rest to
    find the threshold; ``buckets`` bounds the models."""

    labelled: int = 20_000
    buckets: int = 1 << 18
    grams: tuple[int, ...] = (4, 6, 8)
    prior: float = 1.5
    segment: int = 16
    worst_share: float = 0.01
    worst_words: int = 2
    temperature: float = 0.05
    seed: int = 11


def word_hashes(word: bytes, sizes: tuple[int, ...]) -> bytes:
    """Hashes (uint32) of a word: the word itself and its byte n-grams, ends marked."""
    marked = b"\x02" + word + b"\x03"
    grams = [b"\x01" + word]
    for n in sizes:
        grams += [marked[i:i + n] for i in range(max(1, len(marked) - n + 1))]
    return array("I", map(zlib.crc32, grams)).tobytes()


def joined_buckets(hashes: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of many words one after another, and how many each word has."""
    joined = np.frombuffer(b"".join(hashes), np.uint32) & np.uint32(buckets - 1)
    return joined, np.fromiter(map(len, hashes), np.int64, len(hashes)) // 4


def bucket_counts(texts: list[str], cache: dict, buckets: int) -> np.ndarray:
    seen = Counter()
    for text in texts:
        seen.update(byte_words(text))
    if not seen:
        return np.zeros(buckets)
    ids, sizes = joined_buckets(list(map(cache.__getitem__, seen)), buckets)
    return np.bincount(ids, np.repeat(np.fromiter(seen.values(), float, len(seen)), sizes), buckets)


def labelled_sample(labels: DataFrame, spec: QualitySpec) -> DataFrame:
    """(_label_id, _good, _fit), at most ``spec.labelled`` rows: those of the smallest hashes.

    Good is quality 1 and not toxic, in every label row of the document; rows with NULL in a
    label or the id count as unlabelled.
    """
    each = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg(
        F.min(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")).alias("_good")
    )
    hashed = each.withColumn("_h", F.xxhash64("doc_id", F.lit(spec.seed)))
    chosen = hashed.orderBy("_h", "doc_id").limit(spec.labelled)
    return chosen.select(F.col("doc_id").alias("_label_id"), "_good", (F.col("_h") % 4 != 0).alias("_fit"))


def ngram_models(docs: DataFrame, sample: DataFrame, spec: QualitySpec, id_col: str, text_col: str):
    """Counts of every bucket: in all documents, and in the good ones of the fitting part."""
    good = F.coalesce((F.col("_good") == 1) & F.col("_fit"), F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(sample), F.col("id") == F.col("_label_id"), "left").select(
        "text", good.alias("target")
    )
    parts = 16

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = kept_cache("hashes", spec.grams, lambda w: word_hashes(w, spec.grams))
        total = np.zeros((2, spec.buckets))
        for frame in frames:
            texts, target = texts_of(frame, "text"), frame["target"].to_numpy(bool)
            total[0] += bucket_counts(texts, cache, spec.buckets)
            total[1] += bucket_counts([t for t, g in zip(texts, target, strict=True) if g], cache, spec.buckets)
        pieces = total.reshape(2, parts, -1)
        yield pd.DataFrame({
            "part": np.arange(parts, dtype=np.int32),
            "counts": [zlib.compress(pieces[:, i].astype("<u8").tobytes(), 1) for i in range(parts)],
        })

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), "<u8").astype(np.int64) for c in group["counts"])
        return pd.DataFrame({"part": [key[0]], "counts": [total.astype("<i8").tobytes()]})

    schema = "part int, counts binary"
    summed = rows.mapInPandas(count, schema).groupBy("part").applyInPandas(add, schema).collect()  # by buckets
    if not summed:
        return np.zeros((2, spec.buckets))
    pieces = [np.frombuffer(r.counts, "<i8").reshape(2, -1) for r in sorted(summed, key=lambda r: r.part)]
    return np.concatenate(pieces, axis=1).astype(float)


def log_ratios(raw: np.ndarray, target: np.ndarray, prior: float) -> np.ndarray:
    """Log of target over raw probability of each bucket, ``prior`` occurrences added to both.

    The raw model is scaled to the size of the target sample, so that what is too rare to be
    expected there counts for nothing.
    """
    expected = raw * (target.sum() / max(raw.sum(), 1.0))
    return np.log((target + prior) / (expected + prior))


def weigher(spark, ratios: np.ndarray, spec: QualitySpec):
    """Pandas UDF: log importance weight of a text, by its worst parts.

    A word's log ratio is the sum over its buckets. The weight is the mean over the text's worst
    words (``worst_words`` and ``worst_share`` of all), wherever they stand, plus the mean over
    its worst segment of consecutive words; segments overlap by half.
    """
    shared = spark.sparkContext.broadcast(ratios)  # spec.buckets numbers
    half = max(1, spec.segment // 2)
    key = (spec.grams, zlib.crc32(ratios.tobytes()))

    @F.pandas_udf("double")
    def weight(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = shared.value

        def sums(words: list[bytes]) -> list[float]:
            ids, sizes = joined_buckets([word_hashes(w, spec.grams) for w in words], spec.buckets)
            return np.add.reduceat(table[ids], np.cumsum(sizes) - sizes).tolist()

        cache = kept_cache("ratios", key, lambda w: sums([w])[0])

        def learn(words: set[bytes]) -> None:
            new = [w for w in words.difference(cache).difference(cache.old) if len(w) <= CACHE_WORD_BYTES]
            for word, ratio in zip(new, sums(new) if new else (), strict=True):
                cache.put(word, ratio)

        def worst(words: list[bytes]) -> float:
            n = len(words)
            if not n:
                return 0.0
            each = np.fromiter(map(cache.__getitem__, words), float, n)
            at = np.arange(0, n, half)
            parts, sizes = np.add.reduceat(each, at), np.diff(np.append(at, n))
            if len(parts) > 1:
                parts, sizes = parts[1:] + parts[:-1], sizes[1:] + sizes[:-1]
            k = min(n, spec.worst_words + int(n * spec.worst_share))
            return float(np.partition(each, k - 1)[:k].mean() + (parts / sizes).min())

        for batch in batches:
            found = []
            for part in parts_of(batch):
                texts = [byte_words(t if isinstance(t, str) else "") for t in part]
                learn(set().union(*texts))
                found += [worst(t) for t in texts]
            yield pd.Series(found, dtype=float)

    return weight


def best_threshold(weights: np.ndarray, good: np.ndarray) -> float:
    """Middle of the gap that separates good from other rows best (balanced accuracy)."""
    if not len(weights) or good.all() or not good.any():
        return -np.inf if not len(weights) or good.all() else np.inf
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    kept_good = 1 - np.concatenate([[0], np.cumsum(g)]) / g.sum()
    cut_bad = np.concatenate([[0], np.cumsum(~g)]) / (~g).sum()
    edges = np.concatenate([[True], w[1:] > w[:-1], [True]])
    value = np.where(edges, kept_good + cut_bad, -1)
    places = np.flatnonzero(value == value.max())
    i = int(places[len(places) // 2])
    if i == 0:
        return float(w[0])
    return float(w[-1]) + 1e-9 if i == len(w) else float(w[i - 1] + w[i]) / 2


def resampled(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    spec: QualitySpec = QualitySpec(), whole: bool = False,
) -> DataFrame:
    """(id, weight, key, kept) for each row of ``docs``, and if ``whole`` its columns in ``row``.

    Generative models over hashed n-grams (a word and its byte n-grams) of the labelled good
    documents and of all raw ones give each document its log importance weight, target over raw.
    A document weighs as much as its worst parts, so that a bad passage is not made up for by
    length. As many documents are sampled as weigh at least the threshold that separates the
    held back part of the labelled sample best: those with the largest sum of weight over
    temperature and Gumbel noise (a hash of the id), which is sampling without replacement in
    proportion to the weights.

    NULL and empty texts weigh 1 (log 0). Without labels, or without any that are not good, all
    rows are kept; without good ones none is. Repeated rows weigh the same; ties at the end of
    the sample go to smaller ids, NULL first, and rows equal in weight and id are kept or
    rejected together. An empty table gives no rows.
    """
    spark = docs.sparkSession
    sample = materialize(labelled_sample(labels, spec), "labelled")
    raw, target = ngram_models(docs, sample, spec, id_col, text_col)
    weight = weigher(spark, log_ratios(raw, target, spec.prior), spec)
    own = [F.col(id_col).alias("id"), weight(F.col(text_col)).alias("weight")]
    weighed = materialize(docs.select(*own, *([whole_row(docs)] if whole else [])), "weighed")
    held = F.broadcast(sample.where("not _fit"))
    checked = weighed.join(held, F.col("id") == F.col("_label_id")).groupBy("id").agg(
        F.min("weight").alias("w"), F.min("_good").alias("g")
    ).toPandas()  # at most spec.labelled rows
    cut = best_threshold(checked["w"].to_numpy(float), checked["g"].to_numpy() == 1)
    if np.isinf(cut):
        return weighed.withColumns({"key": F.col("weight"), "kept": F.lit(bool(cut < 0))})
    uniform = (F.xxhash64("id", F.lit(spec.seed + 1)).cast("double") + F.lit(2.0**63 + 1)) / F.lit(2.0**64 + 4096)
    gumbel = -F.log(-F.log(uniform))
    keyed = weighed.withColumn("key", (F.col("weight") - F.lit(cut)) / F.lit(spec.temperature) + gumbel)
    order = F.struct((-F.col("key")).alias("at"), F.col("id").alias("id"))
    wanted = weighed.where(F.col("weight") >= F.lit(cut)).count()
    items = keyed.select(order.alias("key"), F.lit(1).alias("size"))
    end = prefix_end(items, wanted) if wanted else None
    kept = F.lit(False) if end is None else order <= literal(end, items.schema["key"].dataType)
    return keyed.withColumn("kept", kept)


def quality_keys(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(id, ``log_weight``, ``sample_key``, ``kept``), one row for each row of ``docs``."""
    found = resampled(docs, labels, id_col, **options)
    return found.select(
        F.col("id").alias(id_col), F.col("weight").alias("log_weight"), F.col("key").alias("sample_key"), "kept"
    )


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents of the sample, with their own columns."""
    return unpacked_rows(resampled(docs, labels, whole=True, **options).where("kept"), docs)
