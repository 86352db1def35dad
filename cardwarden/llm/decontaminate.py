"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact check."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.common import byte_words, mix64
from cardwarden.llm.simhash import BITS, shingle_hashes, simhash

SHINGLE = 5
MIN_SIMILARITY = 0.8
#: Fingerprints are compared up to this distance. At similarity 0.8 about 10 of 64 bits differ.
RADIUS = 22
BLOCKS = 8
#: Benchmark text that goes to the executors at once; a larger benchmark is searched in blocks.
ITEM_BYTES = 4_000_000
MATCH = "array<struct<item:int,similarity:double,first_word:bigint,n_words:bigint,distance:int>>"


def shingles(words: Sequence[bytes], size: int = SHINGLE) -> Counter:
    """Weight of every run of ``size`` words: how often it occurs; shorter texts are one run."""
    if not words:
        return Counter()
    if len(words) < size:
        return Counter([b" ".join(words)])
    return Counter(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: common weight over all weight."""
    common = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - common
    return common / total if total else 0.0


@dataclass
class SizeClass:
    """Items of the same number of words, and the blocks by which near fingerprints are found."""

    items: list[int]
    prints: np.ndarray
    near: np.ndarray  # [block, value, item]: within the block's share of the radius


def size_class(items: list[int], prints: list[int], radius: int) -> SizeClass:
    """If two fingerprints differ in at most r bits, one of m blocks differs in at most r // m."""
    fps = np.array(prints, np.int64).view(np.uint64)
    width = BITS // BLOCKS
    value = np.arange(1 << width, dtype=np.uint64)
    near = np.empty((BLOCKS, 1 << width, len(items)), bool)
    for b in range(BLOCKS):
        own = (fps >> np.uint64(b * width)) & np.uint64((1 << width) - 1)
        near[b] = np.bitwise_count(value[:, None] ^ own[None, :]) <= radius // BLOCKS
    return SizeClass(items, fps, near)


class Benchmark:
    """Items prepared for the search in one text after another."""

    def __init__(self, texts: Sequence[str | None], shingle: int, minimum: float, radius: int):
        self.shingle, self.minimum, self.radius = shingle, minimum, radius
        words = [byte_words(t) for t in texts]
        self.weights = [shingles(w, shingle) for w in words]
        self.vocabulary = {w: i + 1 for i, w in enumerate(dict.fromkeys(x for ws in words for x in ws))}
        by_size: dict[int, list[int]] = {}
        for i, ws in enumerate(words):
            if ws:
                by_size.setdefault(len(ws), []).append(i)
        self.sizes = {
            n: size_class(items, [simhash(shingle_hashes(words[i], shingle)) for i in items], radius)
            for n, items in by_size.items()
        }
        # shingles of the items by their length in words: sorted keys and the window sizes they call for
        found: dict[int, dict[int, set[int]]] = {}
        for ws in words:
            k = min(shingle, len(ws))
            if k:
                ids = np.array([self.vocabulary[w] for w in ws], np.uint64)
                for key in self._keys(ids, k).tolist():
                    found.setdefault(k, {}).setdefault(key, set()).add(len(ws))
        self.calls = {}
        for k, keys in found.items():
            ordered = np.array(sorted(keys), np.uint64)
            self.calls[k] = ordered, [keys[int(x)] for x in ordered]

    @staticmethod
    def _keys(ids: np.ndarray, k: int) -> np.ndarray:
        """A number for each run of k words; only a filter, so collisions do no harm."""
        n = len(ids) - k + 1
        key = np.zeros(max(n, 0), np.uint64)
        for i in range(k if n > 0 else 0):
            key = mix64(key * np.uint64(31) + ids[i:i + n])
        return key

    def windows(self, words: list[bytes]) -> dict[int, np.ndarray]:
        """By item size, the starts of windows that hold a shingle of an item of that size.

        A window without any shingle of the item has similarity 0 to it. A text with fewer words
        than the item is one window.
        """
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.uint64, len(words))
        known = ids > 0
        marks: dict[int, np.ndarray] = {}
        for k, (keys, sizes) in self.calls.items():
            if len(ids) < k:
                continue
            run = known[: len(ids) - k + 1].copy()
            for i in range(1, k):
                run &= known[i:len(ids) - k + 1 + i]
            at = np.flatnonzero(run)
            if not len(at):
                continue
            key = np.zeros(len(at), np.uint64)
            for i in range(k):
                key = mix64(key * np.uint64(31) + ids[at + i])
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            for p, j in zip(at[keys[place] == key].tolist(), place[keys[place] == key].tolist(), strict=True):
                for n in sizes[j]:
                    last = max(0, len(words) - n)
                    mark = marks.setdefault(n, np.zeros(last + 2, np.int32))
                    mark[max(0, p + k - n)] += 1
                    mark[min(p, last) + 1] -= 1
        return {n: np.flatnonzero(np.cumsum(m[:-1]) > 0) for n, m in marks.items()}

    def search(self, text: str | None) -> list[tuple]:
        """Best window of every item that the text holds: (item, similarity, start, words, distance)."""
        words = byte_words(text)
        best: dict[int, tuple] = {}
        for size, starts in self.windows(words).items():
            group, n = self.sizes[size], min(size, len(words))
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                first, last = int(run[0]), int(run[-1])
                prints = window_prints(words[first:last + n], n, self.shingle)
                window, which = near_items(prints, group, self.radius)
                for w, j in zip(window.tolist(), which.tolist(), strict=True):
                    item, start = group.items[j], first + w
                    own = shingles(words[start:start + n], self.shingle)
                    similarity = weighted_similarity(own, self.weights[item])
                    if similarity >= self.minimum and similarity > best.get(item, (0, 0.0))[1]:
                        distance = int(np.bitwise_count(prints[w] ^ group.prints[j]))
                        best[item] = (item, similarity, start, n, distance)
        return [best[i] for i in sorted(best)]


def window_prints(words: list[bytes], n: int, shingle: int) -> np.ndarray:
    """SimHash of every window of n words, from running sums of the shingles' bits."""
    k = min(shingle, n)
    hashes = shingle_hashes(words, k)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, BITS), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    size = n - k + 1
    ones = sums[size:] - sums[:-size]
    return np.packbits(2 * ones > size, axis=1, bitorder="little").view("<u8").ravel()


def near_items(prints: np.ndarray, group: SizeClass, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, item) of all fingerprints within the radius; candidates share a near block."""
    width = np.uint64(BITS // BLOCKS)
    mask = np.uint64((1 << int(width)) - 1)
    candidates = np.zeros((len(prints), len(group.items)), bool)
    for b in range(BLOCKS):
        candidates |= group.near[b][((prints >> (np.uint64(b) * width)) & mask).astype(np.int64)]
    window, item = np.nonzero(candidates)
    close = np.bitwise_count(prints[window] ^ group.prints[item]) <= radius
    return window[close], item[close]


def searcher(spark: SparkSession, texts: list[str | None], shingle: int, minimum: float, radius: int):
    shared = spark.sparkContext.broadcast(texts)  # ITEM_BYTES at most

    @F.pandas_udf(MATCH)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        benchmark = Benchmark(shared.value, shingle, minimum, radius)
        names = ["item", "similarity", "first_word", "n_words", "distance"]
        for batch in batches:
            yield pd.Series([
                [dict(zip(names, m, strict=True)) for m in benchmark.search(t if isinstance(t, str) else "")]
                for t in batch
            ])

    return search


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int = ITEM_BYTES) -> Iterator[list]:
    """(item, text) rows in blocks of about ``limit`` bytes, one block at a time on the driver."""
    rows = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-2 * total // limit) if total > limit else 1
    for block in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else rows
        yield own.orderBy("item", "text").collect()


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", shingle: int = SHINGLE,
    minimum: float = MIN_SIMILARITY, radius: int = RADIUS,
) -> DataFrame:
    """One row for each item that a document holds: its best window.

    (id, item, ``similarity``, ``first_word``, ``n_words``, ``distance``). A document holds an item
    if one of its windows of the item's number of words (the whole document if it has fewer) has a
    SimHash within ``radius`` of the item's and a weighted similarity of at least ``minimum`` over
    runs of ``shingle`` words (an item or document of fewer words is one run). Words are those
    between ASCII white space, A-Z in lower case. Of equal windows the first is given.

    All windows that share a shingle with an item of their size are looked at, in whole texts. NULL
    and empty texts hold nothing, and NULL or empty items are held by none. Rows with NULL ids
    and repeated rows are searched each; equal items give a row each; empty tables give none.
    """
    found = None
    kind = benchmark.schema[item_col].dataType
    for rows in item_blocks(benchmark, item_col, item_text_col):
        search = searcher(docs.sparkSession, [r.text for r in rows], shingle, minimum, radius)
        names = F.array(*[F.lit(r.item).cast(kind) for r in rows]) if rows else F.array().cast(f"array<{kind.simpleString()}>")
        each = docs.select(F.col(id_col).alias("_id"), F.explode(search(F.col(text_col))).alias("m")).select(
            F.col("_id").alias(id_col), F.get(names, F.col("m.item")).alias(item_col),
            "m.similarity", "m.first_word", "m.n_words", "m.distance",
        )
        found = each if found is None else found.unionByName(each)
    return found


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", shingle: int = SHINGLE, minimum: float = MIN_SIMILARITY, radius: int = RADIUS,
) -> DataFrame:
    """The documents that hold no item of the benchmark, decided row by row."""
    clean: Column | None = None
    for rows in item_blocks(benchmark, item_col, item_text_col):
        search = searcher(docs.sparkSession, [r.text for r in rows], shingle, minimum, radius)
        here = F.size(search(F.col(text_col))) == 0
        clean = here if clean is None else clean & here
    return docs.where(clean)
