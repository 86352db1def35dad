"""Small helpers that several corpus operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a generation of a worker's cache, which keeps two; only speed depends on it.
CACHE_WORDS = 250_000
#: Longer words are worked out each time and never cached.
CACHE_WORD_BYTES = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_words(text: str | None, lower: bool = True) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; NULL is empty. ``lower`` touches A-Z only."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def texts_of(frame: pd.DataFrame, column: str) -> list[str]:
    """Texts of a batch; NULL is empty."""
    return [t if isinstance(t, str) else "" for t in frame[column]]


def parts_of(texts, rows: int = 256) -> Iterator:
    """A batch of texts in small parts, where work on a text takes several times its size."""
    for start in range(0, len(texts), rows):
        yield texts[start:start + rows]


class WordCache(dict):
    """Values of words, each worked out at its first use; bounded, and kept by the process.

    Once it is full, it becomes the old generation, from which words in use are taken over.
    """

    def __init__(self, value: callable, words: int | None = None):
        super().__init__()
        self.value, self.words, self.old = value, words, {}

    def __missing__(self, word):
        found = self.old.get(word)
        if found is None:
            found = self.value(word)
        if len(word) <= CACHE_WORD_BYTES:
            self.put(word, found)
        return found

    def put(self, word, found) -> None:
        if len(self) >= (self.words or CACHE_WORDS):
            self.old = dict(self)
            self.clear()
        self[word] = found

    def known(self, word) -> bool:
        return word in self or word in self.old


_kept: dict[str, tuple] = {}


def kept(name: str, key, make: callable):
    """The one model or cache that this process keeps between tasks, a new one if name or key has changed.

    A worker serves one operator after another; only the present one's words stay in memory.
    """
    if name not in _kept or _kept[name][0] != key:
        _kept.clear()
        _kept[name] = key, make()
    return _kept[name][1]


def kept_cache(name: str, key, value: callable) -> WordCache:
    return kept(name, key, lambda: WordCache(value))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers that spreads every bit over all (SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shuffle_shards(spark: SparkSession) -> int:
    """Shards of a keyed exchange: the session's own measure for its input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def cut_by_shard(shard: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    """(number, place) of every shard with rows; ``shard`` is sorted."""
    ends = np.searchsorted(shard, np.arange(shards + 1))
    for number in np.flatnonzero(ends[1:] > ends[:-1]):
        yield int(number), slice(int(ends[number]), int(ends[number + 1]))


def file_system(uri: str):
    """(file system, path) of a shared folder, for files that are not Spark tables."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), os.path.abspath(uri)
    return fs.FileSystem.from_uri(uri)


def whole_row(docs: DataFrame):
    """All columns as one struct ``row``, which no other column's name can clash with."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def unpacked_rows(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, from ``row``."""
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
