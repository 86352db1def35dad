"""Removal of repeated byte strings, by buckets of q-grams refined through later offsets.

Every position of a text starts a suffix; two suffixes repeat ``LENGTH`` bytes if they share a
bucket of that depth. Buckets are named by hashes: the bucket of 8 bytes at a position is refined
by pairing it with the bucket at the position 8 further on, which names 16 bytes, and so on to
32, 64 and ``LENGTH``; each level reuses the names of the one before (bucket-pointer refinement).

Sorting all suffixes would move many times the input. Every window of LENGTH bytes therefore
stands in the bucket of one of its q-grams, the leftmost smallest by hash, which equal windows
choose alike: consecutive windows with the same choice form a run. Only runs are shuffled, by
bucket; a bucket is refined by what surrounds the q-gram in each run, and the windows of a run are
told apart one by one only where a bucket holds different surroundings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import cut_by_shard, mix64, shuffle_shards
from cardwarden.sources.scratch import materialize

LENGTH = 100
GRAM = 32
CHOICES = LENGTH - GRAM + 1
#: Text of a chunk, the unit of work; a longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20
#: Positions looked at together.
BLOCK = 1 << 18
LOW = np.uint64(0xFFFFFFFF)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
DUPLICATE, REFINE = 1, 2
CHUNK = "chunk bigint, ids binary, known binary, sizes binary, text binary"
ASKED = "shard int, chunk bigint, entries binary"
ANSWER = "chunk bigint, shard int, flags binary"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Name of the bucket of a longer string, from those of its two parts."""
    return mix64(a * FACTOR + b)


def names_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of GRAM bytes and of LENGTH bytes at every position of a block that has so many."""
    n = len(data) - 7
    wide = np.empty(n, np.uint64)
    raw = data.tobytes()
    for k in range(min(8, n)):
        part = np.frombuffer(raw, "<u8", (len(raw) - k) // 8, k)
        wide[k::8] = part[: len(wide[k::8])]
    eight = mix64(wide)
    sixteen = pair(eight[:-8], eight[8:])
    gram = pair(sixteen[:-16], sixteen[16:])
    double = pair(gram[:-32], gram[32:])
    return gram, pair(double[: len(data) - LENGTH + 1], double[LENGTH - 64:])


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values."""
    size = 1
    while 2 * size <= width:
        values, size = np.minimum(values[:-size], values[size:]), 2 * size
    return np.minimum(values[: len(values) - (width - size)], values[width - size:]) if size < width else values


@dataclass
class Runs:
    """Runs of windows of a chunk: first and last start, bucket, and bucket of the surroundings."""

    first: np.ndarray
    last: np.ndarray
    bucket: np.ndarray
    around: np.ndarray


def block_runs(data: np.ndarray, base: int, valid: np.ndarray) -> Runs:
    gram, whole = names_of(data)
    place = np.arange(len(gram), dtype=np.uint64)
    choice = (least((gram & ~LOW) | place, CHOICES) & LOW).astype(np.int64)
    change = np.empty(len(choice), bool)
    change[:1] = True
    change[1:] = (choice[1:] != choice[:-1]) | ~valid[:-1]
    first = np.flatnonzero(change & valid)
    ends = np.flatnonzero(np.append(change[1:], True) & valid) if len(valid) else first
    stop = np.flatnonzero(valid & ~np.append(valid[1:], False))
    last = np.union1d(ends, stop)
    at = choice[first]
    extent = ((at - first).astype(np.uint64) << np.uint64(32)) | (last - first).astype(np.uint64)
    around = pair(pair(whole[first], whole[last]), mix64(extent))
    return Runs(first + base, last + base, gram[at], around)


class Chunk:
    """Texts of a chunk one after another, in the order of their ids."""

    def __init__(self, row):
        self.number = int(row.chunk)
        self.ids = np.frombuffer(row.ids, "<i8")
        self.known = np.frombuffer(row.known, "u1").astype(bool)
        self.sizes = np.frombuffer(row.sizes, "<i8")
        self.starts = np.cumsum(self.sizes) - self.sizes
        size = int(self.sizes.sum())
        raw = zstandard.ZstdDecompressor().decompress(row.text, max_output_size=size) if size else b""
        self.data = np.frombuffer(raw, np.uint8)

    def _blocks(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(place, bytes, which positions start a window) of every block."""
        total = len(self.data) - LENGTH + 1
        for base in range(0, max(total, 0), BLOCK):
            n = min(BLOCK, total - base)
            edges = np.zeros(n + 1, np.int32)
            low = max(0, int(np.searchsorted(self.starts, base, "right")) - 1)
            high = int(np.searchsorted(self.starts, base + n))
            a = np.clip(self.starts[low:high] - base, 0, n)
            b = np.clip(self.starts[low:high] + self.sizes[low:high] - LENGTH + 1 - base, 0, n)
            some = b > a
            np.add.at(edges, a[some], 1)
            np.add.at(edges, b[some], -1)
            yield base, self.data[base:base + n + LENGTH - 1], np.cumsum(edges[:-1]) > 0

    def runs(self) -> Runs:
        parts = [block_runs(data, base, valid) for base, data, valid in self._blocks() if valid.any()]
        if not parts:
            none = np.empty(0, np.int64)
            return Runs(none, none, none.astype(np.uint64), none.astype(np.uint64))
        return Runs(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("first", "last", "bucket", "around")))

    def window_names(self, starts: np.ndarray) -> np.ndarray:
        """Buckets of LENGTH bytes at given positions, in ascending order."""
        out = np.empty(len(starts), np.uint64)
        for base, data, _ in self._blocks():
            low, high = np.searchsorted(starts, [base, base + BLOCK])
            if high > low:
                out[low:high] = names_of(data)[1][starts[low:high] - base]
        return out


def shard_of(names: np.ndarray, shards: int) -> np.ndarray:
    return (mix64(names.copy()) % np.uint64(shards)).astype(np.int64)


@dataclass
class Entries:
    """Distinct names of a chunk with the first place of each, ordered by shard."""

    place: np.ndarray  # of each entry, its first item
    entry_of: np.ndarray  # of each item, its entry
    shard: np.ndarray


def distinct(names: np.ndarray, more: np.ndarray, shards: int) -> Entries:
    """Entries of items that are in the order of their places."""
    shard = shard_of(names, shards)
    order = np.lexsort((np.arange(len(names)), more, names, shard))
    new = np.ones(len(order), bool)
    new[1:] = (names[order][1:] != names[order][:-1]) | (more[order][1:] != more[order][:-1])
    entry_of = np.empty(len(order), np.int64)
    entry_of[order] = np.cumsum(new) - 1
    return Entries(order[new], entry_of, shard[order][new])


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes before all second ones, which compresses better."""
    wide = np.ascontiguousarray(values)
    return wide.view(np.uint8).reshape(len(wide), -1).T.tobytes()


def from_planes(data: bytes, kind: str, n: int, at: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    part = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
    return np.ascontiguousarray(part.T).view(kind).ravel()


def packed_entries(chunk: Chunk, names: np.ndarray, around: np.ndarray | None, place: np.ndarray,
                   shard: np.ndarray, shards: int) -> pd.DataFrame:
    """One row a shard: steps of the ascending names, surroundings, places; and the ids they need.

    A place tells its document, as the starts and ids of the documents that the row names go with it.
    """
    document = np.searchsorted(chunk.starts, place, "right") - 1
    zstd, rows = zstandard.ZstdCompressor(level=1), []
    for s, own in cut_by_shard(shard, shards):
        steps = np.diff(names[own], prepend=np.uint64(0))
        named = np.unique(document[own])
        ids, starts = np.diff(chunk.ids[named], prepend=0), np.diff(chunk.starts[named], prepend=0)
        documents = planes(ids.astype("<i8")) + planes(starts.astype("<i8"))
        n = len(steps)
        head = np.array([n, len(ids)], "<i8").tobytes()
        more = around[own].astype("<u8").tobytes() if around is not None else b""
        body = planes(steps.astype("<u8")) + planes(place[own].astype("<i8")) + documents + more
        rows.append((s, chunk.number, zstd.compress(head + body)))
    return pd.DataFrame(rows, columns=["shard", "chunk", "entries"])


def unpacked_entries(entries: bytes, refine: bool) -> tuple[np.ndarray, ...]:
    """(names, surroundings, ids, places)."""
    data = zstandard.ZstdDecompressor().decompress(entries)
    n, m = (int(x) for x in np.frombuffer(data, "<i8", 2))
    steps, place = from_planes(data, "<u8", n, 16), from_planes(data, "<i8", n, 16 + 8 * n)
    at = 16 + 16 * n
    ids, starts = (np.cumsum(from_planes(data, "<i8", m, a)) for a in (at, at + 8 * m))
    around = np.frombuffer(data, "<u8", n, at + 16 * m) if refine else np.zeros(n, np.uint8)
    document = np.searchsorted(starts, place, "right") - 1
    return np.cumsum(steps, dtype=np.uint64), around, ids[document], place


def answers(group: pd.DataFrame, refine: bool) -> pd.DataFrame:
    """Flags of every entry of a shard.

    DUPLICATE: an equal name stands earlier, in the order of id, chunk and place. REFINE: the
    bucket holds different surroundings.
    """
    group = group.sort_values("chunk")
    columns = [unpacked_entries(e, refine) for e in group["entries"]]
    sizes = [len(c[0]) for c in columns]
    name, around, ids, place = (np.concatenate(c) for c in zip(*columns, strict=True))
    del columns
    chunk = np.repeat(group["chunk"].to_numpy(), sizes)
    order = np.argsort(name, kind="stable")
    same = name[order][1:] == name[order][:-1]
    shared = np.zeros(len(order), bool)
    shared[1:] |= same
    shared[:-1] |= same
    at = order[shared]  # most buckets hold one entry and need no more sorting
    at = at[np.lexsort((place[at], chunk[at], ids[at], around[at], name[at]))]
    flags = np.zeros(len(name), np.uint8)
    alike = (name[at][1:] == name[at][:-1]) & (around[at][1:] == around[at][:-1])
    flags[at[1:][alike]] |= DUPLICATE
    if refine and len(at):
        starts = np.flatnonzero(np.append(True, name[at][1:] != name[at][:-1]))
        kinds_of = np.append(True, ~alike).astype(np.int64)
        several = np.add.reduceat(kinds_of, starts) > 1
        flags[at[np.repeat(several, np.diff(np.append(starts, len(at))))]] |= REFINE
    cuts = np.cumsum(sizes) - sizes
    return pd.DataFrame({
        "chunk": group["chunk"], "shard": group["shard"],
        "flags": [flags[a:a + n].tobytes() for a, n in zip(cuts, sizes, strict=True)],
    })


def joined_flags(rows: pd.DataFrame) -> np.ndarray:
    parts = rows.sort_values("shard")["flags"]
    return np.frombuffer(b"".join(parts), np.uint8)


def refined_windows(chunk: Chunk, flags: np.ndarray, shards: int):
    """Runs with their entries; and the windows to be told apart, with theirs."""
    runs = chunk.runs()
    entries = distinct(runs.bucket, runs.around, shards)
    own = flags[entries.entry_of]
    repeated = (own & DUPLICATE).astype(bool)
    repeated |= entries.place[entries.entry_of] != np.arange(len(own))  # not the chunk's first
    ask = ~repeated & ((own & REFINE) > 0)
    size = runs.last[ask] - runs.first[ask] + 1
    starts = np.repeat(runs.first[ask] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    names = chunk.window_names(starts)
    return runs, repeated, starts, names, distinct(names, np.zeros(len(names), np.uint8), shards)


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row of ``docs``.

    Texts are UTF-8 bytes. A byte is removed if a string of LENGTH bytes that covers it also starts
    earlier: in the same text, or in one that comes before in the order of ids. Strings never
    cross texts, overlaps count, and all is judged on the input. Spans are maximal removed runs;
    the checksum is that of the remaining bytes.

    NULL is an empty text. NULL ids come before all others; rows with equal ids are ordered by
    their place in the input. Repeated rows are each returned. An empty table gives no rows.
    Other columns are ignored.

    A chunk sends each of its buckets once, however often it holds it, so a passage that very many
    texts share costs one entry a chunk. Equality is that of 64-bit names.
    """
    spark = docs.sparkSession
    shards = shuffle_shards(spark)

    def collect(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, n = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []
        size = 0

        def chunk() -> pd.DataFrame:
            ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
            known = np.array([r[0] is not None for r in ordered], "u1")
            smallest = np.iinfo(np.int64).min
            ids = np.array([smallest if r[0] is None else r[0] for r in ordered], "<i8")
            text = zstandard.ZstdCompressor(level=1).compress(b"".join(r[1] for r in ordered))
            sizes = np.array([len(r[1]) for r in ordered], "<i8")
            return pd.DataFrame({
                "chunk": [(part << 32) + n], "ids": [ids.tobytes()], "known": [known.tobytes()],
                "sizes": [sizes.tobytes()], "text": [text],
            })

        for frame in frames:
            for key, text in zip(frame["id"], frame["text"], strict=True):
                data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
                if rows and size + len(data) > CHUNK_BYTES:
                    yield chunk()
                    rows, size, n = [], 0, n + 1
                rows.append((None if pd.isna(key) else int(key), data))
                size += len(data)
        if rows:
            yield chunk()

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                c = Chunk(row)
                runs = c.runs()
                entries = distinct(runs.bucket, runs.around, shards)
                at = entries.place
                if len(at):
                    first = runs.first[at]
                    yield packed_entries(c, runs.bucket[at], runs.around[at], first, entries.shard, shards)

    def ask_windows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(next(left.itertuples(index=False)))
        _, _, starts, names, entries = refined_windows(c, joined_flags(right), shards)
        at = entries.place
        return packed_entries(c, names[at], None, starts[at], entries.shard, shards)

    def finish(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(next(left.itertuples(index=False)))
        level = right["level"].to_numpy() if len(right) else np.empty(0)
        runs, repeated, starts, _, entries = refined_windows(c, joined_flags(right[level == 1]), shards)
        flags = joined_flags(right[level == 2])
        again = (flags[entries.entry_of] & DUPLICATE).astype(bool)
        again |= entries.place[entries.entry_of] != np.arange(len(starts))
        edges = np.zeros(len(c.data) + 1, np.int32)
        np.add.at(edges, runs.first[repeated], 1)
        np.add.at(edges, runs.last[repeated] + LENGTH, -1)
        np.add.at(edges, starts[again], 1)
        np.add.at(edges, starts[again] + LENGTH, -1)
        gone = np.cumsum(edges[:-1], dtype=np.int32) > 0
        del edges
        rows = []
        for key, known, a, size in zip(c.ids, c.known, c.starts, c.sizes, strict=True):
            own = gone[a:a + size]
            spans = int((own[1:] & ~own[:-1]).sum()) + int(size > 0 and own[0])
            kept = hashlib.sha256(c.data[a:a + size][~own].tobytes()).hexdigest()
            rows.append((int(key) if known else None, int(size), int(own.sum()), spans, kept))
        out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    chunks = materialize(rows.mapInPandas(collect, CHUNK), "chunks")
    asked = chunks.mapInPandas(ask, ASKED)
    first = asked.groupBy("shard").applyInPandas(lambda g: answers(g, True), ANSWER)
    first = materialize(first, "buckets")
    windows = chunks.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInPandas(ask_windows, ASKED)
    second = windows.groupBy("shard").applyInPandas(lambda g: answers(g, False), ANSWER)
    second = materialize(second, "windows")
    both = first.withColumn("level", F.lit(1)).unionByName(second.withColumn("level", F.lit(2)))
    found = chunks.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInPandas(finish, RESULT)
    return found if id_col == "doc_id" else found.withColumnRenamed("doc_id", id_col)
