"""Approximate nearest neighbours with an inverted multi-index (Babenko and Lempitsky, 2012)."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwarden.sources.scratch import materialize

RESULT = "query_id bigint, rank int, vec_id bigint, score double"


@dataclass(frozen=True)
class IndexSpec:
    """``sample`` bounds the vectors the centroids are fitted on; every vector is indexed.

    A query visits cells in order of distance until it has seen ``cells`` that are not empty and
    ``share`` of all vectors, by one rule at every size. The share is large because vectors without
    clusters, like those of the test tables, need it for a recall of 0.9; clustered ones don't.
    """

    centroids: int = 16
    sample: int = 20_000
    rounds: int = 12
    cells: int = 32
    share: float = 0.7
    vectors_a_block: int = 4_096
    queries_a_block: int = 1_024
    seed: int = 5


def usable(vector: Column, dim: int) -> Column:
    """Vectors of the index's length with finite components that are not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dim) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def half_centroids(points: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's k-means on distinct points."""
    points = np.unique(points, axis=0)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        own = distances(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)


def closest_cells(first: np.ndarray, second: np.ndarray, sizes: dict[int, int], cells: int, wanted: int) -> list[int]:
    """Cells in order of the sum of both halves' distances, by a heap over pairs of ranks.

    A pair enters the heap once both pairs before it have left, so few are ever in it.
    """
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, left, out, seen = [(first[a[0]] + second[b[0]], 0, 0)], set(), [], 0
    while heap and (len(out) < cells or seen < wanted):
        _, i, j = heapq.heappop(heap)
        left.add((i, j))
        cell = int(a[i]) * len(b) + int(b[j])
        if cell in sizes:
            out.append(cell)
            seen += sizes[cell]
        if i + 1 < len(a) and (j == 0 or (i + 1, j - 1) in left):
            heapq.heappush(heap, (first[a[i + 1]] + second[b[j]], i + 1, j))
        if j + 1 < len(b) and (i == 0 or (i - 1, j + 1) in left):
            heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))
    return out


def best_of_block(ids: np.ndarray, vectors: np.ndarray, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest of a block for each query, ties to smaller ids."""
    asked = unpacked(queries["v"])
    rough = unit(asked) @ unit(vectors).T
    rows = []
    for number, (key, query) in enumerate(zip(queries["query_id"], asked, strict=True)):
        other = np.flatnonzero(ids != key)
        if not len(other):
            continue
        near = rough[number, other]
        least = np.partition(near, -k)[-k] if len(near) > k else near.min()
        other = other[near >= least - 1e-9]  # rounding of the product must not decide
        score = cosine(query, vectors[other])
        for i in np.lexsort((ids[other], -score))[:k]:
            rows.append((key, queries["v"].iloc[number], ids[other[i]], score[i]))
    return pd.DataFrame(rows, columns=["query_id", "v", "vec_id", "score"])


def cosine(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosine in double precision, summed in the same order for every row.

    Powers of two are taken out first, which changes no digit and keeps squares finite.
    """
    x = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])
    q = np.ldexp(query, -np.frexp(np.abs(query).max())[1])
    return (x * q).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (q * q).sum())


def unpacked(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1)


def lengths(vectors: DataFrame, vector_col: str) -> list[int]:
    """Lengths of the vectors, the most frequent first; few, as a table has one or a handful."""
    found = vectors.where(F.size(vector_col) > 0).groupBy(F.size(vector_col).alias("n")).count()
    return [r.n for r in found.orderBy(F.desc("count"), F.desc("n")).collect()]


def build_index(vectors: DataFrame, id_col: str, vector_col: str, dim: int, spec: IndexSpec) -> tuple[DataFrame, list]:
    """(vec_id, v, cell) of every usable vector of a length, and the two sets of centroids."""
    asked = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    asked = asked.where("vec_id is not null")
    rows = asked.where(usable(F.col("x"), dim))
    chosen = rows.orderBy(F.xxhash64("vec_id", F.lit(spec.seed)), "vec_id").limit(spec.sample).toPandas()
    if chosen.empty:
        return rows.selectExpr("vec_id", "cast(null as binary) v", "0 cell"), []
    points, rng, cut = unit(np.stack(chosen["x"].to_numpy()).astype(float)), np.random.default_rng(spec.seed), dim // 2
    halves = [half_centroids(points[:, :cut], spec.centroids, spec.rounds, rng),
              half_centroids(points[:, cut:], spec.centroids, spec.rounds, rng)]
    shared = vectors.sparkSession.sparkContext.broadcast(halves)  # 2 x spec.centroids vectors

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, second = shared.value
        for frame in frames:
            if frame.empty:
                continue
            x = np.stack(frame["x"].to_numpy()).astype("<f8")
            u = unit(x)
            cell = distances(u[:, :cut], first).argmin(axis=1) * len(second) + distances(u[:, cut:], second).argmin(axis=1)
            yield pd.DataFrame({"vec_id": frame["vec_id"], "v": [r.tobytes() for r in x], "cell": cell.astype(np.int32)})

    return materialize(rows.mapInPandas(assign, "vec_id bigint, v binary, cell int"), "index"), halves


def nearest(
    vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id",
    vector_col: str = "embedding", spec: IndexSpec = IndexSpec(),
) -> DataFrame:
    """Each query's k nearest rows found: (``query_id``, ``rank`` from 1, ``vec_id``, ``score``).

    ``queries`` is a condition on ``vec_id``. Nearness is the cosine in double precision on the
    original vectors; ties go to the smaller id. Candidates are the rows of other ids in the
    cells that the query visits; a query gets fewer than k rows only if there are no more.

    Vectors that are NULL, zero or hold NULL or non-finite components, or whose id is NULL take no
    part. Vectors of one length are searched among each other, each length with an index of its
    own. Repeated rows are candidates each; a query repeated with the same vector is answered once,
    with another vector once for each. An empty table gives no rows; other columns are ignored.

    Each half of the vector is quantised on its own; a cell is a pair of centroids. Cells are
    searched in blocks of bounded numbers of vectors and queries, so a cell that holds most rows
    is spread over many tasks, and a block gives k rows a query at most. The driver sees cell
    counts only, at most ``centroids`` squared.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("x"))
    parts = [_nearest_of_length(rows, queries, k, dim, spec) for dim in lengths(rows, "x")]
    parts = [p for p in parts if p is not None]
    if not parts:
        return vectors.sparkSession.createDataFrame([], RESULT)
    return reduce(DataFrame.unionByName, parts)


def _nearest_of_length(vectors: DataFrame, queries: Column, k: int, dim: int, spec: IndexSpec) -> DataFrame | None:
    index, halves = build_index(vectors, "vec_id", "x", dim, spec)
    if not halves:
        return None
    sizes = {r.cell: r["count"] for r in index.groupBy("cell").count().collect()}
    wanted = max(k + 1, int(spec.share * sum(sizes.values())))
    shared = vectors.sparkSession.sparkContext.broadcast((halves, sizes))

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (first, second), held = shared.value
        cut = first.shape[1]
        for frame in frames:
            if frame.empty:
                continue
            u = unit(unpacked(frame["v"]))
            one, two = distances(u[:, :cut], first), distances(u[:, cut:], second)
            cells = [closest_cells(p, q, held, spec.cells, wanted) for p, q in zip(one, two, strict=True)]
            yield pd.DataFrame({"query_id": frame["vec_id"], "v": frame["v"], "cells": cells})

    asked = index.where(queries).select("vec_id", "v").distinct()
    visits = materialize(asked.mapInPandas(visit, "query_id bigint, v binary, cells array<int>"), "visits")
    visits = visits.withColumn("cell", F.explode("cells")).drop("cells")
    asks = {r.cell: r["count"] for r in visits.groupBy("cell").count().collect()}
    blocks = vectors.sparkSession.createDataFrame(
        [(c, -(-n // spec.vectors_a_block), -(-asks[c] // spec.queries_a_block)) for c, n in sizes.items() if c in asks],
        "cell int, n_v int, n_q int",
    )  # one row a cell
    pick = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = index.join(F.broadcast(blocks), "cell").select("cell", pick("vec_id", "n_v").alias("bv"), every("n_q").alias("bq"), "vec_id", "v")
    sent = visits.join(F.broadcast(blocks), "cell").select("cell", every("n_v").alias("bv"), pick("query_id", "n_q").alias("bq"), "query_id", "v")

    def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "v": [], "vec_id": [], "score": []})
        return best_of_block(left["vec_id"].to_numpy(), unpacked(left["v"]), right, k)

    keys = ["cell", "bv", "bq"]
    found = held.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(
        rerank, "query_id bigint, v binary, vec_id bigint, score double"
    )
    place = F.row_number().over(W.partitionBy("query_id", "v").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
