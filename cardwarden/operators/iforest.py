"""Isolation forest (Liu, Ting and Zhou, 2008): fitted on a bounded sample, scored per batch."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cardwarden.fixed_values import FEATURES, FOREST_SAMPLE, FOREST_SEED, FOREST_TREES
from cardwarden.operators.features import MODEL_PREFIX

MODEL_COLUMNS = [MODEL_PREFIX + c for c in FEATURES]
FOREST_SCHEMA = "tree INT, node INT, feature INT, threshold DOUBLE, path DOUBLE, rows INT"
LEAF = -1


@dataclass(frozen=True)
class ForestSpec:
    trees: int = FOREST_TREES
    sample: int = FOREST_SAMPLE
    seed: int = FOREST_SEED


def mean_path(n: int) -> float:
    """Mean depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


class SampleError(RuntimeError):
    """A tree got fewer rows than it should, which chance does not explain."""


def sample_rows(matrix: DataFrame, n_rows: int, spec: ForestSpec, key: str) -> DataFrame:
    """Rows of every tree's sample, chosen by hash: the same for any partitioning and any size.

    A tree takes the rows of the smallest hashes of (key, tree). Each row keeps only the trees
    for which its hash is below a bound that lets through about twice the sample, so that no
    map task sends more than its share and a tree's rows are a bounded group. Of many rows most
    have no such tree; they are dropped on the bare hashes, before anything is built for them.
    """
    columns = [key, *MODEL_COLUMNS]
    share = min(1.0, 2.0 * spec.sample / max(n_rows, 1))
    numbers = F.sequence(F.lit(0), F.lit(spec.trees - 1))

    def drawn(tree: Column) -> Column:
        return F.xxhash64(F.col(key), tree, F.lit(spec.seed))

    hashed = F.transform(numbers, lambda t: F.struct(t.alias("tree"), drawn(t).alias("_h")))
    if share < 1.0:
        bound = int(-(2**63) + share * 2**64)
        matrix = matrix.where(F.exists(numbers, lambda t: drawn(t) < bound))
        hashed = F.filter(hashed, lambda x: x["_h"] < bound)
    chosen = matrix.select(*columns, F.explode(hashed).alias("_t")).select("_t.*", *columns)
    per_tree = W.partitionBy("tree").orderBy("_h", key)
    ranked = chosen.withColumn("_rn", F.row_number().over(per_tree))
    return ranked.where(F.col("_rn") <= spec.sample).select("tree", *columns)


def grow_tree(points: np.ndarray, depth_limit: int, rng: np.random.Generator) -> list[tuple]:
    """Nodes (number, feature, threshold, path) of one random tree, numbered as in a heap."""
    nodes, todo = [], [(0, 0, points)]
    while todo:
        number, depth, part = todo.pop()
        low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (None, None)
        usable = np.flatnonzero(high > low) if len(part) > 1 else np.empty(0, int)
        if depth >= depth_limit or not len(usable):
            nodes.append((number, LEAF, 0.0, depth + mean_path(len(part))))
            continue
        feature = int(rng.choice(usable))
        cut = rng.uniform(low[feature], high[feature])
        if cut >= high[feature]:
            cut = low[feature]
        left = part[:, feature] <= cut
        nodes.append((number, feature, float(cut), 0.0))
        todo.append((2 * number + 2, depth + 1, part[~left]))
        todo.append((2 * number + 1, depth + 1, part[left]))
    return nodes


def fit(matrix: DataFrame, n_rows: int, spec: ForestSpec = ForestSpec(), key: str = "id_transacao"
        ) -> DataFrame:
    """The forest as rows: at most ``trees`` × ``2 * sample - 1`` of them for any input size."""
    wanted = min(spec.sample, n_rows)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        if len(group) < wanted:
            raise SampleError(f"tree {tree} has {len(group)} of {wanted} rows")
        points = group.sort_values(key)[MODEL_COLUMNS].to_numpy(float)
        depth_limit = ceil(log2(max(len(points), 2)))
        nodes = grow_tree(points, depth_limit, np.random.default_rng([spec.seed, tree]))
        frame = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "path"])
        frame.insert(0, "tree", tree)
        frame["rows"] = len(points)
        return frame

    sample = sample_rows(matrix, n_rows, spec, key)
    return sample.groupBy("tree").applyInPandas(grow, FOREST_SCHEMA)


def _levels(forest: pd.DataFrame) -> tuple[list, np.ndarray, float]:
    """Per level the (feature, threshold) tables, the paths at the bottom, and the scale.

    A leaf above the bottom sends every row to its left child, down to the bottom.
    """
    trees = forest["tree"].nunique()
    index = {t: i for i, t in enumerate(sorted(forest["tree"].unique()))}
    depth = int(np.floor(np.log2(forest["node"].max() + 1)))
    size = 2 ** (depth + 1) - 1
    feature = np.zeros((trees, size), np.int64)
    cut = np.full((trees, size), np.inf)
    path = np.zeros((trees, size))
    for tree, node, f, c, p in forest[["tree", "node", "feature", "threshold", "path"]].itertuples(
        index=False
    ):
        row = index[tree]
        if f != LEAF:
            feature[row, node], cut[row, node] = f, c
            continue
        while node < 2**depth - 1:
            node = 2 * node + 1
        path[row, node] = p
    levels = [
        (feature[:, 2**d - 1: 2 ** (d + 1) - 1].copy(), cut[:, 2**d - 1: 2 ** (d + 1) - 1].copy())
        for d in range(depth)
    ]
    return levels, path[:, 2**depth - 1:].copy(), mean_path(int(forest["rows"].max()))


def anomaly_degree(points: np.ndarray, levels: list, paths: np.ndarray, scale: float) -> np.ndarray:
    """2^(-mean path / scale) of each row; without a scale (one point) every row gets 0.5."""
    n = len(points)
    by_feature = np.ascontiguousarray(points.T).ravel()
    rows = np.arange(n)
    total = np.zeros(n)
    for tree in range(len(paths)):
        place = np.zeros(n, np.int64)
        for feature, cut in levels:
            value = by_feature.take(feature[tree].take(place) * n + rows)
            place = 2 * place + (value > cut[tree].take(place))
        total += paths[tree].take(place)
    if scale == 0:
        return np.full(n, 0.5)
    return np.exp2(-total / (len(paths) * scale))


def scorer(forest: DataFrame) -> Column:
    """Column with the raw degree of anomaly: the forest goes to the executors once.

    Only the model columns cross to Python, in Arrow batches; the others stay in the JVM.
    """
    shared = forest.sparkSession.sparkContext.broadcast(_levels(forest.toPandas()))

    @F.pandas_udf("double")
    def degree(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        levels, paths, scale = shared.value
        for batch in batches:
            points = np.column_stack([c.to_numpy(float) for c in batch])
            yield pd.Series(anomaly_degree(points, levels, paths, scale))

    return degree(*MODEL_COLUMNS)


def score(matrix: DataFrame, forest: DataFrame) -> DataFrame:
    """Rows with their raw degree of anomaly; higher is more anomalous."""
    return matrix.withColumn("raw_score", scorer(forest))
