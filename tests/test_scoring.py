"""Features, isolation forest, score tail; counts on hot keys against brute force."""

import datetime as dt
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardwarden.fixed_values import MODEL_VERSION
from cardwarden.operators import iforest, scoring
from cardwarden.operators.features import feature_frame, model_matrix
from cardwarden.operators.lookup import attach_group_count
from cardwarden.plans.refresh import Settings, score_features
from cardwarden.sources.scratch import materialize_measured

RUN = dt.datetime(2026, 9, 30, 12)
SETTINGS = Settings(load_id="t", as_of=dt.date(2026, 9, 30), run_ts=RUN,
                    forest=iforest.ForestSpec(trees=50))
GOLD = (
    "id_transacao LONG, sk_data INT, sk_orgao STRING, sk_favorecido STRING, sk_portador STRING, "
    "vl_transacao DOUBLE, media_orgao DOUBLE, z_score DOUBLE, dia_semana INT, fl_fim_semana INT"
)


def gold_rows(n=100):
    rng = np.random.default_rng(42)
    rows = [
        [i + 1, 20260101 + i, "10", "101" if i < n - 10 else "102",
         "501" if i < n - 20 else "502", float(rng.uniform(50, 400)), 200.0,
         float(rng.uniform(-1, 1)), int(rng.integers(2, 7)), 0]
        for i in range(n)
    ]
    rows[0][3], rows[0][5:] = "999", [35000.0, 200.0, 5.2, 1, 1]
    rows[1][5:] = [18000.0, 200.0, 3.8, 7, 1]
    return rows


def test_features_hold_no_nan(spark):
    matrix = model_matrix(feature_frame(spark.createDataFrame(gold_rows(), GOLD))).toPandas()
    assert len(matrix) == 100
    assert not matrix[iforest.MODEL_COLUMNS].isna().any().any()
    counts = matrix.groupby("sk_favorecido")["freq_favorecido"].first().to_dict()
    assert counts == {"101": 89, "102": 10, "999": 1}


def test_ratio_fallbacks(spark):
    rows = gold_rows(4)
    rows[0][6], rows[1][6] = None, 0.0
    rows[2][4] = None
    frame = feature_frame(spark.createDataFrame(rows, GOLD)).orderBy("id_transacao").collect()
    overall = sum(r[5] for r in rows) / 4
    assert frame[0].razao_media_orgao == pytest.approx(rows[0][5] / overall)
    assert frame[1].razao_media_orgao == pytest.approx(rows[1][5] / overall)
    assert frame[2].freq_portador is None


def test_scores_have_the_reference_properties(spark):
    features = feature_frame(spark.createDataFrame(gold_rows(), GOLD))
    scores = score_features(features, SETTINGS).toPandas()
    assert len(scores) == 100
    assert scores.anomaly_score.min() == 0.0 and scores.anomaly_score.max() == 1.0
    odd = scores[scores.id_transacao == 1].iloc[0]
    assert odd.anomaly_score > scores.anomaly_score.median()
    assert odd.is_anomaly_p99 == 1 and "fim de semana" in odd.motivo_anomalia
    assert set(scores.model_version) == {MODEL_VERSION}
    assert scores.is_anomaly_p95.sum() >= 5


def test_empty_features_give_no_scores(spark):
    assert score_features(feature_frame(spark.createDataFrame([], GOLD)), SETTINGS) is None


def test_one_row_is_scored(spark):
    features = feature_frame(spark.createDataFrame(gold_rows(2)[:1], GOLD))
    row = score_features(features, SETTINGS).first()
    assert (row.anomaly_score, row.is_anomaly_p95, row.is_anomaly_p99) == (0.0, 1, 1)


def random_matrix(spark, n, partitions):
    rng = np.random.default_rng(7)
    frame = pd.DataFrame(rng.normal(size=(n, 7)), columns=iforest.MODEL_COLUMNS)
    frame.loc[: 15, iforest.MODEL_COLUMNS] += 8.0
    frame.insert(0, "id_transacao", np.arange(n))
    return spark.createDataFrame(frame).repartition(partitions)


@pytest.mark.parametrize("n", [300, 900, 6000])
def test_forest_ignores_partitioning(spark, n):
    spec = iforest.ForestSpec(trees=15)
    forests = [
        iforest.fit(random_matrix(spark, n, p), n, spec).toPandas()
        .sort_values(["tree", "node"]).reset_index(drop=True)
        for p in (1, 4, 16)
    ]
    pd.testing.assert_frame_equal(forests[0], forests[1])
    pd.testing.assert_frame_equal(forests[0], forests[2])
    assert forests[0].tree.nunique() == 15 and (forests[0].rows == 256).all()


def test_one_sampling_rule_at_every_size(spark):
    spec = iforest.ForestSpec(trees=150, sample=4)
    for n in (599, 600, 601):  # as many rows as all samples together, one less and one more
        sample = iforest.sample_rows(random_matrix(spark, n, 3), n, spec, "id_transacao").collect()
        per_tree = Counter(r.tree for r in sample)
        assert set(per_tree.values()) <= set(range(5)) and len(per_tree) > 140
        assert len({(r.tree, r.id_transacao) for r in sample}) == len(sample)
        assert len({r.id_transacao for r in sample}) < len(sample)  # trees may share rows


def test_outliers_score_high(spark):
    matrix = random_matrix(spark, 6000, 4)
    forest = iforest.fit(matrix, 6000, iforest.ForestSpec(trees=20))
    scores = iforest.score(matrix, forest).select("id_transacao", "raw_score").toPandas()
    outliers = scores[scores.id_transacao <= 15].raw_score
    assert outliers.min() > scores[scores.id_transacao > 15].raw_score.quantile(0.99)


def test_batch_scoring_equals_walking_the_trees():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(200, 7))
    nodes = []
    for tree in range(5):
        for node in iforest.grow_tree(points[tree::5], 6, np.random.default_rng(tree)):
            nodes.append((tree, *node, 40))
    forest = pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "path", "rows"])

    def walk(tree, point):
        table = forest[forest.tree == tree].set_index("node")
        node = 0
        while table.loc[node, "feature"] >= 0:
            feature = int(table.loc[node, "feature"])
            node = 2 * node + (1 if point[feature] <= table.loc[node, "threshold"] else 2)
        return table.loc[node, "path"]

    expected = [
        2 ** (-np.mean([walk(t, p) for t in range(5)]) / iforest.mean_path(40)) for p in points[:40]
    ]
    got = iforest.anomaly_degree(points[:40], *iforest._levels(forest))
    np.testing.assert_allclose(got, expected)


def tail(spark, rows):
    schema = (
        "id_transacao LONG, raw_score DOUBLE, fl_fim_semana INT, z_score DOUBLE, "
        "freq_favorecido LONG, vl_transacao DOUBLE"
    )
    scaled = scoring.scale_scores(spark.createDataFrame(rows, schema))
    return scoring.flag(scaled, RUN)


def test_tail_edges(spark):
    same = tail(spark, [(i, 0.5, 0, None, 9, 1.0) for i in range(5)]).collect()
    assert {(r.anomaly_score, r.is_anomaly_p95, r.is_anomaly_p99) for r in same} == {(0.0, 1, 1)}
    assert {r.motivo_anomalia for r in same} == {"Anomalia severa multivariada"}
    single = tail(spark, [(1, 0.5, 0, None, 2, 1000.0)]).first()
    assert single.is_anomaly_p99 == 1 and "esporádico" not in single.motivo_anomalia
    full = tail(spark, [(1, 0.5, 1, 2.0, 2, 1000.01)]).first()
    assert full.motivo_anomalia.count(" | ") == 2
    assert tail(spark, []).count() == 0


def test_limits_equal_numpy(spark):
    values = np.round(np.random.default_rng(5).random(5000), 4)
    frame = spark.createDataFrame([(float(v),) for v in values], "anomaly_score DOUBLE")
    row = scoring.score_limits(frame).first()
    assert row.p95 == pytest.approx(np.percentile(values, 95), abs=1e-12)
    assert row.p99 == pytest.approx(np.percentile(values, 99), abs=1e-12)


@pytest.mark.parametrize("hot_keys", [1, 3, 1000])
def test_hot_key_counts_equal_brute_force(spark, hot_keys):
    keys = ["quente"] * 2000 + [f"k{i % 37}" for i in range(900)] + [None] * 50
    rows = spark.createDataFrame(list(enumerate(keys)), "id LONG, k STRING").repartition(6)
    got = attach_group_count(rows, rows, "k", "id", "n", hot_keys).collect()
    counts = Counter(k for k in keys if k is not None)
    assert len(got) == len(keys)
    assert all(r.n == counts.get(r.k) for r in got)


def test_hot_rows_are_spread_by_the_shuffle(spark):
    keys = ["quente"] * 6000 + [f"k{i}" for i in range(6000)]
    rows = spark.createDataFrame(list(enumerate(keys)), "id LONG, k STRING")
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        joined = attach_group_count(rows, rows, "k", "id", "n", 10)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 12000 / 4


def test_a_hot_key_uses_all_of_many_partitions(spark):
    rows = spark.range(60000).select("id", F.lit("quente").alias("k"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    shuffled = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for name, value in zip(before, ("-1", "false")):
            spark.conf.set(name, value)
        spark.conf.set("spark.sql.shuffle.partitions", "2000")
        joined = attach_group_count(rows, rows, "k", "id", "n", 10)
        tasks = joined.groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)
        for name, value in before.items():
            spark.conf.set(name, value)
    assert tasks > 1990


def test_summary(spark):
    flagged = tail(spark, [(i, i / 200, 0, None, 9, 1.0) for i in range(201)])
    row = scoring.run_summary(flagged).first()
    assert (row.total_processado, row.anomalias_p95, row.anomalias_p99) == (201, 11, 3)
    assert (row.score_min, row.score_mediana, row.score_max) == (0.0, 0.5, 1.0)
    empty = scoring.run_summary(flagged.where(F.lit(False))).first()
    assert empty.total_processado == 0


def test_measures_taken_while_writing(spark):
    rows = spark.range(1000).repartition(7).withColumn("raw_score", F.col("id") / 1000)
    written, seen = materialize_measured(
        rows, "measured", n=F.count("*"), mean=F.avg("id"), low=F.min("raw_score"), high=F.max("raw_score")
    )
    assert written.count() == 1000
    assert seen == {"n": 1000, "mean": 499.5, "low": 0.0, "high": 0.999}
    known = scoring.scale_scores(written, (seen["low"], seen["high"]))
    assert known.exceptAll(scoring.scale_scores(written)).isEmpty()
    _, none = materialize_measured(rows.limit(0), "measured", n=F.count("*"), low=F.min("raw_score"))
    assert none == {"n": 0, "low": None}
