"""The quality classifier: accuracy on labels it has not seen, and the sampling by hand."""

import numpy as np
import pytest
from frames import awkward
from pyspark.sql import functions as F

from cardwarden.llm import quality as q
from cardwarden.llm.common import table

SF = "/root/testdata/sf0.1"
LABELS = "doc_id bigint, quality int, toxic int"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    seen = labels.where("doc_id % 3 != 0")  # the rest is never shown to the classifier
    keys = q.quality_keys(docs, seen).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    good = (keys.quality == 1) & (keys.toxic == 0)
    assert keys[good].kept.mean() > 0.93
    assert keys[keys.toxic == 1].kept.mean() < 0.12
    assert keys[keys.quality == 0].kept.mean() < 0.2


def labelled(spark):
    good = ["the river runs past the old mill and the quiet town"] * 30
    bad = ["BUY!! NOW!! CHEAP!! PILLS!! CLICK!! HERE!!"] * 30
    texts = [f"{t} {i}" for i, t in enumerate(good + bad)] + [None, "", good[0], good[0]]
    ids = [*range(60), 60, 61, None, 0]
    labels = [(i, int(i < 30), 0) for i in range(60)] + [(None, 1, 0), (5, None, 0), (7, 1, 0)]
    return awkward(spark, texts, ids), spark.createDataFrame(labels, LABELS)


def test_sample_is_gumbel_top_k(spark):
    docs, labels = labelled(spark)
    spec = q.QualitySpec(labelled=40)
    rows = q.quality_keys(docs, labels, spec=spec).collect()
    assert len(rows) == 64
    kept = sorted((r for r in rows if r.kept), key=lambda r: -r.sample_key)
    rest = [r.sample_key for r in rows if not r.kept]
    assert min(r.sample_key for r in kept) >= max(rest)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None and r.doc_id not in (0, 60, 61)}
    assert all(by_id[i].kept == (i < 30) for i in by_id)
    empty = [r for r in rows if r.doc_id in (60, 61)]
    assert [r.log_weight for r in empty] == [0.0, 0.0]
    again = q.quality_keys(docs.repartition(5), labels, spec=spec).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    whole = q.good_documents(docs, labels, spec=spec)
    assert whole.columns == docs.columns and whole.count() == len(kept)


@pytest.mark.parametrize("labels, kept", [([], 64), ([(1, 1, 0), (2, 1, 0)], 64), ([(1, 0, 0), (2, 1, 1)], 0)])
def test_one_sided_labels(spark, labels, kept):
    docs, _ = labelled(spark)
    rows = q.quality_keys(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert sum(r.kept for r in rows) in ({kept} if len(labels) != 2 else {0, 64})
    assert q.quality_keys(docs.limit(0), spark.createDataFrame(labels, LABELS)).count() == 0


def test_weight_by_hand(spark):
    spec = q.QualitySpec(segment=4, worst_share=0.0, worst_words=1, buckets=1 << 10, grams=(3,))
    ratios = np.random.default_rng(4).normal(size=spec.buckets)
    texts = ["a bb ccc dddd a bb a zz", "one", "", "b b b b b b b b b b b"]
    weigh = q.weigher(spark, ratios, spec)
    rows = awkward(spark, texts).select("doc_id", weigh(F.col("text")).alias("w")).collect()
    for r in rows:
        hashes = [np.frombuffer(q.word_hashes(w, (3,)), np.uint32) for w in texts[r.doc_id].encode().split()]
        each = [ratios[h % 1024].sum() for h in hashes]
        halves = [each[i:i + 2] for i in range(0, len(each), 2)]
        parts = [a + b for a, b in zip(halves, halves[1:])] or halves
        expected = min(each) + min(sum(p) / len(p) for p in parts) if each else 0.0
        assert r.w == pytest.approx(expected)


def test_threshold():
    w, g = np.array([-5.0, -4, -1, 0, 1, 2]), np.array([0, 0, 0, 1, 1, 1]) == 1
    assert q.best_threshold(w, g) == -0.5
    assert q.best_threshold(w[:3], g[:3]) == np.inf and q.best_threshold(w[3:], g[3:]) == -np.inf
