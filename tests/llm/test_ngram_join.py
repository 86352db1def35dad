"""Jaccard components against all pairs and SQL; prefix trees with every block layout."""

import random

import numpy as np
import pytest
from compare import duck, duck_rows, spark_rows
from frames import awkward, by_id

from cardwarden.llm import ngram_join as join
from cardwarden.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def plain_set(text, size=4):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain(texts, percent=85):
    sets = [plain_set(t) for t in texts]
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return [(i, len(s), g) for i, (s, g) in enumerate(zip(sets, group))]


def near_copies(seed, groups=12, copies=9):
    rng = random.Random(seed)
    shared = [f"passage{i}" for i in range(30)]
    texts = []
    for g in range(groups):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([5, 7, 20, 60, 300]))] + shared * (g % 3 == 0)
        for _ in range(copies):
            own = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 8])):
                own[rng.randrange(len(own))] = f"edit{rng.randrange(50)}"
            texts.append(" ".join(own))
    return texts


def test_bounds_hold():
    bounds = join.Threshold(85)
    for n in range(1, 120):
        for m in range(n, 160):
            least = next(o for o in range(m + 1) if 100 * o >= 85 * (n + m - o))
            assert bounds.overlap(n, m) == least
            if least <= n:  # similar sets of n and m exist
                share = bounds.common(n)
                assert n - least + share <= bounds.index(n) or bounds.index(n) == n
                assert m - least + share <= bounds.probe(m) or bounds.probe(m) == m
                assert bounds.needed(m) <= share and bounds.needed(n) <= share


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(spark, seed):
    texts = near_copies(seed) + [None, "", " \n", "one", "ONE", "two words", "a b c", "A B C", "a b c d", "a b c d a b c d a"]
    got = by_id(join.jaccard_components(awkward(spark, texts)), "n_shingles", "component_id")
    assert got == plain(texts)
    assert len({c for _, _, c in got}) < len(texts) - 30


def test_small_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(join, "BLOCK_SETS", 4)  # every bucket of copies is cut into blocks
    texts = near_copies(7, groups=4, copies=40)
    got = by_id(join.jaccard_components(awkward(spark, texts)), "n_shingles", "component_id")
    assert got == plain(texts)


def test_frequent_names_come_last():
    order = join.GlobalOrder(np.array([50, 7, 30], np.uint64))  # 30 is the most frequent
    assert order.sorted(np.array([7, 8, 30, 50, 60], np.uint64)).tolist() == [8, 60, 50, 7, 30]
    assert join.GlobalOrder(np.empty(0, np.uint64)).sorted(np.array([3, 4], np.uint64)).tolist() == [3, 4]


def test_tree_links_exactly_the_components():
    rng, bounds = np.random.default_rng(5), join.Threshold(85)
    base = [np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64)) for n in (1, 6, 7, 40, 200)]
    sets = [b for b in base]
    for b in base:
        for _ in range(8):
            own = b.copy()
            own[rng.integers(0, len(own), max(0, len(own) // rng.integers(5, 30)))] = rng.integers(0, 1 << 62)
            sets.append(np.unique(own))
    group = [(bytes([i]), bytes([i]), s.tobytes()) for i, s in enumerate(sets)]
    links = [(a[0], b[0]) for a, b in join.block_links(group, bounds)]
    similar = lambda i, j: 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))
    assert all(similar(i, j) for i, j in links)

    def roots(pairs):
        at = list(range(len(sets)))
        for i, j in pairs:
            low, high = sorted((at[i], at[j]))
            at = [low if g == high else g for g in at]
        return at

    assert roots(links) == roots([(i, j) for i in range(len(sets)) for j in range(i) if similar(i, j)])
    assert len(links) <= len(sets) - 1  # no pair within a component twice


def test_null_and_repeated_ids(spark):
    texts = ["a b c d e", "a b c d e", "a b c d e", None, "", "q r s t u"]
    ids = [None, 5, 5, 7, None, None]
    rows = join.jaccard_components(awkward(spark, texts, ids)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in rows) == [
        ("5", 2, "5"), ("5", 2, "5"), ("7", 0, "7"), ("None", 0, "None"), ("None", 2, "5"), ("None", 2, "None"),
    ]
    assert join.jaccard_components(awkward(spark, []).limit(0)).count() == 0


def test_very_long_text(spark):
    words = [f"w{i}" for i in range(30_000)]
    other = list(words)
    other[15_000] = "x"
    rows = join.jaccard_components(awkward(spark, [" ".join(words), " ".join(other), " ".join(words[:20_000])])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == [(0, 29_997, 0), (1, 29_997, 0), (2, 19_997, 2)]


def test_same_as_sql(spark):
    assert spark_rows(QUERIES["op12_ngram_join"](spark, SF)) == duck_rows(duck(SF), ORACLES["op12_ngram_join"])


def test_sketches_never_rule_out_a_similar_set():
    rng, bounds = np.random.default_rng(9), join.Threshold(85)
    sets = []
    for n in (1, 7, 60, 900, 1100, 5000):  # sketches of 1024 to 8192 bits
        base = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        for share in (0, 0.02, 0.05, 0.07, 0.09, 0.2, 0.5):
            own = base.copy()
            own[:int(n * share)] = rng.integers(0, 1 << 62, int(n * share))
            sets.append(np.unique(own)[:n - int(n * share / 2)])
    assert len({len(join.sketch(s)) for s in sets}) == 4
    for a in sets:
        for b in sets:
            short, long = sorted((np.frombuffer(join.sketch(s), np.uint64) for s in (a, b)), key=len)
            apart = int(np.bitwise_count(short ^ join.folded(long, len(short))).sum())
            assert apart <= len(np.setxor1d(a, b))
    group = [(i, i, len(s), join.sketch(s)) for i, s in enumerate(sets)]
    left = {key for key, _ in join.maybe_similar(group, bounds)}
    similar = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b))
    needed = {i for i, a in enumerate(sets) if any(i != j and similar(a, b) for j, b in enumerate(sets))}
    assert needed <= left and len(left) < len(sets)
    one = [(i, 7, n, s) for i, _, n, s in group]  # all of one component: nothing is left to look at
    assert list(join.maybe_similar(one, bounds)) == []
