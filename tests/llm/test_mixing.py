"""Mixing against plain Python, and its SQL."""

import hashlib
import re

import pytest
from compare import duck, duck_rows, spark_rows
from frames import SF, awkward

from cardwarden.llm import mixing, selection
from cardwarden.llm.queries import ORACLES, QUERIES


def plain(rows, weights=(3, 1, 2), share=1.5, repeats=2, seed=7):
    """(id, source, text) to size, target and taken, with equal sources filled step by step."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    total = {s: sum(size(t) for _, x, t in rows if x == s) for s in sources}
    budget, target, open_ = share * sum(total.values()), {}, set(sources)
    while True:
        left = budget - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if repeats * total[s] < level * weight[s]}
        if not full:
            target.update({s: level * weight[s] for s in open_})
            break
        target.update({s: repeats * total[s] for s in full})
        open_ -= full
    items = []
    for s in sources:
        own = [r for r in rows if r[1] == s]
        own.sort(key=lambda r: hashlib.md5(f"{'null' if r[0] is None else r[0]}:{seed}".encode()).hexdigest())
        for copy in range(repeats):
            done = 0
            for r in own:
                done += size(r[2])
                if size(r[2]):
                    key = ((done + copy * total[s]) / target[s], (s is not None, s or ""), copy)
                    items.append((key, r, size(r[2])))
    taken, used = {}, 0
    for _, r, n in sorted(items, key=lambda i: i[0]):
        used += n
        if used > int(budget):
            break
        taken[r[0]] = taken.get(r[0], 0) + n
    return {r[0]: (size(r[2]), total[r[1]], target[r[1]], taken.get(r[0], 0)) for r in rows}


def documents():
    texts = [" ".join(["w"] * (i * 7 % 23)) for i in range(60)] + [None, "", "\t \n", "one"]
    sources = [f"s{i % 4}" for i in range(60)] + [None, "ä", "Z", None]
    return texts, sources


def test_against_plain_python(spark):
    texts, sources = documents()
    ids = [*range(63), None]
    got = {r.doc_id: r for r in mixing.mix(awkward(spark, texts, ids, sources)).collect()}
    expected = plain(list(zip(ids, sources, texts)))
    assert len(got) == 64
    for key, (size, total, target, taken) in expected.items():
        r = got[key]
        assert (r["size"], r.source_size, r.taken) == (size, total, taken)
        assert r.target == pytest.approx(target) and r.taken <= 2 * r["size"]


def test_reruns_and_sources(spark):
    texts, sources = documents()
    df = awkward(spark, texts, None, sources)
    a = sorted(map(tuple, mixing.mix(df).collect()), key=str)
    assert a == sorted(map(tuple, mixing.mix(df.repartition(7)).collect()), key=str)
    rows = mixing.mix(df).groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["max(target)"]) <= 2 * r["max(size)"] + 1 for r in rows)


def test_repeated_and_empty(spark):
    same = awkward(spark, ["a b c"] * 3 + ["d"], [1, 1, 1, 2])
    rows = mixing.mix(same).collect()
    assert len(rows) == 4 and sum(r.taken for r in rows) <= 15
    out = mixing.mixed_documents(same)
    assert out.columns == same.columns
    assert sum(len(r.text.split()) for r in out.collect()) == sum(r.taken for r in rows)
    assert mixing.mix(same.limit(0)).count() == 0
    assert mixing.mixed_documents(same.limit(0)).count() == 0
    assert [r.taken for r in mixing.mix(awkward(spark, [None, ""])).collect()] == [0, 0]


def test_documents_as_often_as_taken(spark):
    texts, sources = documents()
    df = awkward(spark, texts, None, sources)
    copies = {r.doc_id: r.copies for r in mixing.mix(df).collect()}
    seen = {}
    for r in mixing.mixed_documents(df).collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {k: v for k, v in copies.items() if v}


def test_pieces_of_a_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN_ROWS", 5)
    monkeypatch.setattr(selection, "LAST_ROWS", 3)
    monkeypatch.setattr(selection, "SLICES", 4)
    texts, sources = documents()
    ids = list(range(64))
    got = {r.doc_id: r.taken for r in mixing.mix(awkward(spark, texts, ids, sources)).collect()}
    assert got == {k: v[3] for k, v in plain(list(zip(ids, sources, texts))).items()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    got = spark_rows(QUERIES[name](spark, SF))
    assert got == duck_rows(duck(SF), ORACLES[name]) and got[1]
