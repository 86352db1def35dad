"""SimHash groups against all pairs."""

import numpy as np
import pytest
import xxhash
from frames import SF, awkward

from cardwarden.llm import simhash
from cardwarden.llm.common import byte_words, table
from cardwarden.llm.components import components


def plain_print(text, size=3):
    words = byte_words(text)
    runs = [words[i:i + size] for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if runs else 0


def plain_groups(prints, bits):
    prints = np.array(prints, np.uint64)
    group = list(range(len(prints)))
    for i in range(len(prints)):
        near = np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= bits)
        for j in {group[k] for k in near}:
            group = [group[i] if g == j else g for g in group]
    return group


def smallest(ids, group):
    out = {}
    for i, g in zip(ids, group):
        if i is not None:
            out[g] = min(out.get(g, i), i)
    return [out.get(g) for g in group]


def texts():
    base = "the quick brown fox jumps over a lazy dog near the bank of a river that runs to the sea and back"
    words = (base * 12).split()
    out = [None, "", " \n", "one", "ONE", "two words", base, base.upper(), base]
    for i in range(40):
        own = list(words)
        for j in range(0, i % 9):
            own[(i * 31 + j * 17) % len(own)] = f"x{i % 4}"
        out.append(" ".join(own))
    return out


def test_groups(spark):
    made = texts()
    rows = sorted(simhash.near_duplicates(awkward(spark, made)).collect(), key=lambda r: r.doc_id)
    prints = [plain_print(t) for t in made]
    assert [r.fingerprint for r in rows] == [f"{p:016x}" for p in prints]
    assert [r.component_id for r in rows] == smallest(range(len(made)), plain_groups(prints, 2))
    assert len({r.component_id for r in rows}) < len(made) - 8


def test_null_and_repeated_ids(spark):
    made, ids = ["", None, "a b c d", "a b c d", "a b c d", "q r s"], [None, 7, 5, 5, None, None]
    rows = simhash.near_duplicates(awkward(spark, made, ids)).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in rows) == [
        ("5", "5"), ("5", "5"), ("7", "7"), ("None", "5"), ("None", "7"), ("None", "None"),
    ]
    kept = simhash.one_of_each(awkward(spark, made, ids))
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [
        ("5", "a b c d"), ("7", "None"), ("None", "q r s"),
    ]
    assert kept.columns == awkward(spark, []).columns
    none = awkward(spark, []).limit(0)
    assert simhash.near_duplicates(none).count() == 0 and simhash.one_of_each(none).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_for_any_radius(spark, bits):
    rng = np.random.default_rng(bits)
    prints = []
    for _ in range(12):
        p = int(rng.integers(0, 2**63))
        for _ in range(6):
            for place in rng.choice(64, int(rng.integers(1, 4)), replace=False):
                p ^= 1 << int(place)
            prints.append(p)
    prints = list(dict.fromkeys(prints))
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    links = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), bits)
    assert all(bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= bits for r in links.collect())
    root = {r.node: r.root for r in components(links).collect()}
    group = plain_groups(prints, bits)
    got = [root.get(p, p) for p in signed]
    assert [[a == b for a in got] for b in got] == [[a == b for a in group] for b in group]


def test_long_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(0, 300)]
    hub = [(1000, 1001 + i) for i in range(50)]
    df = spark.createDataFrame(path + hub + [(5000, 5000)], "a bigint, b bigint")
    roots = {r.node: r.root for r in components(df).collect()}
    assert roots == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(51)}}


def test_query_on_the_tables(spark):
    from cardwarden.llm.queries import op9_simhash

    docs = sorted((r.doc_id, r.text) for r in table(spark, SF, "documents").collect())
    rows = {r.doc_id: r for r in op9_simhash(spark, SF).collect()}
    prints = [plain_print(t) for _, t in docs]
    assert [rows[i].fingerprint for i, _ in docs] == [f"{p:016x}" for p in prints]
    assert [rows[i].component_id for i, _ in docs] == smallest([i for i, _ in docs], plain_groups(prints, 2))
