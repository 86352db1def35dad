"""Benchmark passages against all windows of all texts."""

import random

import numpy as np
from frames import SF, awkward

from cardwarden.llm import decontaminate as dc
from cardwarden.llm.common import byte_words, table

ITEM = "item_id bigint, text string, doc_id string"


def plain(docs, items):
    out = set()
    for key, text in docs:
        words = byte_words(text)
        for item, passage in items:
            own = byte_words(passage)
            if own and any(
                dc.weighted_similarity(dc.shingles(words[s:s + len(own)]), dc.shingles(own)) >= 0.8
                for s in range(len(words) - len(own) + 1)
            ):
                out.add((key, item))
    return out


def made():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(rnd.randint(10, 60)))) for i in range(12)]
    items += [(20, "one two three"), (21, "solo"), (22, None), (23, ""), (24, items[0][1])]
    filler = lambda n: " ".join(word() for _ in range(n))
    docs = [filler(200), None, "", "solo", "One TWO three", "two three one"]
    for _, passage in items[:12]:
        own = passage.split()
        changed = list(own)
        changed[len(own) // 2] = "zzz"
        docs += [f"{filler(30)} {passage.upper()}\n{filler(9)}", " ".join(changed), " ".join(own[: len(own) // 2]),
                 filler(5) + " " + " ".join(own[1:]) + " " + filler(5), f"{passage} {passage}"]
    return docs, items


def test_all_windows(spark):
    docs, items = made()
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], ITEM)
    found = dc.benchmark_matches(awkward(spark, docs), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == plain(enumerate(docs), items)
    for r in found:
        own = byte_words(docs[r.doc_id])[r.first_word:r.first_word + r.n_words]
        passage = dc.shingles(byte_words(dict(items)[r.item_id]))
        assert abs(dc.weighted_similarity(dc.shingles(own), passage) - r.similarity) < 1e-12
    clean = dc.clean_documents(awkward(spark, docs), benchmark)
    assert {r.doc_id for r in clean.collect()} == set(range(len(docs))) - {r.doc_id for r in found}
    assert clean.columns == awkward(spark, []).columns


def plain_short(docs, items):
    """Documents with fewer words than an item that are similar to it as a whole."""
    weights = {i: dc.shingles(byte_words(t)) for i, t in items}
    return {
        (key, i) for key, text in docs for i, passage in items
        if 0 < len(byte_words(text)) < len(byte_words(passage))
        and dc.weighted_similarity(dc.shingles(byte_words(text)), weights[i]) >= 0.8
    }


def test_documents_shorter_than_the_item(spark):
    docs, items = made()
    for _, passage in items[:12]:
        own = passage.split()
        docs += [" ".join(own[:-2]), " ".join(own[1:-1]), " ".join(own[3:]), " ".join(own[:-1]).upper(), " ".join(own[-4:])]
    docs += ["one two", "two three", "a b c d"]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], ITEM)
    found = dc.benchmark_matches(awkward(spark, docs), benchmark).collect()
    short = plain_short(enumerate(docs), items)
    assert len(short) > 30 and {(r.doc_id, r.item_id) for r in found} == plain(enumerate(docs), items) | short
    for r in found:
        if (r.doc_id, r.item_id) in short:
            words, passage = byte_words(docs[r.doc_id]), byte_words(dict(items)[r.item_id])
            assert (r.first_word, r.n_words) == (0, len(words))
            assert abs(dc.weighted_similarity(dc.shingles(words), dc.shingles(passage)) - r.similarity) < 1e-12
    clean = dc.clean_documents(awkward(spark, docs), benchmark)
    assert {r.doc_id for r in clean.collect()} == set(range(len(docs))) - {r.doc_id for r in found}


def test_benchmark_in_blocks(spark, monkeypatch):
    docs, items = made()
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], ITEM)
    blocks = list(dc.item_blocks(benchmark, "item_id", "text", limit=600))
    assert len(blocks) > 3 and sorted(r.item for b in blocks for r in b) == sorted(i for i, _ in items)


def test_empty_tables(spark):
    docs, items = made()
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], ITEM)
    assert dc.benchmark_matches(awkward(spark, docs), benchmark.limit(0)).count() == 0
    assert dc.benchmark_matches(awkward(spark, docs).limit(0), benchmark).count() == 0
    assert dc.clean_documents(awkward(spark, docs), benchmark.limit(0)).count() == len(docs)


def test_blocks_find_all_near_fingerprints():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 5).astype(np.int64)
    prints = []
    for b in base.view(np.uint64).tolist():
        for flips in range(0, 40, 2):
            for place in rng.choice(64, flips, replace=False):
                b ^= 1 << int(place)
            prints.append(b)
    prints = np.array(prints, np.uint64)
    group = dc.size_class(list(range(5)), base.tolist(), dc.RADIUS)
    window, item = dc.near_items(prints, group, dc.RADIUS)
    near = np.bitwise_count(prints[:, None] ^ base.view(np.uint64)[None, :]) <= dc.RADIUS
    assert set(zip(window.tolist(), item.tolist())) == set(zip(*(a.tolist() for a in np.nonzero(near))))


def test_query_on_the_tables(spark):
    from cardwarden.llm.queries import op3_decontamination

    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert {(r.doc_id, r.item_id) for r in op3_decontamination(spark, SF).collect()} == plain(docs, items)
