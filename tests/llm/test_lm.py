"""Language-model scores against plain counting, and the trie against dictionaries."""

import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from frames import SF, awkward
from pyspark.sql import functions as F

from cardwarden.llm import eliasfano, lm
from cardwarden.llm.common import byte_words, table

END = b""


def plain(rows, held, prior=lm.PRIOR):
    """(n_tokens, n_known, N, base, score) of each row, without quantised weights."""
    word, pair, context = Counter(), Counter(), Counter()
    for (_, text), out in zip(rows, held):
        if not out:
            stream = [None, *byte_words(text), END]
            word.update(stream[1:])
            pair.update(zip(stream, stream[1:]))
            context.update(stream[:-1])
    n, v = sum(word.values()), len(word)
    unigram = lambda w: (word[w] + 1) / (n + v + 1)
    out = []
    for _, text in rows:
        stream = [None, *byte_words(text), END]
        base = sum(log10(unigram(w)) for w in stream[1:])
        score = sum(log10((pair[u, w] + prior * unigram(w)) / (context[u] + prior)) for u, w in zip(stream, stream[1:]))
        out.append((len(stream) - 1, sum(word[w] > 0 for w in stream[1:]), n, base, score))
    return out


def same(rows, expected):
    for r, (n_tokens, n_known, n, base, score) in zip(rows, expected, strict=True):
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert r.score == pytest.approx(score, rel=0.02, abs=0.05)  # quantised weights


TEXTS = [None, "", "\t\n", "the cat sat", "The CAT sat on the mat", "the the the the", "unseen words here", "a b c " * 400,
         "x" * 5000, "é É ß", "the cat sat", "the cat sat"]


def test_scores(spark):
    rows = list(enumerate(TEXTS))
    held = [i % 5 == 1 for i in range(len(TEXTS))]
    got = lm.language_scores(awkward(spark, TEXTS), F.col("doc_id") % 5 == 1).collect()
    got.sort(key=lambda r: r.doc_id)
    assert [r.held_out for r in got] == held
    same(got, plain(rows, held))


def test_null_ids_no_training_and_none(spark):
    ids = [None, 3, 3, *range(4, 13)]
    got = lm.language_scores(awkward(spark, TEXTS, ids), F.col("doc_id") > 8).collect()
    rows = list(zip(ids, TEXTS))
    expected = plain(rows, [i is not None and i > 8 for i in ids])
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known) for r in got) == sorted(
        (str(i), e[0], e[1]) for (i, _), e in zip(rows, expected)
    )
    untrained = lm.language_scores(awkward(spark, TEXTS), F.lit(True)).collect()
    same(sorted(untrained, key=lambda r: r.doc_id), plain(list(enumerate(TEXTS)), [True] * len(TEXTS)))
    assert lm.language_scores(awkward(spark, TEXTS).limit(0), F.lit(False)).count() == 0


def test_split_contexts_give_the_same():
    word = np.arange(1, 4000)
    hot = lm.split_shard(np.full(len(word), 7), word, np.full(len(word), 900), 1000, 20)
    assert np.bincount(hot, minlength=20).max() < len(word) / 10  # a hot context is spread
    cold = lm.split_shard(np.full(len(word), 7), word, np.full(len(word), 3), 1000, 20)
    assert len(set(cold.tolist())) == 1


def test_query_on_the_tables(spark):
    from cardwarden.llm.queries import op10_language_scores

    rows = sorted((r.doc_id, r.text) for r in table(spark, SF, "documents").collect())
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    got = sorted(op10_language_scores(spark, SF).collect(), key=lambda r: r.doc_id)
    assert [r.held_out for r in got] == held
    same(got, plain(rows, held))
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_scores_do_not_depend_on_the_session(spark):
    docs = table(spark, SF, "documents")
    name, found = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(name)
    try:
        for partitions in ("3", "40"):
            spark.conf.set(name, partitions)
            rows = lm.language_scores(docs, F.col("doc_id") % 7 == 2).collect()
            found.append(sorted((r.doc_id, r.score, r.base_score) for r in rows))
    finally:
        spark.conf.set(name, before)
    assert found[0] == found[1] and found[0]


def test_chunks_are_shuffled_once(spark, capsys):
    found = lm.language_scores(table(spark, SF, "documents"), F.col("doc_id") % 7 == 2)
    assert found.count()
    found.collect()
    found.explain()
    plan = capsys.readouterr().out.split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1
    assert plan.count("+- Exchange hashpartitioning(chunk") == 2  # chunks with their words' counts, weights
    assert "words#" not in plan


@pytest.mark.parametrize("top", [1, 255, 256, 1 << 17, 1 << 24, 1 << 40, (1 << 63) - 1])
def test_packed_columns(top):
    rng = np.random.default_rng(5)
    for n in (0, 1, 20_000):
        columns = rng.integers(0, top, n), rng.integers(0, 2, n).astype(np.uint16)
        assert all((a == b).all() for a, b in zip(columns, lm.unpack(lm.pack(*columns)), strict=True))
    bits = lm.pack(rng.integers(0, top, 200_000))
    assert len(bits) < 200_000 * (int(top).bit_length() / 8 + 0.1) + 100  # not much beyond the bits there are


def test_packed_bigrams():
    rng = np.random.default_rng(6)
    pairs = np.unique(rng.integers(0, 300, 9000) * 100_000 + rng.integers(0, 50_000, 9000))
    context, word = pairs // 100_000 * 977, pairs % 100_000
    counts, total = rng.integers(0, 9, len(pairs)), context % 1000
    for own in (slice(None), slice(0, 1), slice(5, 40)):
        columns = context[own], word[own], counts[own], total[own]
        data = lm.bigram_entries(*columns)
        assert all((a == b).all() for a, b in zip(columns, lm.read_bigrams(data), strict=True))
    assert len(lm.bigram_entries(context, word, counts, total)) < 2.4 * len(pairs)


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (1, 10**12), (5, 3), (1000, 10**6), (30000, 2**40), (5000, 5001)])
def test_sequences(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n))
    sequence = eliasfano.Sequence(eliasfano.MappedArrays(eliasfano.encoded(values, "s")), "s")
    if n:
        assert (sequence.access(np.arange(n)) == values.astype(np.uint64)).all()
    asked = np.concatenate([values, rng.integers(0, top + 9, 500)])
    place, known = sequence.find(asked), set(values.tolist())
    assert [p >= 0 for p in place.tolist()] == [x in known for x in asked.tolist()]
    assert (values[place[place >= 0]] == asked[place >= 0]).all()


def test_trie():
    rng = np.random.default_rng(1)
    pairs = np.unique(rng.integers(0, 50, 4000) * 1000 + rng.integers(0, 900, 4000))
    context, word = pairs // 1000, pairs % 1000
    contexts, first = np.unique(context, return_index=True)
    lowest = 1e-6
    weights = np.maximum(rng.random(len(pairs)), lowest)
    weights[:2] = lowest, 1.0
    trie = eliasfano.BigramTrie(contexts * 3, np.append(first, len(pairs)), word, weights, lowest)
    got = eliasfano.code_book(lowest)[trie.codes(context * 3, word)]
    spread = -np.log(lowest) / eliasfano.LEVELS
    assert (np.abs(np.log(got / weights)) <= 0.501 * spread).all()
    known = set(zip((context * 3).tolist(), word.tolist()))
    c, w = rng.integers(0, 160, 5000), rng.integers(0, 1000, 5000)
    assert [x > 0 for x in trie.codes(c, w)] == [(a, b) in known for a, b in zip(c.tolist(), w.tolist())]
    assert trie.arrays.n_bytes < 8 * len(pairs)
