"""The pipeline: each stage on its own input against brute force, and the run as their sequence."""

import sys
from collections import Counter

import pytest
from frames import SF
from test_decontaminate import plain as plain_matches
from test_mixing import plain as plain_mix
from test_simhash import plain_groups, plain_print, smallest
from test_tokens import plain as plain_records

import corpus_pipeline
from cardwarden.llm.common import table
from cardwarden.llm.queries import op4_quality
from cardwarden.sources.scratch import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """Rows before the first and after each stage."""
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        out.append(docs)
    return [df.collect() for df in out], [df.columns for df in out]


def test_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "mixing", "records",
    ]
    assert steps[1][:5] == [COLUMNS] * 5


def test_quality(spark, steps):
    kept = {r.doc_id for r in op4_quality(spark, SF).collect() if r.kept}
    assert Counter(steps[0][1]) == Counter(r for r in steps[0][0] if r.doc_id in kept)
    assert 0 < len(kept) < len(steps[0][0])


def test_near_duplicates(steps):
    rows = sorted(steps[0][1], key=lambda r: r.doc_id)
    first = smallest([r.doc_id for r in rows], plain_groups([plain_print(r.text) for r in rows], 2))
    assert Counter(steps[0][2]) == Counter(r for r, f in zip(rows, first) if r.doc_id == f)


def test_decontamination(spark, steps):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    bad = {key for key, _ in plain_matches([(r.doc_id, r.text) for r in steps[0][2]], items)}
    assert Counter(steps[0][3]) == Counter(r for r in steps[0][2] if r.doc_id not in bad)


def test_mixing(steps):
    taken = plain_mix([(r.doc_id, r.source, r.text) for r in steps[0][3]])
    times = {k: t // n if n else 0 for k, (n, _, _, t) in taken.items()}
    assert Counter(steps[0][4]) == Counter({r: times[r.doc_id] for r in steps[0][3] if times[r.doc_id]})


def test_records(steps):
    rows = sorted((r.doc_id, r.text) for r in steps[0][4])
    assert sorted(map(tuple, steps[0][5])) == plain_records(rows)


def test_run_is_the_sequence(spark, steps):
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == Counter(map(tuple, steps[0][5]))


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert sys.modules["corpus_pipeline"].ORACLE_SQL is None
