"""Repeated bytes against a set of all strings seen before."""

import hashlib
import random
from types import SimpleNamespace

import numpy as np
import pytest
import zstandard
from frames import SF, awkward, by_id

from cardwarden.llm import suffixes
from cardwarden.llm.common import table

COLUMNS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def plain(rows, length=suffixes.LENGTH):
    seen, out = set(), []
    for key, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            if data[s:s + length] in seen:
                gone[s:s + length] = True
            seen.add(data[s:s + length])
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(len(gone) > 0 and gone[0])
        kept = hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()
        out.append((key, len(data), int(gone.sum()), spans, kept))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, str(r[1:])))


def texts():
    rnd = random.Random(3)
    some = lambda letters, a, b: "".join(rnd.choice(letters) for _ in range(rnd.randint(a, b)))
    passage = "A passage that many texts share is at least a little longer than one hundred bytes, as it has to be here."
    out = ["x" * 500, "ab" * 200, "é" * 120 + "z", "", None, "q" * 99, "q" * 100, "q" * 100]
    out += [some("ab", 50, 900) for _ in range(30)]
    out += [some("abcdefgh ", 0, 200) + passage + some("abcdefgh ", 0, 200) for _ in range(50)]
    out += [out[i][20:200] + out[j][:150] for i in range(50, 60) for j in range(40, 43)]
    return out


def test_all_cases(spark):
    made = texts()
    got = by_id(suffixes.repeated_bytes(awkward(spark, made)), *COLUMNS)
    assert got == plain(enumerate(made))


def test_every_window_is_in_one_run_of_some_block(monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 256)
    row = SimpleNamespace()
    data = "".join(t or "" for t in texts()).encode()
    row.chunk, row.ids = 0, np.zeros(1, "<i8").tobytes()
    row.known, row.sizes = np.ones(1, "u1").tobytes(), np.array([len(data)], "<i8").tobytes()
    row.text = zstandard.ZstdCompressor().compress(data)
    runs = suffixes.Chunk(row).runs()
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(runs.first, runs.last)])
    assert (starts == np.arange(len(data) - suffixes.LENGTH + 1)).all()
    names = suffixes.Chunk(row).window_names(starts)
    by_text = {}
    for s, name in zip(starts.tolist(), names.tolist()):
        assert by_text.setdefault(data[s:s + suffixes.LENGTH], name) == name
    assert len(set(by_text.values())) == len(by_text)


def test_null_and_repeated_ids(spark):
    a, b = "y" * 30 + "".join(map(str, range(90))), "z" * 150
    rows = [(None, a), (None, b), (4, a), (4, a), (4, b), (9, b)]
    df = awkward(spark, [t for _, t in rows], [i for i, _ in rows], parts=1)
    got = by_id(suffixes.repeated_bytes(df), *COLUMNS)
    assert got == plain(rows)


def test_empty_and_all_tiny(spark):
    assert suffixes.repeated_bytes(awkward(spark, []).limit(0)).count() == 0
    got = by_id(suffixes.repeated_bytes(awkward(spark, [None, "", "a"])), *COLUMNS)
    assert [r[1:4] for r in got] == [(0, 0, 0), (0, 0, 0), (1, 0, 0)]


@pytest.mark.parametrize("width", [1, 2, 5, 69])
def test_smallest_of_a_window(width):
    values = np.random.default_rng(0).integers(0, 50, 400).astype(np.uint64)
    got = suffixes.least(values, width)
    assert got.tolist() == [values[i:i + width].min() for i in range(len(values) - width + 1)]


def test_query_on_the_tables(spark):
    docs = table(spark, SF, "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert by_id(suffixes.repeated_bytes(docs), *COLUMNS) == plain(rows)
