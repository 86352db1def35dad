"""Token counts and records against the libraries on whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from frames import SF, awkward
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cardwarden.llm import records, tokens
from cardwarden.llm.common import WordCache, table
from cardwarden.llm.crc32c import TABLE, crc32c, masked
from cardwarden.sources.scratch import scratch_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
MERGES = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "  ", "\n", "hello  world", " lead", "trail  ", "a b　c", "▁x a▁b ▁", "<s>hi</s> <unk> <0x0A>",
    "line\n\n next\r\nline", "A\tB", "x\x00y", "İstanbul ﬁ é é ǅ Σς ÉCOLE", "日本語。テスト", "it's 'll ''d they'RE",
    "a…. —. b'. 12.5 km²", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "x" * 3000, "word " * 5000,
    "same text", "same text", "\x1c\x85  y", "😀 ok 😀😀",
]
LETTERS = st.text(st.sampled_from("ab Zé'.,!\n\t▁1²<|>ßİ́ 日"), max_size=40)


def test_piece_lengths(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = tokens.token_counts(awkward(spark, TEXTS), PIECES, token_limit=4000).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        n = len(model.encode(TEXTS[r.doc_id] or ""))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((TEXTS[r.doc_id] or "").encode()), n > 4000)
    assert tokens.piece_model(PIECES).splits
    assert tokens.token_counts(awkward(spark, []).limit(0), PIECES).count() == 0
    few = tokens.token_counts(awkward(spark, ["a", "a"], [None, None]), PIECES, frequent=1).collect()
    assert [(r.doc_id, r.n_tokens) for r in few] == [(None, 1)] * 2


@settings(max_examples=400, deadline=None, derandomize=True)
@given(LETTERS)
def test_random_texts(text):
    pieces, merges = tokens.piece_model(PIECES), tokens.merge_model(MERGES)
    assert sum(map(pieces.length, pieces.pre_tokens(text))) == pieces.count(text)
    assert merges.encode([text]) == [merges.raw(text)]


def test_texts_as_a_whole():
    merges = tokens.merge_model(MERGES)
    assert merges.by_part and merges.by_end
    assert merges.encode([t or "" for t in TEXTS]) == [merges.raw(t or "") for t in TEXTS]


def test_every_code_point_of_simple_texts():
    merges = tokens.merge_model(MERGES)
    simple = [c for c in map(chr, range(0x110000)) if merges.SIMPLE.fullmatch(c.lower())]
    letters = {*simple, *map(chr, range(0x250))}
    texts = [t for c in sorted(letters) for t in (f"{c}an is here", f"x'{c}a {c}{c}", f"a{c}1.{c}", f"don'{c} {c}'s")]
    assert merges.encode(["Ɗan is here"]) == [merges.raw("Ɗan is here")]
    assert [t for t, got in zip(texts, merges.encode(texts), strict=True) if got != merges.raw(t)] == []
    assert merges.cut("Élan is here") and not merges.cut("Ɗan is here")


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr("cardwarden.llm.common.CACHE_WORDS", 10)
    cache = WordCache(len)
    assert [cache["x" * (i % 37)] for i in range(500)] == [i % 37 for i in range(500)]
    assert len(cache) <= 10 and len(cache.old) <= 10
    cache["y" * 100]
    assert "y" * 100 not in cache


def plain(rows):
    model, start, out = Tokenizer.from_file(MERGES), 0, []
    for key, text in rows:
        ids = model.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_records(spark):
    folder = scratch_path(spark, "records")
    df = awkward(spark, TEXTS, [(i * 7) % len(TEXTS) + 100 for i in range(len(TEXTS))])
    manifest = records.write_records(df, folder, MERGES, 1, parts=4)
    rows = records.read_records(spark, folder, manifest).collect()
    ordered = sorted((r.doc_id, r.text) for r in df.collect())
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == plain(ordered)
    assert len({r.file for r in rows}) == manifest.count() > 1
    some = max(rows, key=lambda r: r.record)
    key, ids = records.read_record(folder, some.file, some.record)
    assert key == some.doc_id and zlib.crc32(ids.astype("<u4").tobytes()) == some.ids_crc32
    path = f"{some.file}.rec"
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 1
    open(path, "wb").write(bytes(data))
    with pytest.raises(Exception, match="checksum|cut off"):
        records.read_records(spark, folder, manifest).collect()


def test_awkward_ids(spark):
    df = awkward(spark, ["b", "a", "a", "c", None], [5, None, 5, 5, 2])
    rows = records.binary_output(df, MERGES).collect()
    assert sorted(r.start for r in rows) == [0, 2, 3, 5, 7]
    assert {r.doc_id for r in rows if r.start == 0} == {None}
    assert records.binary_output(df.limit(0), MERGES).count() == 0


def test_checksums():
    strings = [b"123456789", b"", b"a", b"xyz", b"abcd", b"\0" * 32, bytes(range(256)) * 5, b"q" * 255, b"q" * 257]

    def slow(data):
        rest = 0xFFFFFFFF
        for b in data:
            rest = int(TABLE[(rest ^ b) & 255]) ^ (rest >> 8)
        return rest ^ 0xFFFFFFFF

    assert crc32c(strings).tolist() == [slow(s) for s in strings]
    assert int(crc32c([b"123456789"])[0]) == 0xE3069283  # the check value of CRC-32C
    one = 0xE3069283
    assert int(masked(crc32c([b"123456789"]))[0]) == (((one >> 15) | (one << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def test_query_on_the_tables(spark):
    from cardwarden.llm.queries import op6_token_counts, op8_binary_output

    docs = sorted((r.doc_id, r.text) for r in table(spark, SF, "documents").collect())
    assert sorted(map(tuple, op8_binary_output(spark, SF).collect())) == plain(docs)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: r.n_tokens for r in op6_token_counts(spark, SF).collect()}
    assert got == {k: len(model.encode(t or "")) for k, t in docs}
