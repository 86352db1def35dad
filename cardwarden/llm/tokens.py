"""Token counts and token ids of whole texts, worked out once a word."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import CACHE_WORD_BYTES, CACHE_WORDS, WordCache, kept, texts_of

#: Entries of the shared table of frequent pre-tokens, each of CACHE_WORD_BYTES characters at most.
FREQUENT = 16_384
#: Pre-tokens that one task may count at a time, and reports.
COUNTED, REPORTED = 200_000, 8_192

#: Words of a generation of the cache of token ids, which cost most to work out.
ID_WORDS = 400_000
#: New words that are encoded as one text.
JOINED = 500


class PieceModel:
    """A sentencepiece model and how a text falls into pre-tokens that cannot affect each other.

    No piece goes on after a blank that follows another character, and none holds a line feed:
    so a text is cut before each run of blanks and before each line feed, and its tokens are
    those of the parts. A model with other pieces is applied to whole texts.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        across = any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        raw = "a  b\nﬁ ÅÅ　 "
        as_is = self.model.decode(self.model.encode(raw)) == raw
        self.splits = as_is and not across and self.count("▁") == 1 + self.count("a ▁") - self.count("a ")
        self.blank = self.count("a ") - self.count("a")
        self.lengths = WordCache(self.length)

    def count(self, text: str) -> int:
        return len(self.model.encode(text, num_threads=1))

    def pre_tokens(self, text: str) -> list[str]:
        if not self.splits:
            return [text] if text else []
        return re.findall(r" +[^ \n]*|\n[^ \n]*", " " + text.replace("▁", " ")) if text else []

    def length(self, part: str) -> int:
        """Tokens of a pre-token in its place: the model puts one blank before any text."""
        if not self.splits:
            return self.count(part)
        if part == " ":
            return self.blank
        return self.count(part[1:]) if part[0] == " " else self.count(part) - self.blank


class MergeModel:
    """A tokenizers file whose pre-tokens are runs of letters, digits and other characters.

    Texts of ASCII and Latin letters are then put together from their pre-tokens, each of which
    is encoded once. Texts with other characters or with the string of an added token, and all
    texts of models with other rules, are encoded as a whole.
    """

    #: Lower-case texts made of nothing but ASCII and the letters of PARTS.
    SIMPLE = re.compile("[\\x00-\\x7fß-öø-ɏ]*")
    PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ɏ]+|[0-9]|[^ \\t-\\ra-zß-öø-ɏ0-9]+")
    PROBE = "Anna's, LIEF. It's 12.5 km!? été… ñ-x a.b (c) <d>\n\t 'll ''d \x1c ok;"

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        # for runs of small letters, whose normal form and pre-token they are themselves
        self.of_runs = Tokenizer(self.model.model)
        self.of_runs.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        size = self.model.get_vocab_size(with_added_tokens=True)
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        self.added = [t.content.lower() for t in self.model.get_added_tokens_decoder().values()]
        self.ends = np.zeros(1 + max(self.model.get_vocab(with_added_tokens=True).values()), bool)
        for token, number in self.model.get_vocab(with_added_tokens=False).items():
            self.ends[number] = token.endswith("</w>")
        self.parts = WordCache(self.raw, ID_WORDS)
        probe = self.PROBE.replace("…", "")
        self.by_part = b"".join(map(self.raw, self.PARTS.findall(probe.lower()))) == self.raw(probe)
        self.by_end = all(self._ends_once(w) for w in ("ab", "zqxj", "été", "inandthion"))
        runs = ["été", "straße", "inandthion", "ɏœǆ", *map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x250)])]
        runs = [r for r in runs if r == r.lower()]
        if [e.ids for e in self.of_runs.encode_batch(runs)] != [
            e.ids for e in self.model.encode_batch(runs, add_special_tokens=False)
        ]:
            self.of_runs = self.model

    def _ends_once(self, word: str) -> bool:
        return self.ends[np.frombuffer(self.raw(word), self.kind)].nonzero()[0].tolist() == [
            len(self.raw(word)) // np.dtype(self.kind).itemsize - 1
        ]

    def raw(self, text: str) -> bytes:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def cut(self, text: str) -> list[str] | None:
        """Pre-tokens of a simple text; None for others."""
        if not self.by_part:
            return None
        text = text.lower()  # some capitals of Latin letters have small ones outside of SIMPLE
        return None if not self.SIMPLE.fullmatch(text) or any(a in text for a in self.added) else self.PARTS.findall(text)

    def learn(self, parts: set[str]) -> None:
        """Encode the new runs of letters among many at once, told apart by their last tokens."""
        new = parts.difference(self.parts).difference(self.parts.old)
        new = [p for p in new if p.isalpha() and len(p) <= CACHE_WORD_BYTES]
        if not new or not self.by_end:
            return
        joined = ["\n".join(new[i:i + JOINED]) for i in range(0, len(new), JOINED)]
        coded = [e.ids for e in self.of_runs.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.array([i for part in coded for i in part], self.kind)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(new):
            return  # they are then encoded one by one
        flat, width, start = ids.tobytes(), ids.itemsize, 0
        for part, stop in zip(new, (stops * width).tolist(), strict=True):
            self.parts.put(part, flat[start:stop])
            start = stop

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text, as bytes of type ``kind``."""
        known, cuts, found, open_ = self.parts.get, [self.cut(t) for t in texts], [], []
        for number, parts in enumerate(cuts):
            ids = None if parts is None else list(map(known, parts))
            if ids and None in ids:
                open_.append((number, [k for k, own in enumerate(ids) if own is None]))
            found.append(ids)
        fresh: set[str] = set()
        for number, places in open_:
            parts = cuts[number]
            fresh.update([parts[k] for k in places])
            if len(fresh) > CACHE_WORDS // 4:
                self.learn(fresh)
                fresh = set()
        self.learn(fresh)
        for number, places in open_:
            parts, ids = cuts[number], found[number]
            for k in places:
                ids[k] = self.parts[parts[k]]
        return [self.raw(t) if ids is None else b"".join(ids) for t, ids in zip(texts, found, strict=True)]


def piece_model(path: str) -> PieceModel:
    """The model, loaded once by each process that works on nothing else meanwhile."""
    return kept("piece", path, lambda: PieceModel(path))


def merge_model(path: str) -> MergeModel:
    return kept("merge", path, lambda: MergeModel(path))


def frequent_lengths(texts: DataFrame, path: str, limit: int = FREQUENT) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens of a column ``text``.

    Every task counts the pre-tokens of all its texts, forgetting the rare ones whenever it
    holds more than COUNTED, and reports REPORTED rows at most. Which pre-tokens are found
    only decides how fast counting is, never what it gives.
    """

    def report(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, seen = piece_model(path), Counter()
        for frame in frames:
            for text in texts_of(frame, "text"):
                seen.update(model.pre_tokens(text))
                if len(seen) > COUNTED:
                    seen = Counter(dict(seen.most_common(COUNTED // 4)))
        top = [(w, n) for w, n in seen.most_common(REPORTED) if len(w) <= CACHE_WORD_BYTES]
        if top:
            yield pd.DataFrame({"word": [w for w, _ in top], "n": np.array([n for _, n in top], np.int64)})

    counted = texts.mapInPandas(report, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    model = piece_model(path)
    rows = counted.orderBy(F.desc("n"), "word").limit(limit).collect()  # bounded by limit
    return {r.word: model.length(r.word) for r in rows}


def token_counts(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
    token_limit: int = 4096, frequent: int = FREQUENT,
) -> DataFrame:
    """One row (id, ``n_bytes``, ``n_tokens``, ``over_limit``) for each row of ``docs``.

    ``n_tokens`` is the length the sentencepiece library gives for the whole text, without begin
    and end marks; ``over_limit`` says whether it exceeds ``token_limit``. NULL and empty texts
    have 0 tokens and bytes. Rows with a NULL id and repeated rows are each returned; an empty
    table gives no rows; other columns are ignored. ``model_path`` must name the file on every
    machine.

    Two tiers of lookup: the lengths of the most frequent pre-tokens (at most ``frequent``) are
    broadcast; others are encoded once and kept in the cache of the worker process. No pre-token
    is shuffled, only each task's short list of frequent ones.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(frequent_lengths(rows.select("text"), model_path, frequent))
    kind = docs.schema[id_col].dataType.simpleString()

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = piece_model(model_path)
        lengths = WordCache(model.lengths.__getitem__)
        lengths.update(shared.value)
        for frame in frames:
            texts = texts_of(frame, "text")
            tokens = [sum(map(lengths.__getitem__, model.pre_tokens(t))) for t in texts]
            size = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pd.DataFrame({
                "id": frame["id"], "n_bytes": np.array(size, np.int64), "n_tokens": np.array(tokens, np.int64),
            })

    counted = rows.mapInPandas(count, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens",
        (F.col("n_tokens") > token_limit).alias("over_limit"),
    )
