"""Language-model scores from smoothed bigrams in Elias-Fano tries, dealt out by context.

The model is an interpolated bigram with a Dirichlet prior (MacKay and Peto, 1995):
P(w | u) = (c(u, w) + m P(w)) / (c(u) + m), with P(w) = (c(w) + 1) / (N + V + 1). Its words are
told apart as bytes. Texts are worked on in chunks. A chunk asks, once for each of its distinct
words, for counts, and once for each of its distinct bigrams, for weights; each shard of words or
bigrams adds up what the chunks have counted, builds its part of the model and answers. So the
model is never in one place, and neither words nor bigrams of any frequency are hot: a chunk
sends each once, and the successors of a frequent context lie in several shards.

A chunk meets the answers twice, but it and the counts of its words are shuffled once: both steps
are one query over the same exchange, which Spark then reuses.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import byte_words, cut_by_shard, mix64, shuffle_shards
from cardwarden.llm.eliasfano import BigramTrie, code_book
from cardwarden.sources.scratch import materialize

#: Tokens of a chunk; a longer text is a chunk of its own.
CHUNK_TOKENS = 1_000_000
#: Weight of the unigram model, in occurrences.
PRIOR = 100.0
#: Number of the mark before a text; words have numbers from 1.
BEGIN = 0
END_WORD = b""
CHUNK = "chunk bigint, ids binary, known binary, held binary, sizes binary, tokens binary, dealt binary, words binary"
#: Columns of a chunk that its later steps need; the words themselves are not among them.
SENT = ("ids", "known", "held", "sizes", "tokens")
ASKED = "shard int, chunk bigint, entries binary"
ANSWER = "shard int, chunk bigint, kind int, entries binary, n bigint, v bigint"


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, each squeezed to the bytes its values need, bytes of equal weight side by side."""
    parts = [np.array([len(columns[0]), len(columns)], "<i8").tobytes()]
    for column in columns:
        top = int(column.max()) if len(column) else 0
        width = max(1, (top.bit_length() + 7) // 8)
        raw = np.ascontiguousarray(column, "<i8").view("u1").reshape(-1, 8)
        parts += [bytes([width]), raw[:, :width].T.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(data)
    n, columns = (int(x) for x in np.frombuffer(raw, "<i8", 2))
    at, out = 16, []
    for _ in range(columns):
        width = raw[at]
        wide = np.zeros((n, 8), "u1")
        wide[:, :width] = np.frombuffer(raw, "u1", width * n, at + 1).reshape(width, n).T
        out.append(wide.view("<i8").ravel())
        at += 1 + width * n
    return out


def pack_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b" ".join(words))


def unpack_words(data: bytes, n: int) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompressobj().decompress(data).split(b" ") if n else []


class Chunk:
    """Texts as numbers of the chunk's own words, which are sorted by shard and bytes."""

    def __init__(self, row):
        self.number = int(row.chunk)
        self.ids = np.frombuffer(row.ids, "<i8")
        self.known = np.frombuffer(row.known, "u1").astype(bool)
        self.held = np.frombuffer(row.held, "u1").astype(bool)
        self.sizes = np.frombuffer(row.sizes, "<i8")  # with the end
        self.tokens = unpack(row.tokens)[0]
        self.n_words = int(self.tokens.max()) + 1

    def training(self) -> np.ndarray:
        return np.repeat(~self.held, self.sizes)


def word_order(words: list[bytes], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words by shard and bytes, and how many each shard has."""
    import xxhash

    shard = np.array([xxhash.xxh64_intdigest(w) % shards for w in words], np.int64)
    order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
    return order[np.argsort(shard[order], kind="stable")], np.bincount(shard, minlength=shards)


def split_shard(context: np.ndarray, word: np.ndarray, context_count: np.ndarray, total: int, shards: int) -> np.ndarray:
    """Shard of a bigram: that of its context, or one of several if the context is frequent.

    A context with the share s of all tokens has its successors in about 1 + s * shards shards.
    """
    ways = 1 + (context_count * shards // max(total, 1)).astype(np.uint64)
    home = mix64(context.astype(np.uint64) + np.uint64(1))
    part = mix64(word.astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) % ways
    return ((home + part) % np.uint64(shards)).astype(np.int64)


class Resolved:
    """A chunk with the global numbers and counts of its words, and its distinct bigrams."""

    def __init__(self, group: pd.DataFrame, n: int, n_begin: int, shards: int):
        """``group`` is the chunk's row and the answers about its words; ``n_begin`` texts are learned from."""
        self.chunk = chunk = Chunk(next(group[group["shard"] < 0].itertuples(index=False)))
        answers = group[group["shard"] >= 0].sort_values("shard")
        parts = [word_answer(e, s, shards) for e, s in zip(answers["entries"], answers["shard"], strict=True)]
        self.number, self.count = (np.concatenate(c) for c in zip(*parts, strict=True))
        tokens = chunk.tokens
        before = np.empty(len(tokens), np.int64)
        before[1:] = tokens[:-1] + 1
        before[np.cumsum(chunk.sizes) - chunk.sizes] = 0  # the mark before a text
        pairs = before * chunk.n_words + tokens
        distinct, self.pair_of = np.unique(pairs, return_inverse=True)
        self.context, self.word = distinct // chunk.n_words - 1, distinct % chunk.n_words
        begin = self.context < 0
        self.context_count = np.where(begin, n_begin, self.count[self.context])
        context, word = np.where(begin, BEGIN, self.number[self.context]), self.number[self.word]
        shard = split_shard(context, word, self.context_count, n, shards)
        self.order = np.lexsort((word, context, shard))
        self.shard = shard[self.order]
        self.columns = context[self.order], word[self.order], self.context_count[self.order]

    def bigram_counts(self) -> np.ndarray:
        return np.bincount(self.pair_of[self.chunk.training()], minlength=len(self.order))[self.order]


def word_answer(data: bytes, shard: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and counts of a chunk's words of one shard."""
    step, seen = unpack(data)
    return np.cumsum(step) * shards + shard + 1, seen


def add_words(group: pd.DataFrame, number: int) -> pd.DataFrame:
    """Counts of a shard's words over all chunks, and a number for each by its rank in the shard."""
    total: dict[bytes, int] = defaultdict(int)
    asked = []
    for chunk, data in zip(group["chunk"], group["entries"], strict=True):
        size = int(np.frombuffer(data, "<i8", 1)[0])
        counts = unpack(data[8:8 + size])[0]
        words = unpack_words(data[8 + size:], len(counts))
        for word, n in zip(words, counts.tolist(), strict=True):
            total[word] += n
        asked.append((chunk, words))
    rank = {word: i for i, word in enumerate(sorted(total))}
    rows = []
    for chunk, words in asked:
        own = np.array([rank[w] for w in words], np.int64)  # ascending, as a chunk's words are
        seen = np.fromiter((total[w] for w in words), np.int64, len(words))
        rows.append((number, chunk, 0, pack(np.diff(own, prepend=0), seen), 0, 0))
    n, v = sum(total.values()), sum(c > 0 for c in total.values())
    rows.append((number, -1, 1, b"", n, v))
    if END_WORD in total:
        rows.append((number, -1, 2, b"", total[END_WORD], 0))
    return pd.DataFrame(rows, columns=["shard", "chunk", "kind", "entries", "n", "v"])


def bigram_entries(context: np.ndarray, word: np.ndarray, counts: np.ndarray, context_count: np.ndarray) -> bytes:
    """Sorted bigrams: contexts once with their counts and number of successors; numbers as steps."""
    first = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
    sizes = np.diff(np.append(first, len(context)))
    step = np.diff(context[first], prepend=0)
    word_step = np.diff(word, prepend=0)
    word_step[first] = word[first]
    head = pack(step, context_count[first], sizes)
    return np.array([len(head)], "<i8").tobytes() + head + pack(word_step, counts)


def read_bigrams(data: bytes) -> tuple[np.ndarray, ...]:
    size = int(np.frombuffer(data, "<i8", 1)[0])
    step, total, sizes = unpack(data[8:8 + size])
    word_step, counts = unpack(data[8 + size:])
    word = np.cumsum(word_step)
    first = np.cumsum(sizes) - sizes
    word -= np.repeat(word[first] - word_step[first], sizes)
    return np.repeat(np.cumsum(step), sizes), word, counts, np.repeat(total, sizes)


def weigh_bigrams(group: pd.DataFrame, number: int, prior: float, lowest: float) -> pd.DataFrame:
    """The shard's part of the model as a trie, and its answer to every chunk."""
    asked = [read_bigrams(d) for d in group["entries"]]
    ends = np.cumsum([len(a[0]) for a in asked])
    context, word, counts, context_count = (np.concatenate(c) for c in zip(*asked, strict=True))
    del asked
    contexts, rank = np.unique(context, return_inverse=True)
    width = int(word.max()) + 1
    if len(contexts) * width < 1 << 62:
        pairs, of = np.unique(rank * width + word, return_inverse=True)
        pair_rank, pair_word = pairs // width, pairs % width
    else:
        words, own = np.unique(word, return_inverse=True)
        pairs, of = np.unique(rank * len(words) + own, return_inverse=True)
        pair_rank, pair_word = pairs // len(words), words[pairs % len(words)]
    total = np.bincount(of, counts, len(pairs))
    of_context = np.zeros(len(contexts))
    of_context[rank] = context_count
    kept = total > 0
    pair_rank, pair_word, total = pair_rank[kept], pair_word[kept], total[kept]
    seen, first = np.unique(pair_rank, return_index=True)
    weights = total / (of_context[pair_rank] + prior)
    trie = BigramTrie(contexts[seen], np.append(first, len(pair_rank)), pair_word, weights, lowest)
    del pairs, of, pair_rank, pair_word, total, counts, context_count, rank
    rows, start = [], 0
    for chunk, end in zip(group["chunk"], ends.tolist(), strict=True):
        codes, start = trie.codes(context[start:end], word[start:end]), end
        rows.append((number, chunk, pack(codes)))
    return pd.DataFrame(rows, columns=["shard", "chunk", "entries"])


def lowest_weight(n: int, prior: float) -> float:
    """Least weight of a bigram: one occurrence after a context that is all of ``n`` tokens."""
    return 1 / (n + prior + 1)


def bigram_weights(answers: pd.DataFrame, lowest: float) -> np.ndarray:
    parts = [unpack(data)[0] for data in answers.sort_values("shard")["entries"]]
    return code_book(lowest)[np.concatenate(parts)]


def scored(resolved: Resolved, weights: np.ndarray, n: int, v: int, prior: float) -> pd.DataFrame:
    chunk, known = resolved.chunk, resolved.count > 0
    unigram = (resolved.count + 1) / (n + v + 1)
    back = prior / (resolved.context_count + prior)
    weight = np.empty(len(resolved.order))
    weight[resolved.order] = weights
    pair_score = np.log10(weight + back * unigram[resolved.word])
    at = np.cumsum(chunk.sizes) - chunk.sizes
    out = pd.DataFrame({
        "id": pd.array(np.where(chunk.known, chunk.ids, 0), "Int64"), "held_out": chunk.held, "n_tokens": chunk.sizes,
        "n_known": np.add.reduceat(known[chunk.tokens].astype(np.int64), at), "train_tokens": n,
        "base_score": np.add.reduceat(np.log10(unigram)[chunk.tokens], at),
        "score": np.add.reduceat(pair_score[resolved.pair_of], at),
    })
    out.loc[~chunk.known, "id"] = pd.NA
    return out


def language_scores(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", prior: float = PRIOR,
) -> DataFrame:
    """One row (id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each document.

    The model learns from the rows for which ``held_out`` is not true and scores all. Tokens are
    the words between ASCII white space, A-Z in lower case, then one end. ``base_score`` is the
    log10 probability by single words with one occurrence added to each and to one unknown word;
    ``score`` is that of the bigram model above it, whose weights are quantised to 12 bits by bounds
    that depend on the number of training tokens only, so the session's settings change no score.
    ``n_known`` counts tokens that occur in training, ``train_tokens`` all tokens there.

    NULL and empty texts are one end. Rows with a NULL id and repeated rows are each learned from
    and scored. Without training rows every token is unknown. An empty table gives no rows.
    Other columns are ignored. Reading the result weighs the bigrams, each time anew.
    """
    spark = docs.sparkSession
    shards = shuffle_shards(spark)

    def collect(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, n = TaskContext.get().partitionId(), 0
        words: dict[bytes, int] = defaultdict(count().__next__)
        ids, known, held, sizes, tokens, size = [], [], [], [], [], 0

        def chunk() -> pd.DataFrame:
            own = list(words)
            order, dealt = word_order(own, shards)
            place = np.empty(len(own), np.uint32)
            place[order] = np.arange(len(own))
            columns = (np.array(ids, "<i8"), np.array(known, "u1"), np.array(held, "u1"), np.array(sizes, "<i8"))
            return pd.DataFrame({
                "chunk": [(part << 32) + n],
                **{k: [c.tobytes()] for k, c in zip(("ids", "known", "held", "sizes"), columns, strict=True)},
                "tokens": [pack(place[np.concatenate(tokens)])], "dealt": [pack(dealt)],
                "words": [pack_words([own[i] for i in order.tolist()])],
            })

        for frame in frames:
            for key, out, text in zip(frame["id"], frame["held"], frame["text"], strict=True):
                own = byte_words(text if isinstance(text, str) else "")
                if ids and size + len(own) + 1 > CHUNK_TOKENS:
                    yield chunk()
                    words, n, size = defaultdict(count().__next__), n + 1, 0
                    ids, known, held, sizes, tokens = [], [], [], [], []
                if not ids:
                    words[END_WORD]
                numbers = np.fromiter(map(words.__getitem__, own), np.int64, len(own))
                tokens.append(np.append(numbers, 0).astype(np.uint32))
                ids.append(0 if pd.isna(key) else int(key))
                known.append(not pd.isna(key))
                held.append(bool(out))
                sizes.append(len(own) + 1)
                size += len(own) + 1
        if ids:
            yield chunk()

    def ask_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                c = Chunk(row)
                counts = np.bincount(c.tokens[c.training()], minlength=c.n_words)
                words, rows = unpack_words(row.words, c.n_words), []
                for s, own in cut_by_shard(np.repeat(np.arange(shards), unpack(row.dealt)[0]), shards):
                    head, body = pack(counts[own]), pack_words(words[own])
                    rows.append((s, c.number, np.array([len(head)], "<i8").tobytes() + head + body))
                yield pd.DataFrame(rows, columns=["shard", "chunk", "entries"])

    def sum_words(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return add_words(group, int(key[0]))

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"),
        F.col(text_col).alias("text"),
    )
    chunks = materialize(rows.mapInPandas(collect, CHUNK), "tokens")
    words = chunks.mapInPandas(ask_words, ASKED).groupBy("shard").applyInPandas(sum_words, ANSWER)
    words = materialize(words, "words")
    # one row of sums
    n, v, n_begin = words.where("kind > 0").agg(
        F.sum(F.when(F.col("kind") == 1, F.col("n"))), F.sum(F.when(F.col("kind") == 1, F.col("v"))),
        F.sum(F.when(F.col("kind") == 2, F.col("n"))),
    ).first()
    n, v, n_begin = n or 0, v or 0, n_begin or 0
    lowest = lowest_weight(n, prior)
    # a chunk's row, of shard -1, and the answers about its words; both steps below read one exchange of it
    sent = chunks.select("chunk", *SENT, F.lit(-1).alias("shard"), F.lit(None).cast("binary").alias("entries"))
    counts = words.where("kind = 0").select("chunk", "shard", "entries")
    known = sent.unionByName(counts, allowMissingColumns=True)

    def ask_bigrams(group: pd.DataFrame) -> pd.DataFrame:
        r = Resolved(group, n, n_begin, shards)
        context, word, total = r.columns
        seen = r.bigram_counts()
        rows = [
            (s, r.chunk.number, bigram_entries(context[own], word[own], seen[own], total[own]))
            for s, own in cut_by_shard(r.shard, shards)
        ]
        return pd.DataFrame(rows, columns=["shard", "chunk", "entries"])

    def weigh(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return weigh_bigrams(group, int(key[0]), prior, lowest)

    def finish(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return scored(Resolved(left, n, n_begin, shards), bigram_weights(right, lowest), n, v, prior)

    asked = known.groupBy("chunk").applyInPandas(ask_bigrams, ASKED)
    weights = asked.groupBy("shard").applyInPandas(weigh, ASKED)
    kind = docs.schema[id_col].dataType.simpleString()
    found = known.groupBy("chunk").cogroup(weights.groupBy("chunk")).applyInPandas(
        finish, "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
    return found.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
