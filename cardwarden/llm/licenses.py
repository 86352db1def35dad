"""Fuzzy search for short licence notices: exact seeds, then bounded-error matching."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (label, phrase) whose exact places are the base result.
BASE = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]
#: Further notices.
NOTICES = [
    ("apache", "licensed under the apache license"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("cc", "creative commons attribution"),
    ("copyright", "this work is protected by copyright"),
    ("mit", "permission is hereby granted free of charge"),
    ("mpl", "mozilla public license"),
    ("public-domain", "released into the public domain"),
]
#: A notice may differ by one edit for each so many characters.
CHARACTERS_PER_EDIT = 10
SPANS = "array<struct<label:string,first_word:bigint,last_word:bigint,start_byte:bigint,end_byte:bigint,edits:int,score:double>>"

# letters and digits of ASCII in lower case, every other ASCII byte a blank, the rest as it is
_FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


@dataclass(frozen=True)
class Notice:
    label: str
    phrase: str
    edits: int
    seeds: tuple[tuple[str, int], ...]
    patterns: tuple  # one for each number of edits, from 1


def notice(label: str, phrase: str, per_edit: int = CHARACTERS_PER_EDIT) -> Notice:
    """With at most k edits, one of k + 1 pieces of the phrase occurs unchanged."""
    edits = len(phrase) // per_edit
    cuts = [round(i * len(phrase) / (edits + 1)) for i in range(edits + 2)]
    seeds = tuple((phrase[a:b], a) for a, b in zip(cuts, cuts[1:]))
    escaped = regex.escape(phrase, special_only=True)
    patterns = tuple(regex.compile(rf"(?<= )(?:{escaped}){{e<={k}}}(?= )") for k in range(1, edits + 1))
    return Notice(label, phrase, edits, seeds, patterns)


def gaps(spans: Sequence[Sequence[int]], taken: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the spans cover together, without the places taken; these are of one length and in order."""
    merged: list[list[int]] = []
    for low, high in sorted(spans):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(high, merged[-1][1])
        else:
            merged.append([low, high])
    out, at = [], 0
    for low, high in merged:
        while at < len(taken) and taken[at][0] < high:
            start, stop = taken[at]
            if low < start:
                out.append((low, start))
            low = max(low, stop)
            if stop > high:
                break
            at += 1
        if low < high:
            out.append((low, high))
    return out


class Scanner:
    def __init__(self, notices: Sequence[tuple[str, str]]):
        self.notices = [notice(*n) for n in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, n in enumerate(self.notices):
            for seed, offset in n.seeds:
                seeds.setdefault(seed, []).append((i, offset))
        self.seeds = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.seeds.add_word(seed, (len(seed), places))
        if seeds:
            self.seeds.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple]]:
        """Number of words, and matches (label, first and last word, bytes, edits, score)."""
        words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
        if not words:
            return 0, []
        joined = " " + b" ".join(words).decode("latin-1") + " "
        found: dict[tuple[int, int, int], int] = {}
        windows: dict[int, list[list[int]]] = {}
        for end, (size, places) in self.seeds.iter(joined) if len(self.seeds) else ():
            for i, offset in places:
                n, at = self.notices[i], end + 1 - size - offset
                stop = at + len(n.phrase)
                if joined[at - 1:stop + 1] == f" {n.phrase} ":
                    found[i, at, stop] = 0
                elif n.edits:
                    low, high = max(0, at - n.edits - 1), min(len(joined), stop + n.edits + 1)
                    spans = windows.setdefault(i, [])
                    if spans and low <= spans[-1][1]:
                        spans[-1][0], spans[-1][1] = min(low, spans[-1][0]), max(high, spans[-1][1])
                    else:
                        spans.append([low, high])
        for i, spans in windows.items():
            n, taken = self.notices[i], sorted((a, b) for j, a, b in found if j == i)
            for pattern in n.patterns:  # all places with one edit, then in what is left those with two, …
                for low, high in gaps(spans, taken):
                    if high - low < len(n.phrase) - n.edits + 2:
                        continue
                    for m in pattern.finditer(joined, low, high):
                        found[i, m.start(), m.end()] = sum(m.fuzzy_counts)
                        taken.append(m.span())
                taken.sort()
        return len(words), self._spans(text, joined, found) if found else []

    def _spans(self, text: str, joined: str, found: dict) -> list[tuple]:
        data = text.encode("utf-8", "surrogatepass").translate(_FOLD)
        starts, at = [], 0
        for word in data.split():
            at = data.index(word, at)
            starts.append((at, at + len(word)))
            at += len(word)
        blanks = [k for k, c in enumerate(joined) if c == " "]
        out = []
        for (i, a, b), edits in found.items():
            n = self.notices[i]
            first, last = bisect_left(blanks, a) - 1, bisect_left(blanks, b) - 1
            score = 1.0 - edits / len(n.phrase)
            out.append((n.label, first, last, starts[first][0], starts[last][1], edits, score))
        return sorted(out, key=lambda m: (m[1], m[0], m[2]))


def license_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    notices: Sequence[tuple[str, str]] = tuple(BASE + NOTICES),
) -> DataFrame:
    """One row (id, ``n_words``, ``matches``) for each row of ``docs``, from whole texts.

    Words are runs of ASCII letters and digits and of all other characters, A-Z in lower case. A
    match is a place where the words of a notice stand in a row, with at most one edit for each
    CHARACTERS_PER_EDIT characters of it; matches begin and end with whole words. Exact places are
    all given; a place with edits is given unless it overlaps another of the same notice. Spans
    count words from 0 and bytes of the original UTF-8 text.

    NULL and empty texts have no words and no matches; NULL ids and repeated rows are each
    returned; an empty table gives no rows; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    listed = list(notices)

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(listed)
        names = ["label", "first_word", "last_word", "start_byte", "end_byte", "edits", "score"]
        for frame in frames:
            rows = [scanner.scan(t) for t in frame["text"]]
            yield pd.DataFrame({
                "id": frame["id"], "n_words": [n for n, _ in rows],
                "matches": [[dict(zip(names, m, strict=True)) for m in found] for _, found in rows],
            })

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInPandas(scan, f"id {kind}, n_words bigint, matches {SPANS}")
    return out.withColumnRenamed("id", id_col)
