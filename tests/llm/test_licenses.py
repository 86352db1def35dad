"""Licence notices against plain search, and edits found by the method."""

import re

from frames import SF, awkward

from cardwarden.llm import licenses
from cardwarden.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    """(words, places, labels) of the exact phrases."""
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for label, phrase in licenses.BASE:
        own = phrase.split()
        at = [i for i in range(len(words) - len(own) + 1) if words[i:i + len(own)] == own]
        places += at
        labels |= {label} if at else set()
    return len(words), sorted(places), labels


TEXTS = [
    None, "", "CC BY", "cc--by cc by", "cc cc by by", "accby cc  by4", "General\nPublic, LICENSE!", "general public licenses",
    "Genral Public License", "all rights\x00reserved all rights reserved", "All Rigths Reserved", "é all rights reservedé",
    "permission is hereby granted, free-of charge", "permision is hereby grantd free of charge", "zz " * 2000 + "cc by" + " y" * 900,
    "all rights all rights reserved", "general public license general publik license", "ccby", "cc by", "cc by",
]


def exact(row):
    names = {label for label, _ in licenses.BASE}
    found = [m for m in row.matches if m.edits == 0 and m.label in names]
    return row.n_words, sorted(m.first_word for m in found), {m.label for m in found}


def test_exact_places(spark):
    rows = licenses.license_scan(awkward(spark, TEXTS)).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert exact(r) == plain(TEXTS[r.doc_id])
        for m in r.matches:
            data = TEXTS[r.doc_id].encode()
            words = licenses.Scanner([]).scan(data[m.start_byte:m.end_byte].decode())[0]
            assert words == m.last_word - m.first_word + 1 and m.score == 1 - m.edits / len(
                dict((a, b) for a, b in licenses.BASE + licenses.NOTICES)[m.label]
            )
    assert licenses.license_scan(awkward(spark, []).limit(0)).count() == 0


def found(text):
    return {(m[0], m[5]) for m in licenses.Scanner(licenses.BASE + licenses.NOTICES).scan(text)[1]}


def test_edits():
    assert found("Genral Public License") == {("gpl", 1)}
    assert found("all rightz reserved") == {("reserved", 1)}
    assert found("all rights rezervd") == set()  # two edits in nineteen characters are too many
    assert found("permision is hereby grantd free of charge") == {("mit", 2)}
    assert found("xx general public license xx generl public license") == {("gpl", 0), ("gpl", 1)}


def test_every_error_within_the_bound_is_found():
    import random

    rnd = random.Random(8)
    for label, phrase in licenses.BASE + licenses.NOTICES:
        for _ in range(60):
            text = list(phrase)
            for _ in range(len(phrase) // licenses.CHARACTERS_PER_EDIT):
                i = rnd.randrange(1, len(text) - 1)
                text[i:i + 1] = rnd.choice([[], [rnd.choice("qxz")], [text[i], rnd.choice("qxz")]])
            if "  " in "".join(text):
                continue  # a blank less than was written
            hit = {x for x, _ in found(f"aa {''.join(text)} bb")}
            assert label in hit, "".join(text)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_every_place_with_edits_that_overlaps_no_other():
    import random

    scanner = licenses.Scanner([licenses.BASE[1]])
    label, phrase = licenses.BASE[1]
    worse, better = "general publik licence", "general public licence"
    for text in (f"{worse} {better}", f"{better} {worse}", f"{worse} {phrase} {better} {worse}"):
        assert len(scanner.scan(text)[1]) == (len(text) + 1) // (len(phrase) + 1)
    rnd = random.Random(4)
    pieces = [worse, better, phrase, "general", "public", "license", "genral", "publc license", "x"]
    for _ in range(150):
        words = " ".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 9))).split()
        given = {(m[1], m[2]): m[5] for m in scanner.scan(" ".join(words))[1]}
        for first in range(len(words)):
            for last in range(first, min(first + 5, len(words))):
                edits = distance(" ".join(words[first:last + 1]), phrase)
                if (first, last) in given:
                    assert given[first, last] == edits <= 2
                elif edits <= 2:
                    assert edits and any(first <= y and x <= last for x, y in given), words
        assert all(b < c or d < a or (a, b) == (c, d) for a, b in given for c, d in given)


def test_query_on_the_tables(spark):
    from cardwarden.llm.queries import op7_license_scan

    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for r in op7_license_scan(spark, SF).collect():
        n, places, labels = plain(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(places), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == ((places[0], places[-1]) if places else (None, None))
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_long_texts_of_near_notices_take_time_in_proportion():
    from time import perf_counter

    scanner = licenses.Scanner(licenses.BASE + licenses.NOTICES)

    def seconds(n):
        text = " ".join(f"general publi{'kc'[i % 2]} licence x{i} all rights resrved" for i in range(n))
        start = perf_counter()
        words, found = scanner.scan(text)
        assert words == 7 * n and len(found) == 2 * n
        return perf_counter() - start

    seconds(100)
    assert seconds(3000) < 30 * max(seconds(300), 0.01)  # 21 000 words; quadratic would be a hundredfold
