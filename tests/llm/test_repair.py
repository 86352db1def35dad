"""Conversation repair against a search over all edits, and against SQL."""

import hashlib
import itertools
import random

import pytest
from compare import duck, duck_rows, spark_rows

from cardwarden.llm import repair
from cardwarden.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, audit string, cost int"


def legal(initials: str) -> bool:
    rest = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (rest != "" and len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2))


def plain(turns):
    """The least (cost, audit) and its turns, by trying every edit with up to one insert a gap."""
    seen, faults = set(), []
    for role, text in turns:
        body = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    choices = []
    for (role, text), fault in zip(turns, faults):
        extra = 5 * (fault == "truncated")
        edits = [("D", 2, [])]
        if fault not in ("blank", "duplicate"):
            edits += [("K", extra, [(role, text)]), ("R", 1 + extra, [("user", text)]), ("R", 1 + extra, [("assistant", text)])]
        choices.append(edits)
    gap = [("", 0, []), ("I", 5, [("user", "")]), ("I", 5, [("assistant", "")])]
    best = None
    for picked in itertools.product(*[c for edits in choices for c in (gap, edits)], gap):
        kept = [t for _, _, out in picked for t in out]
        if legal("".join(r[:1] or "?" for r, _ in kept)):
            found = (sum(c for _, c, _ in picked), "".join(a for a, _, _ in picked), kept)
            best = found if best is None or found[:2] < best[:2] else best
    return best, [faults.count(f) for f in ("blank", "duplicate", "truncated")]


def test_against_every_edit():
    rng = random.Random(5)
    grammar = repair.RoleGrammar()
    for _ in range(150):
        turns = [
            (rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["a.", "b?", "c", " ", "", "d! \n"]))
            for _ in range(rng.randrange(0, 5))
        ]
        reader = repair.Repair(grammar, repair.Costs())
        for number, turn in enumerate(turns):
            reader.turn(number, *turn)
        (cost, audit, kept), faults = plain(turns)
        got = reader.report()
        assert list(got[1:4]) == faults
        assert got[5:7] == (cost, audit), turns
        assert got[7] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()


def test_long_conversations_settle(monkeypatch):
    turns = [("user" if n % 2 == 0 or n % 7 == 0 else "assistant", "cut" if n % 11 == 0 else f"{n}.") for n in range(3000)]
    reports = []
    for settle in (1, 64, 10_000):
        monkeypatch.setattr(repair, "SETTLE", settle)
        reader = repair.Repair(repair.RoleGrammar(), repair.Costs())
        for number, turn in enumerate(turns):
            reader.turn(number, *turn)
        assert max(len(at.audit) for at in reader.front.values()) <= 3 * settle
        reports.append(reader.report())
    assert reports[0] == reports[1] == reports[2]


def test_other_grammar():
    grammar = repair.RoleGrammar((("C", "ua"), ("C", "uCa")))  # nested: the stack must be kept
    stacks = {grammar.bottom[0]}
    for role in "uuuaaa":
        stacks = {after for s in stacks for after in grammar.shift(s, role)}
    assert any(grammar.accepts(s) for s in stacks)
    assert not any(grammar.accepts(a) for s in stacks for a in grammar.shift(s, "a"))


def rows():
    long = "word " * 40_000 + "end."
    return [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (1, None, "system", "S."),
        (2, 3, None, "x."), (2, 5, "user", None), (2, 9, "user", long), (3, None, "assistant", "A!"),
        (None, 1, "user", "lost."), (4, 0, "user", "Q?"), (4, 1, "assistant", "no end"), (4, 2, "assistant", "A."),
    ]


def test_awkward_rows(spark):
    given = spark.createDataFrame([(*r, "c", "KKK", 7) for r in rows()], SCHEMA).repartition(3)
    found = repair.conversation_repairs(given)
    by = {r.conv_id: r for r in found.collect()}
    assert sorted(by) == [1, 2, 3, 4]
    assert (by[1].audit, by[1].cost, by[1].duplicate, by[1].gaps) == ("KKKD", 2, 1, 0)
    assert (by[2].gaps, by[2].blank) == (4, 1) and by[3].gaps == 0
    assert (by[4].truncated, by[4].illegal) == (1, 1)
    turns = repair.repaired_turns(given, found)
    for conv, report in by.items():
        kept = [f"{t.role}:{t.text}" for t in turns.where(f"conv_id = {conv}").orderBy("position").collect()]
        assert hashlib.sha256("\n".join(kept).encode()).hexdigest() == report.repaired_sha256
    none = given.limit(0)
    assert repair.conversation_repairs(none).count() == 0
    assert repair.repaired_turns(none, found.limit(0)).count() == 0
    assert repair.damaged_and_repaired(none).count() == 0


def test_a_conversation_without_turns_left(spark):
    lost = next(n for n in range(500) if __import__("zlib").crc32(f"{n}:0".encode()) % 20 == 0)
    given = spark.createDataFrame([(lost, 0, "user", "Hi.")], "conv_id bigint, turn bigint, role string, text string")
    row = repair.damaged_and_repaired(given).first()
    assert (row.conv_id, row.gaps, row.cost, row.audit) == (lost, 0, 0, "")
    assert row.repaired_sha256 == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("parts", [1, 5])
def test_repaired_turns_of_the_table(spark, parts):
    given = repair.damaged_turns(spark.read.parquet(f"{SF}/conversations.parquet")).repartition(parts)
    found = repair.conversation_repairs(given)
    kept: dict = {}
    for t in sorted(repair.repaired_turns(given, found).collect(), key=lambda t: (t.conv_id, t.position)):
        kept.setdefault(t.conv_id, []).append(t)
    for report in found.collect():
        turns = kept.get(report.conv_id, [])
        assert legal("".join(t.role[0] for t in turns))
        assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in turns).encode()).hexdigest() == report.repaired_sha256


def test_same_as_sql(spark):
    assert spark_rows(QUERIES["op13_repair"](spark, SF)) == duck_rows(duck(SF), ORACLES["op13_repair"])
