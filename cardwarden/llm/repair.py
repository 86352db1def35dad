"""Conversation repair by generalised LR parsing over a role grammar with weighted edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Small letters are initials of roles, capitals are rules: ``(s?(ua)+)?``.
ROLE_RULES = (("C", ""), ("C", "T"), ("C", "sT"), ("T", "Tua"), ("T", "ua"))
#: Roles that a turn may be given or that may be inserted, by initial.
WRITABLE = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = frozenset(["su", "ua", "au"])
BLANKS = " \t\n\v\f\r"
#: After so many turns the edits so far are put aside, and only their order is kept.
SETTLE = 64


@dataclass(frozen=True)
class Costs:
    """Price of each edit; a truncated turn that stays costs ``truncated`` more."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


class RoleGrammar:
    """LR(0) automaton of a role grammar, and what shifting a role makes of a stack.

    A stack is a pair (state, stack below), so stacks share their lower parts. Reductions are
    made at once and in every possible way; stacks that can neither shift nor accept are dropped.
    """

    def __init__(self, rules: tuple = ROLE_RULES):
        self.rules = (("^", rules[0][0]), *rules)
        self.heads = {head for head, _ in rules}
        self.terminals = sorted({c for _, body in rules for c in body} - self.heads)
        start = self._closed({(0, 0)})
        self.states, self.goto = [start], {}
        for number, state in enumerate(self.states):  # grows while it is walked
            for symbol in sorted({self.rules[r][1][dot] for r, dot in state if dot < len(self.rules[r][1])}):
                after = self._closed({
                    (r, dot + 1) for r, dot in state
                    if dot < len(self.rules[r][1]) and self.rules[r][1][dot] == symbol
                })
                if after not in self.states:
                    self.states.append(after)
                self.goto[number, symbol] = self.states.index(after)
        self._after: dict = {}
        self.bottom = self._reduced([(0, None)])

    def _closed(self, items: set) -> frozenset:
        todo = list(items)
        while todo:
            rule, dot = todo.pop()
            body = self.rules[rule][1]
            for r, (head, _) in enumerate(self.rules):
                if dot < len(body) and head == body[dot] and (r, 0) not in items:
                    items.add((r, 0))
                    todo.append((r, 0))
        return frozenset(items)

    def _reduced(self, stacks: list) -> tuple:
        """The stacks and all that reductions make of them, without dead ones."""
        found = list(stacks)
        for stack in found:  # grows while it is walked
            for r, dot in self.states[stack[0]]:
                head, body = self.rules[r]
                if r and dot == len(body):
                    below = stack
                    for _ in body:
                        below = below[1]
                    made = (self.goto[below[0], head], below)
                    if made not in found:
                        found.append(made)
        return tuple(s for s in found if self.accepts(s) or any((s[0], t) in self.goto for t in self.terminals))

    def accepts(self, stack: tuple) -> bool:
        return (0, 1) in self.states[stack[0]]

    def shift(self, stack: tuple, role: str) -> tuple:
        """The stacks after one more role; none where the grammar does not allow it."""
        key = stack, role
        if key not in self._after:
            to = self.goto.get((stack[0], role)) if role in self.terminals else None
            self._after[key] = () if to is None else self._reduced([(to, stack)])
        return self._after[key]


class Reading(NamedTuple):
    """The cheapest way to one stack: what it cost, its edits, and the digest of what it keeps.

    ``rank`` orders the edits put aside in ``before``, a chain of (chain, edits).
    """

    cost: int
    rank: int
    audit: str
    before: tuple | None
    digest: object
    lines: int


class Repair:
    """Reads one conversation turn by turn and keeps, per stack, the least (cost, audit).

    Two readings of the same turns with the same stack have the same future, and neither audit
    can be the beginning of the other at the same cost, so the lesser one stays the lesser.
    """

    def __init__(self, grammar: RoleGrammar, costs: Costs):
        self.grammar, self.costs = grammar, costs
        self.front = {s: Reading(0, 0, "", None, hashlib.sha256(), 0) for s in grammar.bottom}
        self.seen: set[bytes] = set()
        self.initials = ""
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first = self.last = None

    @staticmethod
    def _offer(made: dict, stack: tuple, origin: Reading, price: int, edit: str, role: str | None, text: str) -> None:
        """Keep a step to ``stack`` if it is the least one so far."""
        step = (origin.cost + price, origin.rank, origin.audit + edit, origin, role, text)
        if stack not in made or step[:3] < made[stack][:3]:
            made[stack] = step

    @staticmethod
    def _read(step: tuple) -> Reading:
        """The reading after a chosen step; deleted turns leave the digest as it was."""
        cost, rank, audit, origin, role, text = step
        if role is None:
            return Reading(cost, rank, audit, origin.before, origin.digest, origin.lines)
        digest = origin.digest.copy()
        digest.update(f"{chr(10) if origin.lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        return Reading(cost, rank, audit, origin.before, digest, origin.lines + 1)

    def _inserted(self) -> None:
        """Offer every insert before the next turn, until none is an improvement."""
        todo = list(self.front)
        while todo:
            made: dict = {}
            for stack in todo:
                for initial, role in WRITABLE.items():
                    for after in self.grammar.shift(stack, initial):
                        self._offer(made, after, self.front[stack], self.costs.insert, "I", role, "")
            better = {s: step for s, step in made.items() if s not in self.front or step[:3] < self.front[s][:3]}
            self.front.update({stack: self._read(step) for stack, step in better.items()})
            todo = list(better)

    def _settle(self) -> None:
        """Put the edits so far aside. All of them end with the same turn, so none begins another."""
        order = {key: rank for rank, key in enumerate(sorted({(at.rank, at.audit) for at in self.front.values()}))}
        chains: dict = {}
        for stack, at in self.front.items():
            key = at.rank, at.audit
            chain = chains.setdefault(key, (at.before, at.audit))
            self.front[stack] = at._replace(rank=order[key], audit="", before=chain)

    def turn(self, number, role: str, text: str) -> None:
        body = text.strip(BLANKS)
        name = hashlib.md5(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()
        blank, repeated = not body, name in self.seen
        cut = not blank and not repeated and body[-1] not in ".!?"
        self.seen.add(name)
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += cut
        initial = role[:1]
        self.illegal += self.turns > 0 and self.initials + initial not in LEGAL_PAIRS
        self.initials = initial
        self.turns += 1
        if number is not None:
            self.distinct += number != self.last
            self.first, self.last = number if self.first is None else self.first, number
        self._inserted()
        made: dict = {}
        price = self.costs.truncated * cut
        for stack, at in self.front.items():
            self._offer(made, stack, at, self.costs.delete, "D", None, "")
            if blank or repeated:
                continue
            for after in self.grammar.shift(stack, initial):
                self._offer(made, after, at, price, "K", role, text)
            for letter, other in WRITABLE.items():
                for after in self.grammar.shift(stack, letter):
                    self._offer(made, after, at, self.costs.rerole + price, "R", other, text)
        self.front = {stack: self._read(step) for stack, step in made.items()}
        if self.turns % SETTLE == 0:
            self._settle()

    def report(self) -> tuple:
        self._inserted()
        best = min((at for s, at in self.front.items() if self.grammar.accepts(s)), key=lambda at: at[:3])
        edits, chain = [best.audit], best.before
        while chain is not None:
            chain, part = chain
            edits.append(part)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, best.cost,
                "".join(reversed(edits)), best.digest.hexdigest())


REPORT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)


def _columns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    named = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
    )
    return named.where(F.col("conv").isNotNull())


def _in_order(rows: DataFrame, *first: Column | str) -> DataFrame:
    """Whole conversations in one task each, turn by turn; sorting spills, nothing is collected."""
    order = [*first, F.col("turn").asc_nulls_first(), "role", "text"]
    return rows.repartition("conv").sortWithinPartitions("conv", *order)


def _stream(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def conversation_repairs(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", rules: tuple = ROLE_RULES, costs: Costs = Costs(),
) -> DataFrame:
    """One row for each conversation: its faults, and the cheapest edits that make it legal.

    ``gaps`` counts missing turn numbers; ``blank``, ``duplicate`` and ``truncated`` the turns by
    their first fault (no text; role and text seen before; no final mark); ``illegal`` the pairs of
    neighbours that the roles do not allow. ``audit`` spells the edits in order (Keep, Rerole,
    Delete, Insert), the least in ASCII among the cheapest; ``cost`` is their price and
    ``repaired_sha256`` the digest of the repaired turns, ``role:text`` each, joined by newlines.

    Turns are read in order of their number (NULL first, ties by role and text). NULL roles and
    texts count as one space; rows without a conversation belong to none and are left out; a role
    without an initial in the grammar can only be reroled or deleted. Repeated rows are duplicate
    turns. An empty table gives no rows. Other columns are ignored.

    A task holds the turns of no conversation, only a few readings of the one it is at, an edit a
    turn and a digest for each distinct turn; texts of any length pass through once.
    """
    kind = rows.schema[conv_col].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = RoleGrammar(rules)
        schema = pa.schema([("conv", key_type)] + [
            (c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in REPORT.split(", ")
        ])
        done: list[tuple] = []
        at, repair = None, None
        for conv, turn, role, text in _stream(batches, ["conv", "turn", "role", "text"]):
            if repair is None or conv != at:
                if repair is not None:
                    done.append((at, *repair.report()))
                at, repair = conv, Repair(grammar, costs)
                if len(done) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
                    done = []
            repair.turn(turn, role, text)
        if repair is not None:
            done.append((at, *repair.report()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(rows.schema[conv_col].dataType)
    ordered = _in_order(_columns(rows, conv_col, turn_col, role_col, text_col))
    return ordered.mapInArrow(parse, f"conv {kind}, {REPORT}").withColumnRenamed("conv", conv_col)


def repaired_turns(
    rows: DataFrame, repairs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """The repaired conversations: (conversation, ``position``, ``edit``, role, text), a row a turn.

    ``repairs`` is what :func:`conversation_repairs` gave for the same rows, whose audit is played
    again over the turns in order. Deleted turns are left out, inserted ones have an empty text.
    NULLs, ties and empty tables are treated as there.
    """
    kind = rows.schema[conv_col].dataType.simpleString()
    heads = repairs.select(F.col(conv_col).alias("conv"), "audit")
    turns = _columns(rows, conv_col, turn_col, role_col, text_col)
    both = turns.unionByName(heads, allowMissingColumns=True)

    def play(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("conv", key_type), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()),
        ])
        audit, place, position, previous = "", 0, 0, ""
        made: list[tuple] = []

        def emit(conv, edit, role, text) -> None:
            nonlocal position, previous
            previous = role[:1] if role is not None else ("a" if previous == "u" else "u")
            made.append((conv, position, edit, WRITABLE[previous] if role is None else role, text))
            position += 1

        def inserts(conv) -> None:
            nonlocal place
            while audit[place:place + 1] == "I":
                emit(conv, "I", None, "")
                place += 1

        conv = None
        for key, told, role, text in _stream(batches, ["conv", "audit", "role", "text"]):
            if told is not None:
                inserts(conv)
                conv, audit, place, position, previous = key, told, 0, 0, ""
            else:
                inserts(conv)
                edit = audit[place]
                place += 1
                if edit != "D":
                    emit(conv, edit, role if edit == "K" else None, text)
            if len(made) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)
                made = []
        inserts(conv)
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(rows.schema[conv_col].dataType)
    ordered = _in_order(both, F.col("audit").isNull())
    out = ordered.select("conv", "audit", "role", "text").mapInArrow(
        play, f"conv {kind}, position bigint, edit string, role string, text string"
    )
    return out.select(F.col("conv").alias(conv_col), "position", "edit", F.col("role").alias(role_col), F.col("text").alias(text_col))


def damaged_turns(rows: DataFrame) -> DataFrame:
    """Conversations with known faults, by a hash of conversation and turn; NULLs are one space."""
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    text = F.coalesce("text", F.lit(" "))
    return (
        rows.withColumn("_damage", F.crc32(name) % 20)
        .where("_damage != 0")
        .select(
            "conv_id", "turn",
            F.when(F.col("_damage") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
            F.when(F.col("_damage") == 1, "").when(F.col("_damage") == 2, F.regexp_replace(text, "[.!?]", ""))
            .otherwise(text).alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("_damage") == 3, 2).otherwise(1))).alias("_copy"),
        )
        .drop("_copy")
    )


def damaged_and_repaired(rows: DataFrame) -> DataFrame:
    """The report of every conversation of ``rows`` after damage; zeros where no turn is left."""
    reports = conversation_repairs(damaged_turns(rows))
    nothing = hashlib.sha256(b"").hexdigest()
    every = rows.where(F.col("conv_id").isNotNull()).select("conv_id").distinct()
    joined = every.join(reports, "conv_id", "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
