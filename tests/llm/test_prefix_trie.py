"""The trie of conversations against plain counting and SQL; radix trees against sorted lists."""

import hashlib
import random

import pytest
from compare import duck, duck_rows, spark_rows

from cardwarden.llm import prefix_trie as trie
from cardwarden.llm import radix
from cardwarden.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, key string, depth int, parent string"


def test_radix_tree_grows_its_layouts():
    rng = random.Random(3)
    keys = {bytes(rng.randrange(256) for _ in range(rng.randrange(0, 4))) for _ in range(4000)}
    keys |= {bytes([200, i]) for i in range(30)} | {b"abcdefgh" * 9, b"abcdefgh" * 9 + b"x"}
    tree = radix.RadixTree()
    for key in sorted(keys, key=lambda _: rng.random()):
        tree.insert(key, key)
    assert [n.value for n, _ in tree.nodes() if n.value is not None] == sorted(keys)
    assert {type(n.children) for n, _ in tree.nodes()} == {radix.SortedLayout, radix.IndexedLayout, radix.FullLayout}
    for node, parent in tree.nodes():
        assert parent is None or (parent.end < node.end and node.key[:parent.end] == parent.key[:parent.end])


def plain(conversations: dict):
    """Nodes of {conversation: [(role, text)]}."""
    members: dict = {}
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    kids = {}
    for seq in members:
        if seq:
            kids.setdefault(seq[:-1], []).append(seq)

    def subtree(seq):
        below = [subtree(k) for k in kids.get(seq, [])]
        own = (len(members[seq]) - 1) * len(seq[-1][1]) if seq else 0
        return sum(b[0] for b in below) or 1, own + sum(b[1] for b in below)

    rows = []
    for seq, convs in members.items():
        leaves, saved = subtree(seq)
        ends = sorted(c for c in convs if len(conversations[c]) == len(seq))
        rows.append((
            min(convs), len(seq), min(members[seq[:-1]]) if seq else None, len(convs), len(kids.get(seq, [])), leaves, saved,
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("run_rows", [1, 3, 20_000])
def test_random_conversations(spark, run_rows):
    rng = random.Random(run_rows)
    conversations = {}
    for conv in range(120):
        depth = rng.choice([1, 2, 3, 6, 40])
        conversations[conv] = [(rng.choice("ua"), rng.choice(["a", "bb", "ä€😀"]) if i < 3 else "same") for i in range(depth)]
    for conv in range(120, 180):  # one conversation that a third of all are copies of
        conversations[conv] = [("u", "hot"), ("a", "copy")]
    rows = [(c, i, r, t, "x", "y", 1, "p") for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]
    given = spark.createDataFrame(rows, SCHEMA).repartition(4)
    keyed = trie.turn_keys(given, "conv_id", "turn", "role", "text")
    assert found(trie.prefix_trie(keyed, run_rows)) == plain(conversations)


def test_awkward_rows(spark):
    long = "x" * 200_000
    rows = [
        (1, None, None, None), (1, 0, "", ""), (1, 0, "", ""), (None, 0, "u", "lost"), (2, 5, "u", long), (-7, 1, "u", long),
        (3, 2, "a:", "b"), (4, 2, "a", ":b"),
    ]
    given = spark.createDataFrame([(*r, "x", "y", 1, "p") for r in rows], SCHEMA)
    got = found(trie.conversation_trie(given))
    assert got == plain({1: [("", "")] * 3, 2: [("u", long)], -7: [("u", long)], 3: [("a:", "b")], 4: [("a", ":b")]})
    assert trie.conversation_trie(given.limit(0)).count() == 0
    assert trie.prefix_trie(trie.rebuilt_keys(given.limit(0))).count() == 0


def test_turnless_conversations_are_members_of_the_root(spark):
    gone = next(n for n in range(101, 200) if __import__("zlib").crc32(str(n).encode()) % 6 >= 1)
    given = spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id bigint, turn bigint, role string, text string")
    assert found(trie.prefix_trie(trie.rebuilt_keys(given))) == plain({gone: []})


def test_same_as_sql(spark):
    assert spark_rows(QUERIES["op11_prefix_trie"](spark, SF)) == duck_rows(duck(SF), ORACLES["op11_prefix_trie"])
