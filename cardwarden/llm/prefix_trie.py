"""The trie of shared beginnings of conversations, from radix trees over ranges of sorted keys."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwarden.llm.common import shuffle_shards
from cardwarden.llm.radix import Node, RadixTree, shared_length
from cardwarden.sources.scratch import materialize

#: Bytes of a turn's id, and of its text's length beside it.
WIDTH, SIZE = 16, 4
#: A radix tree takes as many sorted keys as fit; both bounds only set the work's layout.
RUN_ROWS, RUN_BYTES = 20_000, 16 << 20
#: Conversations of a task, where the session's partitions would give it more.
TASK_ROWS = 200_000

INNER, EDGE, ENDS = 0, 1, 2
PARTS = pa.schema([
    ("kind", pa.int8()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("parent", pa.binary()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved", pa.int64()), ("ends_sha256", pa.string()), ("node", pa.binary()), ("run", pa.int64()),
    ("side", pa.int8()), ("fork", pa.int64()), ("size", pa.int64()), ("ids", pa.binary()),
])
PARTS_DDL = (
    "kind tinyint, conv_id bigint, depth bigint, parent_conv_id bigint, parent binary, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved bigint, ends_sha256 string, node binary, run bigint, "
    "side tinyint, fork bigint, size bigint, ids binary"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_keys(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, key, sizes): each conversation's turn ids and text lengths in order, packed.

    An id is the MD5 of role and text, 16 big-endian bytes; a size counts code points. A
    conversation is held as 20 bytes a turn; its texts only pass through the sort.
    """
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    turns = rows.select(
        F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
    ).where(F.col("conv").isNotNull())
    ordered = turns.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    named = ordered.select(
        "conv", F.unhex(F.md5(F.concat(F.char_length("role"), F.lit(":"), "role", "text"))).alias("id"),
        F.char_length("text").alias("size"),
    )

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv", pa.int64()), ("key", pa.binary()), ("sizes", pa.binary())])
        at, key, sizes, done, held = None, [], [], [], 0

        def close() -> None:
            if at is not None:
                done.append((at, b"".join(key), np.array(sizes, f">i{SIZE}").tobytes()))

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

        for b in batches:
            for conv, name, size in zip(*(b.column(c).to_pylist() for c in ("conv", "id", "size"))):
                if conv != at:
                    close()
                    held += len(key) * (WIDTH + SIZE)
                    at, key, sizes = conv, [], []
                    if len(done) >= 5000 or held >= RUN_BYTES:
                        yield batch()
                        done, held = [], 0
                key.append(name)
                sizes.append(size)
        close()
        if done:
            yield batch()

    return named.mapInArrow(pack, "conv bigint, key binary, sizes binary")


@dataclass
class Ends:
    """The conversations that end at a node, as far as one run saw them."""

    sizes: bytes
    ids: list[int] = field(default_factory=list)


@dataclass
class Below:
    """What lies at and below a radix node: all of it is complete except on a run's edges."""

    n: int = 0
    least: int = 0
    first_nodes: int = 0
    leaves: int = 0
    saved: int = 0


class Run:
    """One radix tree over sorted keys, and the rows of its turn-aligned depths."""

    def __init__(self, number: int):
        self.number, self.tree, self.first, self.last = number, RadixTree(), None, None
        self.ends: Ends | None = None
        self.rows = self.bytes = 0

    def add(self, conv: int, key: bytes, sizes: bytes) -> None:
        if key != self.last:
            if self.first is None:
                self.first = key
            self.last, self.ends = key, Ends(sizes)
            self.tree.insert(key, self.ends)
            self.bytes += len(key)
        self.ends.ids.append(conv)
        self.rows += 1

    def _names(self, key: bytes) -> list[bytes]:
        """The name of every turn-aligned beginning of a key."""
        running, names = hashlib.md5(), [hashlib.md5().digest()]
        for at in range(0, len(key), WIDTH):
            running.update(key[at:at + WIDTH])
            names.append(running.copy().digest())
        return names

    def parts(self) -> Iterator[tuple]:
        """Rows of nodes that only this run holds, of those on its edges, and of ends on its edges.

        Every node that another run may hold too is a beginning of the first or the last key, as
        keys are sorted. For these the subtree's sums leave out what lies on the edges.
        """
        low, high = self._names(self.first), self._names(self.last)
        fork = shared_length(self.first, self.last, 0, min(len(self.first), len(self.last))) // WIDTH
        order = list(self.tree.nodes())
        sizes: dict[int, bytes] = {}
        below: dict[int, Below] = {}
        shown: dict[int, list] = {}

        def edge(node: Node) -> int:
            """Up to which depth the beginnings of a node's keys are on an edge."""
            stop = node.end
            return max(
                shared_length(node.key, side, 0, min(stop, len(side), len(node.key))) // WIDTH
                for side in (self.first, self.last)
            )

        for node, parent in reversed(order):  # children before parents
            sums = below.setdefault(id(node), Below())
            text = sizes.get(id(node))
            if node.value is not None:
                ids = node.value.ids
                sums.n += len(ids)
                sums.least = min(sums.least, ids[0]) if sums.n > len(ids) else ids[0]
                text = node.value.sizes
            sizes[id(node)] = text or b""
            above = parent.end // WIDTH if parent is not None else -1
            rim = edge(node)
            rows = []
            kids, leaves, saved = sums.first_nodes, sums.leaves, sums.saved
            for depth in range(node.end // WIDTH, above, -1):
                size = int.from_bytes(text[(depth - 1) * SIZE:depth * SIZE], "big") if depth else 0
                on_edge = depth <= rim
                ends = node.value if depth * WIDTH == node.end else None
                if on_edge:
                    rows.append((depth, kids, leaves, saved, size, ends))
                    kids = leaves = saved = 0
                else:
                    leaves += kids == 0 and leaves == 0
                    saved += (sums.n - 1) * size
                    rows.append((depth, kids, leaves, saved, size, ends))
                    kids = 1
            shown[id(node)] = [rim, rows]
            if parent is not None:
                up = below.setdefault(id(parent), Below())
                up.least = min(up.least, sums.least) if up.n else sums.least
                up.n += sums.n
                up.first_nodes += kids
                up.leaves += leaves
                up.saved += saved
                sizes[id(parent)] = text or b""
        owner: dict[int, tuple] = {}
        for node, parent in order:
            conv, name = owner.get(id(parent), (None, None))
            sums = below[id(node)]
            rim, rows = shown[id(node)]
            for depth, kids, leaves, saved, size, ends in reversed(rows):
                if depth <= rim:
                    right = depth > fork and node.key[:depth * WIDTH] == self.last[:depth * WIDTH]
                    names = high if right else low
                    yield (EDGE, sums.least, depth, None, names[depth - 1] if depth else None, sums.n, kids, leaves,
                           saved, None, names[depth], self.number, int(right), fork, size, None)
                    if ends is not None:
                        yield (ENDS, ends.ids[0], depth, None, None, None, None, None, None, None, names[depth],
                               None, None, None, None, ",".join(map(str, ends.ids)).encode())
                    conv, name = None, names[depth]
                else:
                    sha = hashlib.sha256(",".join(map(str, ends.ids)).encode()).hexdigest() if ends else NO_ENDS
                    yield (INNER, sums.least, depth, conv, name, sums.n, kids, leaves, saved, sha,
                           None, None, None, None, None, None)
                    conv, name = sums.least, None
            owner[id(node)] = conv, name


def _parts(batches: Iterable[pa.RecordBatch], run_rows: int) -> Iterator[pa.RecordBatch]:
    """Cuts sorted (key, conv, sizes) rows into runs and gives their parts."""
    task = TaskContext.get().partitionId() << 32

    def given(run: Run) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for row in run.parts():
            rows.append(row)
            if len(rows) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PARTS)], schema=PARTS)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PARTS)], schema=PARTS)

    run, count = Run(task), 0
    for batch in batches:
        for conv, key, sizes in zip(*(batch.column(c).to_pylist() for c in ("conv", "key", "sizes"))):
            if run.rows >= run_rows or run.bytes >= RUN_BYTES:
                yield from given(run)
                count += 1
                run = Run(task + count)
            run.add(conv, key, sizes)
    if run.rows:
        yield from given(run)


def _joined_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's ends, from their pieces in order, which only pass through."""
    schema = pa.schema([("node", pa.binary()), ("sha", pa.string())])
    at, digest, done = None, None, []
    for batch in batches:
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if node != at:
                if at is not None:
                    done.append((at, digest.hexdigest()))
                at, digest = node, hashlib.sha256(ids)
            else:
                digest.update(b"," + ids)
        if len(done) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
            done = []
    if at is not None:
        done.append((at, digest.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)


def _edge_nodes(edges: DataFrame, ends: DataFrame) -> DataFrame:
    """The nodes that several runs hold, put together.

    A node's subtree is what hangs off the edges below it, summed over all runs, and the edge
    nodes below it, each counted in the run that owns it: the first one that holds it.
    """
    whole = edges.groupBy("node").agg(
        F.min("run").alias("owner"), F.min("conv_id").alias("least"), F.sum("n_convs").alias("n"),
        F.sum("n_children").alias("inner"), F.min("parent").alias("above"),
    )
    kids = whole.where(F.col("above").isNotNull()).groupBy(F.col("above").alias("node")).agg(F.count("*").alias("outer"))
    ids = ends.select("node", "conv_id", "ids").repartition("node").sortWithinPartitions("node", "conv_id")
    digests = ids.select("node", "ids").mapInArrow(_joined_ends, "node binary, sha string")
    whole = whole.join(kids, "node", "left").join(digests, "node", "left")
    whole = materialize(whole.withColumn("children", F.col("inner") + F.coalesce("outer", F.lit(0))), "edge_nodes")
    owned = F.col("run") == F.col("owner")
    seen = edges.join(whole, "node").select(
        "node", "depth", "run", "side", "fork", "least", "n", "children", "sha", "above",
        (F.col("n_leaves") + (owned & (F.col("children") == 0)).cast("bigint")).alias("leaves"),
        (F.col("saved") + F.col("n_convs") * F.col("size") - F.when(owned, F.col("size")).otherwise(0)).alias("saved"),
    )
    down = W.partitionBy("run", "side").orderBy(F.desc("depth")).rowsBetween(W.unboundedPreceding, W.currentRow)
    of_run = W.partitionBy("run")
    stem = (F.col("side") == 0) & (F.col("depth") <= F.col("fork"))

    def subtree(c: str) -> Column:
        other = F.sum(F.when(F.col("side") == 1, F.col(c)).otherwise(0)).over(of_run)
        return F.sum(c).over(down) + F.when(stem, other).otherwise(0)

    summed = seen.withColumns({"all_leaves": subtree("leaves"), "all_saved": subtree("saved")})
    return summed.groupBy("node").agg(
        *[F.min(c).alias(c) for c in ("depth", "least", "n", "children", "sha", "above")],
        F.sum("all_leaves").alias("n_leaves"), F.sum("all_saved").alias("saved_tokens"),
    )


def prefix_trie(keyed: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """One row for each distinct beginning of the given conversations.

    ``keyed`` holds (conv, key, sizes) as :func:`turn_keys` packs them. A node's ``conv_id`` is the
    smallest conversation that begins so, ``n_convs`` their number; ``n_children`` and ``n_leaves``
    describe its subtree, ``saved_tokens`` the code points it saves to store each turn there once,
    and ``ends_sha256`` is the digest of the conversations that end there, ascending, comma-joined.

    Rows are sorted by key over all tasks, so copies of one conversation, however many, spread
    too. A task builds one radix tree after another over bounded runs of them. Nodes that lie inside
    a run are complete; those on a run's edges, at most two a depth, are put together by joins.
    ``run_rows`` only sets the layout. An empty table gives no rows; conversations are distinct.
    """
    spark = keyed.sparkSession
    keyed = materialize(keyed, "keyed")
    tasks = max(shuffle_shards(spark), keyed.count() // TASK_ROWS + 1)
    ordered = keyed.repartitionByRange(tasks, "key", "conv").sortWithinPartitions("key", "conv")
    parts = materialize(ordered.mapInArrow(lambda batches: _parts(batches, run_rows), PARTS_DDL), "parts")
    edges = _edge_nodes(parts.where(F.col("kind") == EDGE), parts.where(F.col("kind") == ENDS))
    edges = materialize(edges, "edges")
    parents = edges.select(F.col("node").alias("parent"), F.col("least").alias("edge_conv"))
    inner = parts.where(F.col("kind") == INNER)
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    under = inner.join(parents, "parent", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "edge_conv").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256",
    )
    top = edges.join(parents, edges["above"] == parents["parent"], "left").select(
        F.col("least").alias("conv_id"), "depth", F.col("edge_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    return under.select(out).unionByName(top.select(out))


def conversation_trie(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The trie (see :func:`prefix_trie`) of the conversations as they are.

    Turns are ordered by number (NULL first, ties by role and text); NULL roles and texts are
    empty; rows without a conversation belong to none and are left out; repeated rows are repeated
    turns. Texts may have any length. Other columns are ignored.
    """
    return prefix_trie(turn_keys(rows, conv_col, turn_col, role_col, text_col))


def rebuilt_keys(rows: DataFrame, block: int = 100, longest: int = 6) -> DataFrame:
    """Conversations that begin as their block's first one does, so that beginnings are shared.

    Conversation c takes the first h turns of c - c % ``block`` (all if it has fewer, none if it
    is absent) in place of its own first h; h is the CRC-32 of c in decimal, modulo ``longest``.
    """
    keyed = materialize(turn_keys(rows, "conv_id", "turn", "role", "text"), "turn_keys")
    heads = keyed.where(F.col("conv") % block == 0).select(
        F.col("conv").alias("_base"), F.substring("key", 1, (longest - 1) * WIDTH).alias("_key"),
        F.substring("sizes", 1, (longest - 1) * SIZE).alias("_sizes"),
    )
    taken = (F.crc32(F.col("conv").cast("string")) % longest).cast("int")
    joined = keyed.withColumns({"_h": taken, "_of": F.col("conv") - F.col("conv") % block}).join(
        heads, F.col("_of") == F.col("_base"), "left"
    )

    def spliced(own: str, head: str, width: int) -> Column:
        start = F.coalesce(F.substring(F.col(head), F.lit(1), F.col("_h") * width), F.lit(b""))
        return F.concat(start, F.substring(F.col(own), F.col("_h") * width + 1, F.octet_length(own)))

    return joined.select(
        "conv", spliced("key", "_key", WIDTH).alias("key"), spliced("sizes", "_sizes", SIZE).alias("sizes")
    )
