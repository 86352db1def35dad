"""Similarity join of n-gram sets by Jaccard, with prefix trees over globally ordered sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwarden.llm.common import byte_words, mix64, parts_of
from cardwarden.llm.components import components
from cardwarden.sources.scratch import materialize

#: A shingle that this share of a chunk's sets holds is a candidate for the frequent ones.
FREQUENT_SHARE = 1 / 2000
#: Frequent shingles that are placed last in the global order: at most so many are broadcast.
FREQUENT = 100_000
#: Shingles of a chunk in which frequent ones are counted.
CHUNK = 2_000_000
#: Sets of a block; a larger bucket is joined block by block.
BLOCK_SETS = 1000
#: Buckets in which a set looks for partners first.
FIRST_BUCKETS = 2
#: Least and most bits of a set's sketch, which bounds its difference from other sets from below.
SKETCH_BITS = 1 << 10, 1 << 16
#: Bits of the map of wanted rows: the table that is broadcast never holds more, in rows of 32768.
ROW_BITS = 1 << 27


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Distinct 64-bit names of all runs of ``size`` words, ascending; shorter texts are one run.

    A run's name mixes its number of words and the XXH64 of each word in turn.
    """
    if not words:
        return np.empty(0, np.uint64)
    names = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    runs = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        runs = mix64(runs * np.uint64(3) + names[i:len(words) - size + 1 + i])
    return np.unique(runs)


class Threshold:
    """Integer bounds for Jaccard similarity of at least ``percent`` / 100."""

    def __init__(self, percent: int):
        self.percent = percent

    def overlap(self, n: int, m: int) -> int:
        """Least intersection of similar sets of n and m."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def common(self, n: int) -> int:
        """Shingles that similar sets share in their prefixes, by the size of the smaller one."""
        return 1 + n // 20

    def needed(self, n: int) -> int:
        """Shingles that a set of n shares with the prefix of any similar set, whatever its size."""
        return self.common(-(-self.percent * n // 100))

    def probe(self, n: int) -> int:
        """Length of the prefix in which a set of n meets similar sets that are not larger."""
        return min(n, n + (-self.percent * n // 100) + self.common(n))

    def index(self, n: int) -> int:
        """Length of the prefix in which a set of n meets similar sets that are not smaller."""
        return min(n, n - self.overlap(n, n) + self.common(n))


def sketch(names: np.ndarray) -> bytes:
    """Parity of the names by their last bits, as many bits as there are names, rounded up.

    Sketches of two sets, the longer one folded by exclusive or, differ in no more bits than the
    sets differ in names.
    """
    least, most = SKETCH_BITS
    bits = min(most, max(least, 1 << (len(names) - 1).bit_length()))
    return np.packbits(np.bincount((names % np.uint64(bits)).astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes()


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (a row each, or one) cut down to ``words`` 64-bit words."""
    while sketches.shape[-1] > words:
        half = sketches.shape[-1] // 2
        sketches = sketches[..., :half] ^ sketches[..., half:]
    return sketches


class GlobalOrder:
    """Names ascending, except that the frequent ones come last, the most frequent at the end."""

    def __init__(self, frequent: np.ndarray):
        self.rank = np.argsort(frequent, kind="stable")
        self.names = frequent[self.rank]

    def sorted(self, names: np.ndarray) -> np.ndarray:
        """``names``, which are ascending, in the global order."""
        if not len(self.names):
            return names
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        late = self.names[at] == names
        last = names[late][np.argsort(self.rank[at[late]])]
        return np.concatenate([names[~late], last])


def frequent_shingles(docs: DataFrame, text_col: str, size: int) -> np.ndarray:
    """The most frequent shingles, the most frequent last: at most ``FREQUENT``.

    Each task counts its own chunks and passes on what is frequent there: a shingle that is
    frequent overall is frequent in some chunk. Only the order of the work depends on the list.
    """
    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("name", pa.int64()), ("n", pa.int64())])
        sets, held = [], 0

        def counted() -> pa.RecordBatch:
            names, times = np.unique(np.concatenate(sets), return_counts=True)
            often = times >= max(2, FREQUENT_SHARE * len(sets))
            return pa.RecordBatch.from_arrays([pa.array(names[often].view(np.int64)), pa.array(times[often])], schema=schema)

        for batch in batches:
            for texts in parts_of(batch.column("text")):
                for text in texts.to_pylist():
                    sets.append(shingle_set(byte_words(text), size))
                    held += len(sets[-1])
                    if held >= CHUNK:
                        yield counted()
                        sets, held = [], 0
        if sets:
            yield counted()

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(counts, "name bigint, n bigint")
    top = found.groupBy("name").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "name").limit(FREQUENT)
    names = [row.name for row in top.orderBy("n", "name").collect()]
    return np.array(names, np.int64).view(np.uint64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_hash"))


def set_prints(docs: DataFrame, id_col: str, text_col: str, size: int, bounds: Threshold, order: GlobalOrder) -> DataFrame:
    """(id, text_hash, n, n_index, needed, fp, key, prefix) of each row.

    ``fp`` names the whole set by 128 bits, ``key`` by 64. The prefix is empty where the same set
    came just before. Two sets of one key only cost time: they are looked at as one until they
    are joined by ``fp``.
    """
    def prints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, 2048):
                sizes, names, prefixes, seen = [], [], [], set()
                for text in part.column("text").to_pylist():
                    found = shingle_set(byte_words(text), size)
                    sizes.append(len(found))
                    names.append(hashlib.md5(found.tobytes()).digest())
                    length = 0 if names[-1] in seen else bounds.probe(len(found))
                    prefixes.append(order.sorted(found)[:length].view(np.int64))
                    seen.add(names[-1])
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("text_hash"), pa.array(sizes, pa.int64()),
                    pa.array([bounds.index(n) for n in sizes], pa.int32()), pa.array([bounds.needed(n) for n in sizes], pa.int32()),
                    pa.array(names, pa.binary()), pa.array([int.from_bytes(x[:8], "big", signed=True) for x in names], pa.int64()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ], ["id", "text_hash", "n", "n_index", "needed", "fp", "key", "prefix"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _texts(docs, id_col, text_col).mapInArrow(
        prints, f"id {kind}, text_hash bigint, n bigint, n_index int, needed int, fp binary, key bigint, prefix array<bigint>"
    )


def shared_names(prints: DataFrame) -> DataFrame:
    """(key, name, pos) of the prefix names that two sets may meet at, each once.

    A set holds as many names as its prefix is long, so that no name holds more than a small
    part of the postings, also where most sets are near copies of one another.
    """
    code = F.col("pos") * 2 + (F.col("pos") < F.col("n_index")).cast("int")
    postings = prints.select("key", "n_index", F.posexplode("prefix").alias("pos", "name")).select("name", "key", code.alias("code"))
    at = W.partitionBy("name")
    met = postings.select("name", "key", "code", *[
        f.over(at).alias(c) for c, f in (("_a", F.min("key")), ("_b", F.max("key")), ("_indexed", F.max(F.col("code") % 2)))
    ]).where("_a != _b and _indexed = 1")
    return met.select("key", "name", F.shiftright("code", 1).alias("pos"))


def only_wanted(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows that may be wanted: their hash is marked in a bit map of a fixed size."""
    spot = F.pmod(F.xxhash64("id", "text_hash"), F.lit(ROW_BITS))
    bit = F.bitmap_bit_position(F.col("_spot"))
    marks = wanted.withColumn("_spot", spot).groupBy(F.bitmap_bucket_number(F.col("_spot")).alias("_page")).agg(
        F.bitmap_construct_agg(bit).alias("_marks")
    )  # at most ROW_BITS / 32768 rows of 4 KB
    found = rows.withColumn("_spot", spot).withColumns({"_page": F.bitmap_bucket_number(F.col("_spot")), "_bit": bit})
    byte = F.conv(F.hex(F.substring(F.col("_marks"), (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = byte.bitwiseAND(F.expr("shiftleft(1, cast(_bit % 8 as int))")) != 0
    return found.join(F.broadcast(marks), "_page").where(marked).select(rows.columns)


def whole_sets(docs: DataFrame, id_col: str, text_col: str, size: int, order: GlobalOrder, wanted: DataFrame) -> DataFrame:
    """(key, fp, n, sketch, names) of the ``wanted`` sets, made again from one text each.

    Names are in global order. ``wanted`` says how many rows are equal to the one it names.
    """
    schema = pa.schema([
        ("key", pa.int64()), ("fp", pa.binary()), ("n", pa.int64()), ("sketch", pa.binary()), ("names", pa.binary()),
    ])

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, 1024):
                kept = []
                for key, fp, text in zip(*(part.column(c).to_pylist() for c in ("key", "fp", "text"))):
                    found = shingle_set(byte_words(text), size)
                    if hashlib.md5(found.tobytes()).digest() == fp:
                        kept.append((key, fp, len(found), sketch(found), order.sorted(found).tobytes()))
                if kept:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)

    rows = only_wanted(_texts(docs, id_col, text_col), wanted)
    same = rows["id"].eqNullSafe(wanted["id"]) & (rows["text_hash"] == wanted["text_hash"])
    found = rows.join(wanted, same).select("key", "fp", "text", "times")
    once = found.where("times = 1").unionByName(found.where("times > 1").dropDuplicates(["fp"]))
    return once.select("key", "fp", "text").mapInArrow(sets, "key bigint, fp binary, n bigint, sketch binary, names binary")


class Branch:
    """A node of a prefix tree: the run of names that leads to it, and the sets below."""

    __slots__ = ("run", "children", "sets", "least", "most", "one")

    def __init__(self, run: np.ndarray, n: int, member: int):
        self.run, self.children, self.sets = run, {}, []
        self.least = self.most = n
        #: A set below if all sets below are known to be of one component, else None.
        self.one: int | None = member


class SetTree:
    """Sets in a prefix tree over the global order; links new sets to those of other components."""

    def __init__(self, bounds: Threshold):
        self.bounds = bounds
        self.root: Branch | None = None
        self.parent: list[int] = []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)

    def insert(self, member: int, names: np.ndarray) -> None:
        n = len(names)
        if self.root is None:
            self.root = Branch(names[:0], n, member)
        at, depth = self.root, 0
        while True:
            at.least, at.most = min(at.least, n), max(at.most, n)
            if at.one is not None and self.find(at.one) != self.find(member):
                at.one = None
            if depth == n:
                at.sets.append(member)
                return
            child = at.children.get(names[depth])
            if child is None:
                leaf = Branch(names[depth:], n, member)
                leaf.sets.append(member)
                at.children[names[depth]] = leaf
                return
            size = min(len(child.run), n - depth)
            differs = np.flatnonzero(child.run[:size] != names[depth:depth + size])
            shared = int(differs[0]) if len(differs) else size
            if shared < len(child.run):
                upper = Branch(child.run[:shared], child.least, child.one)
                upper.most = child.most
                child.run = child.run[shared:]
                upper.children[child.run[0]] = child
                at.children[names[depth]] = child = upper
            at, depth = child, depth + shared

    def links(self, member: int, names: np.ndarray) -> Iterator[int]:
        """One similar set of each other component in the tree; the components are joined."""
        if self.root is None:
            return
        n = len(names)
        place = np.argsort(names)
        known = names[place]
        stack = [(self.root, 0, 0, 0, False)]
        while stack:
            node, depth, overlap, used, left = stack.pop()
            if left:  # all below has been searched: note if it is one component now
                ones = [c.one for c in node.children.values()] + node.sets
                if None not in ones and len({self.find(o) for o in ones}) == 1:
                    node.one = ones[0]
                continue
            if node.one is not None and self.find(node.one) == self.find(member):
                continue
            least = self.bounds.overlap(n, node.least)
            start, step = 0, 32
            while start < len(node.run):
                if overlap + min(n - used, node.most - depth - start) < least:
                    break
                run = node.run[start:start + step]
                at = np.minimum(np.searchsorted(known, run), n - 1)
                hits = at[known[at] == run]
                overlap += len(hits)
                if len(hits):
                    used = int(place[hits[-1]]) + 1
                start, step = start + len(run), step * 4
            depth += start
            if overlap + min(n - used, node.most - depth) < least:
                continue
            for other in node.sets:
                if self.find(other) != self.find(member) and overlap >= self.bounds.overlap(n, depth):
                    self.join(member, other)
                    yield other
            if node.children:
                if node.one is None:
                    stack.append((node, 0, 0, 0, True))
                stack.extend((child, depth, overlap, used, False) for child in node.children.values())


def block_links(group: list[tuple], bounds: Threshold) -> Iterator[tuple[bytes, bytes]]:
    """Links (a, b) that join all similar sets of a block, given as (fp, component, names)."""
    sets = sorted(((np.frombuffer(names, np.uint64), fp, comp) for fp, comp, names in group), key=lambda s: (len(s[0]), s[1]))
    tree = SetTree(bounds)
    first: dict = {}
    for member, (_, _, comp) in enumerate(sets):
        tree.parent.append(first.setdefault(comp, member))
    if len(first) < 2:
        return
    for member, (names, fp, _) in enumerate(sets):
        for other in tree.links(member, names):
            yield fp, sets[other][1]
        tree.insert(member, names)


def maybe_similar(group: list[tuple], bounds: Threshold) -> Iterator[tuple[int, int]]:
    """(set, component) of a block's sets that some set of another component may be similar to.

    ``group`` holds (set, component, n, sketch); sketches leave out what differs too much.
    """
    n = np.array([size for _, _, size, _ in group], np.int64)
    comp = np.array([c for _, c, _, _ in group], np.int64)
    open_ = np.zeros(len(group), bool)
    by_length: dict[int, list[int]] = {}
    for i, (_, _, _, found) in enumerate(group):
        by_length.setdefault(len(found) // 8, []).append(i)
    bits = {
        words: np.frombuffer(b"".join(group[i][3] for i in at), np.uint64).reshape(len(at), words)
        for words, at in by_length.items()
    }
    for words, at in by_length.items():
        for other, those in by_length.items():
            if other > words:
                continue  # each pair of lengths once, the shorter ones as partners
            shorter, theirs = bits[other], np.array(those)
            for row, i in enumerate(at):
                least = -(-bounds.percent * (n[i] + n[theirs]) // (100 + bounds.percent))
                fits = np.flatnonzero((comp[theirs] != comp[i]) & (least <= np.minimum(n[i], n[theirs])))
                apart = np.bitwise_count(shorter[fits] ^ folded(bits[words][row], other)).sum(axis=1, dtype=np.int64)
                near = theirs[fits[apart <= n[i] + n[theirs[fits]] - 2 * least[fits]]]
                open_[near] = True
                open_[i] |= len(near) > 0
    return (group[i][:2] for i in np.flatnonzero(open_))


def by_block(rows: DataFrame, columns: list[str], found: callable, out: str, carried: bool = False) -> DataFrame:
    """What ``found`` gives for the rows of each block, whose place is carried on where asked for.

    Rows are dealt out and sorted by (name, block) and pass by; a task holds one block at a time.
    """
    out += ", name bigint, block bigint" * carried
    schema = pa.schema([(c.split()[0], pa.binary() if c.endswith("binary") else pa.int64()) for c in out.split(", ")])

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group, made = None, [], []

        def close() -> None:
            if len(group) > 1:
                made.extend((*row, *at) if carried else row for row in found(group))

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)

        for b in batches:
            for name, block, *row in zip(*(b.column(c).to_pylist() for c in ("name", "block", *columns))):
                if (name, block) != at:
                    close()
                    at, group = (name, block), []
                group.append(row)
            if made:
                yield batch()
                made = []
        close()
        if made:
            yield batch()

    ordered = rows.select("name", "block", *columns).repartition("name", "block").sortWithinPartitions("name", "block")
    return ordered.mapInArrow(blocks, out)


def joined_blocks(members: DataFrame, sets: DataFrame, bounds: Threshold) -> DataFrame:
    """Links (a, b) found in each block of ``members`` (key, comp, name, block)."""
    rows = members.join(sets.select("key", "fp", "names"), "key")
    return by_block(rows, ["fp", "comp", "names"], lambda group: block_links(group, bounds), "a binary, b binary")


def open_blocks(members: DataFrame, sets: DataFrame, bounds: Threshold) -> DataFrame:
    """The ``members`` whose sketches leave a similar set of another component possible."""
    rows = members.join(sets.select("key", "n", "sketch"), "key")
    return by_block(rows, ["key", "comp", "n", "sketch"], lambda group: maybe_similar(group, bounds), "key bigint, comp bigint", True)


def _block(sets: Column) -> Column:
    return F.pmod(F.xxhash64("key"), F.greatest(F.ceil(sets / BLOCK_SETS), F.lit(1)))


def first_round(flagged: DataFrame) -> DataFrame:
    """Blocks of the first round: each set in a few buckets, chosen so that similar sets agree."""
    chosen = F.slice(F.array_sort(F.transform("kept", lambda k: k["name"])), 1, FIRST_BUCKETS)
    members = flagged.select("key", F.explode(chosen).alias("name"))
    sizes = members.groupBy("name").agg(F.count("*").alias("_n")).where("_n > 1")
    return members.join(sizes, "name").select("key", F.col("key").alias("comp"), "name", _block(F.col("_n")).alias("block"))


def _still_apart(flagged: DataFrame, comps: DataFrame) -> DataFrame:
    """Postings (key, comp, needed, pos, name) in buckets that hold several components.

    Sets left with fewer of them than they need to be similar to any other set are dropped.
    """
    named = flagged.join(comps, "key", "left").select("key", "needed", F.coalesce("comp", "key").alias("comp"), "kept")
    posts = named.select("key", "needed", "comp", F.inline("kept"))
    for _ in range(2):
        mixed = posts.groupBy("name").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b")).where("_a != _b")
        posts = posts.join(materialize(mixed.select("name"), "mixed"), "name", "left_semi")
        lists = posts.groupBy("key", "needed", "comp").agg(F.collect_list(F.struct("pos", "name")).alias("kept"))
        lists = materialize(lists.where(F.size("kept") >= F.col("needed")), "apart")
        posts = lists.select("key", "needed", "comp", F.inline("kept"))
    return lists


def _without_contained(held: DataFrame) -> DataFrame:
    """Postings without the buckets whose sets all meet in another bucket as well.

    Each set names its largest bucket of at most a block. If all sets of a bucket name the same
    other one, they are all in that one, which stays: a set that names it is in it.
    """
    sizes = held.groupBy("name").agg(F.count("*").alias("_n"))
    counted = held.join(sizes, "name")
    fits = F.when(F.col("_n") <= BLOCK_SETS, F.col("_n"))
    largest = counted.groupBy("key").agg(F.max_by("name", F.struct(fits.alias("n"), "name")).alias("_largest"))
    named = held.join(materialize(largest, "largest"), "key")
    agreed = named.groupBy("name").agg(F.min("_largest").alias("_a"), F.max("_largest").alias("_b"))
    left = materialize(agreed.where("_a != _b or _a = name").select("name"), "left")
    return held.join(left, "name", "left_semi")


def second_round(apart: DataFrame) -> DataFrame:
    """Blocks in which every two sets of different components that may still be similar meet.

    A set leaves its last ``needed`` - 1 buckets out: similar sets share ``needed`` of them, so the
    first one that they share is not among these. A bucket's largest component may hold most of
    it, so its sets only meet the others: blocks of the others with one another and with blocks of it.
    """
    first = F.slice(F.sort_array("kept"), F.lit(1), F.size("kept") - F.col("needed") + 1)
    held = apart.select("key", "comp", F.inline(first)).drop("pos")
    held = materialize(_without_contained(held), "held")
    sizes = held.groupBy("name", "comp").agg(F.count("*").alias("n")).groupBy("name").agg(
        F.sum("n").alias("total"), F.max("n").alias("main_sets"), F.max_by("comp", F.struct("n", "comp")).alias("main"),
        F.count("*").alias("comps"),
    ).where("comps > 1")
    rest = F.greatest(F.ceil((F.col("total") - F.col("main_sets")) / BLOCK_SETS), F.lit(1))
    main = F.greatest(F.ceil(F.col("main_sets") / BLOCK_SETS), F.lit(1))
    placed = held.join(materialize(sizes, "sizes"), "name").withColumns({"_rest": rest, "_main": main})
    of_main = F.col("comp") == F.col("main")
    own = F.when(of_main, F.col("_rest") + F.pmod(F.xxhash64("key"), F.col("_main"))).otherwise(F.pmod(F.xxhash64("key"), F.col("_rest")))
    placed = placed.withColumn("_own", own)
    partners = F.when(of_main, F.sequence(F.lit(0).cast("bigint"), F.col("_rest") - 1)).otherwise(
        F.sequence(F.lit(0).cast("bigint"), F.col("_rest") + F.col("_main") - 1)
    )
    small = F.col("total") <= BLOCK_SETS
    met = placed.withColumn("_with", F.explode(F.when(small, F.array(F.col("_own"))).otherwise(partners)))
    low, high = F.least("_own", "_with"), F.greatest("_own", "_with")
    block = F.when(small, 0).otherwise(low * (F.col("_rest") + F.col("_main")) + high)
    return met.select("key", "comp", "name", block.cast("bigint").alias("block"))


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, percent: int = 85
) -> DataFrame:
    """One row (id, ``n_shingles``, ``component_id``) for each row of ``docs``.

    A row's set holds the distinct runs of ``shingle`` words (``[^\\x20\\x09-\\x0D]+``, A-Z
    lower-cased) of its whole text; a text with fewer words is one run, NULL and texts without
    words have an empty set, which links with nothing. Two rows link where
    100 * intersection >= ``percent`` * union; the component id is the smallest id that can be
    reached over links, the row's own included. Rows with NULL ids are returned and link too; the
    component id is NULL only if all of its rows have none. Repeated rows are each returned. An
    empty table gives no rows. Other columns are ignored.

    Equal sets are reduced to one by a 128-bit name before anything else. Sets are ordered
    globally, frequent shingles last, and meet in the buckets of the first names of their order,
    where any two similar ones share a number of names that grows with their size; sets without
    that many are done. The others are joined in prefix trees, block by block: first in two
    buckets each, which joins nearly all of a group of copies, then wherever different components
    share a bucket and sketches of their sets do not rule them out. No pair within a component is looked at twice, so a group of very many near
    copies costs no more than its members, and no link between components is lost.
    """
    bounds = Threshold(percent)
    order = GlobalOrder(frequent_shingles(docs, text_col, shingle))
    prints = materialize(set_prints(docs, id_col, text_col, shingle, bounds, order), "set_prints")
    rows = prints.where("n > 0").groupBy("fp", "key", "needed", "id", "text_hash").agg(F.count("*").alias("times"))
    lowest = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash", "times"))
    distinct = rows.groupBy("fp", "key", "needed").agg(lowest.alias("first"))
    distinct = materialize(distinct.select("fp", "key", "needed", "first.id", "first.text_hash", "first.times"), "distinct_sets")
    kept = shared_names(prints).groupBy("key").agg(F.collect_set(F.struct("pos", "name")).alias("kept"))
    least = distinct.groupBy("key").agg(F.min("needed").alias("needed"))
    flagged = materialize(kept.join(least, "key").where(F.size("kept") >= F.col("needed")), "flagged")
    wanted = materialize(distinct.join(flagged.select("key"), "key", "left_semi").drop("needed"), "wanted")
    sets = materialize(whole_sets(docs, id_col, text_col, shingle, order, wanted), "sets")
    links = materialize(joined_blocks(first_round(flagged), sets, bounds), "first_links")
    comps = components(links).join(wanted, F.col("node") == F.col("fp")).groupBy("key").agg(
        F.min(F.xxhash64("root")).alias("comp")
    )
    apart = _still_apart(flagged, materialize(comps, "comps"))
    left = materialize(open_blocks(second_round(apart), sets, bounds), "open_blocks")
    more = materialize(joined_blocks(left, sets, bounds), "second_links")
    roots = materialize(components(links.unionByName(more)), "set_roots")
    named = distinct.select("fp", "id").join(roots, F.col("fp") == roots["node"], "left")
    named = named.select("fp", "id", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    of_set = materialize(named.join(least, "root").select("fp", "component_id"), "set_components")
    own = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return prints.join(of_set, "fp", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id")
    )
