"""An adaptive radix tree over byte keys: node layouts that grow, and compressed paths."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

#: Children a layout holds before it grows into the next one.
SMALL, LISTED = 16, 48


class SortedLayout:
    """Up to 16 children: their bytes in order, and beside them the children."""

    __slots__ = ("bytes", "nodes")

    def __init__(self):
        self.bytes, self.nodes = bytearray(), []

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return None if at < 0 else self.nodes[at]

    def put(self, byte: int, node):
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.nodes[at] = node
            return self
        if len(self.nodes) == SMALL:
            return _grown(self, IndexedLayout()).put(byte, node)
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def items(self) -> Iterator[tuple[int, object]]:
        return zip(self.bytes, self.nodes)


class IndexedLayout:
    """Up to 48 children: a table of 256 places into a list of children."""

    __slots__ = ("place", "nodes")

    def __init__(self):
        self.place, self.nodes = bytearray(256), []

    def get(self, byte: int):
        at = self.place[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node):
        at = self.place[byte]
        if at:
            self.nodes[at - 1] = node
            return self
        if len(self.nodes) == LISTED:
            return _grown(self, FullLayout()).put(byte, node)
        self.nodes.append(node)
        self.place[byte] = len(self.nodes)
        return self

    def items(self) -> Iterator[tuple[int, object]]:
        return ((b, self.nodes[at - 1]) for b, at in enumerate(self.place) if at)


class FullLayout:
    """Any number of children: one slot a byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node):
        self.nodes[byte] = node
        return self

    def items(self) -> Iterator[tuple[int, object]]:
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


def _grown(layout, larger):
    for byte, node in layout.items():
        larger.put(byte, node)
    return larger


class Node:
    """All keys below share ``key[:end]``; ``key`` is one of them. ``value`` is set where one ends."""

    __slots__ = ("key", "end", "children", "value")

    def __init__(self, key: bytes, end: int, value=None):
        self.key, self.end, self.value = key, end, value
        self.children = SortedLayout()


def shared_length(a: bytes, b: bytes, start: int, stop: int) -> int:
    """Length of the common beginning of two keys, which agree before ``start``."""
    while start < stop:
        step = min(64, stop - start)
        if a[start:start + step] == b[start:start + step]:
            start += step
            continue
        while a[start] == b[start]:
            start += 1
        return start
    return stop


class RadixTree:
    """Keys of any length, each with a value."""

    def __init__(self):
        self.root = Node(b"", 0)

    def insert(self, key: bytes, value) -> Node:
        """The node at which ``key`` ends, with ``value``."""
        at, above = self.root, None
        depth = 0
        while True:
            common = shared_length(at.key, key, depth, min(at.end, len(key)))
            if common < at.end:  # the compressed path is left here, or the key ends on it
                upper = Node(at.key, common)
                upper.children = upper.children.put(at.key[common], at)
                above.children = above.children.put(key[above.end], upper)
                at = upper
            depth = at.end
            if depth == len(key):
                at.value = value
                return at
            child = at.children.get(key[depth])
            if child is None:
                leaf = Node(key, len(key), value)
                at.children = at.children.put(key[depth], leaf)
                return leaf
            above, at = at, child

    def nodes(self) -> Iterator[tuple[Node, Node | None]]:
        """(node, its parent), parents first, children in the order of their bytes."""
        todo: list[tuple[Node, Node | None]] = [(self.root, None)]
        while todo:
            node, parent = todo.pop()
            yield node, parent
            todo.extend((child, node) for _, child in reversed(list(node.children.items())))
