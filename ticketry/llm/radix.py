"""An adaptive radix tree over byte strings: node layouts that grow, compressed paths, no recursion."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Sorted:
    """Up to ``room`` children by sorted labels (the layouts of 4 and of 16)."""

    __slots__ = ("labels", "nodes", "room")

    def __init__(self, room: int = 4, labels: bytes = b"", nodes: tuple = ()):
        self.room, self.labels, self.nodes = room, bytearray(labels), list(nodes)

    def get(self, label: int):
        at = self.labels.find(label)
        return self.nodes[at] if at >= 0 else None

    def add(self, label: int, node):
        """The layout that holds the child too: this one, or the next larger."""
        if len(self.nodes) == self.room:
            grown = Sorted(16, self.labels, self.nodes) if self.room == 4 else Indexed(self)
            return grown.add(label, node)
        at = bisect_left(self.labels, label)
        self.labels.insert(at, label)
        self.nodes.insert(at, node)
        return self

    def items(self) -> Iterator[tuple[int, "Node"]]:
        return zip(self.labels, self.nodes)


class Indexed:
    """Up to 48 children; a table of 256 bytes says where each label's child is."""

    __slots__ = ("index", "nodes")

    def __init__(self, small: Sorted):
        self.index, self.nodes = bytearray(256), []
        for label, node in small.items():
            self.add(label, node)

    def get(self, label: int):
        at = self.index[label]
        return self.nodes[at - 1] if at else None

    def add(self, label: int, node):
        if len(self.nodes) == 48:
            return Direct(self).add(label, node)
        self.nodes.append(node)
        self.index[label] = len(self.nodes)
        return self

    def items(self) -> Iterator[tuple[int, "Node"]]:
        return ((label, self.nodes[at - 1]) for label, at in enumerate(self.index) if at)


class Direct:
    """A place for each of the 256 labels."""

    __slots__ = ("nodes",)

    def __init__(self, indexed: Indexed):
        self.nodes: list = [None] * 256
        for label, node in indexed.items():
            self.nodes[label] = node

    def get(self, label: int):
        return self.nodes[label]

    def add(self, label: int, node):
        self.nodes[label] = node
        return self

    def items(self) -> Iterator[tuple[int, "Node"]]:
        return ((label, node) for label, node in enumerate(self.nodes) if node is not None)


class Node:
    """``path`` follows the label that leads here; ``value`` belongs to the key that ends behind it."""

    __slots__ = ("path", "value", "children")

    def __init__(self, path: bytes, value=None, children=None):
        self.path, self.value, self.children = path, value, children

    def add(self, label: int, node: "Node") -> None:
        self.children = (self.children or Sorted()).add(label, node)

    def items(self) -> Iterator[tuple[int, "Node"]]:
        return self.children.items() if self.children else iter(())


def common(a: bytes, b: bytes) -> int:
    """Bytes that two strings have in common from the start."""
    least = min(len(a), len(b))
    a, b = memoryview(a), memoryview(b)
    low, step = 0, 64
    while low < least and a[low : low + step] == b[low : low + step]:
        low, step = min(low + step, least), 2 * step
    high = min(low + step, least)
    while low < high:  # the first difference, if any, lies in [low, high)
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTree:
    """Keys are byte strings, of which one may begin another."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value) -> None:
        """``value`` (not None) under ``key``; it replaces an earlier one."""
        node, at = self.root, 0
        while True:
            if not key.startswith(node.path, at):
                shared = common(node.path, memoryview(key)[at:])
                rest = Node(node.path[shared + 1 :], node.value, node.children)
                label = node.path[shared]
                node.path, node.value, node.children = node.path[:shared], None, None
                node.add(label, rest)
            at += len(node.path)
            if at == len(key):
                node.value = value
                return
            child = node.children.get(key[at]) if node.children else None
            if child is None:
                node.add(key[at], Node(key[at + 1 :], value))
                return
            node, at = child, at + 1

    def get(self, key: bytes):
        node, at = self.root, 0
        while key.startswith(node.path, at):
            at += len(node.path)
            if at == len(key):
                return node.value
            node = node.children.get(key[at]) if node.children else None
            if node is None:
                return None
            at += 1
        return None
