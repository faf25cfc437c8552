"""A trie of globally ordered sets, searched for Jaccard neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


class Similar:
    """Jaccard threshold as a fraction, so that borderline pairs are exact."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def overlap(self, a: int, b: int) -> int:
        """Least common elements of sets of sizes ``a`` and ``b`` that are similar."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def prefix(self, size: int) -> int:
        """Rarest elements among which a similar set must share one."""
        return size - -(-self.num * size // self.den) + 1


class _Node:
    __slots__ = ("tokens", "depth", "children", "members", "low", "high")

    def __init__(self, tokens: np.ndarray, depth: int):
        self.tokens, self.depth = tokens, depth  # depth: elements from the root to the end of this node
        self.children: list[_Node] = []
        self.members: list[int] = []
        self.low = self.high = 0


class PrefixTree:
    """Sets in one global order: elements shared by many sets come first.

    Sets with a common beginning share its nodes, and so do the partial overlaps
    of a search. A subtree is left when the elements that remain, of the query
    and of the largest set below, cannot reach the overlap the smallest needs.
    """

    def __init__(self, sets: list[np.ndarray]):
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        self._vocabulary, where, counts = np.unique(every, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        self._rank = np.empty(len(order), np.int64)
        self._rank[order] = np.arange(len(order))
        ends = np.cumsum([len(s) for s in sets])
        self.sets = [np.sort(self._rank[w]) for w in np.split(where, ends[:-1])] if sets else []
        self.root = self._build()

    def _build(self) -> _Node:
        root = _Node(np.zeros(0, np.int64), 0)
        path = [root]
        last = np.zeros(0, np.int64)
        for i in sorted(range(len(self.sets)), key=lambda i: self.sets[i].astype(">i8").tobytes()):
            tokens = self.sets[i]
            width = min(len(last), len(tokens))
            differ = np.flatnonzero(last[:width] != tokens[:width])
            common = int(differ[0]) if len(differ) else width
            while path[-1].depth > common:
                node = path.pop()
                above = path[-1]
                if above.depth < common:  # split: the upper part becomes a node of its own
                    cut = common - above.depth
                    upper = _Node(node.tokens[:cut], common)
                    node.tokens = node.tokens[cut:]
                    above.children[-1] = upper
                    upper.children.append(node)
                    path.append(upper)
            if len(tokens) > common or path[-1] is root:
                leaf = _Node(tokens[common:], len(tokens))
                path[-1].children.append(leaf)
                path.append(leaf)
            path[-1].members.append(i)
            last = tokens
        self._bound(root)
        return root

    def _bound(self, root: _Node) -> None:
        stack, order = [root], []
        while stack:
            node = stack.pop()
            order.append(node)
            stack.extend(node.children)
        for node in reversed(order):
            sizes = [node.depth] if node.members else []
            node.low = min(sizes + [c.low for c in node.children], default=0)
            node.high = max(sizes + [c.high for c in node.children], default=0)

    def ranks(self, elements: np.ndarray) -> np.ndarray:
        """Ranks of the elements that the tree knows."""
        at = np.searchsorted(self._vocabulary, elements)
        at = at[(at < len(self._vocabulary)) & (self._vocabulary[np.minimum(at, len(self._vocabulary) - 1)] == elements)] if len(self._vocabulary) else at[:0]
        return self._rank[at]

    def search(self, ranks: np.ndarray, size: int, similar: Similar) -> Iterator[int]:
        """Sets similar to a set of ``size`` elements whose known ones have ``ranks``."""
        mask = np.zeros(len(self._vocabulary) + 1, np.int64)
        mask[ranks] = 1
        later = np.concatenate((np.cumsum(mask[::-1])[::-1], [0]))  # query elements from a rank on
        stack = [(self.root, 0)]
        while stack:
            node, shared = stack.pop()
            if len(node.tokens):
                shared += int(mask[node.tokens].sum())
                rest = int(later[node.tokens[-1] + 1])
            else:
                rest = int(later[0])
            for i in node.members:
                if shared >= similar.overlap(size, node.depth):
                    yield i
            for child in node.children:
                reach = shared + min(rest, child.high - node.depth)
                if reach >= similar.overlap(size, child.low):
                    stack.append((child, shared))


class Groups:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = sorted((self.find(i), self.find(j)))
        self.parent[j] = i
        return i != j
