"""Suffix trees of integer sequences, and longest common extensions from them in constant time."""

from __future__ import annotations

from array import array

import numpy as np

END = -1
_BLOCK = 16


def ukkonen(text: list[int]) -> tuple[array, array, array, array]:
    """The suffix tree of text, whose last symbol stands nowhere else: parent, start, end and first symbol of every node.

    Node 0 is the root; the edge into a node is text[start:end]. Built online from left to right: an implicit
    tree of each prefix, with suffix links, so the work grows with the length.
    """
    n = len(text)
    start, end, link, parent, first = array("q", [0]), array("q", [0]), array("q", [0]), array("q", [-1]), array("q", [END])
    width = max(text) + 2
    # An edge is found by its node and first symbol.
    edges: dict[int, int] = {}
    node, edge, length, left = 0, 0, 0, 0
    for i, symbol in enumerate(text):
        left += 1
        waiting = -1
        while left:
            if not length:
                edge = i
            key = node * width + text[edge]
            below = edges.get(key)
            if below is None:
                edges[key] = len(start)
                start.append(i), end.append(n), link.append(0), parent.append(node), first.append(text[edge])
                if waiting >= 0:
                    link[waiting] = node
                    waiting = -1
            else:
                size = min(end[below], i + 1) - start[below]
                if length >= size:
                    edge += size
                    length -= size
                    node = below
                    continue
                if text[start[below] + length] == symbol:
                    if waiting >= 0:
                        link[waiting] = node
                    length += 1
                    break
                split = len(start)
                edges[key] = split
                start.append(start[below]), end.append(start[below] + length), link.append(0), parent.append(node), first.append(text[edge])
                start[below] += length
                parent[below] = split
                first[below] = text[start[below]]
                edges[split * width + first[below]] = below
                edges[split * width + symbol] = len(start)
                start.append(i), end.append(n), link.append(0), parent.append(split), first.append(symbol)
                if waiting >= 0:
                    link[waiting] = split
                waiting = split
            left -= 1
            if node == 0 and length:
                length -= 1
                edge = i - left + 1
            elif node:
                node = link[node]
    return parent, start, end, first


class Extensions:
    """Longest common prefixes of suffixes, and the suffixes' order, by the lowest common ancestor in an Euler tour."""

    def __init__(self, text: list[int]):
        """Symbols are 0 or more; the end of the text is smaller than any."""
        n = len(text)
        tree = [np.frombuffer(x, np.int64) for x in ukkonen([x + 1 for x in text] + [0])]
        parent, start, end, first = tree
        count = len(parent)
        # Children lie together in the order of their first symbols.
        by = np.lexsort((first, parent))[1:]
        child_from = np.searchsorted(parent[by], np.arange(count + 1))
        children, bounds = by.tolist(), child_from.tolist()
        size = (end - start).tolist()
        tour, deep = array("q"), array("q")
        rank, seen = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        leaf, leaf_at = array("q"), array("q")
        # The tour goes down to a child, and comes by the node again after it.
        stack = [(0, 0, bounds[0])]
        while stack:
            node, depth, at = stack.pop()
            tour.append(depth)
            if bounds[node] == bounds[node + 1]:
                leaf.append(n + 1 - depth), leaf_at.append(len(tour) - 1)
            elif at < bounds[node + 1]:
                below = children[at]
                stack.append((node, depth, at + 1))
                stack.append((below, depth + size[below], bounds[below]))
        suffix = np.frombuffer(leaf, np.int64)
        rank[suffix] = np.arange(n + 1)
        seen[suffix] = np.frombuffer(leaf_at, np.int64)
        self.n, self.rank, self.seen = n, rank[:n], seen
        self._index(np.frombuffer(tour, np.int64))

    def _index(self, depth: np.ndarray) -> None:
        """Minima of stretches of the tour: from and to the ends of blocks, and of 1, 2, 4, ... blocks."""
        padded = np.full(-(-len(depth) // _BLOCK) * _BLOCK, depth.max(), np.int32)
        padded[:len(depth)] = depth
        blocks = padded.reshape(-1, _BLOCK)
        self.depth = padded
        self.upto = np.minimum.accumulate(blocks, axis=1).ravel()
        self.onwards = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.runs = [blocks.min(axis=1)]
        while (1 << len(self.runs)) <= len(blocks):
            half, last = 1 << (len(self.runs) - 1), self.runs[-1]
            self.runs.append(np.minimum(last[:-half], last[half:]))

    def lowest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The least depth between two places of the tour, for arrays of places."""
        a, b = np.minimum(a, b), np.maximum(a, b)
        low, high = a // _BLOCK, b // _BLOCK
        found = np.minimum(self.onwards[a], self.upto[b])
        inside = low == high
        if inside.any():
            x, y = a[inside], b[inside]
            least = self.depth[x]
            for k in range(1, _BLOCK):
                least = np.minimum(least, self.depth[np.minimum(x + k, y)])
            found[inside] = least
        gap = high - low - 1
        far = gap > 0
        if far.any():
            x, y, g = low[far] + 1, high[far], gap[far]
            level = np.frexp(g.astype(np.float64))[1] - 1
            least = np.empty(len(x), np.int32)
            for k in np.unique(level):
                own = level == k
                least[own] = np.minimum(self.runs[k][x[own]], self.runs[k][y[own] - (1 << k)])
            found[far] = np.minimum(found[far], least)
        return found

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at a and at b share; a suffix may begin at the end, and a <> b."""
        return self.lowest(self.seen[a], self.seen[b]).astype(np.int64)
