"""Suffix trees of integer sequences and constant-time longest common extensions.

``SuffixTree`` is built from left to right by Ukkonen's algorithm. Its Euler tour
turns the lowest common ancestor of two leaves into a range minimum over string
depths, which blocks and a sparse table of block minima answer in constant time, for
whole arrays of queries at once.
"""

from __future__ import annotations

import numpy as np

_BLOCK = 16


def _ukkonen(s: list[int]) -> tuple[list[int], list[int], list[dict | None]]:
    """Edge starts, edge ends and children of the nodes (none for a leaf); 0 is the root.

    ``s`` must end with a value that occurs nowhere else. Leaves are numbered in
    the order of their suffixes.
    """
    n = len(s)
    start, end, kids, link = [0], [0], [{}], [0]
    node = edge = length = pending = 0
    for i in range(n):
        c = s[i]
        pending += 1
        inner = 0
        while pending:
            if not length:
                edge = i
            below = kids[node]
            first = s[edge]
            to = below.get(first)
            if to is None:
                below[first] = len(start)
                start.append(i)
                end.append(n)
                kids.append(None)
                link.append(0)
                if inner:
                    link[inner] = node
                inner = 0
            else:
                at = start[to]
                span = end[to] - at
                if length >= span:
                    edge += span
                    length -= span
                    node = to
                    continue
                other = s[at + length]
                if other == c:
                    length += 1
                    if inner:
                        link[inner] = node
                    break
                split = len(start)
                start.append(at)
                end.append(at + length)
                kids.append({other: to, c: split + 1})
                link.append(0)
                below[first] = split
                start[to] = at + length
                start.append(i)
                end.append(n)
                kids.append(None)
                link.append(0)
                if inner:
                    link[inner] = split
                inner = split
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - pending + 1
    return start, end, kids


class RangeMinimum:
    """Minima of ranges of a fixed array, each in constant time."""

    def __init__(self, values: np.ndarray):
        pad = -len(values) % _BLOCK
        v = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, _BLOCK)
        self.flat = v.ravel()
        self.left = np.minimum.accumulate(v, axis=1).ravel()
        self.right = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [v.min(axis=1)]
        step = 1
        while 2 * step <= len(v):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def query(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of the values at ``lo`` to ``hi``, both included, ``lo <= hi``."""
        out = np.minimum(self.right[lo], self.left[hi])
        a, b = lo // _BLOCK, hi // _BLOCK
        same = np.flatnonzero(a == b)
        if len(same):
            at = (a[same] * _BLOCK)[:, None] + np.arange(_BLOCK)
            inside = (at >= lo[same, None]) & (at <= hi[same, None])
            out[same] = np.where(inside, self.flat[at], np.iinfo(self.flat.dtype).max).min(axis=1)
        wide = np.flatnonzero(b - a > 1)
        if len(wide):
            first, size = a[wide] + 1, b[wide] - a[wide] - 1
            level = np.frexp(size)[1] - 1
            for k in np.unique(level):
                of = level == k
                row, l, r = self.table[k], first[of], first[of] + size[of] - (1 << int(k))
                out[wide[of]] = np.minimum(out[wide[of]], np.minimum(row[l], row[r]))
        return out


class SuffixTree:
    """Suffix tree of ``values`` (non-negative), with an end mark below every value."""

    def __init__(self, values: list[int]):
        s = [*values, -1]
        n = len(s)
        start, end, kids = _ukkonen(s)
        depth, place, suffix = [0] * len(start), [0] * n, [0] * len(start)
        leaf = 0
        for v, k in enumerate(kids):
            if k is None:
                suffix[v] = leaf
                leaf += 1
        tour, order, stack = [], [], [0]
        while stack:
            v = stack.pop()
            if v < 0:
                tour.append(depth[~v])
                continue
            k = kids[v]
            if k is None:
                place[suffix[v]] = len(tour)
                order.append(suffix[v])
                tour.append(depth[v])
                continue
            d = depth[v]
            tour.append(d)
            kids[v] = below = [c for _, c in sorted(k.items())]
            for c in reversed(below):
                depth[c] = d + end[c] - start[c]
                stack.append(c)
                stack.append(~v)
            stack.pop()
        self.size = n - 1
        self._kids, self._suffix, self._ends = kids, suffix, {v for v, x in enumerate(end) if x == n and s[start[v]] == -1}
        self.order = order
        self._place = np.array(place, np.int64)
        self._tour = RangeMinimum(np.array(tour, np.int64))

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``i`` and ``j`` (``i != j``, up to the size)."""
        a, b = self._place[i], self._place[j]
        return self._tour.query(np.minimum(a, b), np.maximum(a, b))

    def descending(self) -> list[int]:
        """The suffixes in the order of inverted values; a prefix still comes before what it begins."""
        out, stack = [], [0]
        while stack:
            v = stack.pop()
            k = self._kids[v]
            if k is None:
                out.append(self._suffix[v])
            elif k[0] in self._ends:
                stack += k[1:]
                stack.append(k[0])
            else:
                stack += k
        return out
