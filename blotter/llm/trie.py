"""Prefix-tree similarity join of one block of sets.

Sets are ascending arrays of 64-bit keys whose order is the global one (rarest
first). They are laid out as a prefix tree by sorting them; a walk down the
tree carries, for every set of the block as a query, the overlap with the path
so far, so sets below a node share the work of their common prefix. A subtree
is left when no query can reach the overlap it needs with the elements that
remain below.
"""

from __future__ import annotations

import numpy as np

from .text import ranges


class Union:
    """Disjoint sets over 0..n-1; the root is the smallest member."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def add(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def links(sets: list[np.ndarray], sizes: np.ndarray, num: int, den: int,
          asks: np.ndarray | None = None) -> Union:
    """Union of all pairs of ``sets`` with den * overlap >= num * union.

    ``sizes`` are the whole set sizes (a set may leave out elements that no
    other set holds). ``asks`` limits the queries to those sets; every set is
    still in the tree."""
    n = len(sets)
    out = Union(n)
    if n < 2:
        return out
    lens = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    if not len(flat):
        return out
    _, rank = np.unique(flat, return_inverse=True)
    ends = np.cumsum(lens)
    starts = ends - lens
    ids = [rank[a:b] for a, b in zip(starts, ends)]
    # postings: rank -> queries that hold it
    asks = np.arange(n) if asks is None else asks
    q_rank = np.concatenate([ids[q] for q in asks]) if len(asks) else np.zeros(0, np.int64)
    q_of = np.repeat(np.arange(len(asks)), lens[asks])
    order = np.argsort(q_rank, kind="stable")
    post = q_of[order]
    post_at = np.searchsorted(q_rank[order], np.arange(rank.max() + 2))
    q_size = sizes[asks]

    tree = sorted(range(n), key=lambda i: ids[i].astype(">u4").tobytes())
    lcp = np.zeros(n + 1, np.int64)
    for i in range(1, n):
        a, b = ids[tree[i - 1]], ids[tree[i]]
        m = min(len(a), len(b))
        diff = np.flatnonzero(a[:m] != b[:m])
        lcp[i] = diff[0] if len(diff) else m
    t_size = sizes[tree]
    t_len = lens[tree]

    def grown(overlap, tokens):
        size = post_at[tokens + 1] - post_at[tokens]
        return overlap + np.bincount(post[ranges(post_at[tokens], size)], minlength=len(asks))

    stack = [(0, n, 0, np.zeros(len(asks), np.int64))]
    while stack:
        lo, hi, depth, overlap = stack.pop()
        path = ids[tree[lo]]
        to = int(lcp[lo + 1:hi].min()) if hi - lo > 1 else len(path)
        least, most = int(t_size[lo:hi].min()), int(t_len[lo:hi].max())
        need = -(-num * (q_size + least) // (num + den))
        alive = True
        while depth < to:
            step = min(to, depth + max(16, (len(path) - depth) // 4))
            overlap = grown(overlap, path[depth:step])
            depth = step
            viable = overlap + (most - depth) >= need
            if hi - lo == 1:  # a set always reaches itself
                viable[asks == tree[lo]] = False
            if not viable.any():
                alive = False
                break
        if not alive:
            continue
        i = lo
        while i < hi and t_len[i] == to:  # sets that end here
            hit = np.flatnonzero((num + den) * overlap >= num * (q_size + t_size[i]))
            for q in asks[hit]:
                out.add(int(q), tree[i])
            i += 1
        while i < hi:
            j = i + 1
            while j < hi and lcp[j] > to:
                j += 1
            stack.append((i, j, to, overlap))
            i = j
    return out
