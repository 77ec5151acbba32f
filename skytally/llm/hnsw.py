"""A hierarchical navigable small-world graph over unit vectors, built and searched in batches of numpy."""

from __future__ import annotations

import io

import numpy as np

DEGREE = 16          # links per node on the upper levels, twice as many on the lowest
BUILD_BEAM = 48
BATCH = 256          # nodes inserted, or queries searched, together
EXTRA = 4            # links a node gives at most to nodes that no other link leads to
STEP = 4             # beam entries expanded at a time


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def levels_of(n: int, degree: int, seed: int = 1) -> np.ndarray:
    u = np.random.default_rng(seed).random(n)
    return np.floor(-np.log(1 - u) / np.log(degree)).astype(int)


class Graph:
    """``links[level]`` is (n, degree): neighbours of each node, -1 where there are fewer."""

    def __init__(self, x: np.ndarray, links: list[np.ndarray], entry: int):
        self.x, self.links, self.entry = x, links, entry

    # ------------------------------------------------------------------ search

    def _fresh(self, rows: np.ndarray, nodes: np.ndarray, visited: np.ndarray, q: np.ndarray):
        """Distinct unvisited (row, node) and their cosines; marks them visited."""
        ok = nodes >= 0
        key = rows[ok] * visited.shape[1] + nodes[ok]
        key = np.unique(key[~visited.reshape(-1)[key]])    # most neighbours of hits have been met before
        visited.reshape(-1)[key] = True
        rows, nodes = np.divmod(key, visited.shape[1])
        return rows, nodes, np.einsum("ij,ij->i", q[rows], self.x[nodes])

    def beam(self, q: np.ndarray, level: int, start: np.ndarray, width: int, visited: np.ndarray,
             least: float = np.inf, hits: list | None = None):
        """(nodes, cosines), each (queries, width), best first: the beams around ``start`` (queries, any).
        ``hits`` gets every (query, node, cosine) of ``least`` or more that was met on the way."""
        b, links = len(q), self.links[level]
        nodes = np.full((b, width), -1)
        cos = np.full((b, width), -np.inf)
        done = np.ones((b, width), bool)
        grown = (np.repeat(np.arange(b), start.shape[1]), start.reshape(-1))
        while True:
            r, c, s = self._fresh(*grown, visited, q)
            if hits is not None and len(r):
                near = s >= least
                hits.append((r[near], c[near], s[near]))
            if len(r):
                touched, inverse = np.unique(r, return_inverse=True)
                place = np.arange(len(r)) - np.searchsorted(r, r)
                room = int(place.max()) + 1
                n2, c2 = np.full((len(touched), room), -1), np.full((len(touched), room), -np.inf)
                n2[inverse, place], c2[inverse, place] = c, s
                alln, allc = np.hstack([nodes[touched], n2]), np.hstack([cos[touched], c2])
                alld = np.hstack([done[touched], n2 < 0])
                order = np.argsort(-allc, axis=1, kind="stable")[:, :width]
                nodes[touched], cos[touched], done[touched] = (np.take_along_axis(a, order, 1) for a in (alln, allc, alld))
            open_ = ~done
            first = open_ & (np.cumsum(open_, axis=1) <= STEP)
            r, c = np.nonzero(first)
            if not len(r):
                return nodes, cos
            done[r, c] = True
            near = links[nodes[r, c]]
            grown = (np.repeat(r, near.shape[1]), near.reshape(-1))

    def descend(self, q: np.ndarray, down_to: int, width: int = 4) -> np.ndarray:
        start = np.full((len(q), 1), self.entry)
        for level in range(len(self.links) - 1, down_to, -1):
            start, _ = self.beam(q, level, start, width, np.zeros((len(q), len(self.x)), bool))
        return start

    def nearest(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, cosines), each (queries, width), best first; -1 and -inf where a beam holds fewer."""
        start = np.hstack([self.descend(q, 0), np.full((len(q), 1), self.entry)])
        return self.beam(q, 0, start, width, np.zeros((len(q), len(self.x)), bool))

    def within(self, q: np.ndarray, least: float, width: int):
        """(query, node, cosine) found with cosine >= ``least``: beams of ``width``, then everything that
        links of hits lead to, as long as new hits come up."""
        out = []
        for at in range(0, len(q), BATCH):
            part = q[at:at + BATCH]
            visited = np.zeros((len(part), len(self.x)), bool)
            hits = []
            # from the entry every node can be reached
            start = np.hstack([self.descend(part, 0), np.full((len(part), 1), self.entry)])
            self.beam(part, 0, start, width, visited, least, hits)
            r, n, s = (np.concatenate(x) for x in zip(*hits, strict=True))
            while len(r):
                out.append((r + at, n, s))
                near = self.links[0][n]
                r, n, s = self._fresh(np.repeat(r, near.shape[1]), near.reshape(-1), visited, part)
                hit = s >= least
                r, n, s = r[hit], n[hit], s[hit]
        if not out:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    # ------------------------------------------------------------------- bytes

    def dumps(self) -> bytes:
        f = io.BytesIO()
        np.savez(f, x=self.x, entry=self.entry, **{f"l{k}": v for k, v in enumerate(self.links)})
        return f.getvalue()

    @staticmethod
    def loads(data: bytes) -> Graph:
        z = np.load(io.BytesIO(data))
        return Graph(z["x"], [z[f"l{k}"] for k in range(len(z.files) - 2)], int(z["entry"]))


def choose(x: np.ndarray, base: np.ndarray, cand: np.ndarray, cos: np.ndarray, keep: int) -> np.ndarray:
    """(rows, keep) of ``cand`` (rows, any; -1 is none): the nearest that aren't closer to one already
    chosen than to the row's own vector, then the nearest of the rest."""
    order = np.argsort(-np.where(cand >= 0, cos, -np.inf), axis=1, kind="stable")
    cand, cos = np.take_along_axis(cand, order, 1), np.take_along_axis(cos, order, 1)
    b, k = cand.shape
    v = x[np.maximum(cand, 0)]
    among = v @ v.transpose(0, 2, 1)
    taken = np.zeros((b, k), bool)
    for i in range(k):
        closer = (taken & (among[:, i] > cos[:, i, None])).any(1)
        taken[:, i] = (cand[:, i] >= 0) & ~closer & (taken.sum(1) < keep)
    rank = np.where(taken, 0, np.where(cand >= 0, 1, 2)) * k + np.arange(k)
    best = np.argsort(rank, axis=1, kind="stable")[:, :keep]
    out = np.take_along_axis(cand, best, 1)
    return out if out.shape[1] == keep else np.hstack([out, np.full((b, keep - out.shape[1]), -1)])


def build(x: np.ndarray, degree: int = DEGREE, width: int = BUILD_BEAM) -> Graph:
    """Insert unit vectors batch by batch, no batch larger than what the graph holds."""
    n = len(x)
    level = levels_of(n, degree)
    order = np.argsort(-level, kind="stable")  # nodes of the top level first
    top = int(level.max())
    g = Graph(x, [np.full((n, degree * (2 if k == 0 else 1)), -1) for k in range(top + 1)], int(order[0]))
    at = 1
    while at < n:
        new = order[at:at + min(BATCH, at)]
        q = x[new]
        start = np.full((len(new), 1), g.entry)
        among = q @ q.T
        np.fill_diagonal(among, -np.inf)
        for lv in range(top, -1, -1):
            nodes, cos = g.beam(q, lv, start, width, np.zeros((len(new), n), bool))
            start = nodes[:, :4]
            here = np.flatnonzero(level[new] >= lv)
            if not len(here):
                continue
            # candidates: the beam, and the nearest of the batch itself
            mates = np.argsort(-among[np.ix_(here, here)], axis=1)[:, :degree]
            mate_cos = np.take_along_axis(among[np.ix_(here, here)], mates, 1)
            mate_ids = np.where(np.isfinite(mate_cos), new[here][mates], -1)
            picked = choose(x, q[here], np.hstack([nodes[here], mate_ids]), np.hstack([cos[here], mate_cos]), degree)
            table = g.links[lv]
            table[new[here], :degree] = picked
            _link_back(x, table, np.repeat(new[here], degree), picked.reshape(-1))
        at += len(new)
    g.links[0] = _reachable(x, g.links[0], g.entry)
    return g


def _reachable(x: np.ndarray, table: np.ndarray, entry: int) -> np.ndarray:
    """``table`` with further columns, so that links lead from ``entry`` to every node: a node that none leads to
    gets one from the nearest node reached that has given fewer than ``EXTRA``."""
    n = len(x)
    reached, given = np.zeros(n, bool), np.zeros(n, int)
    more = np.full((n, EXTRA), -1)

    def spread(nodes: np.ndarray) -> None:
        while len(nodes):
            reached[nodes] = True
            near = np.unique(np.hstack([table[nodes], more[nodes]]))
            near = near[near >= 0]
            nodes = near[~reached[near]]

    spread(np.array([entry]))
    for node in np.flatnonzero(~reached):
        if not reached[node]:
            free = np.flatnonzero(reached & (given < EXTRA))
            owner = free[np.argmax(x[free] @ x[node])]
            more[owner, given[owner]] = node
            given[owner] += 1
            spread(np.array([node]))
    return np.hstack([table, more[:, :given.max()]])


def _link_back(x: np.ndarray, table: np.ndarray, source: np.ndarray, target: np.ndarray) -> None:
    """Let ``target`` link to ``source`` too; lists that overflow are chosen anew."""
    ok = target >= 0
    source, target = source[ok], target[ok]
    cap = table.shape[1]
    cos = np.einsum("ij,ij->i", x[source], x[target])
    order = np.lexsort((-cos, target))
    source, target = source[order], target[order]
    place = np.arange(len(target)) - np.searchsorted(target, target)
    some = place < cap
    source, target, place = source[some], target[some], place[some]
    owners, inverse = np.unique(target, return_inverse=True)
    more = np.full((len(owners), cap), -1)
    more[inverse, place] = source
    both = np.hstack([table[owners], more])
    # one entry per neighbour
    ordered = np.sort(both, axis=1)
    ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1
    for lo in range(0, len(owners), BATCH):
        own, cand = owners[lo:lo + BATCH], ordered[lo:lo + BATCH]
        near = np.einsum("ij,ikj->ik", x[own], x[np.maximum(cand, 0)])
        table[own] = choose(x, x[own], cand, near, cap)
