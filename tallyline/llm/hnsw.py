"""A hierarchical navigable small-world graph in numpy that searches many queries in step.

Nodes are scored as ``query . vector - offset``: without offsets by inner product (the cosine of unit
vectors), with half the squared lengths as offsets by Euclidean distance. Each layer holds about one in
``SCALE`` nodes of the layer below; a search starts at the best node of the top layer and goes down.
"""

from __future__ import annotations

import numpy as np

SCALE = 16
LINKS, MOST_LINKS = 32, 64
BUILD_BEAM = 48
BATCH = 1024
AT_ONCE, STEPS = 4, 16  # nodes of a beam expanded in one step: at least so many, and one in so many of its width
GATHERED = 1 << 18  # numbers of vectors gathered at a time: they stay in the processor's cache


class Layer:
    def __init__(self, vectors: np.ndarray, offsets: np.ndarray):
        """Room for all nodes; the last row stands for "none"."""
        self.vectors = np.vstack([vectors, np.zeros((1, vectors.shape[1]), np.float32)]).astype(np.float32)
        self.offsets = np.append(offsets, np.inf).astype(np.float32)
        self.none = len(vectors)
        self.links = np.full((len(vectors) + 1, MOST_LINKS), self.none, np.int32)
        self.size = 0

    def scores(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        columns, dim = nodes.shape[1], self.vectors.shape[1]
        out = np.empty((len(nodes), columns, 1), np.float32)
        rows = max(1, GATHERED // max(1, columns * dim))
        room = np.empty((rows * columns, dim), np.float32)
        for start in range(0, len(nodes), rows):
            some = nodes[start : start + rows]
            gathered = np.take(self.vectors, some.ravel(), axis=0, out=room[: some.size], mode="clip")
            np.matmul(gathered.reshape(*some.shape, dim), queries[start : start + rows, :, None], out=out[start : start + rows])
        return out[:, :, 0] - self.offsets[nodes]

    def beam(self, queries: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The best nodes reached for each query, best first, and their scores."""
        count = len(queries)
        nodes = np.full((count, width), self.none, np.int32)
        scores = np.full((count, width), -np.inf, np.float32)
        nodes[:, : entries.shape[1]] = entries
        scores[:, : entries.shape[1]] = self.scores(queries, entries)
        todo = nodes != self.none
        seen = np.zeros((count, self.none + 1), bool)
        np.put_along_axis(seen, entries.astype(np.int64), True, axis=1)
        seen[:, self.none] = True
        flat, starts = seen.ravel(), np.arange(count)[:, None] * (self.none + 1)
        active = np.arange(count)
        at_once = min(width, max(AT_ONCE, width // STEPS))
        while len(active):
            open_scores = np.where(todo[active], scores[active], -np.inf)
            picks = np.argpartition(-open_scores, at_once - 1, axis=1)[:, :at_once]
            has = np.isfinite(np.take_along_axis(open_scores, picks, axis=1))
            going = has.any(axis=1)
            active, picks, has = active[going], picks[going], has[going]
            if not len(active):
                break
            expanded = np.where(has, nodes[active[:, None], picks], self.none)
            todo[active[:, None], picks] = False
            near = np.take(self.links, expanded, axis=0).reshape(len(active), -1)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = self.none
            places = starts[active] + near
            near[np.take(flat, places)] = self.none
            flat[places] = True
            near.sort(axis=1)  # what has been seen is the last number, so that fewer columns are left to score
            near = near[:, : int((near != self.none).sum(axis=1).max())]
            all_nodes = np.concatenate([nodes[active], near], axis=1)
            all_scores = np.concatenate([scores[active], self.scores(queries[active], near)], axis=1)
            all_todo = np.concatenate([todo[active], near != self.none], axis=1)
            best = np.argpartition(-all_scores, width - 1, axis=1)[:, :width]
            nodes[active] = np.take_along_axis(all_nodes, best, axis=1)
            scores[active] = np.take_along_axis(all_scores, best, axis=1)
            todo[active] = np.take_along_axis(all_todo, best, axis=1)
        order = np.argsort(-scores, axis=1, kind="stable")
        return np.take_along_axis(nodes, order, axis=1), np.take_along_axis(scores, order, axis=1)

    def insert(self, new: np.ndarray, entries: np.ndarray | None) -> None:
        """Links the nodes ``new`` (numbered on from the present size) with each other and the layer."""
        queries = self.vectors[new]
        own = queries @ queries.T - self.offsets[new]
        np.fill_diagonal(own, -np.inf)
        take = min(LINKS * 2, len(new) - 1)
        among = np.argpartition(-own, take - 1, axis=1)[:, :take] if take else np.empty((len(new), 0), int)
        candidates, scores = new[among], np.take_along_axis(own, among, axis=1)
        if self.size:
            found, found_scores = self.beam(queries, entries, BUILD_BEAM)
            candidates, scores = np.hstack([candidates, found]), np.hstack([scores, found_scores])
        if not candidates.shape[1]:
            self.size += len(new)
            return
        order = np.argsort(-scores, axis=1, kind="stable")
        candidates, scores = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(scores, order, axis=1)
        chosen = self._diverse(candidates, scores)
        rows, columns = np.nonzero(chosen)
        here, there, score = new[rows], candidates[rows, columns], scores[rows, columns]
        # A link counts in both directions; each node keeps its best ones.
        back = score + self.offsets[there] - self.offsets[here]
        ends = np.unique(there[there < self.size]) if self.size else np.empty(0, int)
        old = self.links[ends]
        kept_rows, kept_columns = np.nonzero(old != self.none)
        old_there = old[kept_rows, kept_columns]
        old_here = ends[kept_rows]
        old_score = self.scores(self.vectors[ends], old)[kept_rows, kept_columns]
        a = np.concatenate([here, there, old_here]).astype(np.int64)
        b = np.concatenate([there, here, old_there]).astype(np.int64)
        s = np.concatenate([score, back, old_score])
        _, unique = np.unique(a * (self.none + 1) + b, return_index=True)
        a, b, s = a[unique], b[unique], s[unique]
        order = np.lexsort((-s, a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        rank = np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)]))
        self.links[np.unique(a)] = self.none
        keep = rank < MOST_LINKS
        self.links[a[keep], rank[keep]] = b[keep]
        self.size += len(new)

    def _diverse(self, candidates: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Up to LINKS candidates of each row, best first, leaving out those nearer to a chosen one."""
        vectors = self.vectors[candidates]
        between = np.matmul(vectors, vectors.transpose(0, 2, 1))
        offsets = self.offsets[candidates]
        chosen = np.zeros(candidates.shape, bool)
        covered = np.full(candidates.shape, -np.inf, np.float32)  # best score of each candidate among the chosen
        for j in range(candidates.shape[1]):
            # Both scores leave out the same node's offset, so that they compare as distances do.
            good = np.isfinite(scores[:, j]) & (covered[:, j] < scores[:, j]) & (chosen.sum(axis=1) < LINKS)
            chosen[good, j] = True
            covered[good] = np.maximum(covered[good], between[good, j] - offsets[good])
        return chosen


class Graph:
    """Built over all of its vectors at once."""

    def __init__(self, vectors: np.ndarray, offsets: np.ndarray | None = None, seed: int = 1):
        vectors = np.asarray(vectors, np.float32)
        offsets = np.zeros(len(vectors), np.float32) if offsets is None else np.asarray(offsets, np.float32)
        order = np.random.default_rng(seed).permutation(len(vectors))
        self.node_of = order  # layer 0 numbers nodes in this order; layer l holds its first n / SCALE^l
        self.layers: list[Layer] = []
        size = len(vectors)
        while True:
            self.layers.append(Layer(vectors[order[:size]], offsets[order[:size]]))
            if size <= BATCH // SCALE:
                break
            size = -(-size // SCALE)
        at = 0
        while at < len(vectors):
            end = min(len(vectors), at + min(BATCH, max(BATCH // SCALE, at)))
            for depth, layer in enumerate(self.layers):
                new = np.arange(at, min(end, layer.none))
                if len(new):
                    layer.insert(new, self._entries(layer.vectors[new], depth, 1) if at else None)
            at = end

    def _entries(self, queries: np.ndarray, depth: int, width: int) -> np.ndarray:
        """Where to enter layer ``depth``."""
        top = self.layers[-1]
        scores = queries @ top.vectors[: top.size].T - top.offsets[: top.size]
        entries = np.argmax(scores, axis=1)[:, None].astype(np.int32)
        for layer in self.layers[-2:depth:-1]:
            entries = layer.beam(queries, entries, 8)[0][:, :4]
        return entries

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query, up to ``width`` nodes, best first (-1 for none), and their scores."""
        width = max(width, AT_ONCE, 8)
        queries = np.asarray(queries, np.float32)
        nodes = np.empty((len(queries), width), np.int64)
        scores = np.empty((len(queries), width), np.float32)
        for start in range(0, len(queries), BATCH):
            part = slice(start, start + BATCH)
            found, scores[part] = self.layers[0].beam(queries[part], self._entries(queries[part], 0, 8), width)
            nodes[part] = np.where(found == self.layers[0].none, -1, np.append(self.node_of, -1)[found])
        return nodes, scores
