"""Near-duplicate embeddings: vectors meet in cells around centroids, each cell a shard that is searched by its members.

A large table's vectors go to the cell of their nearest centroid and to every other cell whose boundary with it
is at most a margin away. The margin is the one with which ``AUDIT_RECALL`` of audited pairs at the linking angle
share a cell: vectors of a sample, turned by that angle into any direction and towards other vectors, and the
sample's own pairs. Two vectors are compared in the first cell they share, so that no pair counts twice. Many
centroids are found by a small-world graph, whose beam is widened until the audit passes; a small table is one cell.

Vectors of a cell within half the linking angle of each other's centre are a ball: all of them are linked, whatever
their number, so that a large group of near copies is counted, not paired. Centres are compared as a matrix product;
where a shard holds more centres than a beam of its graph is worth, each centre is searched in the graph. A beam that
such centres fill to half is widened. So is a shard's until an audit of ``AUDITS`` of its own vectors that have
partners in it, and then a block's until an audit of ``AUDITS`` of its queries, find ``AUDIT_RECALL`` of the centres
that may hold partners and of the nearest ones, both against all centres. Balls that lie within the linking angle as
a whole are counted; members of the others are verified one by one by cosine in double precision. One link per ball
is enough to unite components. A vector finds its own ball by its place, not by search.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Callable, Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.llm.common import ship_package, stored
from tallyline.llm.graphs import components
from tallyline.llm.hnsw import BATCH, Graph
from tallyline.llm.vectors import is_vector, matrix, unit, usable_vectors

CELL_ROWS = 2048  # vectors for each centroid
ONE_CELL = 65_536  # up to so many vectors all are one cell
PART_ROWS = 16_384  # vectors in each part of a table of one cell
SHARD_ROWS = 100_000  # vectors of a cell that are searched at once; a larger cell is searched in pairs of parts
GRAPH_CELLS = 32_768  # from so many centroids on a graph finds them in less time than a product with all
SAMPLED, COPIED = 8192, 4  # sampled rows beside the centroids; a vector so many of them share is searched once for all its rows
FIRST_BEAM = 64
EXACT_SHARE = 16  # beams of a wider share of the centres than 1 in so many give way to all centres
PRODUCT_SHARE = 2048  # the same where the shard's own centres are compared, in one product: 1.4 ns a pair, a beam of 64 takes 160 us
AUDITS, AUDIT_RECALL = 256, 0.99
PAIRS = 2048  # audited for the margin, of each kind
ROUNDING = 1e-4  # of the graph's cosines, which are single precision
SLACK = 1e-6  # radians by which a whole ball must lie inside, against rounding
BLOCK = 256, 2048  # centres on either side of a product at a time, which stays in the processor's cache

SENT = ["vec_id", "row", "weight", "vectors", "cells", "n_cells"]  # of many vectors at a time, as bytes
SENT_TYPE = "dim int, task bigint, " + ", ".join(f"{name} binary" for name in SENT)
CHUNK_BYTES, MOST_SENT = 16 << 20, 1024  # vectors dealt at a time; vectors sent in a row
ENTRY_BYTES, PARTITION_BYTES = 32, 64 << 20  # of a vector sent, beside its components; of all that is sent, for each task
ROUND_LEAST, ROUND_SHARE = 1 << 30, 3  # bytes, and times the vectors' own size, beyond which the cells are searched in rounds
FOUND_TYPE = "vec_id bigint, row bigint, n bigint, copies int, partners array<bigint>"
FOUND = ["vec_id", "row", "n", "copies", "partners"]
NONE_FOUND = pa.table([*(pa.array([], pa.int64()) for _ in range(3)), pa.array([], pa.int32()), pa.array([], pa.list_(pa.int64()))], names=FOUND)


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


class Balls:
    """A shard's vectors gathered around centres no more than ``radius`` away."""

    def __init__(self, vectors: np.ndarray, radius: float):
        units = unit(vectors)
        self.centres: list[int] = []
        self.centre = np.empty(len(units), np.int64)
        self.angle = np.zeros(len(units))
        near = math.cos(radius)
        single = units.astype(np.float32)
        graph, in_graph = None, 0
        for start in range(0, len(units), BATCH):
            rows = np.arange(start, min(start + BATCH, len(units)))
            best, score = np.full(len(rows), -1), np.full(len(rows), -2.0)
            if graph is not None:
                best = graph.search(units[rows], 8)[0][:, 0]
                score = np.einsum("ij,ij->i", units[rows], units[np.array(self.centres)[best]])
            for first in range(in_graph, len(self.centres), BLOCK[1]):  # centres younger than the graph, if there is one
                some = np.array(self.centres[first : first + BLOCK[1]])
                at = (single[rows] @ single[some].T).argmax(axis=1)
                recent = np.einsum("ij,ij->i", units[rows], units[some[at]])
                better = recent > score
                best[better], score[better] = first + at[better], recent[better]
            far = np.flatnonzero(score < near)
            among = units[rows[far]] @ units[rows[far]].T >= near
            alone = among.sum(axis=1) <= 1
            free = np.ones(len(far), bool)
            for i in range(len(far)):  # the first of the vectors no centre holds yet is one
                if free[i]:
                    held = i if alone[i] else np.append(np.flatnonzero(free & among[i]), i)
                    free[held] = False
                    best[far[held]] = len(self.centres)
                    self.centres.append(int(rows[far[i]]))
            self.centre[rows] = best
            self.angle[rows] = angles(np.einsum("ij,ij->i", units[rows], units[np.array(self.centres)[best]]))
            if len(self.centres) > max(GRAPH_CELLS, 2 * in_graph):
                graph, in_graph = Graph(units[self.centres]), len(self.centres)


class Shard:
    """A shard as it is searched."""

    def __init__(self, row: dict):
        self.vec_id = np.frombuffer(row["vec_id"], np.int64)
        self.row = np.frombuffer(row["row"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(len(self.vec_id), -1)
        self.ball = centre = np.frombuffer(row["centre"], np.int64)
        angle = np.frombuffer(row["angle"], np.float64)
        self.units = unit(self.vectors)
        # Members ball by ball, in the order of their angles to the centre.
        self.members = np.lexsort((angle, centre))
        sizes = np.bincount(centre)
        self.starts = np.cumsum(sizes) - sizes
        self.sizes = sizes
        self.radius = np.maximum.reduceat(angle[self.members], self.starts)
        self.centres = self.units[self.members[self.starts]]  # the centre itself has the smallest angle
        self.weight = row.get("weight", np.ones(len(self.vec_id), np.int64))  # rows of the table behind each vector
        self.weights = np.add.reduceat(self.weight[self.members], self.starts)
        self.beam = FIRST_BEAM

    @cached_property
    def graph(self) -> Graph:
        return Graph(self.centres)

    def exact(self, width: int, share: int = EXACT_SHARE) -> bool:
        """Whether queries are compared with all centres instead of a beam so wide."""
        return share * width >= len(self.centres)

    def audited_beam(self, queries: np.ndarray, cosines: np.ndarray, least: float, width: int) -> int:
        """The first width from ``width`` on that finds enough of the centres at ``least`` or more and of the nearest."""
        expected, nearest, each = cosines >= least, cosines.argmax(axis=1), np.arange(len(queries))
        while len(queries) and not self.exact(width):
            nodes, _ = self.graph.search(queries, width)
            found = np.zeros((len(queries), len(self.centres) + 1), bool)
            found[each[:, None], nodes] = True  # -1 for none is the last column
            partners, best = (found[:, :-1] & expected).sum(), found[each, nearest].sum()
            if partners >= AUDIT_RECALL * expected.sum() and best >= AUDIT_RECALL * len(queries):
                break
            width *= 2
        return width

    def partnered(self, linked: float) -> np.ndarray:
        """``AUDITS`` of the shard's own vectors that have partners in it, or all of them if there are fewer."""
        order, chosen = np.random.default_rng(1).permutation(len(self.units)), np.empty(0, np.int64)
        for start in range(0, len(order), AUDITS):
            some = order[start : start + AUDITS]
            partners = (self.units[some] @ self.units.T >= math.cos(linked)).sum(axis=1) - 1
            chosen = np.append(chosen, some[partners > 0])
            if len(chosen) >= AUDITS:
                break
        return chosen[:AUDITS]

    def own_beam(self, linked: float) -> int:
        """The beam that the shard's own vectors need. A centre finds itself at once, so that does not count."""
        if self.exact(self.beam):
            return self.beam
        audited = self.partnered(linked)
        queries = self.units[audited]
        cosines = queries @ self.centres.T
        place = self.members[self.starts[self.ball[audited]]] == audited
        cosines[place, self.ball[audited][place]] = -2
        return self.audited_beam(queries, cosines, math.cos(linked + self.radius.max()), self.beam)

    def candidates(self, queries: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and ball whose centre is at most ``reach`` radians away."""
        least = math.cos(reach)
        audited = queries[:: max(1, len(queries) // AUDITS)]
        width = self.beam if self.exact(self.beam) else self.audited_beam(audited, audited @ self.centres.T, least, self.beam)
        todo = np.arange(len(queries))
        rows, balls = [], []
        while len(todo) and not self.exact(width):
            nodes, scores = self.graph.search(queries[todo], width)
            close = (scores >= least - ROUNDING) & (nodes >= 0)
            done = close.sum(axis=1) <= width // 2
            at, column = np.nonzero(close & done[:, None])
            rows.append(todo[at])
            balls.append(nodes[at, column])
            todo = todo[~done]
            width *= 2
        for start in range(0, len(todo), AUDITS):
            some = todo[start : start + AUDITS]
            at, ball = np.nonzero(queries[some] @ self.centres.T >= least - ROUNDING)
            rows.append(some[at])
            balls.append(ball)
        return np.concatenate(rows), np.concatenate(balls)

    def places(self, vec_id: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and member that are the same vector of the table, or copies of it."""
        order = np.argsort(self.row, kind="stable")
        first, upto = (np.searchsorted(self.row[order], row, side) for side in ("left", "right"))
        query = np.repeat(np.arange(len(row)), upto - first)
        step = np.arange(len(query)) - np.repeat(np.cumsum(upto - first) - (upto - first), upto - first)
        member = order[first[query] + step]
        same = self.vec_id[member] == vec_id[query]
        return query[same], member[same]

    def partners(
        self, queries: np.ndarray, linked: float, vec_id: np.ndarray, row: np.ndarray,
        own: np.ndarray | None = None, allowed: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
    ) -> tuple[np.ndarray, list[list[int]]]:
        """How many vectors here each query is linked with, itself and its copies by their place, and the
        id of one of them for each ball. ``own`` are the queries that count themselves, if not all do,
        ``allowed`` tells which pairs of query and ball count."""
        counts = np.zeros(len(queries), np.int64)
        partners: list[list[int]] = [[] for _ in range(len(queries))]
        itself, place = self.places(vec_id, row)
        if own is not None:
            itself, place = itself[own[itself]], place[own[itself]]
        rows, balls = self.candidates(queries, linked + self.radius.max())
        if allowed is not None:
            here = allowed(rows, balls)
            rows, balls = rows[here], balls[here]
        own_pairs = itself * len(self.centres) + self.ball[place]
        pairs = np.union1d(rows * len(self.centres) + balls, own_pairs)
        rows, balls = np.divmod(pairs, len(self.centres))
        angle = angles(np.einsum("ij,ij->i", queries[rows], self.centres[balls]))
        whole = angle + self.radius[balls] <= linked - SLACK
        np.add.at(counts, rows[whole], self.weights[balls[whole]])
        counted = np.isin(own_pairs, pairs[whole])
        np.subtract.at(counts, itself[counted], self.weight[place[counted]])
        np.add.at(counts, itself, self.weight[place])
        for at, ball in zip(rows[whole].tolist(), balls[whole].tolist(), strict=True):
            partners[at].append(int(self.vec_id[self.members[self.starts[ball]]]))
        least = math.cos(linked)
        part = ~whole & (angle - self.radius[balls] <= linked + SLACK)
        for at, ball in zip(rows[part].tolist(), balls[part].tolist(), strict=True):
            members = self.members[self.starts[ball] : self.starts[ball] + self.sizes[ball]]
            found = members[self.units[members] @ queries[at] >= least]
            if len(found):
                counts[at] += self.weight[found[(self.vec_id[found] != vec_id[at]) | (self.row[found] != row[at])]].sum()
                partners[at].append(int(self.vec_id[found[0]]))
        return counts, partners


def places_of(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns that hold; faster than two-dimensional ``nonzero`` where few do."""
    return np.divmod(np.flatnonzero(chosen.ravel()), chosen.shape[1])


def close_balls(a: Shard, b: Shard, linked: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a ball of ``a`` and one of ``b`` whose members may be partners; within one shard either order of a pair
    is found, and each ball beside itself."""
    orders = [np.argsort(s.radius, kind="stable") for s in (a, b)]
    left, right = (np.ascontiguousarray(s.centres[o], np.float32) for s, o in zip((a, b), orders, strict=True))
    for start in range(0, len(left), BLOCK[0]):
        rows = orders[0][start : start + BLOCK[0]]
        # Balls stand in the order of their radius, so that blocks of single vectors ask for the linking angle alone.
        least = np.cos(np.minimum(linked + a.radius[rows].max() + b.radius[orders[1]], math.pi)) - ROUNDING
        least = least.astype(np.float32)
        for at in range(start if a is b else 0, len(right), BLOCK[1]):
            scores = left[start : start + BLOCK[0]] @ right[at : at + BLOCK[1]].T
            i, j = places_of(scores >= least[at : at + BLOCK[1]])
            if a is b:  # the lower triangle is the upper one's mirror
                upper = start + i <= at + j
                i, j = i[upper], j[upper]
            x, y, score = rows[i], orders[1][at + j], scores[i, j]
            near = score >= np.cos(np.minimum(linked + a.radius[x] + b.radius[y], math.pi)) - ROUNDING
            x, y = x[near], y[near]
            if a is b:
                x, y = np.concatenate([x, y[x != y]]), np.concatenate([y, x[x != y]])
            yield x, y


class Cells:
    """Which cells hold a vector."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = unit(centroids)
        self.single = self.centroids.astype(np.float32)
        self.graph = Graph(self.centroids) if len(centroids) > GRAPH_CELLS else None
        self.beam, self.margin = FIRST_BEAM, 0.0
        self.parts = np.ones(len(centroids), np.int64)

    def near(self, units: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, cell and distance to the cell's boundary, for the nearest cell (0) and all others at most ``margin`` away;
        a row's cells in ascending order. Without a graph, equal vectors have equal cells, whatever rows they come with."""
        out = []
        for start in range(0, len(units), BLOCK[0]):
            some = units[start : start + BLOCK[0]]
            if self.graph:
                nodes, scores = self.graph.search(some, self.beam)
                rows, at = np.nonzero((nodes >= 0) & (scores >= scores[:, :1] - 2 * margin - ROUNDING))
                cells = nodes[rows, at]
                order = np.lexsort((cells, rows))
                rows, cells = rows[order], cells[order]
            else:
                scores = some.astype(np.float32) @ self.single.T
                rows, cells = places_of(scores >= scores.max(axis=1, keepdims=True) - np.float32(2 * margin + ROUNDING))
            score = np.einsum("ij,ij->i", some[rows], self.centroids[cells])
            first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            top = np.maximum.reduceat(score, first)
            is_top = np.flatnonzero(score == top[rows])
            best = cells[is_top[np.flatnonzero(np.r_[True, rows[is_top][1:] != rows[is_top][:-1]])]]
            apart = self.centroids[best][rows] - self.centroids[cells]
            away = (top[rows] - score) / np.maximum(np.sqrt(np.einsum("ij,ij->i", apart, apart)), 1e-12)
            kept = away <= margin
            out.append((start + rows[kept], cells[kept], away[kept]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def audit(self, sample: np.ndarray, linked: float) -> None:
        """Sets the margin (and the beam) with which ``AUDIT_RECALL`` of each kind of audited pairs share a cell."""
        random = np.random.default_rng(2)
        units = unit(sample)
        own = units[:PAIRS]
        # No vector is turned towards a centroid itself: a large group of near copies would be the direction of many.
        rows, cells, _ = self.near(units, 0.0)
        others = units[np.unique(rows[np.einsum("ij,ij->i", units[rows], self.centroids[cells]) < math.cos(linked)])]
        others = others[random.integers(0, len(others), len(own))] if len(others) else own
        kinds = []
        for towards in (others, random.standard_normal(own.shape)):
            aside = towards - np.einsum("ij,ij->i", towards, own)[:, None] * own
            length = np.linalg.norm(aside, axis=1)
            some = length > 1e-6
            aside = aside[some] / length[some, None]
            kinds.append((own[some], math.cos(linked) * own[some] + math.sin(linked) * aside))
        a, b = np.nonzero(np.triu(own @ units.T >= math.cos(linked), 1))
        some = random.permutation(len(a))[:PAIRS]
        kinds.append((own[a[some]], units[b[some]]))
        for left, right in kinds:
            if not len(left):
                continue
            reach = max(self.margin, 0.04)
            while True:
                needed = self._needed(left, right, reach)
                margin = float(np.quantile(needed, AUDIT_RECALL, method="higher"))
                if margin <= reach:
                    break
                reach *= 2
                if self.graph and reach > 1:
                    self.beam, reach = 2 * self.beam, max(self.margin, 0.04)
            self.margin = max(self.margin, margin)

    def _needed(self, left: np.ndarray, right: np.ndarray, reach: float) -> np.ndarray:
        """For each pair the least margin with which it shares a cell; infinite beyond ``reach``."""
        needed = np.full(len(left), np.inf)
        count = len(self.centroids)
        for start in range(0, len(left), AUDITS):
            some = slice(start, start + AUDITS)
            (a, c, x), (b, d, y) = self.near(left[some], reach), self.near(right[some], reach)
            _, i, j = np.intersect1d(a * count + c, b * count + d, return_indices=True)
            np.minimum.at(needed, start + a[i], np.maximum(x[i], y[j]))
        return needed

    def divide(self, sample: np.ndarray, count: int, shard_rows: int) -> None:
        """Sets the number of parts of each cell, by estimate from the sample of ``count`` vectors."""
        held = np.bincount(self.near(unit(sample), self.margin)[1], minlength=len(self.parts))
        self.parts = np.maximum(1, np.ceil(held * (count / len(sample) / shard_rows))).astype(np.int64)
        self.copies = (held * self.parts).sum() / len(sample)

    def of(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of row and cell, in order."""
        return self.near(units, self.margin)[:2]


def tasks(cells: tuple[np.ndarray, np.ndarray] | None, row: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What goes where: numbers of vectors and of the tasks that need them (a cell and two of its parts); all vectors'
    cells, one vector after the other, and how many they are (the one cell there is, if there are no others)."""
    at, cells = cells or (np.arange(len(row)), np.zeros(len(row), np.int64))
    times = parts[cells]
    other = steps(times)
    own = np.repeat(row[at] % times, times)
    task = (np.repeat(cells, times) << 32) | (np.minimum(own, other) << 16) | np.maximum(own, other)
    return np.repeat(at, times), task, cells.astype(np.int32), np.bincount(at, minlength=len(row)).astype(np.int32)


def steps(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each size, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def sent(
    dim: int, columns: dict[str, np.ndarray], cells: tuple[np.ndarray, np.ndarray] | None, parts: np.ndarray,
    turn: int = 0, rounds: int = 1,
) -> Iterator[pa.RecordBatch]:
    """Vectors of one length as rows of ``SENT_TYPE``, up to ``MOST_SENT`` for one task in a row, for every so many-th cell."""
    at, task, flat, n_cells = tasks(cells, columns["row"], parts)
    now = np.flatnonzero((task >> 32) % rounds == turn)
    if not len(now):
        return
    order = now[np.argsort(task[now], kind="stable")]
    at, task = at[order], task[order]
    first = np.flatnonzero(np.r_[True, task[1:] != task[:-1]])
    sizes = np.diff(np.r_[first, len(task)])
    pieces = -(-sizes // MOST_SENT)
    first = np.repeat(first, pieces) + MOST_SENT * steps(pieces)
    starts = np.cumsum(n_cells) - n_cells
    for a in range(0, len(first), 256):
        begin, end = first[a], first[a + 256] if a + 256 < len(first) else len(task)
        some, ends = at[begin:end], np.r_[first[a : a + 256], end] - begin
        lengths = n_cells[some]
        lists = flat[np.repeat(starts[some], lengths) + steps(lengths)]
        values = {**{name: x[some] for name, x in columns.items()}, "cells": lists, "n_cells": lengths}
        bytes_ = {name: ends * (x.nbytes // len(some)) for name, x in values.items() if name != "cells"}
        bytes_["cells"] = 4 * np.r_[0, np.cumsum(lengths)][ends]
        binary = [
            pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(bytes_[name].astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values[name]))])
            for name in SENT
        ]
        of = task[first[a : a + 256]]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(of), dim, np.int32)), pa.array(of), *binary], names=["dim", "task", *SENT])


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to about ``CHUNK_BYTES``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= CHUNK_BYTES:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def received(rows: pa.Table, kind: type, dim: int) -> dict[str, np.ndarray]:
    """What ``sent`` put into rows; ``lists`` are the different lists of cells (-1 where they end), ``code`` tells whose is which."""
    kinds = dict(zip(SENT, (np.int64, np.int64, np.int64, kind, np.int32, np.int32), strict=True))
    values = {name: np.frombuffer(b"".join(rows[name].to_pylist()), of) for name, of in kinds.items()}
    values["vectors"] = values["vectors"].reshape(-1, dim)
    flat, lengths = values.pop("cells"), values.pop("n_cells")
    lists = np.full((len(lengths), lengths.max()), -1, np.int32)
    lists[np.arange(lists.shape[1]) < lengths[:, None]] = flat
    factors = np.random.default_rng(6).integers(1 << 62, size=lists.shape[1])
    _, once, code = np.unique((lists * factors).sum(axis=1), return_index=True, return_inverse=True)
    if (lists[once][code] != lists).any():
        _, once, code = np.unique(lists, axis=0, return_index=True, return_inverse=True)
    return {**values, "code": code.ravel(), "lists": lists[once]}


def gathered(units: np.ndarray, code: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Balls of the vectors that share a code: each vector's ball and its angle to the centre."""
    ball, angle = np.arange(len(units)), np.zeros(len(units))
    order = np.argsort(code, kind="stable")
    ordered = code[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    sizes = np.diff(np.r_[first, len(order)])
    near = np.zeros(len(units), bool)
    for step in range(1, min(8, sizes.max())):  # small groups all at once
        pairs = np.flatnonzero(ordered[step:] == ordered[:-step])
        close = np.einsum("ij,ij->i", units[order[pairs]], units[order[pairs + step]]) >= math.cos(radius)
        near[pairs[close]] = True
    for at in np.flatnonzero(np.logical_or.reduceat(near, first) | (sizes > 8)).tolist():
        some = order[first[at] : first[at] + sizes[at]]
        balls = Balls(units[some], radius)
        ball[some], angle[some] = some[np.array(balls.centres)[balls.centre]], balls.angle
    return np.unique(ball, return_inverse=True)[1], angle


class Members:
    """The vectors of one part of a cell; ``cells`` has the lists of cells that they have, ``code`` tells whose is which."""

    def __init__(self, values: dict[str, np.ndarray], lists: np.ndarray, linked: float):
        self.copies = np.ones(len(values["row"]), np.int64)
        if len(np.unique(values["row"])) < len(values["row"]):  # rows that repeat an id and vector
            keys = np.rec.fromarrays([values["vec_id"], values["row"]])
            _, once, self.copies = np.unique(keys, return_index=True, return_counts=True)
            values = {name: x[once] for name, x in values.items()}
        self.rows = values["weight"] == 1  # of the table itself; others stand for rows that are counted by them
        self.code, self.cells = values["code"], lists
        units = unit(values["vectors"].astype(np.float64))
        centre, angle = gathered(units, self.code, linked / 2 - SLACK)
        held = {name: values[name] for name in ("vec_id", "row")}
        self.shard = Shard({**held, "vectors": units, "centre": centre, "angle": angle, "weight": values["weight"] * self.copies})
        self.ball_code = self.code[self.shard.members[self.shard.starts]]

    def home(self, cell: int) -> np.ndarray:
        """Whether the cell is the first one of each vector."""
        return self.cells[self.code, 0] == cell


def meet_here(cell: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether two lists of cells that both have ``cell`` share no smaller one; ``a`` and ``b`` hold a list per row."""
    sooner = np.zeros(len(a), bool)
    for column in range(b.shape[1]):
        asked = np.flatnonzero((b[:, column] >= 0) & (b[:, column] < cell))
        sooner[asked] |= (a[asked] == b[asked, column, None]).any(axis=1)
    return ~sooner


class Ties:
    """Groups of numbers that are tied with each other, named by their smallest."""

    def __init__(self, count: int):
        self.root = np.arange(count)

    def tie(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            if (x == y).all():
                return
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


def links_by_product(cell: int, a: Members, b: Members, linked: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """For the members of either side (one side only, if both are the same) the numbers of links with the other one that
    count in this cell, and the smallest id reachable over links here."""
    sides = [a.shard] if a is b else [a.shard, b.shard]
    second = 0 if a is b else len(a.shard.centres)
    ties = Ties(second + len(b.shard.centres))
    by_ball = [np.zeros(len(s.centres), np.int64) for s in sides]
    by_member = [np.zeros(len(s.vec_id), np.int64) for s in sides]
    least = math.cos(linked)

    def members(shard: Shard, ball: int) -> np.ndarray:
        return shard.members[shard.starts[ball] : shard.starts[ball] + shard.sizes[ball]]

    for x, y in close_balls(a.shard, b.shard, linked):
        here = meet_here(cell, a.cells[a.ball_code[x]], b.cells[b.ball_code[y]])
        x, y = x[here], y[here]
        cosine = np.einsum("ij,ij->i", a.shard.centres[x], b.shard.centres[y])
        radius = a.shard.radius[x] + b.shard.radius[y]
        whole = angles(cosine) + radius <= linked - SLACK
        whole |= (a.shard.sizes[x] == 1) & (b.shard.sizes[y] == 1) & (cosine >= least)
        if a is b:
            whole |= x == y
        np.add.at(by_ball[0], x[whole], b.shard.weights[y[whole]])
        tied = whole.copy()
        for at in np.flatnonzero(~whole & (angles(cosine) - radius <= linked + SLACK)).tolist():
            p, q = members(a.shard, x[at]), members(b.shard, y[at])
            if len(p) == len(q) == 1:
                continue
            pairs = a.shard.units[p] @ b.shard.units[q].T >= least
            by_member[0][p] += pairs @ b.shard.weight[q]
            if a is not b:
                by_member[1][q] += a.shard.weight[p] @ pairs
            tied[at] = pairs.any()
        if a is not b:
            np.add.at(by_ball[1], y[whole], a.shard.weights[x[whole]])
        ties.tie(x[tied], second + y[tied])
    smallest = np.concatenate([np.minimum.reduceat(s.vec_id[s.members], s.starts) for s in sides])
    np.minimum.at(smallest, ties.root, smallest.copy())
    ends = np.cumsum([len(s.centres) for s in sides])[:-1]
    named = np.split(smallest[ties.root], ends)
    return [(n[s.ball] + m, ids[s.ball]) for s, n, m, ids in zip(sides, by_ball, by_member, named, strict=True)]


def links_by_graph(cell: int, asked: Members, held: Members, linked: float) -> tuple[np.ndarray, list[list[int]]]:
    """For the members asked the numbers of links with those held that count in this cell, and an id for each ball."""
    shard, own = held.shard, asked.home(cell) & (asked is held)
    shard.beam = shard.own_beam(linked)

    def allowed(rows: np.ndarray, balls: np.ndarray) -> np.ndarray:
        return meet_here(cell, asked.cells[asked.code[rows]], held.cells[held.ball_code[balls]])

    return shard.partners(asked.shard.units, linked, asked.shard.vec_id, asked.shard.row, own, allowed)


def links_in_cell(cell: int, a: Members, b: Members, linked: float) -> pa.Table:
    """Rows of ``FOUND_TYPE`` for the members of both sides, which may be the same."""
    sides = [a] if a is b else [a, b]
    if all(m.shard.exact(FIRST_BEAM, PRODUCT_SHARE) for m in sides):
        found = [(n, ids, np.ones(len(n), np.int64)) for n, ids in links_by_product(cell, a, b, linked)]
    else:
        found = []
        for x, y in zip(sides, sides[::-1], strict=True):
            n, partners = links_by_graph(cell, x, y, linked)
            found.append((n, np.array([p for own in partners for p in own], np.int64), np.array([len(own) for own in partners])))
    out = []
    for side, (n, ids, times) in zip(sides, found, strict=True):
        home = side.home(cell) & (a is b)
        some = np.flatnonzero((n > 0) | home)
        # A member without links here has no partners, so that all partners belong to the rows that are kept.
        other = (ids != np.repeat(side.shard.vec_id, times)) & np.repeat(n > 0, times)
        times = np.bincount(np.repeat(np.arange(len(n)), times)[other], minlength=len(n))
        partners = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(times[some])].astype(np.int32)), pa.array(ids[other]))
        copies = np.where(home & side.rows, side.copies, 0).astype(np.int32)
        out.append(pa.table([side.shard.vec_id[some], side.shard.row[some], n[some], copies[some], partners], names=FOUND))
    return pa.concat_tables(out)


@contextlib.contextmanager
def removed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, a query's shuffle files go as soon as its result is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fit_cells(rows: DataFrame, count: int, linked: float, shard_rows: int) -> tuple[Cells, list[int]]:
    """Cells for so many vectors of one length, and the hashes of vectors that a good share of the rows repeat."""
    wanted = -(-count // CELL_ROWS)
    share = min(1.0, 1.1 * (wanted + SAMPLED) / count)
    chance = F.pmod(F.xxhash64("row", F.lit(5)), F.lit(1 << 30)) / (1 << 30)
    sample = rows.where(chance < share).select("vector", F.xxhash64("vector").alias("copied")).toArrow()
    vectors, copied = matrix(sample["vector"]), sample["copied"].to_numpy()
    keys, once, times = np.unique(copied, return_index=True, return_counts=True)
    once = np.random.default_rng(4).permutation(once)
    centroids = vectors[once[:wanted]]
    cells = Cells(centroids[Balls(centroids, linked).centres])
    asked = once[wanted:] if len(once) > 2 * wanted else once
    cells.audit(vectors[asked], linked)
    cells.divide(vectors[asked], count, shard_rows)
    return cells, keys[times >= COPIED].tolist()


def embedding_duplicates(
    df: DataFrame, cosine: float = 0.95, vec_id: str = "vec_id", embedding: str = "embedding", shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links`` (other vectors with at least that cosine),
    ``component_id`` (the smallest id reachable over links, its own included), ``kept`` (its own is it).

    Vectors that are null, empty or zero or hold null or non-finite components have no links, and
    neither have rows without an id; vectors of different lengths are never linked. Rows that repeat an
    id and vector are vectors of their own, linked with each other, and share one component id.

    ``df`` is read several times and must have the same rows each time.
    """
    spark = df.sparkSession
    ship_package(spark)
    linked = math.acos(cosine)
    single = df.schema[embedding].dataType.simpleString() == "array<float>"
    kind = np.float32 if single else np.float64  # as they came, so that no more is sent
    rows = usable_vectors(df, vec_id, embedding)
    fitted: dict[int, Cells] = {}
    parts: dict[int, np.ndarray] = {}
    hot, volume, plain = [], 0.0, 0
    for dim, count in rows.groupBy("dim").count().where(F.col("count") > PART_ROWS).collect():  # one length of vectors, as a rule
        if count > ONE_CELL:
            fitted[dim], copied = fit_cells(rows.where(F.col("dim") == dim), count, linked, shard_rows)
            hot += [(dim, key) for key in copied]
            parts[dim] = fitted[dim].parts
            plain += count * dim * kind().itemsize
            volume += count * fitted[dim].copies * (dim * kind().itemsize + ENTRY_BYTES)
        else:
            parts[dim] = np.array([-(-count // PART_ROWS)])

    dealt = rows.withColumn("weight", F.lit(1).cast("bigint"))
    if hot:
        # A vector that very many rows share takes part once, as the row with the smallest id.
        rows = rows.withColumn("copied", F.xxhash64("vector"))
        keys = F.broadcast(stored(spark.createDataFrame(hot, "dim int, copied bigint"), "copied"))
        repeated = rows.join(keys, ["dim", "copied"])
        first = repeated.groupBy("dim", "copied").agg(F.min(F.struct("vec_id", "row", "vector")).alias("first"), F.count("*").alias("weight"))
        first = stored(first.select("dim", "copied", "weight", "first.*"), "copies")
        columns = ["vec_id", "vector", "dim", "row", "weight"]
        others = rows.join(keys, ["dim", "copied"], "left_anti").withColumn("weight", F.lit(1).cast("bigint"))
        dealt = others.select(columns).unionByName(first.select(columns))
        named = F.broadcast(first.select("dim", "copied", F.col("vec_id").alias("first_id"), F.col("row").alias("first_row")))
        repeated = repeated.join(named, ["dim", "copied"]).select("vec_id", "first_id", "first_row")

    def dealer(turn: int, rounds: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chunk in chunks(batches):
                for dim in np.unique(chunk["dim"].to_numpy()).tolist():
                    some = chunk.filter(pc.equal(chunk["dim"], dim))
                    vectors = matrix(some["vector"])
                    columns = {name: some[name].to_numpy() for name in ("vec_id", "row", "weight")} | {"vectors": vectors.astype(kind)}
                    cells = fitted[dim].of(unit(vectors)) if dim in fitted else None
                    yield from sent(dim, columns, cells, parts.get(dim, np.ones(1, np.int64)), turn, rounds)

        return deal

    def search(key: tuple, rows: pa.Table) -> pa.Table:
        dim, task = (x.as_py() for x in key)
        cell, i, j = task >> 32, task >> 16 & 0xFFFF, task & 0xFFFF
        values = received(rows, kind, dim)
        part = values["row"] % parts[dim][cell] if dim in parts else np.zeros(len(values["row"]), np.int64)
        sides = [Members({name: x[part == k] for name, x in values.items() if name != "lists"}, values["lists"], linked) for k in {i, j} if (part == k).any()]
        if i != j and len(sides) < 2:
            return NONE_FOUND
        return links_in_cell(cell, sides[0], sides[-1], linked)

    # What one round sends is removed before the next one starts, so that the disk holds one round's share.
    rounds = math.ceil(volume / (ROUND_SHARE * plain)) if volume > ROUND_LEAST else 1
    partitions = math.ceil(volume / rounds / PARTITION_BYTES)
    found = []
    with removed_shuffles(spark):
        for turn in range(rounds):
            entries = dealt.select("vec_id", "row", "weight", "dim", "vector").mapInArrow(dealer(turn, rounds), SENT_TYPE)
            if partitions > int(spark.conf.get("spark.sql.shuffle.partitions")):
                entries = entries.repartition(partitions, "dim", "task")
            found.append(stored(entries.groupBy("dim", "task").applyInArrow(search, FOUND_TYPE), "found"))
    found = reduce(DataFrame.unionByName, found)

    counts = found.groupBy("vec_id", "row").agg((F.sum("n") - 1).alias("n_links"), F.sum("copies").alias("copies"))
    usable = counts.where("copies > 0").select("vec_id", "n_links", F.explode(F.sequence(F.lit(1), "copies"))).drop("col")
    links = found.select(F.col("vec_id").alias("a"), F.explode("partners").alias("b"))
    if hot:
        shared = counts.where("copies = 0").select(F.col("vec_id").alias("first_id"), F.col("row").alias("first_row"), "n_links")
        usable = usable.unionByName(repeated.join(F.broadcast(shared), ["first_id", "first_row"]).select("vec_id", "n_links"))
        links = links.unionByName(repeated.select(F.col("vec_id").alias("a"), F.col("first_id").alias("b")))
    roots = components(links)
    usable = usable.join(roots, usable["vec_id"] == roots["node"], "left")
    usable = usable.select("vec_id", "n_links", F.coalesce("root", "vec_id").alias("component_id"))
    others = df.where(F.col(vec_id).isNull() | ~is_vector(embedding)).select(F.col(vec_id).cast("bigint").alias("vec_id"))
    others = others.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return usable.unionByName(others).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
