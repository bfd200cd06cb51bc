"""Nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample, evenly filled clusters preferred, and held in an in-memory
graph. Every vector goes to the list of its nearest centroid; one near a boundary also to those of
further centroids that are hardly more distant and not on the same side of it. A query reads the lists
whose centroids lie within a ratio of the nearest one's distance; the ratio is the one with which
sampled queries find ``RECALL`` of their true neighbours in the sample. Candidates are ranked by the
exact distance of the original vectors.

A long list is split, so that no task holds more than about ``SHELF_ROWS`` vectors however alike they
are, and equal query vectors are searched once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from tallyline.llm.common import ship_package, stored
from tallyline.llm.hnsw import Graph
from tallyline.llm.vectors import matrix, usable_vectors

SAMPLE_ROWS = 20_000  # on average; twice as many at most
ROWS_PER_CENTROID = 16  # at least, of the sample
ROUNDS = 8
CROWDING = 0.3  # how much a cluster of twice the mean size seems farther away
REPLICAS, BOUNDARY = 6, 1.15
AUDITS, RECALL = 200, 0.99
ENOUGH = 50  # vectors that a query's lists hold at least, by estimate, for each neighbour asked for
SHELF_ROWS, QUERY_BLOCK = 20_000, 4096


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all of ``b``; fast, good to about seven digits."""
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


@dataclass
class Lists:
    centroids: np.ndarray
    graph: Graph
    ratio: float = 1.0
    filled: np.ndarray | None = None  # vectors in each list, estimated from the sample

    def nearest(self, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids the graph finds, nearest first (-1 for none), and their distances."""
        nodes, _ = self.graph.search(rows, min(width, len(self.centroids)))
        away = np.full(nodes.shape, np.inf)
        for column in range(nodes.shape[1]):
            found = nodes[:, column] >= 0
            away[found, column] = np.linalg.norm(rows[found] - self.centroids[nodes[found, column]], axis=1)
        order = np.argsort(away, axis=1, kind="stable")
        return np.take_along_axis(nodes, order, axis=1), np.take_along_axis(away, order, axis=1)

    def homes(self, rows: np.ndarray) -> list[list[int]]:
        """The lists that hold each vector."""
        nodes, away = self.nearest(rows, 4 * REPLICAS)
        out = []
        for own, far in zip(nodes.tolist(), away.tolist(), strict=True):
            chosen = own[:1]
            for node, distance in zip(own[1:], far[1:], strict=True):
                if len(chosen) == REPLICAS or distance > BOUNDARY * far[0]:
                    break
                between = np.linalg.norm(self.centroids[chosen] - self.centroids[node], axis=1)
                if between.min() > 0.7 * distance:
                    chosen.append(node)
            out.append(chosen)
        return out

    def probes(self, rows: np.ndarray, least: int) -> list[list[int]]:
        """The lists each query reads: the beam grows until it reaches beyond the ratio and the lists
        hold ``least`` vectors."""
        out: list[list[int]] = [[] for _ in range(len(rows))]
        todo, width = np.arange(len(rows)), 32
        while len(todo):
            nodes, away = self.nearest(rows[todo], width)
            limit = self.ratio * away[:, 0]
            before = np.cumsum(np.where(nodes >= 0, self.filled[nodes], 0), axis=1)
            before = np.hstack([np.zeros((len(nodes), 1)), before[:, :-1]])
            read = (nodes >= 0) & ((away <= limit[:, None]) | (before < least))
            done = ~read[:, -1] & (nodes[:, -1] >= 0) | (width >= len(self.centroids))
            for at in np.flatnonzero(done).tolist():
                out[todo[at]] = nodes[at][read[at]].tolist()
            todo, width = todo[~done], 2 * width
        return out


def fit_lists(sample: np.ndarray, rows: int) -> Lists:
    """Centroids from the sample for an index of so many rows, and the ratio measured on the sample."""
    random = np.random.default_rng(3)
    count = max(1, min(round(math.sqrt(rows)), len(sample) // ROWS_PER_CENTROID))
    centroids = sample[random.choice(len(sample), count, replace=False)]
    crowd = np.zeros(count)
    for _ in range(ROUNDS):
        seeming = distances(sample, centroids) * (1 + CROWDING * crowd)
        own = seeming.argmin(axis=1)
        sizes = np.bincount(own, minlength=count)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
        crowd = np.clip(sizes * count / len(sample) - 1, -0.5, 2)
    lists = Lists(centroids, Graph(centroids, (centroids * centroids).sum(axis=1) / 2))
    queries = sample[random.choice(len(sample), min(AUDITS, len(sample)), replace=False)]
    truth = np.argsort(distances(queries, sample), axis=1)[:, 1:11]
    homes = lists.homes(sample)
    members = np.bincount([home for own in homes for home in own], minlength=count)
    lists.filled = members * rows / len(sample)
    to_centroids = distances(queries, centroids)
    needed = [
        min(to_centroids[q, home] for home in homes[t]) / max(to_centroids[q].min(), 1e-300)
        for q in range(len(queries)) for t in truth[q].tolist()
    ]
    lists.ratio = max(1.0, float(np.quantile(needed, RECALL))) if needed else math.inf
    return lists


def _rank(queries: pa.Table, held: pa.Table, k: int) -> pa.Table:
    """For each query of a shelf, the nearest ``k`` rows in the lists that it reads."""
    order = np.argsort(held["vec_id"].to_numpy(), kind="stable")  # ties in distance go to smaller ids
    ids, rows = held["vec_id"].to_numpy()[order], held["uid"].to_numpy()[order]
    vectors, lists = matrix(held["vector"])[order], held["list"].to_numpy()[order]
    asked, probes = matrix(queries["vector"]), queries["list"].to_numpy()
    keys = queries["query"].to_numpy()
    best: dict[int, list] = {}
    for list_ in np.unique(probes).tolist():
        members = np.flatnonzero(lists == list_)
        if not len(members):
            continue
        for at in np.flatnonzero(probes == list_).tolist():
            away = np.sqrt(((vectors[members] - asked[at]) ** 2).sum(axis=1))
            first = np.argsort(away, kind="stable")[:k]
            best.setdefault(int(keys[at]), []).append((away[first], ids[members[first]], rows[members[first]]))
    out = {"query": [], "vec_id": [], "uid": [], "score": []}
    for key, parts in best.items():
        away, own, uid = (np.concatenate(x) for x in zip(*parts, strict=True))
        _, once = np.unique(uid, return_index=True)
        first = once[np.lexsort((own[once], away[once]))][:k]
        for name, values in (("query", np.full(len(first), key)), ("vec_id", own[first]), ("uid", uid[first]), ("score", away[first])):
            out[name].append(values)
    types = {"query": np.int64, "vec_id": np.int64, "uid": np.int64, "score": np.float64}
    return pa.table({name: np.concatenate([np.empty(0, types[name]), *values]).astype(types[name]) for name, values in out.items()})


def nearest_neighbours(
    df: DataFrame, query_every: int, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """For every row whose id is divisible by ``query_every``, its ``k`` nearest other rows found (fewer if
    there are fewer): ``query_id``, ``rank`` from 1, ``vec_id``, ``score`` (Euclidean distance, in doubles),
    nearest first, ties to the smaller id.

    Rows without an id and vectors that are null, empty or zero or hold null or non-finite components
    take no part; vectors are compared with those of their own length. Of rows that repeat an id and
    vector only the query's own is left out of its result.
    """
    ship_package(df.sparkSession)
    rows = usable_vectors(df, vec_id, embedding).withColumn("uid", F.monotonically_increasing_id())
    rows = stored(rows, "vectors")
    sizes = sorted((dim, count) for dim, count in rows.groupBy("dim").count().collect())
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    out = df.sparkSession.createDataFrame([], empty)
    for dim, count in sizes:  # one length of vectors, as a rule
        out = out.unionByName(_search(rows.where(F.col("dim") == dim), count, query_every, k))
    return out


def _search(rows: DataFrame, count: int, query_every: int, k: int) -> DataFrame:
    share = min(1.0, SAMPLE_ROWS / count)
    chance = F.pmod(F.xxhash64("row", F.lit(5)), F.lit(1 << 30)) / (1 << 30)
    sample = rows.where(chance < share).select("vector").limit(2 * SAMPLE_ROWS).toArrow()
    lists = fit_lists(matrix(sample["vector"]), count)

    @arrow_udf("array<int>")
    def homes(vectors: pa.Array) -> pa.Array:
        return pa.array(lists.homes(matrix(vectors)), pa.list_(pa.int32()))

    @arrow_udf("array<int>")
    def probes(vectors: pa.Array) -> pa.Array:
        return pa.array(lists.probes(matrix(vectors), ENOUGH * k), pa.list_(pa.int32()))

    postings = stored(rows.select("vec_id", "uid", "vector", F.explode(homes("vector")).alias("list")), "postings")
    filled = postings.groupBy("list").count()  # at most one row per centroid, of which the sample bounds the number
    pieces = filled.select("list", F.ceil(F.col("count") / SHELF_ROWS).cast("int").alias("pieces"))
    pieces = stored(pieces, "pieces")
    shelves = max(1, -(-postings.count() // SHELF_ROWS))

    asked = rows.where(F.col("vec_id") % query_every == 0)
    vectors = asked.groupBy(F.xxhash64("vector").alias("query"), "vector").agg(F.count("*").alias("times"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    block = F.pmod("query", F.lit(blocks)).cast("int").alias("block")
    reads = vectors.select("query", "vector", block, F.explode(probes("vector")).alias("list"))

    def shelf(piece):
        return F.pmod(F.xxhash64("list", piece), F.lit(shelves)).cast("int").alias("shelf")

    held = postings.join(F.broadcast(pieces), "list").withColumn("piece", F.pmod(F.xxhash64("uid"), F.col("pieces")).cast("int"))
    held = held.select("vec_id", "uid", "vector", "list", shelf(F.col("piece")), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    reads = reads.join(F.broadcast(pieces), "list").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    reads = reads.select("query", "vector", "block", "list", shelf(F.col("piece"))).distinct()

    def rank(key, queries: pa.Table, members: pa.Table) -> pa.Table:
        return _rank(queries, members, k + 1)

    keys = ["shelf", "block"]
    kind = "query bigint, vec_id bigint, uid bigint, score double"
    found = reads.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(rank, kind).distinct()
    nearest = Window.partitionBy("query").orderBy("score", "vec_id", "uid")
    found = stored(found.withColumn("at", F.row_number().over(nearest)).where(F.col("at") <= k + 1), "found")

    own = asked.select(F.col("vec_id").alias("query_id"), F.col("uid").alias("own"), F.xxhash64("vector").alias("query"))
    others = own.join(found, "query").where("uid <> own")
    order = Window.partitionBy("query_id", "own").orderBy("score", "vec_id", "uid")
    ranked = others.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
