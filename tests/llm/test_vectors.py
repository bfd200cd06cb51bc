"""Operators on vectors, against brute force."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import embedding_dups
from tallyline.llm.embedding_dups import embedding_duplicates
from tallyline.llm.hnsw import Graph, Layer
from tallyline.llm.posting_lists import nearest_neighbours


def vectors(spark, rows):
    data = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]
    return spark.createDataFrame(data, "vec_id bigint, embedding array<float>")


def clustered(seed, count=600, dim=24):
    random = np.random.default_rng(seed)
    centres = random.standard_normal((count, dim))
    rows = []
    for i in range(count):
        spread = random.choice([0.0, 0.05, 0.12, 2.0])
        base = centres[i % 40] if spread < 1 else centres[i]
        rows.append(np.float32(base + spread * random.standard_normal(dim)))
    rows[10] = rows[11] * 3  # the same direction
    return np.array(rows)


def expected_links(rows, cosine):
    units = rows.astype(np.float64) / np.linalg.norm(rows.astype(np.float64), axis=1)[:, None]
    linked = units @ units.T >= cosine
    group = np.arange(len(rows))
    changed = True
    while changed:
        smallest = np.array([group[linked[i]].min() for i in range(len(rows))])
        changed = (smallest != group).any()
        group = smallest
    return linked.sum(axis=1) - 1, group


def test_embedding_links_against_brute_force(spark):
    rows = clustered(1)
    counts, groups = expected_links(rows, 0.95)
    found = embedding_duplicates(vectors(spark, enumerate(rows)), 0.95)
    assert sorted(map(tuple, found.collect())) == [(i, int(counts[i]), int(groups[i]), groups[i] == i) for i in range(len(rows))]


def test_embedding_odd_vectors_take_no_part(spark):
    odd = [(1, None), (2, []), (3, [0, 0]), (4, [1, None]), (5, [float("nan"), 1]), (6, [float("inf"), 1]), (None, [1, 1])]
    good = [(10, [1, 1]), (11, [2, 2]), (12, [1, 1, 0]), (13, [1, -1]), (13, [1, -1])]
    df = vectors(spark, odd + good).withColumn("row", F.lit("clash"))
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_duplicates(df).collect()), key=repr)
    expected = [(i, 0, i, True) for i, _ in odd] + [(10, 1, 10, True), (11, 1, 10, False), (12, 0, 12, True), (13, 1, 13, True), (13, 1, 13, True)]
    assert found == sorted(expected, key=repr)
    assert embedding_duplicates(df.limit(0)).count() == 0


def test_one_vector_held_by_most_rows(spark):
    random = np.random.default_rng(4)
    rows = [(i, random.standard_normal(8) if i % 3 else np.ones(8)) for i in range(900)]
    found = {r.vec_id: r for r in embedding_duplicates(vectors(spark, rows)).collect()}
    assert {found[i].n_links for i in range(0, 900, 3)} == {299} and {found[i].component_id for i in range(0, 900, 3)} == {0}


class Narrow:
    """A graph that finds the best centres of every query in wide beams only, else the nearest one of nine in ten."""

    def __init__(self, centres, wide):
        self.centres, self.wide = centres, wide

    def search(self, queries, width):
        scores = queries @ self.centres.T
        nodes = np.argsort(-scores, axis=1)[:, :width]
        if width < self.wide:
            nodes = np.where((np.arange(width) == 0) & (np.arange(len(queries)) % 10 > 0)[:, None], nodes, -1)
        return nodes, np.where(nodes >= 0, np.take_along_axis(scores, nodes, axis=1), -np.inf)


def shard_of(rows, wide, linked):
    balls = embedding_dups.Balls(rows, linked / 2 - embedding_dups.SLACK)
    ids = np.arange(len(rows), dtype=np.int64)
    held = {"vec_id": ids, "row": ids * 7, "vectors": rows, "centre": balls.centre, "angle": balls.angle}
    shard = embedding_dups.Shard({name: values.tobytes() for name, values in held.items()})
    shard.graph = Narrow(shard.centres, wide)
    return shard


def test_audits_ask_for_nearly_all_nearest_centres():
    random = np.random.default_rng(5)
    linked = np.arccos(0.95)
    shard = shard_of(random.standard_normal((6000, 24)), 128, linked)
    queries = embedding_dups.unit(random.standard_normal((3000, 24)))
    queries[10] = embedding_dups.unit(shard.units[:1] + 0.01)  # the only one with a partner, which the audit does not draw
    rows, balls = shard.candidates(queries, 1.5 * linked)
    expected = np.nonzero(queries @ shard.centres.T >= np.cos(1.5 * linked))
    assert {*zip(*(x.tolist() for x in expected), strict=True)} <= {*zip(rows.tolist(), balls.tolist(), strict=True)}
    assert 10 in rows
    audited = queries[:300]
    assert shard.audited_beam(audited, audited @ shard.centres.T, np.cos(linked), 64) == 128


def test_audits_take_the_shards_own_vectors_that_have_partners():
    random = np.random.default_rng(6)
    linked = np.arccos(0.95)
    rows = random.standard_normal((5000, 24))
    rows[4000:] = rows[:1000] + 0.2 * random.standard_normal((1000, 24))
    shard = shard_of(rows, 256, linked)
    own = shard.partnered(linked)
    assert len(own) == embedding_dups.AUDITS and ((shard.units[own] @ shard.units.T >= 0.95).sum(axis=1) > 1).all()
    assert shard.own_beam(linked) == 256


def test_a_vector_counts_itself_without_being_found():
    random = np.random.default_rng(7)
    linked = np.arccos(0.95)
    shard = shard_of(np.repeat(random.standard_normal((3000, 24)), [2] + [1] * 2999, axis=0), 10**9, linked)
    shard.candidates = lambda queries, reach: (np.empty(0, np.int64), np.empty(0, np.int64))
    counts, partners = shard.partners(shard.units, linked, shard.vec_id, shard.row)
    assert counts.tolist() == [2, 2] + [1] * 2999 and all(partners)


@pytest.mark.parametrize("euclidean", [False, True])
def test_graph_finds_near_vectors(euclidean):
    random = np.random.default_rng(2)
    rows = random.standard_normal((3000, 16)).astype(np.float32)
    offsets = (rows * rows).sum(axis=1) / 2 if euclidean else None
    scores = rows[:200] @ rows.T - (0 if offsets is None else offsets)
    nodes, found = Graph(rows, offsets).search(rows[:200], 64)
    best = np.argsort(-scores, axis=1)[:, :5]
    assert np.mean([len(set(b) & set(n)) / 5 for b, n in zip(best.tolist(), nodes.tolist(), strict=True)]) > 0.95
    assert (np.diff(found, axis=1) <= 1e-6).all()


def test_scores_gather_few_vectors_at_a_time():
    """All vectors of this step at once would be 105 MB, beyond any processor's cache."""
    random = np.random.default_rng(8)
    rows, queries = random.standard_normal((5000, 64)), random.standard_normal((1024, 64)).astype(np.float32)
    layer = Layer(rows, np.arange(5000) / 1000)
    nodes = random.integers(0, 5001, (1024, 400)).astype(np.int32)  # 5000 is no node
    tracemalloc.start()
    found = layer.scores(queries, nodes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    expected = np.hstack([queries @ rows.T - np.arange(5000) / 1000, np.full((1024, 1), -np.inf)])
    assert np.allclose(found, np.take_along_axis(expected, nodes.astype(np.int64), axis=1), atol=1e-4)
    assert peak < 16e6
    assert layer.scores(queries, nodes[:, :0]).shape == (1024, 0) and layer.scores(queries[:0], nodes[:0]).shape == (0, 400)


def test_neighbours_recall_and_order(spark):
    rows = clustered(3, 3000, 16)
    ids = np.arange(len(rows)) * 5
    found = {}
    for r in nearest_neighbours(vectors(spark, zip(ids.tolist(), rows, strict=True)), 100).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    exact = rows.astype(np.float64)
    hits = total = 0
    for query in np.flatnonzero(ids % 100 == 0):
        away = np.sqrt(((exact - exact[query]) ** 2).sum(axis=1))
        away[query] = np.inf
        best = np.lexsort((ids, away))[:10]
        own = sorted(found[int(ids[query])])
        assert [x[0] for x in own] == list(range(1, 11))
        assert [(s, v) for _, v, s in own] == sorted((s, v) for _, v, s in own)
        assert all(abs(away[v // 5] - s) < 1e-12 for _, v, s in own)
        hits += len({v for _, v, _ in own} & set(ids[best].tolist()))
        total += 10
    assert hits / total >= 0.9


def test_neighbours_with_ties_few_rows_and_odd_vectors(spark):
    rows = [(0, [1, 0]), (100, [1, 0]), (7, [1, 0]), (3, [2, 0]), (4, None), (200, [0, 0]), (300, [1, 2, 3]), (None, [1, 0]), (100, [1, 0])]
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in nearest_neighbours(vectors(spark, rows), 100).collect())
    assert [f for f in found if f[0] == 0] == [(0, 1, 7, 0.0), (0, 2, 100, 0.0), (0, 3, 100, 0.0), (0, 4, 3, 1.0)]
    assert sum(f[0] == 100 for f in found) == 8 and not any(f[0] in (200, 300) for f in found)
    assert nearest_neighbours(vectors(spark, []), 100).count() == 0


def test_a_vector_that_most_rows_share(spark):
    rows = [(i, [1, 1, 1] if i % 3 else [i, 1, 2]) for i in range(600)]
    found = [r for r in nearest_neighbours(vectors(spark, rows), 100).collect() if r.query_id == 100]
    assert [r.vec_id for r in sorted(found, key=lambda r: r.rank)] == [1, 2, 4, 5, 7, 8, 10, 11, 13, 14]
