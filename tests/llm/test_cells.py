"""Near-duplicate embeddings over many cells, against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from test_vectors import clustered, expected_links, vectors

from tallyline.llm import embedding_dups
from tallyline.llm.common import stored
from tallyline.llm.embedding_dups import Cells, Members, Ties, embedding_duplicates, fit_cells, links_in_cell, meet_here, received, sent, unit
from tallyline.llm.vectors import usable_vectors

LINKED = np.arccos(0.95)


@pytest.fixture
def many_cells(monkeypatch):
    """Cells of some 40 vectors from 200 vectors on."""
    for name, value in {"ONE_CELL": 200, "PART_ROWS": 100, "CELL_ROWS": 40, "SAMPLED": 2000}.items():
        monkeypatch.setattr(embedding_dups, name, value)


def rows_of(found):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found.collect())


def test_each_vector_meets_few_others_however_many_there_are(spark, many_cells):
    """Where every vector is searched in every shard, four times the rows are four times the work for each."""
    random = np.random.default_rng(11)
    met = []
    for count in (2000, 8000):
        rows = random.standard_normal((count, 24))
        df = usable_vectors(vectors(spark, enumerate(np.float32(rows))), "vec_id", "embedding")
        cells, _ = fit_cells(df, count, LINKED, 10**6)
        at, cell = cells.of(unit(rows))
        sizes = np.bincount(cell, minlength=len(cells.centroids))
        assert set(at) == set(range(count))
        met.append(sizes[cell].sum() / count)
    assert met[0] < 1000 and met[1] < 2 * met[0]


def test_audited_pairs_share_a_cell():
    random = np.random.default_rng(12)
    rows = unit(random.standard_normal((4000, 64)))
    cells = Cells(rows[:200])
    cells.audit(rows[200:], LINKED)
    own, aside = rows[1000:3000], random.standard_normal((2000, 64))
    aside = unit(aside - np.einsum("ij,ij->i", aside, own)[:, None] * own)
    needed = cells._needed(own, 0.95 * own + np.sqrt(1 - 0.95**2) * aside, 1.0)
    assert (needed <= cells.margin).mean() > 0.98
    assert len(cells.of(rows)[0]) < 8 * len(rows)


def test_centroids_found_by_graph(monkeypatch):
    random = np.random.default_rng(13)
    rows = unit(random.standard_normal((4000, 24)))
    monkeypatch.setattr(embedding_dups, "GRAPH_CELLS", 1000)
    monkeypatch.setattr(embedding_dups, "FIRST_BEAM", 8)
    cells = Cells(rows[:2000])
    cells.audit(rows[2000:], LINKED)
    assert cells.graph and cells.beam >= 8
    own, aside = rows[2000:], random.standard_normal((2000, 24))
    aside = unit(aside - np.einsum("ij,ij->i", aside, own)[:, None] * own)
    assert (cells._needed(own, 0.95 * own + np.sqrt(1 - 0.95**2) * aside, cells.margin) <= cells.margin).mean() > 0.97


@pytest.mark.parametrize("shard_rows", [10**6, 60])
def test_links_over_many_cells_against_brute_force(spark, many_cells, shard_rows):
    """Few threshold pairs: all links are found. Small shards are searched in pairs of parts."""
    random = np.random.default_rng(14)
    centres = 3 * random.standard_normal((300, 24))
    rows = np.float32([centres[i % 300] + (0.05 if i % 5 else 2.0) * random.standard_normal(24) for i in range(1500)])
    rows[:200] = centres[0] + 0.05 * random.standard_normal((200, 24))  # a group beyond the small shards
    counts, groups = expected_links(rows, 0.95)
    found = rows_of(embedding_duplicates(vectors(spark, enumerate(rows)), 0.95, shard_rows=shard_rows))
    expected = [(i, int(counts[i]), int(groups[i]), bool(groups[i] == i)) for i in range(len(rows))]
    assert len(found) == len(rows) and sum(f != e for f, e in zip(found, expected, strict=True)) <= 3
    assert all(f[1] <= e[1] for f, e in zip(found, expected, strict=True))
    assert [f for f in found if f[0] < 200] == expected[:200]


def test_cells_in_rounds(spark, many_cells, monkeypatch):
    monkeypatch.setattr(embedding_dups, "ROUND_LEAST", 0)
    monkeypatch.setattr(embedding_dups, "ROUND_SHARE", 0.5)
    turns = []
    monkeypatch.setattr(embedding_dups, "stored", lambda df, label: turns.append(label) or stored(df, label))
    rows = np.float32(np.random.default_rng(19).standard_normal((800, 24)))
    rows[400:] = rows[:400] * 2
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    found = rows_of(embedding_duplicates(vectors(spark, enumerate(rows))))
    assert found == [(i, 1, i % 400, i < 400) for i in range(800)] and turns.count("found") > 2
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == before


def test_parts_of_one_cell(spark, monkeypatch):
    monkeypatch.setattr(embedding_dups, "PART_ROWS", 150)
    rows = clustered(15)
    counts, groups = expected_links(rows, 0.95)
    found = rows_of(embedding_duplicates(vectors(spark, enumerate(rows)), 0.95))
    assert found == [(i, int(counts[i]), int(groups[i]), bool(groups[i] == i)) for i in range(len(rows))]


def test_a_vector_that_very_many_rows_share(spark, many_cells):
    """Copies take part once: with other ids, with the same id (one component, each a row of its own), beside near copies
    and beside another vector of a copy's id, whose component is theirs."""
    random = np.random.default_rng(16)
    hot, other = random.standard_normal(24), random.standard_normal(24)
    rows = [(i, random.standard_normal(24)) for i in range(1000, 1600)]
    rows += [(i, hot) for i in range(10, 310)] + [(10, hot), (10, hot), (400, hot + 0.01), (12, other), (500, other)]
    found = rows_of(embedding_duplicates(vectors(spark, [(i, np.float32(v)) for i, v in rows])))
    expected = [(i, 0, i, True) for i in range(1000, 1600)]
    expected += [(i, 302, 10, i == 10) for i in range(10, 310)] + 2 * [(10, 302, 10, True)]
    expected += [(400, 302, 10, False), (12, 1, 10, False), (500, 1, 10, False)]
    assert found == sorted(expected)


def members(ids, rows, lists):
    """Through the bytes that tasks receive."""
    columns = {"vec_id": ids, "row": ids * 7, "weight": np.ones_like(ids), "vectors": rows}
    at = np.repeat(np.arange(len(ids)), [len(x) for x in lists])
    batches = list(sent(rows.shape[1], columns, (at, np.concatenate(lists)), np.ones(9, np.int64)))
    table = embedding_dups.pa.Table.from_batches(batches)
    own = table.filter(embedding_dups.pc.equal(table["task"], 3 << 32))
    values = received(own, np.float64, rows.shape[1])
    cells = values.pop("lists")
    return Members(values, cells, LINKED)


def test_a_pair_counts_in_the_first_cell_it_shares(monkeypatch):
    random = np.random.default_rng(17)
    one = random.standard_normal(24)
    rows = one + 0.01 * random.standard_normal((6, 24))
    lists = [np.array(x) for x in ([3], [3, 5], [1, 3], [1, 3, 5], [2, 3], [1, 2])]
    m = members(np.arange(6), rows, lists)
    found = {r["vec_id"]: (r["n"], r["copies"]) for r in links_in_cell(3, m, m, LINKED).to_pylist()}
    # 0 and 1 are at home here and count themselves; 2 and 3 met in 1.
    assert found == {0: (5, 1), 1: (5, 1), 2: (3, 0), 3: (3, 0), 4: (4, 0)}
    assert meet_here(3, np.array([[1, 3]]), np.array([[1, 3]])).tolist() == [False]


def test_many_centres_are_searched_by_graph(monkeypatch):
    random = np.random.default_rng(18)
    rows = random.standard_normal((2500, 24))
    rows[2000:] = rows[:500] + 0.1 * random.standard_normal((500, 24))
    lists = [np.array([1, 3] if i % 7 == 0 else [3, 4]) for i in range(2500)]
    m = members(np.arange(2500), rows, lists)
    by_product = {r["vec_id"]: r for r in links_in_cell(3, m, m, LINKED).to_pylist()}
    monkeypatch.setattr(embedding_dups, "PRODUCT_SHARE", 0)
    by_graph = {r["vec_id"]: r for r in links_in_cell(3, m, m, LINKED).to_pylist()}
    assert m.shard.beam >= embedding_dups.FIRST_BEAM and by_graph.keys() == by_product.keys()
    assert sum(by_graph[i]["n"] != by_product[i]["n"] for i in by_product) <= 10
    assert all(by_graph[i]["n"] <= by_product[i]["n"] and by_graph[i]["copies"] == by_product[i]["copies"] for i in by_product)


def test_ties():
    ties = Ties(8)
    ties.tie(np.array([7, 5, 2]), np.array([5, 3, 2]))
    ties.tie(np.array([6]), np.array([7]))
    assert ties.root.tolist() == [0, 1, 2, 3, 4, 3, 3, 3]
