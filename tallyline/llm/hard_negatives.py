"""Hard negatives: for each anchor and positive, rows of other labels that score nearly as high.

Scores are inner products of whole numbers, computed exactly by residues (``residues.py``). Rows are dealt
into blocks by chance, anchors into blocks of their own, and each pair of blocks is one cell of work: the
anchors are a stated query set that meets all rows in blocks, without pairs of rows ever being listed.
A first pass finds each anchor's positives, a second one multiplies again and selects in the window
that each positive sets. A cell passes on the best few rows per anchor (and positive) only, ties by id,
so that groups of equal rows or a label that most rows carry don't grow what is merged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyline.llm.common import give_back_memory, ship_package, stored
from tallyline.llm.residues import exact_products
from tallyline.llm.vectors import has_numbers, whole_numbers

ROW_BLOCK, ANCHOR_BLOCK = 8192, 2048
ANCHORS_AT_ONCE = 128

POSITIVE_TYPE = "uid bigint, score bigint, vec_id bigint"
NEGATIVE_TYPE = "uid bigint, number int, score bigint, vec_id bigint"


def best_places(scores: np.ndarray, allowed: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` highest allowed scores, highest first, earlier places first among equals."""
    at = np.flatnonzero(allowed)
    if len(at) > count:
        own = scores[at]
        at = at[own >= np.partition(own, len(own) - count)[len(own) - count]]
    return at[np.argsort(-scores[at], kind="stable")][:count]


class Cell:
    """A block of rows in the order of their ids, and a block of anchors."""

    def __init__(self, rows: pa.Table, anchors: pa.Table, scale: float):
        ids = rows["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids, self.uids = ids[order], rows["uid"].to_numpy()[order]
        self.vectors = whole_numbers(rows["vector"], scale)[order]
        self.anchor_uids = anchors["uid"].to_numpy()
        self.anchor_vectors = whole_numbers(anchors["vector"], scale)
        labels = np.array(rows["label"].to_pylist() + anchors["label"].to_pylist(), dtype=object).astype(str)
        _, codes = np.unique(labels, return_inverse=True)
        self.labels, self.anchor_labels = codes[: len(ids)][order], codes[len(ids) :]

    def scores(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each anchor's place and its scores with all rows."""
        for start in range(0, len(self.anchor_uids), ANCHORS_AT_ONCE):
            some = exact_products(self.anchor_vectors[start : start + ANCHORS_AT_ONCE], self.vectors)
            yield from enumerate(some, start)


def _in_cells(rows: DataFrame, anchors: DataFrame, scale: float, select: Callable[[Cell, pa.Table], dict], types: str) -> DataFrame:
    """``select`` over every pair of a block of rows and a block of anchors."""
    counts = rows.select(F.count("*")).first()[0], anchors.select(F.count("*")).first()[0]
    row_blocks, anchor_blocks = max(1, -(-counts[0] // ROW_BLOCK)), max(1, -(-counts[1] // ANCHOR_BLOCK))

    def dealt(uid: str, blocks: int):
        return F.pmod(F.xxhash64(uid, F.lit(blocks)), F.lit(blocks)).cast("int")

    def all_blocks(blocks: int):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    left = rows.withColumn("row_block", dealt("uid", row_blocks)).withColumn("anchor_block", all_blocks(anchor_blocks))
    right = anchors.withColumn("anchor_block", dealt("uid", anchor_blocks)).withColumn("row_block", all_blocks(row_blocks))
    schema = pa.schema([(n, pa.int32() if t == "int" else pa.int64()) for n, t in (c.split() for c in types.split(", "))])

    def cell(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = select(Cell(left, right, scale), right) if len(left) and len(right) else {n: [] for n in schema.names}
        out = pa.table({n: pa.array(found[n], schema.field(n).type) for n in schema.names})
        give_back_memory()
        return out

    keys = ["dim", "row_block", "anchor_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, types)


def _positives(cell: Cell, count: int) -> dict[str, list]:
    out: dict[str, list] = {"uid": [], "score": [], "vec_id": []}
    for at, scores in cell.scores():
        same = (cell.labels == cell.anchor_labels[at]) & (cell.uids != cell.anchor_uids[at])
        best = best_places(scores, same, count)
        out["uid"] += [int(cell.anchor_uids[at])] * len(best)
        out["score"] += scores[best].tolist()
        out["vec_id"] += cell.ids[best].tolist()
    return out


def _negatives(cell: Cell, positives: list[list[dict]], count: int, low: int, high: int) -> dict[str, list]:
    out: dict[str, list] = {"uid": [], "number": [], "score": [], "vec_id": []}
    for at, scores in cell.scores():
        other = cell.labels != cell.anchor_labels[at]
        for positive in positives[at]:
            least, most = -(-low * positive["score"] // 100), high * positive["score"] // 100
            best = best_places(scores, other & (scores >= least) & (scores <= most), count)
            out["uid"] += [int(cell.anchor_uids[at])] * len(best)
            out["number"] += [positive["number"]] * len(best)
            out["score"] += scores[best].tolist()
            out["vec_id"] += cell.ids[best].tolist()
    return out


def _first(found: DataFrame, keys: list[str], count: int, rank: str) -> DataFrame:
    """The first ``count`` rows of each key: higher scores first, ties by smaller id."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= count)


def hard_negatives(
    df: DataFrame, anchor_every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    scale: float = 256, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """For each anchor (a row whose id is divisible by ``anchor_every``) and each of its first ``positives``
    other rows of the same label, the first ``negatives`` rows of other labels whose score is between
    ``low`` and ``high`` per cent of the positive's: ``anchor_id``, ``positive_id``, ``rank`` (from 1),
    ``negative_id``, ``positive_score``, ``negative_score``.

    A component x counts as ``floor(scale * x)``; a row's score is its inner product with the anchor, exact;
    higher scores come first, ties by smaller id. Rows without id, label or components, or with a null or
    non-finite component, take no part; zero vectors do. Vectors of different lengths never meet. Rows that
    repeat an id are rows of their own, also as anchors and positives. An anchor without positives or without
    rows in a window has no result there. Components or scores beyond 64 bits are an error. Other columns
    are not looked at.
    """
    ship_package(df.sparkSession)
    usable = df.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & has_numbers(embedding))
    usable = usable.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("string").alias("label"),
        F.col(embedding).cast("array<double>").alias("vector"), F.size(embedding).alias("dim"),
    )
    rows = stored(usable.withColumn("uid", F.monotonically_increasing_id()), "rows")
    anchors = rows.where(F.col("vec_id") % anchor_every == 0)

    found = _in_cells(rows, anchors, scale, lambda cell, _: _positives(cell, positives), POSITIVE_TYPE)
    chosen = stored(_first(found, ["uid"], positives, "number"), "positives")
    held = chosen.groupBy("uid").agg(F.collect_list(F.struct("number", "score")).alias("positives"))  # at most ``positives``

    def windows(cell: Cell, anchors: pa.Table) -> dict[str, list]:
        return _negatives(cell, anchors["positives"].to_pylist(), negatives, low, high)

    with_windows = stored(anchors.join(held, "uid"), "anchors")
    found = _in_cells(rows, with_windows, scale, windows, NEGATIVE_TYPE)
    ranked = _first(found, ["uid", "number"], negatives, "rank")
    positive = chosen.select("uid", "number", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        ranked.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        .join(positive, ["uid", "number"])
        .join(anchors.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


NEGATIVE_SQL = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
           list_sum(list_transform(list_zip(a.x, r.x), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM usable a JOIN usable r ON r.vec_id <> a.vec_id AND len(a.x) = len(r.x) WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
