"""Near-duplicate documents by MinHash bands and sequential Bayesian verification.

1. Each text becomes the set of its word shingles (64-bit hashes), a signature of ``HASHES`` minima and
   a hash of the whole set, the node: texts with equal sets are one node, whatever their number.
2. Bands of the signature give buckets. Nodes that share a bucket are candidates, but a bucket's pairs
   are never all emitted: in each round every member is compared with one leader of its bucket,
   unless both are known to belong together already. Components found so far are drawn together after
   each round, so that a large group of near copies costs about its size, not its square. What is
   left after ``ROUNDS`` rounds are pairs from different components. In buckets of up to
   ``LARGE_BUCKET`` members they are compared one by one. Large buckets are drawn together into
   clusters, in which every member outside of the largest component meets all others, in tiles of
   blocks of both; a tile gives one link for each two components that it finds linked.
3. A pair's signatures are compared batch by batch. After each batch the pair is given up if the
   posterior probability that its similarity reaches the threshold is below ``MISS``.
4. Survivors are verified exactly on their full sets.

At similarity 0.8 a pair shares no band with probability 3e-6. Two different sets share a 64-bit
node with probability n^2 / 2^65 for n sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from tallyline.llm.common import give_back_memory, in_chunks, row_key, ship_package, stored, whole_text
from tallyline.llm.graphs import components
from tallyline.llm.words import byte_class, mixed, shingle_hashes, word_hashes

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
BATCH = 32
MISS = 1e-5
ROUNDS = 2
LARGE_BUCKET = 32
TILE_ROWS = 256
TILE_COLUMNS = 4096  # shingles counted at once
WORD_BYTES = byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")

_random = np.random.default_rng(7)
XORS = _random.integers(0, 2**64, HASHES, dtype=np.uint64, endpoint=False)
ODDS = _random.integers(0, 2**64, HASHES, dtype=np.uint64, endpoint=False) | np.uint64(1)


class TextSets:
    """Of many texts: their distinct shingle hashes (sorted, one text after another), counts and nodes."""

    def __init__(self, texts: list[str], size: int):
        self.hashes, self.counts = shingle_hashes(*word_hashes(texts, WORD_BYTES), size)
        text = np.repeat(np.arange(len(texts)), self.counts)
        order = np.lexsort((self.hashes, text))
        self.hashes, text = self.hashes[order], text[order]
        new = np.r_[True, (self.hashes[1:] != self.hashes[:-1]) | (text[1:] != text[:-1])][: len(text)]
        self.hashes, text = self.hashes[new], text[new]
        self.counts = np.bincount(text, minlength=len(texts))
        self.full = np.flatnonzero(self.counts)
        self.starts = (np.cumsum(self.counts) - self.counts)[self.full]

    def nodes(self) -> np.ndarray:
        sums = np.zeros(len(self.counts), np.uint64)
        if len(self.full):
            sums[self.full] = np.add.reduceat(mixed(self.hashes ^ XORS[0]), self.starts)
        return mixed(sums + self.counts.astype(np.uint64)).view(np.int64)

    def signatures(self) -> list[bytes | None]:
        """The upper 16 bits of each minimum."""
        out: list[bytes | None] = [None] * len(self.counts)
        if len(self.full):
            minima = np.empty((HASHES, len(self.full)), np.uint64)
            for j in range(HASHES):
                minima[j] = np.minimum.reduceat((self.hashes ^ XORS[j]) * ODDS[j], self.starts)
            # Minima crowd near 0: all of their bits are mixed before some are kept.
            rows = (mixed(minima) >> np.uint64(48)).astype("<u2").T.tobytes()
            for i, text in enumerate(self.full.tolist()):
                out[text] = rows[2 * HASHES * i : 2 * HASHES * (i + 1)]
        return out

    def sets(self) -> list[bytes]:
        ends = np.cumsum(self.counts)
        data = self.hashes.astype("<u8").tobytes()
        return [data[8 * (end - n) : 8 * end] for end, n in zip(ends.tolist(), self.counts.tolist(), strict=True)]


def _struct(columns: dict[str, pa.Array]) -> pa.StructArray:
    return pa.StructArray.from_arrays(list(columns.values()), list(columns))


def _described(size: int, with_sets: bool):
    kind = "n_shingles bigint, node bigint, signature binary" + ", hashes binary" * with_sets

    @arrow_udf(kind)
    def described(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            counts, nodes, signatures, sets = [], [], [], []
            for texts in in_chunks(batch, 1 << 18):
                own = TextSets(texts, size)
                counts.append(own.counts)
                nodes.append(own.nodes())
                signatures += own.signatures()
                sets += own.sets() if with_sets else []
            counts, nodes = np.concatenate(counts or [np.empty(0, int)]), np.concatenate(nodes or [np.empty(0, np.int64)])
            columns = {
                "n_shingles": pa.array(counts, pa.int64()),
                "node": pa.array(nodes, pa.int64(), mask=counts == 0),
                "signature": pa.array(signatures, pa.binary()),
            }
            yield _struct(columns | ({"hashes": pa.array(sets, pa.binary())} if with_sets else {}))
        give_back_memory()

    return described


def fewest_matches(threshold: float, compared: int) -> int:
    """The fewest equal minima of ``compared`` with which a pair goes on: from a uniform prior, the
    posterior probability of a similarity of at least the threshold is that of a binomial variable."""
    below = 0.0
    for matches in range(compared + 1):
        below += comb(compared + 1, matches) * threshold**matches * (1 - threshold) ** (compared + 1 - matches)
        if below >= MISS:
            return matches
    return compared


def _hopeful(threshold: float):
    steps = [(upto, fewest_matches(threshold, upto)) for upto in range(BATCH, HASHES + 1, BATCH)]

    @arrow_udf("boolean")
    def hopeful(left: pa.Array, right: pa.Array) -> pa.Array:
        a, b = (np.frombuffer(b"".join(x.to_pylist()), "<u2").reshape(-1, HASHES) for x in (left, right))
        matches, open_ = np.zeros(len(a), int), np.arange(len(a))
        passes = np.zeros(len(a), bool)
        for upto, fewest in steps:
            batch = slice(upto - BATCH, upto)
            matches[open_] += (a[open_, batch] == b[open_, batch]).sum(axis=1)
            open_ = open_[matches[open_] >= fewest]
        passes[open_] = True
        return pa.array(passes)

    return hopeful


class Tile:
    """Some members of a cluster, as the rows or the columns of a tile."""

    def __init__(self, table: pa.Table):
        self.label = table["label"].to_numpy()
        self.count = table["n_shingles"].to_numpy()
        self.signatures = np.frombuffer(b"".join(table["signature"].to_pylist()), "<u2").reshape(-1, HASHES)
        self.hashes = [np.frombuffer(x, "<u8") for x in table["hashes"].to_pylist()]

    def some(self, rows: np.ndarray) -> Tile:
        out = object.__new__(Tile)
        out.label, out.count, out.signatures = self.label[rows], self.count[rows], self.signatures[rows]
        out.hashes = [self.hashes[i] for i in rows.tolist()]
        return out


def common_in_tile(left: Tile, right: Tile) -> np.ndarray:
    """The size of the intersection of every set of one side with every set of the other, exactly."""
    keys = np.intersect1d(np.concatenate(left.hashes), np.concatenate(right.hashes))
    out = np.zeros((len(left.hashes), len(right.hashes)), np.float32)
    for start in range(0, len(keys), TILE_COLUMNS):
        some = keys[start : start + TILE_COLUMNS]
        sides = []
        for side in (left, right):
            held = np.zeros((len(side.hashes), len(some)), np.float32)
            for row, hashes in enumerate(side.hashes):
                at = np.minimum(np.searchsorted(hashes, some), len(hashes) - 1)
                held[row] = hashes[at] == some
            sides.append(held)
        out += sides[0] @ sides[1].T
    return np.rint(out).astype(np.int64)


def linked_labels(left: Tile, right: Tile, percent: int) -> np.ndarray:
    """Pairs of labels between which the tile holds a link."""
    small, large = np.minimum.outer(left.count, right.count), np.maximum.outer(left.count, right.count)
    open_ = (left.label[:, None] != right.label) & (100 * small >= percent * large)
    matches = np.zeros(open_.shape, np.int16)
    for upto in range(BATCH, HASHES + 1, BATCH):
        for j in range(upto - BATCH, upto):
            matches += left.signatures[:, j, None] == right.signatures[:, j]
        open_ &= matches >= fewest_matches(percent / 100, upto)
        if not open_.any():
            return np.empty((0, 2), np.int64)
    rows, columns = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
    left, right, open_ = left.some(rows), right.some(columns), open_[np.ix_(rows, columns)]
    both = common_in_tile(left, right)
    a, b = np.nonzero(open_ & (100 * both >= percent * (left.count[:, None] + right.count - both)))
    return np.unique(np.column_stack([left.label[a], right.label[b]]), axis=0)


@arrow_udf(LongType())
def common_hashes(left: pa.Array, right: pa.Array) -> pa.Array:
    """The size of the intersection of two sorted sets of 64-bit hashes."""
    out = []
    for a, b in zip(left, right, strict=True):
        a, b = np.frombuffer(a.as_py(), "<u8"), np.frombuffer(b.as_py(), "<u8")
        out.append(len(np.intersect1d(a, b, assume_unique=True)))
    return pa.array(out, pa.int64())


class Search:
    """The state of one run: the nodes that share buckets, their sets, and the links found so far."""

    def __init__(self, docs: DataFrame, size: int, percent: int):
        ship_package(docs.sparkSession)
        self.percent = percent
        keyed = docs.select("doc_id", whole_text("text").alias("text"), "row")
        described = keyed.withColumn("d", _described(size, False)("text")).select("doc_id", "row", "d.*")
        self.rows = stored(described, "signatures")
        self.shared = self._shared_buckets()
        nodes = self.shared.select("node").distinct()
        chosen = self.rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("row").alias("row")).select("row")
        texts = keyed.join(chosen, "row", "left_semi").groupBy("row").agg(F.any_value("text").alias("text"))
        self.sets = stored(texts.select(_described(size, True)("text").alias("d")).select("d.*"), "sets")
        self.roots = docs.sparkSession.createDataFrame([], "node bigint, root bigint")

    def _shared_buckets(self) -> DataFrame:
        """Buckets (hashes of a band) with more than one node, as rows of bucket and node."""
        width = 2 * ROWS
        bands = [F.xxhash64(F.substring("signature", 1 + width * b, width), F.lit(b)) for b in range(BANDS)]
        members = self.rows.where("node is not null").select("node", F.explode(F.array(*bands)).alias("bucket"))
        several = members.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
        return stored(members.join(several, "bucket", "left_semi").distinct(), "buckets")

    def _labelled(self) -> DataFrame:
        return self.shared.join(self.roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("label"))

    def _open(self) -> DataFrame:
        """Members of the buckets that still hold several components."""
        labelled = self._labelled()
        several = labelled.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
        return labelled.join(several.select("bucket"), "bucket", "left_semi")

    def _with_leaders(self, members: DataFrame, round_: int) -> DataFrame:
        """Each member with its bucket's leader: first the smallest node, later one by chance."""
        if round_ == 0:
            leaders = members.groupBy("bucket").agg(F.min("node").alias("leader"))
            return members.join(leaders, "bucket").where("node <> leader").select("node", "leader")
        chance = F.struct(F.xxhash64("bucket", "node", F.lit(round_)), "node", "label")
        leaders = members.groupBy("bucket").agg(F.min(chance).alias("least"))
        leaders = leaders.select("bucket", F.col("least.node").alias("leader"), F.col("least.label").alias("led"))
        return members.join(leaders, "bucket").where("label <> led").select("node", "leader")

    def _pairs_of_small(self, members: DataFrame) -> DataFrame:
        """All pairs from different components in buckets of few members."""
        sizes = members.groupBy("bucket").count().where(F.col("count") <= LARGE_BUCKET)
        left = members.join(sizes.select("bucket"), "bucket", "left_semi")
        right = left.select("bucket", F.col("node").alias("leader"), F.col("label").alias("led"))
        return left.join(right, "bucket").where("node < leader and label <> led").select("node", "leader")

    def _links_of_large(self, members: DataFrame) -> DataFrame:
        """Links between components in large buckets, as pairs of labels."""
        firsts = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("first"))
        firsts = firsts.where(F.col("n") > LARGE_BUCKET).select("bucket", "first")
        large = stored(members.join(firsts, "bucket").select("node", "label", "first"), "large")
        if large.isEmpty():
            return self.roots.select(F.col("node").alias("a"), F.col("root").alias("b")).limit(0)
        clusters = components(large, "node", "first")
        rows = large.select("node", "label").distinct().join(clusters, "node").withColumnRenamed("root", "cluster")
        rows = stored(rows.select("node", "label", "cluster"), "clusters")
        counts = rows.groupBy("cluster", "label").count()
        most = counts.groupBy("cluster").agg(F.max(F.struct("count", "label")).alias("most"), F.sum("count").alias("all"))
        blocks = [F.ceil(n / TILE_ROWS).cast("int") for n in (F.col("all") - F.col("most.count"), F.col("all"))]
        clusters = most.where("all > most.count").select("cluster", F.col("most.label").alias("main"), blocks[0].alias("rows"), blocks[1].alias("columns"))
        placed = rows.join(clusters, "cluster").join(self.sets, "node").drop("node")
        own = [F.pmod(F.xxhash64("signature", "label", F.lit(3)), F.col(c)).cast("int") for c in ("rows", "columns")]
        all_ = [F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("rows", "columns")]
        left = placed.where("label <> main").withColumn("row", own[0]).withColumn("column", all_[1])
        right = placed.withColumn("column", own[1]).withColumn("row", all_[0])
        percent = self.percent

        def links(key, left: pa.Table, right: pa.Table) -> pa.Table:
            found = np.empty((0, 2), np.int64)
            if len(left) and len(right):
                found = linked_labels(Tile(left), Tile(right), percent)
            return pa.table({"a": pa.array(found[:, 0], pa.int64()), "b": pa.array(found[:, 1], pa.int64())})

        keys, columns = ["cluster", "row", "column"], ["label", "n_shingles", "signature", "hashes"]
        left, right = (side.select(*keys, *columns).toDF(*keys, *columns) for side in (left, right))
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(links, "a bigint, b bigint")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
        side = self.sets.select("node", "n_shingles", "signature")
        for name in ("a", "b"):
            pairs = pairs.join(side.select(*[F.col(c).alias(f"{name}_{c}") for c in side.columns]), F.col(name) == F.col(f"{name}_node"))
        close = F.least("a_n_shingles", "b_n_shingles") * 100 >= F.greatest("a_n_shingles", "b_n_shingles") * self.percent
        hopeful = _hopeful(self.percent / 100)
        pairs = pairs.where(close).where(hopeful("a_signature", "b_signature"))
        pairs = stored(pairs.select("a", "b", "a_n_shingles", "b_n_shingles"), "candidates")
        for name in ("a", "b"):
            own = self.sets.select(F.col("node").alias(name), F.col("hashes").alias(f"{name}_hashes"))
            pairs = pairs.join(own, name)
        both = pairs.withColumn("both", common_hashes("a_hashes", "b_hashes"))
        union = F.col("a_n_shingles") + F.col("b_n_shingles") - F.col("both")
        return both.where(100 * F.col("both") >= self.percent * union).select("a", "b")

    def _join(self, links: DataFrame) -> None:
        links = stored(links, "links")
        if not links.isEmpty():
            known = self.roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            self.roots = stored(components(links.unionByName(known)), "roots")

    def run(self) -> DataFrame:
        """Node and root of all nodes with links."""
        for round_ in range(ROUNDS):
            members = stored(self._open(), "members")
            self._join(self._verified(self._with_leaders(members, round_)))
        members = stored(self._open(), "members")
        self._join(self._verified(self._pairs_of_small(members)).unionByName(self._links_of_large(members)))
        return self.roots


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` (distinct ones), ``component_id`` (the smallest id
    reachable over links, its own included) and ``kept`` (its id is that one).

    Two documents are linked if 100 x common shingles >= percent x shingles of either. Words are runs
    of bytes other than ASCII white space, lower-cased in A-Z. A null or empty text has no shingle and
    no link. A null id counts as larger than any other; rows without an id get the id of their
    component, if it has one. Rows that repeat an id are kept or not together with it.
    """
    return _near_duplicates(docs, shingle, percent, doc_id, text).drop("row")


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that ``near_duplicates`` keeps, with all of their columns."""
    gone = _near_duplicates(docs, shingle, percent, doc_id, text).where(~F.col("kept")).select(F.col("row").alias("__gone")).distinct()
    return docs.join(gone, _row(doc_id, text) == F.col("__gone"), "left_anti")


def _row(doc_id: str, text: str) -> Column:
    return F.xxhash64(row_key(doc_id, text))


def _near_duplicates(docs: DataFrame, shingle: int, percent: int, doc_id: str, text: str) -> DataFrame:
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), _row(doc_id, text).alias("row"))
    search = Search(docs, shingle, percent)
    rows = search.rows.select("doc_id", "n_shingles", "node", "row").join(search.run(), "node", "left")
    rows = rows.withColumn("label", F.coalesce("root", "node"))
    smallest = rows.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("smallest"))
    out = rows.join(smallest, "label", "left").withColumn("component_id", F.coalesce("smallest", "doc_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return out.select("doc_id", "n_shingles", "component_id", kept, "row")
