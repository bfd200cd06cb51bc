"""Benchmark decontamination by suffix arrays of the training texts.

The documents of a task form shards of about ``SHARD_BYTES`` of text; each shard gets a suffix array over its
words (``suffix_arrays.py``), in which every suffix of every benchmark item is searched by bisection. What
comes back are the longest verbatim matches with their places in item and document. Everything about a
document happens in its row's task: documents are not shuffled. Items are dealt by hash into blocks of about
``BLOCK_CHARS``, each sent to the tasks as a whole; with several blocks the documents are passed over once
per block, so that neither driver nor tasks ever hold more than one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from tallyline.llm.common import give_back_memory, in_chunks, ship_package, stored, whole_text
from tallyline.llm.suffix_arrays import Items, shard_matches

SHARD_BYTES = 8 << 20
BLOCK_CHARS = 4 << 20

MATCH_TYPE = "array<struct<item:string,item_word:bigint,word:bigint,words:bigint>>"
FOUND_TYPE = f"struct<n_words:bigint,matches:{MATCH_TYPE}>"
_MATCH = pa.struct([("item", pa.string()), ("item_word", pa.int64()), ("word", pa.int64()), ("words", pa.int64())])


def _shards(texts: pa.Array, limit: int) -> Iterator[list[list[str]]]:
    """The texts in small lists, a shard's lists together."""
    shard, held = [], 0
    for piece in in_chunks(texts):
        size = sum(map(len, piece))
        if shard and held + size > limit:
            yield shard
            shard, held = [], 0
        shard.append(piece)
        held += size
    if shard:
        yield shard


def _finder(names: list[str | None], items: Items, shard_bytes: int):
    @arrow_udf(FOUND_TYPE)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        item_names = pa.array(names, pa.string())
        for batch in batches:
            counts, columns, sizes = [np.empty(0, np.int64)], [], [np.empty(0, np.int64)]
            for shard in _shards(batch, shard_bytes):
                own, text, word, query, length = shard_matches(iter(shard), items)
                counts.append(own)
                sizes.append(np.bincount(text, minlength=len(own)))
                columns.append(pa.StructArray.from_arrays([
                    item_names.take(pa.array(items.item[query])), pa.array(items.offset[query]), pa.array(word), pa.array(length),
                ], fields=list(_MATCH)))
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
            values = pa.concat_arrays(columns) if columns else pa.array([], _MATCH)
            matches = pa.ListArray.from_arrays(pa.array(bounds), values)
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(counts), pa.int64()), matches], ["n_words", "matches"])
        give_back_memory()

    return found


def _covered(matches: Column) -> Column:
    """How many words lie in any of the matches, which are in the order of their first words."""
    start = F.struct(F.lit(0).cast("bigint").alias("upto"), F.lit(0).cast("bigint").alias("n"))

    def step(state: Column, match: Column) -> Column:
        end = match["word"] + match["words"]
        more = F.greatest(end - F.greatest(state["upto"], match["word"]), F.lit(0))
        return F.struct(F.greatest(state["upto"], end).alias("upto"), (state["n"] + more).alias("n"))

    return F.aggregate(matches, start, step)["n"]


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    shard_bytes: int = SHARD_BYTES, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Adds to every document: ``n_words``; ``matches``, the verbatim matches of at least ``window`` words
    of a benchmark item, or of all words of a shorter one, that no word before or behind extends (item as
    text, its first matching word, the document's, number of words), in the document's order; ``n_hit``,
    how many words lie in a match; ``items``, the ids of the matching items as texts, distinct and sorted.

    Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased, told apart by 64-bit
    hashes. Null and empty texts have no words and no matches; an item without words matches nothing.
    Rows of the benchmark that share an id are one item to ``items``; the matches of one without id count
    for ``n_hit`` and carry a null. Documents that repeat are looked at one by one. Input columns of
    the names above are replaced, others kept. Without documents or items the columns are empty or 0.
    """
    ship_package(docs.sparkSession)
    items = benchmark.where(F.length(item_text) > 0).select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text")).distinct()
    chars = items.select(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    found = docs.drop("n_words", "matches", "n_hit", "items").withColumn("__matches", F.array().cast(MATCH_TYPE))
    for number in range(blocks):
        rows = items.where(block == number).collect()  # about ``block_chars``
        finder = _finder([row["id"] for row in rows], Items([row["text"] for row in rows], window), shard_bytes)
        found = found.withColumn("__found", finder(whole_text(text)))
        found = found.withColumn("__matches", F.concat("__matches", "__found.matches"))
        if number < blocks - 1:
            found = stored(found.drop("__found"), "matches")
    in_order = F.array_sort("__matches", lambda a, b: F.when(a["word"] < b["word"], -1).when(a["word"] > b["word"], 1).otherwise(0))
    matches = in_order if blocks > 1 else F.col("__matches")
    ids = F.array_sort(F.array_distinct(F.array_compact(F.transform("matches", lambda m: m["item"]))))
    return (
        found.withColumn("n_words", F.col("__found.n_words"))
        .withColumn("matches", matches)
        .withColumn("n_hit", F.when(F.size("matches") > 0, _covered(F.col("matches"))).otherwise(F.lit(0).cast("bigint")))
        .withColumn("items", ids)
        .drop("__found", "__matches")
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", **names) -> DataFrame:
    """The documents in which ``find_benchmark`` finds nothing, with their own columns."""
    marked = find_benchmark(docs.select(F.col(text).alias("__text"), F.struct(*docs.columns).alias("__row")), benchmark, window, "__text", **names)
    return marked.where(F.size("matches") == 0).select("__row.*")


CONTAMINATION_SQL = r"""
WITH doc_words AS (
    SELECT doc_id, row_number() OVER () AS row, list_filter(string_split(regexp_replace(translate(coalesce(text, ''), '{upper}', '{lower}'),
           '{between}', ' ', 'g'), ' '), lambda w: w <> '') AS words FROM documents
), item_words AS (
    SELECT item_id, list_filter(string_split(regexp_replace(translate(coalesce(text, ''), '{upper}', '{lower}'), '{between}', ' ', 'g'), ' '),
           lambda w: w <> '') AS words FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(words), {window}) AS size, array_to_string(words[i : i + least(len(words), {window}) - 1], ' ') AS run
    FROM item_words, unnest(generate_series(1, len(words) - least(len(words), {window}) + 1)) AS t(i) WHERE len(words) > 0
), runs AS (
    SELECT row, size, i, array_to_string(words[i : i + size - 1], ' ') AS run
    FROM doc_words, (SELECT DISTINCT size FROM windows), unnest(generate_series(1, len(words) - size + 1)) AS t(i)
), hits AS (SELECT row, item_id, i, size FROM runs JOIN windows USING (size, run)),
covered AS (SELECT row, count(DISTINCT word) AS n_hit FROM (SELECT row, unnest(generate_series(i, i + size - 1)) AS word FROM hits) GROUP BY row),
named AS (
    SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT row, item_id::VARCHAR AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (row) LEFT JOIN named USING (row)
"""


def contamination_sql(window: int) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return CONTAMINATION_SQL.format(window=window, upper=upper, lower=upper.lower(), between=r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
