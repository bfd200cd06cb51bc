"""From documents to token ids: five stages, each of which works on all that the one before it kept.

Every stage takes and returns documents (the last one: digests of their ids) and is written as a table
in the cluster's shared folder before the next one starts, so that a lost executor repeats one stage's
tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.llm.common import stored, table
from tallyline.llm.lines import remove_shared_lines
from tallyline.llm.minhash import drop_near_duplicates
from tallyline.llm.mixing import mix_sources
from tallyline.llm.pieces import digest_pieces
from tallyline.llm.settings import MIN_SITES, MIX_WEIGHTS, PASSAGE_SITES, PASSAGE_WORDS, PIECE_MODEL, TOXIC
from tallyline.llm.toxicity import score_toxicity, train_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    model = train_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, score="__toxicity").where(F.col("__toxicity") < TOXIC).select(docs.columns)


def _without_lines(docs: DataFrame, min_sites: int, min_words: int = 1) -> DataFrame:
    cleaned = remove_shared_lines(docs, min_sites, removed="__removed", min_words=min_words)
    n_chars = F.when(F.col("__removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("bigint")
    return cleaned.withColumn("n_chars", n_chars).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sources share go, from all documents but the first; documents stay."""
    return _without_lines(docs, MIN_SITES)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays; long lines that a few
    sources still share then go, from all documents but the first. Before, they would be mostly lines of
    copies, which would stay as what is left of them instead of going whole."""
    kept = stored(drop_near_duplicates(docs).select(docs.columns), "near-deduplicated")
    return _without_lines(kept, PASSAGE_SITES, PASSAGE_WORDS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight asks for, in a global order by chance."""
    return mix_sources(docs, MIX_WEIGHTS).select(docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document of the mix: number and digest of its ids, digest of what they decode to."""
    return digest_pieces(docs.select("doc_id", "source", "text"), PIECE_MODEL).drop("text")


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("minhash_dedup", minhash_dedup),
    ("mix_sources", mix),
    ("sentencepiece", sentencepiece),
]

# A trained network decides which documents go on: SQL can't express that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
