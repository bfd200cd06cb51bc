"""The operators of this package with production parameters over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from tallyline.llm.common import table
from tallyline.llm.contamination import contamination_sql, find_benchmark
from tallyline.llm.embedding_dups import embedding_duplicates
from tallyline.llm.hard_negatives import NEGATIVE_SQL, hard_negatives
from tallyline.llm.licenses import license_sql, scan_licenses
from tallyline.llm.lines import line_sql, remove_shared_lines
from tallyline.llm.minhash import near_duplicates
from tallyline.llm.mixing import mix_sources, mix_sql
from tallyline.llm.pages import extract_text
from tallyline.llm.pieces import digest_pieces
from tallyline.llm.posting_lists import nearest_neighbours
from tallyline.llm.settings import END_ID, LEAK_WORDS, MIN_SITES, MIX_WEIGHTS, PIECE_MODEL, TOXIC, WORD_TOKENIZER
from tallyline.llm.token_files import read_token_files, write_token_files
from tallyline.llm.toxicity import held_out, score_toxicity, train_toxicity
from tallyline.llm.whitening import per_component, whiten
from tallyline.session import scratch_folder

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def query(function):
    LLM_QUERIES[function.__name__] = function
    return function


@query
def op4_sentencepiece(spark, sf):
    return digest_pieces(table(spark, sf, "documents").select("doc_id", "text"), PIECE_MODEL).drop("text")


@query
def op1_mix_sources(spark, sf):
    return mix_sources(table(spark, sf, "documents"), MIX_WEIGHTS)


LLM_ORACLE["op1_mix_sources"] = mix_sql(MIX_WEIGHTS)


@query
def op9_line_dedup(spark, sf):
    return remove_shared_lines(table(spark, sf, "documents"), MIN_SITES).select("doc_id", "text", "n_removed")


LLM_ORACLE["op9_line_dedup"] = line_sql(MIN_SITES)


@query
def op3_license_scan(spark, sf):
    return scan_licenses(table(spark, sf, "documents").select("doc_id", "text")).drop("text", "found")


LLM_ORACLE["op3_license_scan"] = license_sql()


@query
def op2_html_extraction(spark, sf):
    return extract_text(table(spark, sf, "pages").select("page_id", "url", "html")).drop("html")


@query
def op7_token_files(spark, sf):
    """The digests come from the files, not from what was written to them."""
    folder = scratch_folder(spark, "tokens")
    write_token_files(table(spark, sf, "documents"), WORD_TOKENIZER, folder, END_ID)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op6_minhash_dedup(spark, sf):
    return near_duplicates(table(spark, sf, "documents"), shingle=4)


@query
def op5_embedding_dedup(spark, sf):
    return embedding_duplicates(table(spark, sf, "embeddings"), cosine=0.95)


@query
def op10_nearest_neighbours(spark, sf):
    return nearest_neighbours(table(spark, sf, "embeddings"), query_every=100)


@query
def op8_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, train_toxicity(docs, table(spark, sf, "labels")))
    predicted = (F.col("score") >= TOXIC).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


@query
def op11_hard_negatives(spark, sf):
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf, "embeddings").withColumn("label", relabelled), anchor_every=100)


LLM_ORACLE["op11_hard_negatives"] = NEGATIVE_SQL


@query
def op12_decontamination(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = find_benchmark(docs, table(spark, sf, "benchmark"), LEAK_WORDS)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("matches") > 0).alias("contaminated"),
    )


LLM_ORACLE["op12_decontamination"] = contamination_sql(LEAK_WORDS)


@query
def op13_whitening(spark, sf):
    return per_component(whiten(table(spark, sf, "embeddings").select("vec_id", "embedding"), components=32), "vec_id")


@query
def pipeline(spark, sf):
    return corpus_pipeline.run(spark, sf)
