"""Benchmark passages in documents, against windows listed one by one."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm.contamination import find_benchmark, remove_contaminated
from tallyline.llm.suffix_arrays import Items, SuffixArray, shard_matches, words_of

ITEMS = "item_id bigint, text string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(texts, items, window):
    """Per text: number of words, of words in a window, ids of its items."""
    out = []
    for text in map(words, texts):
        hit, ids = set(), set()
        for item_id, item in items:
            item = words(item)
            size = min(len(item), window)
            windows = {tuple(item[i : i + size]) for i in range(len(item) - size + 1)} if size else set()
            for at in range(len(text) - size + 1):
                if tuple(text[at : at + size]) in windows:
                    hit |= set(range(at, at + size))
                    ids.add(item_id)
        out.append((len(text), len(hit), sorted(str(i) for i in ids if i is not None)))
    return out


def found(spark, texts, items, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = find_benchmark(docs, spark.createDataFrame(items, ITEMS), **options).select("doc_id", "n_words", "n_hit", "items").collect()
    return [tuple(row[1:]) for row in sorted(rows)]


def passages(seed, count):
    chance = random.Random(seed)

    def some(vocabulary, length):
        return " ".join(f"w{chance.randrange(vocabulary)}" for _ in range(length))

    items = [(i, some(chance.choice([2, 40]), chance.choice([0, 1, 3, 9, 10, 25]))) for i in range(12)]
    texts = []
    for _ in range(count):
        text = some(chance.choice([2, 40]), chance.choice([0, 1, 5, 60]))
        if chance.random() < 0.5:
            text = f"{text}, {chance.choice(items)[1].upper()}. {some(40, 8)}"
        texts.append(text)
    return texts, items


@pytest.mark.parametrize("window", [1, 3, 10])
@pytest.mark.parametrize("seed", range(20))
def test_shards_against_windows_one_by_one(seed, window):
    texts, items = passages(seed, 30)
    sought = Items([text for _, text in items], window)
    counts, text, word, query, length = shard_matches(iter([texts[:7], texts[7:]]), sought)
    for at, (n_words, n_hit, ids) in enumerate(expected(texts, items, window)):
        own = np.flatnonzero(text == at)
        hit = {w for m in own for w in range(word[m], word[m] + length[m])}
        assert (counts[at], len(hit)) == (n_words, n_hit)
        assert sorted({str(items[i][0]) for i in sought.item[query[own]]}) == ids


def test_suffixes_stand_in_the_order_of_their_words():
    texts, _ = passages(3, 200)
    array = SuffixArray(*words_of(texts), 10)
    runs = [array.codes[p : p + 16].tolist() for p in array.order]
    assert runs == sorted(runs) and sorted(array.order) == list(range(len(array.words)))


def test_a_text_longer_than_packed_ranks_hold(monkeypatch):
    from tallyline.llm import suffix_arrays

    texts, items = passages(5, 60)
    sought = Items([text for _, text in items], 10)
    whole = [x.tolist() for x in shard_matches(iter([texts]), sought)]
    real = suffix_arrays.np.lexsort
    used = []
    monkeypatch.setattr(suffix_arrays.np, "lexsort", lambda keys: used.append(1) or real(keys))
    monkeypatch.setattr(suffix_arrays, "CODE_BITS", 8)
    sought = Items([text for _, text in items], 10)
    counts, text, word, query, length = (x.tolist() for x in shard_matches(iter([texts]), sought))
    assert used and sorted(zip(text, word, length, sought.item[query], strict=True)) == sorted(
        zip(whole[1], whole[2], whole[4], sought.item[whole[3]], strict=True)
    )


@pytest.mark.parametrize("block_chars", [1 << 20, 60])
def test_documents_against_windows_one_by_one(spark, block_chars):
    """In one block of items, and in many."""
    texts, items = passages(11, 80)
    assert found(spark, texts, items, block_chars=block_chars, shard_bytes=500) == expected(texts, items, 10)


def test_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(50_000))
    texts = [None, "", " .,", "one two", "ONE-Two three", long, long, "Ünï Ünï"]
    items = [(1, "one two"), (1, "two three"), (2, None), (3, ""), (4, "?!"), (None, "x7 x8"), (5, " ".join(f"x{i}" for i in range(40_000, 40_030))),
             (5, " ".join(f"x{i}" for i in range(40_000, 40_030))), (6, "ünï"), (7, "Ünï")]
    assert found(spark, texts, items) == expected(texts, items, 10)
    none = spark.createDataFrame([], ITEMS)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {(r.n_hit, tuple(r.items), tuple(r.matches)) for r in find_benchmark(docs, none).collect()} == {(0, (), ())}
    assert find_benchmark(docs.limit(0), spark.createDataFrame(items, ITEMS)).count() == 0


def test_matches_are_as_long_as_they_go_and_name_their_places(spark):
    item = " ".join(f"a{i}" for i in range(30))
    text = "start " + " ".join(f"a{i}" for i in range(5, 22)) + " end " + " ".join(f"a{i}" for i in range(12)) + " a11"
    docs = spark.createDataFrame([(text, "kept")], "text string, matches string").withColumn("items", F.lit(1))
    row = find_benchmark(docs, spark.createDataFrame([(7, item)], ITEMS)).first()
    assert [tuple(m) for m in row["matches"]] == [("7", 5, 1, 17), ("7", 0, 19, 12)] and row["n_hit"] == 29 and row["items"] == ["7"]


def test_affected_documents_go_and_columns_stay(spark):
    item = " ".join(f"a{i}" for i in range(12))
    docs = spark.createDataFrame([(1, "a0 a1", "x"), (2, "b " + item, "y"), (2, item[:-4], "z"), (None, None, "n")], "doc_id bigint, text string, n_hit string")
    kept = remove_contaminated(docs, spark.createDataFrame([(7, item)], ITEMS))
    assert kept.columns == docs.columns and sorted(r.n_hit for r in kept.collect()) == ["n", "x"]


def test_a_passage_that_all_documents_hold_grows_in_proportion():
    """One word over and over, searched for by itself: places are counted, not paired."""
    text, items = "a " * 200_000, Items(["a " * 10, "a"], 10)
    counts, _, word, _, length = shard_matches(iter([[text]]), items)
    assert counts.tolist() == [200_000] and len(word) <= 400_001 and set(np.r_[word, word + length]) <= set(range(200_001))
