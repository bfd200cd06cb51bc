"""Operators on whole collections: mixing, lines, near duplicates, toxicity, the pipeline."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyline.llm import lines, minhash, mixing, pieces, toxicity
from tallyline.llm.common import table
from tallyline.llm.graphs import components
from tallyline.llm.settings import MIN_SITES, MIX_WEIGHTS, PASSAGE_SITES, PASSAGE_WORDS, PIECE_MODEL, TOXIC

SMALL = "/root/testdata/sf0.001"


# Mixing


def test_mix_reaches_the_weights_and_repeats_exactly(spark, documents):
    docs = documents(*[(i, "x" * 99, "a" if i % 3 else "b") for i in range(3000)])
    found = mixing.mix_sources(docs, {"b": 3.0}, epochs=2.0, partitions=5)
    sizes = {r.source: r.n for r in found.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(sizes["b"] / 6000 - 0.75) < 0.03 and abs(sizes["a"] / 6000 - 0.25) < 0.03
    again = mixing.mix_sources(docs.repartition(7), {"b": 3.0}, epochs=2.0, partitions=5)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, again.collect()))


def test_mix_is_in_global_order_and_numbers_copies(spark, documents):
    docs = documents(*[(i, f"text {i}", "a") for i in range(500)])
    rows = mixing.mix_sources(docs, epochs=3.0, partitions=4).collect()
    places = [r.place for r in rows]
    assert places == sorted(places)
    copies = {}
    for r in rows:
        copies.setdefault(r.doc_id, []).append(r.copy)
        assert r.copies >= r.copy
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in copies.values())


def test_counts_follow_poisson_also_at_large_rates(spark, documents):
    docs = documents(*[(i, "y", "big" if i else "one") for i in range(400)])
    found = mixing.mix_sources(docs, {"one": 1000.0, "big": 1.0}, epochs=1.0)
    counts = {r.source: r.n for r in found.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(counts["one"] - 400) < 100


def test_mix_with_nulls_empty_texts_repeats_and_clashes(spark, documents):
    docs = documents((None, None, None), (1, "", "a"), (1, "", "a"), (2, "b", "a")).withColumn("place", F.lit("old"))
    rows = mixing.mix_sources(docs, epochs=20.0).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r.copies)
    assert set(by_doc) == {None, 1, 2} and len(set(by_doc[1])) == 1 and len(by_doc[1]) == 2 * by_doc[1][0]
    assert mixing.mix_sources(documents(), epochs=2.0).count() == 0


# Lines


def test_lines_of_many_sites_stay_once(spark, documents):
    docs = documents(*[(i, f"own {i}\n menu \n\nend", f"s{i % 6}") for i in range(12)], (50, None, "s1"), (51, "", None))
    found = {r.doc_id: r for r in lines.remove_shared_lines(docs, 6).collect()}
    assert found[0].text == "own 0\n menu \n\nend" and found[0].n_removed == 0
    assert found[7].text == "own 7\n" and found[7].n_removed == 2
    assert found[50].text is None and found[51].text == "" and found[51].n_removed == 0
    assert lines.remove_shared_lines(docs, 7).where("n_removed > 0").count() == 0


def test_a_null_site_counts_as_one_and_repeated_rows_go_alike(spark, documents):
    docs = documents((1, "l", None), (2, "l", "a"), (3, "l", "b"), (3, "l", "b")).withColumn("n_removed", F.lit("clash"))
    found = [(r.doc_id, r.text, r.n_removed) for r in lines.remove_shared_lines(docs, 3).collect()]
    assert sorted(found) == [(1, "l", 0), (2, "", 1), (3, "", 1), (3, "", 1)]
    assert lines.remove_shared_lines(documents(), 3).count() == 0


def test_one_very_common_line_and_a_long_text(spark, documents):
    docs = documents(*[(i, "common", f"s{i % 40}") for i in range(400)], (999, "\n".join(f"l{i}" for i in range(20000)) + "\ncommon", "s1"))
    found = lines.remove_shared_lines(docs, 30)
    assert found.where("n_removed = 1").count() == 400
    assert found.where("doc_id = 999").first().text.endswith("l19999")


def test_passages_of_few_sites_go_and_short_lines_and_copies_do_not_become_stubs(spark, documents):
    def words(name, n):
        return " ".join(f"{name}{i}" for i in range(n))

    passage, short, own = words("p", 40), words("s", 29), [words(f"own{i}x", 120) for i in range(12)]
    entries = [(i, f"{own[i]}\n{passage}\n{short}", f"s{i % 3}") for i in range(6)]
    entries += [(i, f"{own[6]}\n{own[7]}", f"s{i}") for i in range(20, 25)]
    entries += [(i, f"{own[i - 22]}\n{words('two', 50)}", f"s{i % 2}") for i in range(30, 34)]
    found = {r.doc_id: r for r in corpus_pipeline.minhash_dedup(spark, documents(*entries), None).collect()}
    assert sorted(found) == [*range(6), 20, *range(30, 34)]
    assert found[0].text == entries[0][1]
    for i in range(1, 6):
        assert found[i].text == f"{own[i]}\n{short}" and found[i].n_chars == len(found[i].text)
    assert found[20].text == f"{own[6]}\n{own[7]}"
    assert all(found[i].text.endswith("two49") for i in range(30, 34))


# Components and near duplicates


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components_against_union_find(spark, shape):
    pick = random.Random(1)
    pairs = {
        "chain": [(i, i + 1) for i in range(40)],
        "star": [(500, i) for i in range(100, 160)] + [(1, 1)],
        "random": [(pick.randint(0, 80), pick.randint(0, 80)) for _ in range(50)],
    }[shape]
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame([*pairs, (None, 3)], "a bigint, b bigint"))
    expected = {x: find(x) for p in pairs if p[0] != p[1] for x in p}
    assert {r.node: r.root for r in found.collect()} == expected


def brute_force(entries, size, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in entries:
        words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(low))
        grams = {tuple(words[j : j + size]) for j in range(len(words) - size + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    group = list(range(len(entries)))
    for a in range(len(entries)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]) and group[a] != group[b]:
                low_, high = sorted((group[a], group[b]))
                group = [low_ if g == high else g for g in group]
    smallest = {g: min(entries[i][0] for i in range(len(entries)) if group[i] == g) for g in group}
    return sorted((entries[i][0], len(sets[i]), smallest[group[i]], entries[i][0] == smallest[group[i]]) for i in range(len(entries)))


def test_near_duplicates_against_brute_force(spark):
    pick = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    entries = []
    for _ in range(12):
        base = [pick.choice(vocabulary) for _ in range(pick.choice([3, 30, 120]))]
        for _ in range(6):
            copy = list(base)
            for _ in range(pick.randint(0, 4)):
                copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
            entries.append((len(entries) * 3 % 1000, " ".join(copy).upper() if pick.random() < 0.3 else "\t".join(copy)))
    entries += [(2000, None), (2001, ""), (2002, " \n "), (2003, "Ein Wort"), (2004, "ein  WORT"), (2005, "é " * 50), (2006, "a" * 5000)]
    docs = spark.createDataFrame(entries, "doc_id bigint, text string").withColumn("node", F.lit("clash"))
    found = minhash.near_duplicates(docs, 4, 80)
    assert sorted(map(tuple, found.collect())) == brute_force(entries, 4, 80)


def test_a_large_group_of_near_copies_and_repeated_ids(spark, documents):
    base = [f"t{i}" for i in range(80)]
    entries = [(i, " ".join([*base[: i % 70], f"x{i}", *base[i % 70 + 1 :]]), "s") for i in range(150)]
    docs = documents(*entries, (7, entries[7][1], "s"), (None, entries[3][1], "s"), (900, "other text of its own here", "s"))
    found = minhash.near_duplicates(docs, 4, 80).collect()
    assert {r.component_id for r in found if r.doc_id != 900} == {0}
    assert sum(r.kept for r in found) == 2
    assert minhash.drop_near_duplicates(docs, 4, 80).count() == 2
    assert minhash.near_duplicates(documents()).count() == 0


def test_a_sharply_lower_batch_count_only_prunes_hopeless_pairs():
    kept = minhash.fewest_matches(0.8, 32)
    assert 8 < kept < 20 and minhash.fewest_matches(0.8, 160) > 4 * kept


# Toxicity


def toxic_texts(count, seed):
    pick = random.Random(seed)
    words = ["".join(pick.choice("abdeilnorstu") for _ in range(pick.randint(2, 8))) for _ in range(400)]
    texts, labels = [], []
    for i in range(count):
        text = [pick.choice(words) for _ in range(pick.choice([5, 40, 200]))]
        if i % 4 == 0:
            text[pick.randrange(len(text))] = pick.choice(["zgrokel", "zgrokeln", "Zgrokelig", "quvash"])
        texts.append(" ".join(text))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_toxicity_on_held_out_texts():
    texts, labels = toxic_texts(800, 3)
    model = toxicity.Model(texts[:600], labels[:600])
    scores = model.scores([*texts[600:], "", "zgrokelung"])
    predicted = scores >= 0.5
    assert (predicted[:200] == (np.array(labels[600:]) == 1)).mean() > 0.95
    assert ((scores >= 0) & (scores <= 1)).all() and scores[200] < 0.5
    long = " ".join(t for t, x in zip(texts, labels, strict=True) if not x)
    assert model.scores([long])[0] < 0.5 <= model.scores([long + " quvash zgrokel"])[0]


def test_toxicity_learns_nothing_from_held_out_rows_and_survives_odd_rows(spark, documents):
    docs = documents((1, None, "s"), (None, "x", "s"), (2, "", "s"), (2, "", "s"))
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.train_toxicity(docs, none)
    scored = toxicity.score_toxicity(docs.withColumn("score", F.lit("clash")), model)
    assert [r.score for r in scored.collect()] == [0.0] * 4
    held = [i for i in range(60) if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    labels = spark.createDataFrame([(i, 1) for i in held] + [(None, 1), (1, None)], "doc_id bigint, toxic int")
    assert toxicity.train_toxicity(documents(*[(i, "bad", "s") for i in held], (1, "x", "s")), labels).constant == 0.0


def test_gradients_against_differences():
    from tallyline.llm.recurrent import gradients, initial, logits

    random_ = np.random.default_rng(0)
    weights = {k: w.astype(np.float64) for k, w in initial(3, 2, 2).items()}
    rows = np.vstack([random_.standard_normal((5, 3)), np.zeros((1, 3))])
    index, lengths = np.array([[0, 1, 2, 3], [4, 1, 5, 5]]), np.array([4, 2])
    out, kept = logits(weights, rows, index, lengths, keep=True)
    slopes, d_rows = gradients(weights, rows, index, kept, np.array([1.0, -2.0]))

    def value():
        return logits(weights, rows, index, lengths) @ np.array([1.0, -2.0])

    for name, slope in slopes.items():
        at = tuple(0 for _ in weights[name].shape)
        weights[name][at] += 1e-3
        up = value()
        weights[name][at] -= 2e-3
        assert abs((up - value()) / 2e-3 - slope[at]) < 2e-2
        weights[name][at] += 1e-3


# The pipeline


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "minhash_dedup", "mix_sources", "sentencepiece"]
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns
    digests = corpus_pipeline.STAGES[4][1](spark, docs, SMALL)
    assert digests.count() == docs.count() and set(digests.columns) >= {"doc_id", "n_tokens", "ids_sha256"}


def test_pipeline_runs_whole(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.count() > 100 and found.where("n_tokens < 2").count() == 0


def plain_lines(docs, min_sites, min_words):
    """Documents (id, text, source) without the shared lines, counted in a dictionary."""
    sites, first = {}, {}
    for i, text, source in sorted(docs):
        for n, line in enumerate(text.split("\n")):
            plain = line.strip(" \t\r")
            if plain and len(re.split("[ \t\r]+", plain)) >= min_words:
                sites.setdefault(plain, set()).add(source)
                first.setdefault(plain, (i, n))
    out = []
    for i, text, source in docs:
        rows = [(n, line, line.strip(" \t\r")) for n, line in enumerate(text.split("\n"))]
        kept = [line for n, line, plain in rows if len(sites.get(plain, ())) < min_sites or first[plain] == (i, n)]
        out.append((i, "\n".join(kept), source))
    return out


def test_pipeline_against_a_plain_version(spark, documents, tmp_path):
    pick = random.Random(8)
    vocabulary = ["".join(pick.choice("abdeilnorstu") for _ in range(pick.randint(3, 8))) for _ in range(900)]
    passage = " ".join(pick.choices(vocabulary, k=45))
    entries = []
    for i in range(160):
        own = [" ".join(pick.choices(vocabulary, k=pick.choice([12, 45]))) for _ in range(4)]
        own += ["Share this page  "] * (i % 2) + [passage] * (i % 23 == 0) + ["zgrokel quvash " * 3] * (i % 5 == 0)
        entries.append((i, "\n".join(own), f"src{i % 14}"))
    for i in range(160, 200):  # near copies of earlier documents, on other sources
        words = entries[i - 153][1].split(" ")
        words[pick.randrange(len(words))] += "x"
        entries.append((i, " ".join(words), f"src{i % 11}"))
    documents(*entries).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int("zgrokel" in text)) for i, text, _ in entries]
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    model = toxicity.train_toxicity(table(spark, tmp_path, "documents"), table(spark, tmp_path, "labels"))
    scores = model.scores([text for _, text, _ in entries])
    clean = [e for e, score in zip(entries, scores, strict=True) if score < TOXIC]
    lined = plain_lines(clean, MIN_SITES, 1)
    alone = {i for i, _, _, kept in brute_force([(i, text) for i, text, _ in lined], 5, 80) if kept}
    kept = [d for d in lined if d[0] in alone]
    docs = plain_lines(kept, PASSAGE_SITES, PASSAGE_WORDS)
    # Every stage has something to do.
    assert 100 < len(clean) < 180 and sum(a != b for a, b in zip(clean, lined, strict=True)) > 40
    assert len(clean) - len(kept) > 10 and sum(a != b for a, b in zip(kept, docs, strict=True)) >= 3

    frame = pd.DataFrame([(i, text, "en", source, len(text)) for i, text, source in docs], columns=["doc_id", "text", "lang", "source", "n_chars"])
    con = duckdb.connect()
    con.register("documents", frame)
    mixed = con.execute(f"SELECT doc_id, text, source FROM ({mixing.mix_sql(MIX_WEIGHTS)})").fetchall()
    library = pieces.model_of(open(PIECE_MODEL, "rb").read()).library

    def digests(text):
        ids = library.encode(text, add_bos=True, add_eos=True)
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()

    expected = sorted((i, source, *digests(text)) for i, text, source in mixed)
    found = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, found.collect())) == expected
