"""Operators on single texts: pages, licenses, pieces, token files."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from tallyline.llm import licenses, pages, pieces, token_files
from tallyline.llm.settings import PIECE_MODEL, WORD_TOKENIZER

ODD_TEXTS = [None, "", " ", "  two  spaces ", "a\nb\tc", "é日本😀", "x" * 1500, "ab " * 3000, " " * 900, "▁▁x", "<s></s>", "Don't 42!", "\x00\x1c"]


# Pages


def test_page_keeps_the_article_alone():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><p>Site name and its motto</header>
    <nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div class="ad">Buy this now, it is cheap and good.</div>
    <article><h1>Head &amp; line</h1><p>First  paragraph of the
    article.<p>Short.<script>var x = "</p>";</script><aside>Not this one, it stands aside of the text.</aside>
    <p>a &lt;b&gt; <a href=/c>link</a></article><section id="comments"><p>A reader says something quite long here.</section>
    <form><p>Name</form><footer>&copy; 2024</footer></body></html>"""
    assert pages.main_texts([page]) == ["Head & line\nFirst paragraph of the article.\nShort.\na <b> link"]


def test_pages_without_an_article_element_go_by_words_and_links():
    long = "word " * 40
    page = f"<body><div><a>Home</a></div><div><a>News</a></div><div><h2>Title</h2><p>{long}</p><p>Brief.</p><p>{long}</p></div></body>"
    assert pages.main_texts([page])[0].split("\n") == ["Title", long.strip(), "Brief.", long.strip()]


def test_broken_pages_do_not_stop_the_reader():
    odd = ["", "<", "<p", "<!--", "<script>", "<article><p>x", "a < b", "</div></p>", "<a <b <c", '<p class="x>y', "&#xZZ;&bogus;"]
    found = pages.main_texts(odd)
    assert len(found) == len(odd) and found[5] == "x"


def test_pages_as_rows_with_nulls_and_a_clashing_column(spark):
    rows = [(1, None, "old"), (2, "", None), (3, "<article><p>é x</p></article>", "old"), (3, "<article><p>é x</p></article>", "old")]
    found = pages.extract_text(spark.createDataFrame(rows, "page_id int, html string, text string"))
    assert sorted((r.page_id, r.text, r.n_chars) for r in found.collect()) == [(1, "", 0), (2, "", 0), (3, "é x", 3), (3, "é x", 3)]
    assert pages.extract_text(spark.createDataFrame([], "html string")).count() == 0


# Licenses


def scanned(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return {r.i: r for r in licenses.scan_licenses(df).collect()}


def test_license_rules_by_tier_and_containment(spark):
    found = scanned(
        spark,
        "Licensed under the Apache License, Version 2.0.",
        "x Licensed under CC BY-NC 4.0, all rights reserved; CC-BY",
        "SPDX-License-Identifier: GPL-3.0-only",
        "GNU General Public License version 3, general public license",
        None,
        "",
        "nothing of the kind",
    )
    assert found[0].labels == "apache-2.0,license" and found[0].n_base == 0 and found[0].base_labels == ""
    assert found[1].labels == "cc-by,cc-by-nc-4.0,license,reserved"
    assert (found[1].n_base, found[1].first_word, found[1].last_word) == (3, 3, 11)
    assert found[1].base_labels == "cc-by,reserved"
    assert found[2].labels == "gpl-3.0" and found[2].score == 1.0
    assert found[3].labels.split(",")[0] == "gpl" and "gpl-3.0" in found[3].labels and found[3].n_base == 2
    for i in (4, 5):
        assert (found[i].n_words, found[i].n_base, found[i].first_word, found[i].labels, found[i].score) == (0, 0, None, "", 0.0)
    assert found[6].n_words == 4 and found[6].found == []


def samples(parsed, whole=True):
    """Strings that a parsed pattern matches: every alternative, with optional parts and (if ``whole``) without."""
    out = [""]
    for kind, value in parsed:
        kind = str(kind)
        if kind == "LITERAL":
            own = [chr(value)]
        elif kind == "IN":
            own = [chr(v if str(k) == "LITERAL" else v[0]) for k, v in value][: 2 if whole else 1]
        elif kind == "BRANCH":
            own = [x for branch in value[1] for x in samples(branch, whole)]
        elif kind == "SUBPATTERN":
            own = samples(value[3], whole)
        else:
            assert kind in ("MAX_REPEAT", "MIN_REPEAT")
            least, most, inner = value
            once = [] if str(inner[0][0]) == "ANY" else samples(inner, whole)
            own = [x * least for x in once] if least else ["", *(once if whole else [])]
        out = [a + b for a in out for b in own]
    return out


def test_every_alternative_of_every_license_rule_holds_its_keyword():
    lost = [(label, text) for label, keyword, pattern, *_ in licenses.RULES
            for text in samples(re._parser.parse(pattern)) if f" {keyword}" not in text]
    assert lost == []


def test_every_alternative_of_every_license_rule_is_found(spark):
    patterns = [(tier, number, label, re.compile(pattern)) for number, (label, _, pattern, tier, _) in enumerate(licenses.RULES)]
    texts = sorted({text for rule in licenses.RULES for text in samples(re._parser.parse(rule[2]), whole=False)})
    found = scanned(spark, *(" ".join(text.split()) for text in texts))
    for i, text in enumerate(texts):
        own = [(tier, number, label) for tier, number, label, p in patterns if (m := p.search(text)) and m.span() == (0, len(text))]
        best = min(own)
        assert (found[i].found[0].label, found[i].found[0].tier, found[i].found[0].end) == (best[2], best[0], len(text.split())), text


def test_license_phrases_without_the_usual_keywords(spark):
    found = scanned(spark, "Under the FreeBSD License.", "PSF License 2.0", "No part of this publication may be reproduced.")
    assert [found[i].labels for i in range(3)] == ["bsd-2-clause", "python-2.0", "reserved"]
    assert [found[i].score for i in range(3)] == [0.7, 0.9, 0.9]


def test_many_detections_in_one_text_and_clashing_columns(spark):
    df = spark.createDataFrame([("CC BY " * 3000, 7)], "text string, score int")
    row = licenses.scan_licenses(df).first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (6000, 3000, 0, 5998)
    assert len(row.found) == 3000


def test_license_plan_has_no_python(spark):
    df = licenses.scan_licenses(spark.createDataFrame([("x",)], "text string"))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


# Pieces


def test_pieces_equal_the_library_on_odd_texts(spark):
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(ODD_TEXTS)], "i int, text string, ids string")
    rows = pieces.decode_pieces(pieces.encode_pieces(df, PIECE_MODEL), PIECE_MODEL).collect()
    library = pieces.model_of(open(PIECE_MODEL, "rb").read()).library
    for r in rows:
        ids = library.encode(ODD_TEXTS[r.i] or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded == library.decode(ids)
    digests = {r.i: r for r in pieces.digest_pieces(df, PIECE_MODEL).collect()}
    for r in rows:
        assert digests[r.i].ids_sha256 == hashlib.sha256(r.ids).hexdigest() and digests[r.i].n_tokens == len(r.ids) // 4
    assert pieces.digest_pieces(df.limit(0), PIECE_MODEL).count() == 0


def test_pieces_equal_the_library_on_random_texts():
    model = pieces.model_of(open(PIECE_MODEL, "rb").read())
    pick = random.Random(5)
    parts = [" ", "  ", "a", "aa", "the", "ing", "\n", "▁", "é", "日", "😀", "=", "--", "er", "'", "\x00", "<0x0A>"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.choice([1, 4, 40]))) for _ in range(3000)]
    expected = model.library.encode(texts, add_bos=True, add_eos=True)
    assert [np.frombuffer(row, "<u4").tolist() for row in model.encode(texts)] == expected


def test_the_table_of_known_words_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_WORDS", 50)
    model = pieces.PieceModel(open(PIECE_MODEL, "rb").read())
    for start in range(0, 400, 40):
        texts = [f"word{i} thing{i}" for i in range(start, start + 40)]
        assert [np.frombuffer(r, "<u4").tolist() for r in model.encode(texts)] == model.library.encode(texts, add_bos=True, add_eos=True)
        assert len(model.known) <= 50 + 80


# Token files


def test_token_ids_equal_the_library_on_odd_texts():
    encoder = token_files.IdEncoder(open(WORD_TOKENIZER, "rb").read())
    pick = random.Random(6)
    parts = [" ", "a", "'s", "'S", "don't", "É", "ß", "Σ", "ς", "12", "½", "\n", "\x1c", "日本", "😀", "́", "--", "İ", "<|endoftext|>", "​", "—", "K"]
    texts = [t or "" for t in ODD_TEXTS] + ["".join(pick.choice(parts) for _ in range(pick.choice([1, 4, 20]))) for _ in range(3000)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.library.encode(text, add_special_tokens=False).ids


def test_token_files_round_trip_in_order(spark, tmp_path):
    entries = [(i * 7 % 100, f"text {i} " * (i % 5)) for i in range(100)] + [(None, "no id"), (5, None), (5, "again"), (5, "again")]
    df = spark.createDataFrame(entries, "doc_id bigint, text string").withColumn("frames", F.lit("clash"))
    token_files.write_token_files(df, WORD_TOKENIZER, str(tmp_path), 2, partitions=3)
    found = sorted(token_files.read_token_files(spark, str(tmp_path)).collect(), key=lambda r: r.start)
    assert len(found) == len(entries)
    keys = [-1 if r.doc_id is None else r.doc_id for r in found]
    assert keys == sorted(keys)
    library = token_files.IdEncoder(open(WORD_TOKENIZER, "rb").read()).library
    expected = {}
    for i, text in entries:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        expected.setdefault(i, []).append(zlib.crc32(np.array(ids, "<u4").tobytes()))
    at = 0
    for r in found:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        expected[r.doc_id].remove(zlib.crc32(r.ids))
        at += r.n_tokens
    assert not any(expected.values())


def test_token_files_of_an_empty_table(spark, tmp_path):
    token_files.write_token_files(spark.createDataFrame([], "doc_id bigint, text string"), WORD_TOKENIZER, str(tmp_path), 2)
    assert token_files.read_token_files(spark, str(tmp_path)).count() == 0


def test_a_block_that_needs_another_dictionary_fails(spark, tmp_path):
    df = spark.createDataFrame([(1, "one")], "doc_id bigint, text string")
    token_files.write_token_files(df, WORD_TOKENIZER, str(tmp_path), 2)
    other = spark.createDataFrame([("0" * 64, bytearray(b""))], "dictionary_sha256 string, dictionary binary")
    other.write.mode("overwrite").parquet(f"{tmp_path}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read_token_files(spark, str(tmp_path)).collect()


def test_tokenizer_files_are_not_copied():
    assert PIECE_MODEL == public_tokenizers.path("piece_bpe_32k.model")


def test_the_fitted_tree_keeps_all_of_an_article_and_nothing_outside():
    words, links = [0, 1, 3, 9, 60, 300], [0, 0.5, 0.9, 1]
    cells = [
        (1, 0, h, i, a, b, c, x, y, z)
        for h in (0, 1) for i in (0, 1) for a in words for b in words[1:] for c in words for x in links for y in links for z in links
    ]
    grid = np.array(cells, float)
    assert pages.fitted_tree().predict(grid).all()
    grid[:, 1] = 1
    assert not pages.fitted_tree().predict(grid).any()
