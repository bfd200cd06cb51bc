"""Time over the number of lines and detections of one text: in proportion, not squared."""

from __future__ import annotations

import time

from tallyline.llm.licenses import scan_licenses
from tallyline.llm.lines import remove_shared_lines


def seconds(run):
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def assert_in_proportion(run):
    """Eight times the input takes less than four times as long, apart from what any run takes."""
    run(500)
    few, many = seconds(lambda: run(10_000)), seconds(lambda: run(80_000))
    assert many < 4 * few + 4, (few, many)


def test_lines_of_one_text(spark):
    def run(count):
        body = "\n".join(f"line {i}" for i in range(count))
        texts = [(1, body + "\nshared", "a"), (2, "shared", "b"), (3, "own\nshared\n" + body, "c")]
        found = remove_shared_lines(spark.createDataFrame(texts, "doc_id int, text string, source string"), 2)
        assert {(r.doc_id, r.n_removed, r.text if r.doc_id > 1 else len(r.text)) for r in found.collect()} == {
            (1, 0, len(body) + 7), (2, 1, ""), (3, count + 1, "own"),
        }

    assert_in_proportion(run)


def test_detections_of_one_text(spark):
    def run(count):
        df = spark.createDataFrame([("gpl x " * count + "general public license",)], "text string")
        row = scan_licenses(df).selectExpr("n_words", "size(found) AS n", "found[0] AS a", "element_at(found, -1) AS z", "n_base", "first_word").first()
        assert (row.n_words, row.n, row.n_base, row.first_word) == (2 * count + 3, count + 1, 1, 2 * count)
        assert (row.a.first, row.a.end, row.z.first, row.z.end) == (0, 1, 2 * count, 2 * count + 3)

    assert_in_proportion(run)
