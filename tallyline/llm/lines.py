"""Removal of lines that many sites share.

The spread of a line is the number of distinct sites whose documents hold it. One HyperLogLog sketch
per line hash is merged by a combining aggregation, so that a line in a third of all rows reaches its
reducer as one sketch per task. Lines whose estimate lies near the threshold get an exact distinct
count; the decision is therefore exact as far as the sketches' error stays within ``MARGIN`` (five
standard errors). Of each line that reaches the threshold one place stays, the one with the smallest
id and line number, so that no content leaves the corpus altogether.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyline.llm.common import row_key, stored, whole_text

SKETCH_BITS = 12
MARGIN = 5 * 1.04 / 2 ** (SKETCH_BITS / 2)
BLANK = " \t\r"


def _lines_of(text: str) -> Column:
    return F.split(whole_text(text), "\n")


def line_places(docs: DataFrame, site: str, doc_id: str, text: str, min_words: int = 1) -> DataFrame:
    """One row per line of at least ``min_words`` words: two hashes of the trimmed line, its document, its number."""
    rows = docs.select(  # what is the same for all lines of a text is computed before there are lines
        F.col(doc_id).alias("doc"),
        row_key(doc_id, text).alias("row_key"),
        F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("null")).alias("site"),
        _lines_of(text).alias("lines"),
    )
    lines = rows.select("doc", "row_key", "site", F.posexplode("lines").alias("line_no", "line"))
    line = F.btrim("line", F.lit(BLANK))
    hashes = F.xxhash64(line).alias("h1"), F.xxhash64(line, F.lit(1)).alias("h2")
    long = F.size(F.split(line, f"[{BLANK}]+")) >= min_words
    return lines.where((line != "") & long if min_words > 1 else line != "").select("doc", "row_key", "site", "line_no", *hashes)


def shared_lines(places: DataFrame, min_sites: int) -> DataFrame:
    """Hashes of the lines on at least ``min_sites`` sites, and the first place of each."""
    spread = places.groupBy("h1", "h2").agg(
        F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"), F.min(F.struct("doc", "line_no")).alias("first")
    )
    sites = F.hll_sketch_estimate("sketch")
    low, high = min_sites * (1 - MARGIN) - 1, min_sites * (1 + MARGIN) + 1
    spread = stored(spread.select("h1", "h2", "first", sites.alias("sites")).where(F.col("sites") >= low), "spread")
    near = spread.where(F.col("sites") <= high)
    exact = (
        places.select("h1", "h2", "site")
        .join(near.select("h1", "h2"), ["h1", "h2"], "left_semi")
        .distinct()
        .groupBy("h1", "h2")
        .count()
        .where(F.col("count") >= min_sites)
    )
    sure = spread.where(F.col("sites") > high).select("h1", "h2", "first")
    return sure.unionByName(near.join(exact, ["h1", "h2"], "left_semi").select("h1", "h2", "first"))


def remove_shared_lines(
    docs: DataFrame,
    min_sites: int,
    site: str = "source",
    doc_id: str = "doc_id",
    text: str = "text",
    removed: str = "n_removed",
    min_words: int = 1,
) -> DataFrame:
    """Every document with its text without the lines that at least ``min_sites`` sites share, and
    their number in the column ``removed`` (which replaces an input column of that name).

    Lines end at ``\\n`` and are compared without blanks at either end; blank lines and lines
    of fewer than ``min_words`` words (between blanks) are not looked at and stay. A null site is a site of its own; a null text stays null. Rows that agree in id and text
    lose the same lines; a document may lose all of its lines and stays with an empty text. Other
    columns are kept.
    """
    places = line_places(docs, site, doc_id, text, min_words)
    shared = stored(shared_lines(places, min_sites), "shared-lines")
    place = F.struct("doc", "line_no")
    hits = (
        places.join(shared, ["h1", "h2"])
        .where(~place.eqNullSafe(F.col("first")))
        .groupBy(F.col("row_key").alias("__hit_key"))
        .agg(F.collect_set("line_no").alias("__hit_lines"))
    )
    # The lines are an array of one element around them, so that they are split once and not per line that stays.
    kept = F.transform(
        F.array(_lines_of(text)),
        lambda lines: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__hit_lines")), lambda i: F.get(lines, i)
            ),
            "\n",
        ),
    )
    return (
        docs.drop(removed)
        .withColumn("__row_key", row_key(doc_id, text))
        .join(hits, F.col("__row_key") == F.col("__hit_key"), "left")
        .withColumn(text, F.when(F.col("__hit_lines").isNull(), F.col(text)).otherwise(F.get(kept, F.lit(0))))
        .withColumn(removed, F.coalesce(F.size("__hit_lines"), F.lit(0)).cast("bigint"))
        .drop("__row_key", "__hit_key", "__hit_lines")
    )


LINE_SQL = """
WITH lines AS (
    SELECT doc_id, source, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
    FROM documents
), named AS (SELECT *, trim(line, chr(32) || chr(9) || chr(13)) AS plain FROM lines),
shared AS (
    SELECT plain, min((doc_id, line_no)) AS first FROM named WHERE plain <> ''
    GROUP BY plain HAVING count(DISTINCT source) >= {min_sites}
), marked AS (
    SELECT n.*, s.plain IS NOT NULL AND (n.doc_id, n.line_no) <> s.first AS gone FROM named n LEFT JOIN shared s USING (plain)
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS text, count(*) FILTER (gone) AS n_removed
FROM marked GROUP BY doc_id
"""


def line_sql(min_sites: int) -> str:
    return LINE_SQL.format(min_sites=min_sites)
