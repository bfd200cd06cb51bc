"""License scans: ordered signature rules over the words of a text, in DataFrame functions alone.

A text becomes one string in which every word stands between two spaces of its own. A document that
holds no word that begins with one of the keywords is done; else the rules whose keyword it holds are applied as regular
expressions, and each match is an interval of words. Rules have a tier (1 is surest). A detection
whose interval lies within that of another is suppressed if the other's tier is better, or equal and
its interval longer (or the same and its rule earlier). Everything happens within the row: nothing
is shuffled, and a document's detections never meet another's.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from tallyline.llm.common import whole_text

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TIER_SCORES = (1.0, 0.9, 0.7, 0.5)

# Phrases whose places are always reported, each with its label and keyword.
BASE_PHRASES = [("cc-by", "cc", "cc by"), ("gpl", "general", "general public license"), ("reserved", "reserved", "all rights reserved")]

# Names of licenses as patterns over words: label, keyword, pattern of the name, versions. Whatever a
# pattern matches holds a word that begins with the keyword.
NAMED = [
    ("apache", "apache", "apache (software )?licen[sc]e", ["1.0", "1.1", "2.0"]),
    ("gpl", "public", "gnu general public licen[sc]e", ["1.0", "2.0", "3.0"]),
    ("lgpl", "public", "gnu (lesser|library) general public licen[sc]e", ["2.0", "2.1", "3.0"]),
    ("agpl", "public", "(gnu )?affero general public licen[sc]e", ["1.0", "3.0"]),
    ("gfdl", "documentation", "gnu free documentation licen[sc]e", ["1.1", "1.2", "1.3"]),
    ("mpl", "mozilla", "mozilla public licen[sc]e", ["1.0", "1.1", "2.0"]),
    ("epl", "eclipse", "eclipse public licen[sc]e", ["1.0", "2.0"]),
    ("cpl", "common", "common public licen[sc]e", ["1.0"]),
    ("cddl", "common", "common development and distribution licen[sc]e", ["1.0", "1.1"]),
    ("eupl", "european", "european union public licen[sc]e", ["1.0", "1.1", "1.2"]),
    ("artistic", "artistic", "(perl )?artistic licen[sc]e", ["1.0", "2.0"]),
    ("osl", "open", "open software licen[sc]e", ["1.0", "2.0", "2.1", "3.0"]),
    ("afl", "academic", "academic free licen[sc]e", ["1.1", "1.2", "2.0", "2.1", "3.0"]),
    ("apsl", "apple", "apple public source licen[sc]e", ["1.0", "1.1", "1.2", "2.0"]),
    ("python", "python", "python software foundation licen[sc]e", ["2.0"]),
    ("python", "psf", "psf licen[sc]e", ["2.0"]),
    ("php", "php", "php licen[sc]e", ["3.0", "3.01"]),
    ("bsl", "boost", "boost software licen[sc]e", ["1.0"]),
    ("ofl", "open", "sil open font licen[sc]e", ["1.0", "1.1"]),
    ("odbl", "open", "open (database|data commons open database) licen[sc]e", ["1.0"]),
    ("ogl", "government", "open government licen[sc]e", ["1.0", "2.0", "3.0"]),
    ("zpl", "zope", "zope public licen[sc]e", ["1.1", "2.0", "2.1"]),
    ("lppl", "latex", "latex project public licen[sc]e", ["1.0", "1.1", "1.2", "1.3"]),
    ("mspl", "microsoft", "microsoft public licen[sc]e", []),
    ("mit", "mit", "mit licen[sc]e", []),
    ("isc", "isc", "isc licen[sc]e", []),
    ("zlib", "zlib", "zlib( libpng)? licen[sc]e", []),
    ("wtfpl", "public", "do what the fuck you want to public licen[sc]e", []),
    ("beerware", "beer", "beer ?ware licen[sc]e", []),
    ("unlicense", "unlicense", "(the )?unlicense", []),
    ("bsd-2-clause", "bsd", "(bsd 2 clause|2 clause bsd|simplified bsd)( licen[sc]e)?", []),
    ("bsd-2-clause", "freebsd", "freebsd( licen[sc]e)?", []),
    ("bsd-3-clause", "bsd", "(bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)( licen[sc]e)?", []),
    ("bsd-4-clause", "bsd", "(bsd 4 clause|4 clause bsd|original bsd)( licen[sc]e)?", []),
    ("bsd", "bsd", "bsd( style)? licen[sc]e", []),
]
SHORT_NAMES = ["apache", "gpl", "lgpl", "agpl", "gfdl", "mpl", "epl", "cpl", "cddl", "eupl", "osl", "afl", "apsl", "ofl", "odbl", "lppl"]
ELEMENTS = ["by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"]
ELEMENT_NAMES = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "(no derivs|no derivatives|noderivs|noderivatives|no derivative works)"}
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
# Sentences that stand for a license or for the lack of one.
SENTENCES = [
    ("mit", "charge", "permission is hereby granted free of charge to any person obtaining a copy", 2),
    ("isc", "fee", "permission to use copy modify and or distribute this software for any purpose with or without fee", 2),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification", 2),
    ("cc0-1.0", "cc0", "cc0( 1 0)?( universal)?", 2),
    ("public-domain", "domain", "(released|placed|dedicated|is) (in|into|to) the public domain", 2),
    ("public-domain", "domain", "public domain", 4),
    ("reserved", "reproduced", "no part of this (publication|work|book|document) may be reproduced", 2),
    ("reserved", "rights", "copyright( c)? [0-9]+ .{0,60} all rights reserved", 3),
    ("proprietary", "proprietary", "proprietary and confidential", 3),
    ("copyright", "copyright", "copyright( c)? [0-9]{4}", 4),
    ("license", "license", "licensed under( the)?( terms of)?", 4),
    ("gpl", "gpl", "gpl", 4),
]


def _version(version: str) -> str:
    """The words of a version; a trailing zero may be left out."""
    whole, _, part = version.partition(".")
    return f"v?{whole}( 0)?" if part == "0" else f"v?{whole} {part}"


def _rules() -> list[tuple]:
    """Label, keyword, pattern, tier of every rule, base phrases last."""
    out = []
    for label, keyword, name, versions in NAMED:
        out += [(f"{label}-{v}", keyword, f"{name}( version)? {_version(v)}", 2) for v in versions]
        out.append((label, keyword, name, 3))
        out += [(f"{label}-{v}", "spdx", f"spdx licen[sc]e identifier {label} {_version(v)}( only| or later)?", 1) for v in versions]
        if not versions:
            out.append((label, "spdx", f"spdx licen[sc]e identifier {label.replace('-', ' ')}", 1))
    versions = {label: vs for label, _, _, vs in NAMED}
    for label in SHORT_NAMES:
        out += [(f"{label}-{v}", label, f"{label}( version)? {_version(v)}", 3) for v in versions[label]]
    for element, version in product(ELEMENTS, ["", *CC_VERSIONS]):
        words = element.replace("-", " ")
        label = f"cc-{element}" + f"-{version}" * bool(version)
        upto = f" {_version(version)}" if version else ""
        long = " ".join(ELEMENT_NAMES[e] for e in element.split("-"))
        tier = 2 if version else 3
        out += [
            (label, "cc", f"cc {words}{upto}", tier),
            (label, "creative", f"creative commons {long}{upto}", tier),
            (label, "creativecommons", f"creativecommons org licen[sc]es {words}{upto}", 1 if version else 2),
            (label, "spdx", f"spdx licen[sc]e identifier cc {words}{upto}", 1),
        ]
    return list(dict.fromkeys(out)) + SENTENCES  # names of one label share their identifiers


def compiled(pattern: str) -> str:
    """A pattern over words, as a pattern over the string of words.

    Spaces separate words; groups hold their own spaces, as in ``(the )?gnu``. ``x ?y`` is one word
    or two.
    """
    pattern = re.sub(r"(\S+) \?(\S+)", r"(\1 \2|\1\2)", pattern)
    out = []
    for token in re.split(r"(\.\{0,60\}|[()|]+\??|\s+)", pattern):
        if not token or token.isspace():
            continue
        out.append(token if token[0] in "()|" else token + "?" if token[0] == "." else f" {token} ")
    return "".join(out)


RULES = [
    *[(label, keyword, compiled(pattern), tier, False) for label, keyword, pattern, tier in _rules()],
    *[(label, keyword, compiled(phrase), 4, True) for label, keyword, phrase in BASE_PHRASES],
]
KEYWORDS = sorted({rule[1] for rule in RULES})
RULE_TYPE = "array<struct<label:string,keyword:string,pattern:string,tier:int,base:boolean,number:int>>"


def word_string(text: Column) -> Column:
    """The words of a text, each between two spaces of its own; empty if there are none."""
    lowered = F.translate(whole_text(text), UPPER, LOWER)
    spaced = F.regexp_replace(F.concat(F.lit(" "), lowered, F.lit(" ")), BETWEEN_WORDS, "  ")
    return F.substring(spaced, F.lit(2), F.length(spaced) - 2)


def _words(spaced: Column) -> Column:
    """How many words stand in a stretch of a word string."""
    return ((F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))) / 2).cast("bigint")


BLOCK = 128


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(values: Column, fold: Callable[[Column], Column], join: Callable[[Column, Column], Column]) -> Column:
    """For each place of an array, ``fold`` of all values before it.

    An array can't grow step by step without being copied each time. So blocks are folded first, then what
    stands before each block, then what stands before each place in its block: ``BLOCK`` steps a place.
    """
    blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))

    def in_block(folds: Column, b: Column) -> Column:
        places = F.sequence(F.lit(0), F.least(F.lit(BLOCK), F.size(values) - b * BLOCK) - 1)
        return _let(
            fold(F.slice(folds, F.lit(1), b)),
            lambda base: F.transform(places, lambda j: join(base, fold(F.slice(values, b * BLOCK + 1, j)))),
        )

    folded = F.transform(blocks, lambda b: fold(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))))
    return _let(folded, lambda folds: F.flatten(F.transform(blocks, lambda b: in_block(folds, b))))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda total, v: total + v)


def _furthest(values: Column) -> Column:
    return F.coalesce(F.array_max(values), F.lit(-1).cast("bigint"))


def _matches(words: Column, rule: Column) -> Column:
    """Intervals of words that a rule matches, in order: every second part of the marked words."""
    marked = F.regexp_replace(words, rule["pattern"], F.lit("\x01$0\x02"))

    def intervals(sizes: Column, starts: Column) -> Column:
        def detection(i: Column) -> Column:
            first = F.get(starts, i)
            return F.struct(
                first.alias("first"), (-(first + F.get(sizes, i))).alias("minus_end"), rule["tier"].alias("tier"),
                rule["number"].alias("number"), rule["label"].alias("label"), rule["base"].alias("base"),
            )

        return F.transform(F.sequence(F.lit(1), F.size(sizes) - 2, F.lit(2)), detection)

    def found(parts: Column) -> Column:
        some = _let(
            F.transform(parts, _words), lambda sizes: _let(_before(sizes, _sum, lambda a, b: a + b), lambda starts: intervals(sizes, starts))
        )
        return F.when(F.size(parts) > 1, some).otherwise(F.array().cast(DETECTION_TYPE))

    return _let(F.split(marked, "[\x01\x02]"), found)


def _kept(detections: Column) -> Column:
    """Detections, sorted by start and falling end, that no earlier one of the same or a better tier reaches beyond."""

    def of_tier(tier: int) -> Column:
        """How far the detections of a tier or better reach that stand before each place."""
        ends = F.transform(detections, lambda d: F.when(d["tier"] <= tier, -d["minus_end"]).otherwise(F.lit(-1).cast("bigint")))
        return _let(ends, lambda e: _before(e, _furthest, lambda a, b: F.greatest(a, b)))

    reaches = F.array(*[of_tier(tier) for tier in range(1, len(TIER_SCORES) + 1)])
    return _let(
        reaches, lambda reach: F.filter(detections, lambda d, i: F.get(F.get(reach, d["tier"] - 1), i) < -d["minus_end"])
    )


def scan_licenses(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds to every row: ``n_words``; ``found``, the detections that stand (label, tier, first word,
    word after the last); ``base_labels``, ``n_base``, ``first_word``, ``last_word`` of the base phrases'
    places, suppressed or not; ``labels`` (base and standing, distinct, sorted, comma-joined) and
    ``score``, that of the best tier, 0 without a detection.

    Null and empty texts have no words and no detections. Rows are independent; input columns of the
    names above are replaced. The detections of a text are an array of its row; their cost grows with their
    number, not its square.
    """
    rules = [dict(zip(("label", "keyword", "pattern", "tier", "base", "number"), (*r, i), strict=True)) for i, r in enumerate(RULES)]
    all_rules = F.from_json(F.lit(json.dumps(rules)), RULE_TYPE)
    words = F.col("__words")
    held = [F.when(words.contains(f" {k}"), F.lit(k)) for k in KEYWORDS]
    gated = F.filter(all_rules, lambda r: F.array_contains("__keywords", r["keyword"]))
    detections = F.when(F.size("__keywords") > 0, F.array_sort(F.flatten(F.transform(gated, lambda r: _matches(words, r)))))
    base = F.filter("__all", lambda d: d["base"])
    base_labels = F.array_distinct(F.transform("__base", lambda d: d["label"]))
    labels = F.array_sort(F.array_union(base_labels, F.transform("__kept", lambda d: d["label"])))
    tier_scores = F.array(*map(F.lit, TIER_SCORES))
    score = F.coalesce(F.array_max(F.transform("__kept", lambda d: F.get(tier_scores, d["tier"] - 1))), F.lit(0.0))
    return (
        df.withColumn("__words", word_string(F.col(text)))
        .withColumn("n_words", _words(words))
        .withColumn("__keywords", F.array_compact(F.array(*held)))
        .withColumn("__all", detections)
        .withColumn("__kept", F.when(F.size("__all") > 0, _kept(F.col("__all"))))
        .withColumn("__base", F.when(F.size("__all") > 0, base))
        .withColumn("n_base", F.greatest(F.size("__base"), F.lit(0)).cast("bigint"))
        .withColumn("first_word", F.array_min(F.transform("__base", lambda d: d["first"])))
        .withColumn("last_word", F.array_max(F.transform("__base", lambda d: d["first"])))
        .withColumn("base_labels", F.coalesce(F.array_join(F.array_sort(base_labels), ","), F.lit("")))
        .withColumn("labels", F.coalesce(F.array_join(labels, ","), F.lit("")))
        .withColumn("score", score)
        .withColumn("found", F.coalesce(F.transform("__kept", _standing), F.array().cast(FOUND_TYPE)))
        .drop("__words", "__keywords", "__all", "__kept", "__base")
    )


DETECTION_TYPE = "array<struct<first:bigint,minus_end:bigint,tier:int,number:int,label:string,base:boolean>>"
FOUND_TYPE = "array<struct<label:string,tier:int,first:bigint,end:bigint>>"


def _standing(d: Column) -> Column:
    return F.struct(d["label"].alias("label"), d["tier"].alias("tier"), d["first"].alias("first"), (-d["minus_end"]).alias("end"))


LICENSE_SQL = r"""
WITH rules(label, keyword, pattern, tier, base, number) AS (VALUES {rules}),
spaced AS (
    SELECT doc_id, regexp_replace(' ' || translate(coalesce(text, ''), '{upper}', '{lower}') || ' ', '{between}', '  ', 'g') AS s FROM documents
), worded AS (SELECT doc_id, substr(s, 2, length(s) - 2) AS words FROM spaced),
marked AS (
    SELECT doc_id, label, tier, base, number,
           string_split(replace(regexp_replace(words, '(?s:(' || pattern || '))', chr(1) || '\1' || chr(2), 'g'), chr(2), chr(1)), chr(1)) AS parts
    FROM worded JOIN rules ON contains(words, ' ' || keyword) AND regexp_matches(words, pattern)
), parts AS (
    SELECT * EXCLUDE (parts), unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM marked
), counted AS (
    SELECT *, (length(part) - length(replace(part, ' ', ''))) // 2 AS n FROM parts
), placed AS (
    SELECT *, sum(n) OVER (PARTITION BY doc_id, number ORDER BY i) AS upto FROM counted
), detected AS (SELECT doc_id, label, tier, base, number, upto - n AS first, upto AS last FROM placed WHERE i % 2 = 0),
reached AS (
    SELECT *, coalesce(greatest({reaches}), -1) AS reach FROM detected
    WINDOW earlier AS (PARTITION BY doc_id ORDER BY first, last DESC, tier, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), bases AS (
    SELECT doc_id, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM detected WHERE base GROUP BY doc_id
), all_labels AS (
    SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, min(tier) FILTER (reach < last) AS best
    FROM reached WHERE base OR reach < last GROUP BY doc_id
)
SELECT doc_id, ((length(words) - length(replace(words, ' ', ''))) // 2)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce([{scores}][best], 0.0)::DOUBLE AS score
FROM worded LEFT JOIN bases USING (doc_id) LEFT JOIN all_labels USING (doc_id)
"""


def license_sql() -> str:
    rules = ", ".join(f"('{label}', '{key}', '{pattern}', {tier}, {base}, {i})" for i, (label, key, pattern, tier, base) in enumerate(RULES))
    tiers = range(1, len(TIER_SCORES) + 1)
    reaches = ", ".join(f"CASE WHEN tier >= {t} THEN max(CASE WHEN tier = {t} THEN last END) OVER earlier END" for t in tiers)
    return LICENSE_SQL.format(
        rules=rules, upper=UPPER, lower=LOWER, between=BETWEEN_WORDS, reaches=reaches, scores=", ".join(map(str, TIER_SCORES))
    )
