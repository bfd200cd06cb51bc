"""Mixing sources to target weights by Poisson replication.

A source's share of the mix is its weight over the sum of weights. With ``epochs`` times the
corpus as the size of the mix, each of its documents is to be repeated ``rate`` times on average:
share x mix size / source size, sizes in characters (plus one for each document). A document's
count is the Poisson distribution of that mean, inverted at a number between 0 and 1 hashed from
the seed, the document's id and its text. Its copies are dealt over the whole mix by a second hash.

Nothing here depends on the order or the partitions of the input: a lost task gives the same copies
again. Sizes combine before their shuffle, and the copies' places are hashes, so that a source with
a third of all rows spreads over all partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyline.llm.common import row_key, stored

UNIT_DIGITS = 13  # hexadecimal digits of a hash that make a number between 0 and 1
PLACE_DIGITS = 15
RATE_PER_PART = 64  # exp(-rate) keeps its precision; larger rates are sums of several parts


def source_rates(
    docs: DataFrame, weights: dict[str, float], default_weight: float = 1.0, epochs: float = 1.0,
    source: str = "source", text: str = "text",
) -> DataFrame:
    """One row per source, a null source being one too: its rate, the number of parts the rate is
    split into, and the distribution function ``upto`` of one part from 0 on."""
    size = F.sum(F.coalesce(F.length(text), F.lit(0)) + F.lit(1).cast("bigint"))
    weight = F.lit(float(default_weight))
    for name, listed in weights.items():
        weight = F.when(F.col("source") == name, F.lit(float(listed))).otherwise(weight)
    sizes = docs.groupBy(F.col(source).alias("source")).agg(size.alias("size")).withColumn("weight", weight)
    sizes = stored(sizes, "sizes")
    total = sizes.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight"))
    share = F.col("weight") / total.select("weight").scalar()
    rate = share * (F.lit(float(epochs)) * total.select("size").scalar()) / F.col("size")
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / RATE_PER_PART)).cast("int")
    mean = F.col("rate") / F.col("parts")
    start = F.struct(F.exp(-mean).alias("term"), F.array(F.exp(-mean)).alias("upto"))

    def following(state: Column, k: Column) -> Column:
        term = state["term"] * mean / k
        upto = F.concat(state["upto"], F.array(F.element_at(state["upto"], -1) + term))
        return F.struct(term.alias("term"), upto.alias("upto"))

    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    upto = F.aggregate(F.sequence(F.lit(1), last), start, following)["upto"]
    rates = sizes.select("source", rate.alias("rate")).withColumn("parts", parts)
    return rates.select("source", "rate", "parts", upto.alias("upto"))


def _number(seed: int, use: str, key: Column, step: Column, digits: int) -> Column:
    hashed = F.md5(F.concat_ws("|", F.lit(f"{seed}-{use}"), key, step.cast("string")))
    return F.conv(F.substring(hashed, 1, digits), 16, 10).cast("bigint")


def mix_sources(
    docs: DataFrame, weights: dict[str, float] | None = None, default_weight: float = 1.0, epochs: float = 1.0,
    seed: int = 1, source: str = "source", doc_id: str = "doc_id", text: str = "text", partitions: int | None = None,
) -> DataFrame:
    """The mix: every document ``copies`` times (rows numbered by ``copy`` from 1, none at 0 copies),
    in the global order of ``place``.

    Sources without an entry in ``weights`` have ``default_weight``. Rows that agree in id, text and
    source get the same count. A null or empty text counts as size 1, a null source is a source of
    its own, an empty table gives an empty mix. Input columns named copy, copies or place are
    replaced; all others are kept.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.drop("copy", "copies", "place")
    rates = source_rates(docs, weights or {}, default_weight, epochs, source, text)
    rates = rates.select(*[F.col(c).alias(f"__mix_{c}") for c in rates.columns])
    key = row_key(doc_id, text)

    def drawn(part: Column) -> Column:
        unit = _number(seed, "count", key, part, UNIT_DIGITS) / F.lit(float(16**UNIT_DIGITS))
        return F.size(F.filter("__mix_upto", lambda upto: upto <= unit))

    parts = F.sequence(F.lit(1), F.col("__mix_parts"))
    copies = F.aggregate(parts, F.lit(0), lambda sum_, part: sum_ + drawn(part))
    mixed = (
        docs.join(rates, F.col(source).eqNullSafe(F.col("__mix_source")))
        .withColumn("copies", copies)
        .where("copies > 0")
        .drop(*rates.columns)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .withColumn("place", _number(seed, "place", key, F.col("copy"), PLACE_DIGITS))
    )
    slot = F.floor(F.col("place") / F.lit(float(16**PLACE_DIGITS)) * partitions).cast("int")
    return mixed.repartitionById(partitions, slot).sortWithinPartitions("place")


MIX_SQL = """
WITH RECURSIVE sizes AS (
    SELECT source, sum(coalesce(length(text), 0) + 1)::DOUBLE AS size, {weight} AS weight FROM documents GROUP BY source
), rates AS (
    SELECT source, rate, greatest(1, ceil(rate / 64))::INT AS parts
    FROM (SELECT source, weight / (SELECT sum(weight) FROM sizes) * ({epochs}::DOUBLE * (SELECT sum(size) FROM sizes)) / size AS rate FROM sizes)
), steps AS (
    SELECT source, parts, rate / parts AS mean, 0 AS k, exp(-(rate / parts)) AS term, exp(-(rate / parts)) AS upto FROM rates
    UNION ALL
    SELECT source, parts, mean, k + 1, term * mean / (k + 1), upto + term * mean / (k + 1)
    FROM steps WHERE k < ceil(mean + 12 * sqrt(mean) + 30)
), keyed AS (
    SELECT *, md5(coalesce('=' || doc_id::VARCHAR, 'null') || '|' || coalesce('=' || md5(text), 'null')) AS row_key FROM documents
), units AS (
    SELECT k.*, p.part, ('0x' || substr(md5('{seed}-count|' || row_key || '|' || p.part), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS unit
    FROM keyed k JOIN (SELECT source, unnest(range(1, parts + 1)) AS part FROM rates) p ON k.source IS NOT DISTINCT FROM p.source
), counts AS (
    SELECT u.doc_id, u.row_key, count(*)::INT AS copies
    FROM units u JOIN steps s ON u.source IS NOT DISTINCT FROM s.source AND s.upto <= u.unit
    GROUP BY u.doc_id, u.row_key
), copied AS (SELECT *, unnest(range(1, copies + 1))::INT AS copy FROM counts)
SELECT k.doc_id, k.text, k.lang, k.source, k.n_chars, c.copies, c.copy,
       ('0x' || substr(md5('{seed}-place|' || k.row_key || '|' || c.copy), 1, 15))::BIGINT AS place
FROM copied c JOIN keyed k USING (row_key)
"""


def mix_sql(weights: dict[str, float], epochs: float = 1.0, seed: int = 1) -> str:
    cases = "".join(f" WHEN source = '{name}' THEN {weight}::DOUBLE" for name, weight in weights.items())
    return MIX_SQL.format(weight=f"CASE{cases} ELSE 1.0::DOUBLE END" if cases else "1.0::DOUBLE", epochs=epochs, seed=seed)
