"""Mixing sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelens.llm.common import BROADCAST_ROWS, WORD_RE, cut

SEED = 17
#: A source's target stops at this many times its own size.
MOST = 3
#: The weights of the sources in code point order, repeating.
CYCLE = (1, 2, 3)


def words(col):
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD_RE)), F.lit(0)).cast("long")


def coin(id_col, text_col, seed: int = SEED):
    """A number in [0, 1) from the seed and the id (from the text where it is null)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"),
                                                 F.md5(F.col(text_col).cast("binary")), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("double") / float(1 << 48)


def ranked(sources: DataFrame) -> DataFrame:
    """Add `rank` from 0 in code point order, null last, without gathering the
    sources in one task: a range sort, then one offset per partition."""
    s = cut(sources.orderBy(F.col("source").asc_nulls_last()))
    s = cut(s.withColumns({"pid": F.spark_partition_id(), "pos": F.monotonically_increasing_id()}))
    starts, at = {}, 0
    for r in s.groupBy("pid").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("p")).orderBy("pid").collect():
        starts[r["pid"]] = at - r["p"]
        at += r["n"]
    shift = F.element_at(F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]), F.col("pid")) \
        if starts else F.lit(0)
    return s.withColumn("rank", F.col("pos") + shift).drop("pid", "pos")


def rates(sources: DataFrame, most: int = MOST, cycle: tuple = CYCLE) -> DataFrame:
    """(source, source_size) -> plus weight, target and rate.

    The level is the number of words a unit of weight gets. Sources whose share
    exceeds `most` times their size stop there and the excess is shared again by
    weight; each round is one aggregate of four numbers, and only adds sources
    to those that stopped.
    """
    s = ranked(sources).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in cycle]), (F.col("rank") % len(cycle) + 1).cast("int")))
    s = cut(s)
    level, stopped = 0.0, -1
    while True:
        over = F.col("source_size") * most < F.lit(level) * F.col("weight") if stopped >= 0 else F.lit(False)
        r = s.agg(F.sum("source_size").alias("total"),
                  F.sum(F.when(over, F.col("source_size") * most)).alias("used"),
                  F.sum(F.when(~over, F.col("weight"))).alias("weight"),
                  F.count(F.when(over, 1)).alias("n")).first()
        if r["n"] == stopped or not r["weight"]:
            break
        stopped = r["n"]
        level = float(r["total"] - (r["used"] or 0)) / float(r["weight"])
    target = F.least((F.col("source_size") * most).cast("double"), F.lit(level) * F.col("weight"))
    return s.withColumn("target", target).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = SEED, most: int = MOST, cycle: tuple = CYCLE) -> DataFrame:
    """The rows with `__size`, `__source_size`, `__target` and `__copies`, the number
    of times the mix takes the row: floor(rate), plus one if its coin is below the
    rate's fraction.

    Reruns agree, since the coin depends on seed and id only. Rows that share an
    id share their coin. A null source is a source of its own, the last one; a
    null text has no words; a source without words is not taken. An empty table
    gives an empty table. Working columns start with two underscores, so other
    columns never clash.
    """
    d = docs.withColumns({"__size": words(F.col(f"`{text_col}`")),
                          "__key": F.coalesce(F.concat(F.lit("s"), F.col(f"`{source_col}`").cast("string")), F.lit("n"))})
    sized = d.groupBy("__key", F.col(f"`{source_col}`").cast("string").alias("source")) \
        .agg(F.sum("__size").alias("source_size"))
    r = cut(rates(sized, most, cycle).select("__key", F.col("source_size").alias("__source_size"),
                                             F.col("target").alias("__target"), F.col("rate").alias("__rate")))
    if r.count() <= BROADCAST_ROWS:
        r = F.broadcast(r)
    d = d.join(r, "__key")
    whole = F.floor("__rate")
    extra = coin(f"`{id_col}`", f"`{text_col}`", seed) < F.col("__rate") - whole
    return d.withColumn("__copies", whole + extra.cast("long")).drop("__key", "__rate")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as many times as it is taken, input columns only."""
    m = mix(docs, **options).where("__copies > 0")
    m = m.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return m.select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST(('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), md5(text), '')), 1, 12)) AS BIGINT)
           / 281474976710656.0::DOUBLE AS coin
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS k FROM w),
p AS (SELECT *, coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight,
         sum(source_size) OVER () AS total FROM o),
l AS (SELECT coalesce((SELECT (total - used)::DOUBLE / left_weight::DOUBLE FROM p
        WHERE 3 * source_size >= (total - used)::DOUBLE / left_weight::DOUBLE * weight ORDER BY k LIMIT 1), 0) AS level),
t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, level * weight) AS target FROM w, l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t)
SELECT d.doc_id, d.size, r.source_size, r.target,
       d.size * CAST(floor(r.rate) + CASE WHEN d.coin < r.rate - floor(r.rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""
