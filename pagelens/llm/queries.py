"""Registered queries of the training-data operators and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.llm import (collocations, cover_tree, exact_dedup, hard_negatives, langid, mixing, packing, pii, sharding, simhash, topk,
                          toxicity, url_filter)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_simhash(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def remainder(column: str, m: int):
    """crc32 of an id as text, modulo m; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % m


def op2_langid(spark, sf):
    docs = _table(spark, sf, "documents")
    held = remainder("doc_id", 4) == 2
    model = langid.fit(docs.where(~held).select("doc_id", "text", "lang"))
    return langid.identify(docs.select("doc_id", held.alias("held_out"), "text"), model)


def op3_exact_dedup(spark, sf):
    rows = exact_dedup.dedup(_table(spark, sf, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op4_sharding(spark, sf):
    docs = sharding.shuffle(_table(spark, sf, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op5_url_filter(spark, sf):
    rows = url_filter.judge(_table(spark, sf, "pages").select("page_id", "url"))
    return rows.select("page_id", "host", "path", "rule", "verdict", "template", "examples", "purity")


def op6_toxicity(spark, sf):
    docs, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    model = toxicity.fit(docs.where(remainder("doc_id", 5) != 0).select("doc_id", "text"),
                         labels.where(remainder("doc_id", 5) != 0).select("doc_id", "toxic"))
    held = (remainder("doc_id", 5) == 0).alias("held_out")
    rows = toxicity.score(docs.select("doc_id", held, "text"), model)
    nearest = F.array_join(F.transform("evidence", lambda e: e.id.cast("string")), ",")
    return rows.select("doc_id", "held_out", "score", "predicted", nearest.alias("nearest"))


def op7_packing(spark, sf):
    p = packing.pack(_table(spark, sf, "documents"))
    return p.select("doc_id", "piece", "pieces", "first_word", "words", "bin_id", "capacity", "fill", "slot", "start",
                    F.crc32(F.col("text").cast("binary")).alias("piece_crc32"))


def op8_mixing(spark, sf):
    m = mixing.mix(_table(spark, sf, "documents").select("doc_id", "text", "source"))
    return m.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                    F.col("__target").alias("target"), (F.col("__size") * F.col("__copies")).alias("taken"))


def op9_pii(spark, sf):
    s = pii.spans(_table(spark, sf, "documents").select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("base", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")

    return s.select("doc_id", *[count(k) for k in pii.KINDS],
                    F.sha2(pii.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                    pii.joined(F.col("every")).alias("spans"))


def op10_topk(spark, sf):
    v = topk.integers(_table(spark, sf, "embeddings"))
    return topk.top_k(v.where("id % 50 = 0"), v)


def op11_collocations(spark, sf):
    return collocations.collocations(_table(spark, sf, "documents"))


def op12_hard_negatives(spark, sf):
    e = _table(spark, sf, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    v = hard_negatives.integers(e.select("vec_id", "embedding", label.alias("label")))
    return hard_negatives.mine(v, F.col("id") % 100 == 0)


def op13_cover_tree(spark, sf):
    return cover_tree.near_duplicates(_table(spark, sf, "embeddings"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_simhash, op2_langid, op3_exact_dedup, op4_sharding, op5_url_filter, op6_toxicity, op7_packing, op8_mixing,
    op9_pii, op10_topk, op11_collocations, op12_hard_negatives, op13_cover_tree)}
ORACLES: dict[str, str] = {
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op5_url_filter": url_filter.oracle_sql(),
    "op8_mixing": mixing.ORACLE,
    "op9_pii": pii.oracle_sql(),
    "op10_topk": topk.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_cover_tree": cover_tree.ORACLE,
}
