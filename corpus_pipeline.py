"""Corpus pipeline over `documents`: drop toxic documents, drop exact copies, keep one
document of each near-duplicate group, mix the sources, pack the mix.

Every stage is (spark, docs, sf_dir) -> DataFrame and works on all rows its
predecessor kept; `run` writes each stage's rows as Parquet in the shared folder and
reads them back as the next one's docs. All but the last stage return the columns
of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.llm import exact_dedup, mixing, packing, simhash, toxicity
from pagelens.llm.common import checked_join, cut, settings, stored, with_locator
from pagelens.llm.queries import remainder


#: Rows of whole texts that go to Python at a time: the stages share executors, and each
#: batch is held by both sides.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5, all columns as they are. The scorer
    learns as query op6 does, from `labels` outside the held-out fold; without any label
    all documents stay. Null and empty texts have no neighbours and stay unless such
    examples are mostly toxic. Only texts and places go through Python, and the places of
    what is rejected come back."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    fold = remainder("doc_id", 5) != 0
    src = with_locator(docs, "__loc")
    with settings(spark, SMALL_BATCHES):
        model = toxicity.fit(docs.where(fold).select("doc_id", "text"), labels.where(fold))
        scored = toxicity.score(src.select("__loc", "text"), model)
        gone = cut(scored.where("predicted = 1").select("__loc"))
    return checked_join(src, gone, "__loc", "left_anti").drop("__loc")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (A-Z lower-cased) the one with the largest doc_id."""
    return exact_dedup.deduplicated(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id (of
    several the one with the smallest place in the input); a group whose ids are all
    null keeps its first document."""
    src = with_locator(docs, "__loc")
    with settings(spark, SMALL_BATCHES):
        rows = simhash.near_duplicates(src.select("doc_id", "text", "__loc"))
        rows = cut(rows.select("doc_id", "__loc", F.col("group_id")))
    first = rows.groupBy("group_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__loc")).alias("f"))
    gone = rows.join(cut(first), "group_id").where(F.col("__loc") != F.col("f.__loc")).select("__loc")
    return checked_join(src, cut(gone), "__loc", "left_anti").drop("__loc")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of their sources takes them."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces with their bins and texts."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Neither the scorer nor the fingerprints can be expressed in SQL; the tests hold
#: each stage against a brute-force version on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
