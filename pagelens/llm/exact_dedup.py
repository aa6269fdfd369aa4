"""Exact deduplication as a stateful stream, in DataFrame operations only.

The rows' digests run through a streaming aggregation whose keyed state lies on
disk (RocksDB, with its changelog in the shared folder) and never expires: per
digest it retains the identifier and the content locator (file and row) of the
row that stays, and the number of rows. Texts of digests hit more than once are
then compared byte by byte.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.llm.common import ascii_lower, checked_join, cut, shared_path, with_locator

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.maintenanceInterval": "3s",  # stores are unloaded soon after the stream ends
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # many small stores: no space ahead of use
}


@contextmanager
def _set(spark: SparkSession, conf: dict):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def sha256_digest(text):
    return F.unhex(F.sha2(text.cast("binary"), 256))


def state_of(log: DataFrame, spark: SparkSession, path: str, files_per_batch: int | None = None,
             checkpoint: str | None = None) -> DataFrame:
    """Run the digest log at `path` (digest, id, loc) through the keyed state and
    return the state: (digest, keep: struct<id, loc>, n).

    With a fixed `checkpoint` folder a later call reads only the files that are
    new since, against the state of all earlier ones.
    """
    checkpoint = checkpoint or shared_path(spark, "dedup-state")
    stream = spark.readStream.schema(log.schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    keyed = stream.parquet(path).groupBy("digest").agg(
        F.max(F.struct("id", "loc")).alias("keep"), F.count(F.lit(1)).alias("n"))
    with _set(spark, STATE_CONF):
        q = (keyed.writeStream.outputMode("update").format("noop").trigger(availableNow=True)
             .option("checkpointLocation", checkpoint).start())
        q.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        kept = state.schema["value"].dataType.names
        return cut(state.select(F.col("key.digest").alias("digest"),
                                F.col(f"value.`{kept[0]}`").alias("keep"),
                                F.col(f"value.`{kept[1]}`").alias("n")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          digest=sha256_digest, files_per_batch: int | None = None) -> DataFrame:
    """One row per input row: `doc_id`, `loc` (struct<file, row>), `digest`, `keep_id`,
    `group_size`, `kept`.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    Of equal texts the row with the largest id stays, a null id below any other;
    of rows equal in both the one with the largest locator. An empty table gives
    an empty table. Other columns, whatever their names, are not touched.

    Texts whose digests agree but whose bytes differ are told apart by the text
    itself, so a collision never drops a row.
    """
    src = with_locator(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), "loc")
    return _classes(src, digest, files_per_batch)


def _classes(src: DataFrame, digest=sha256_digest, files_per_batch: int | None = None) -> DataFrame:
    """dedup() of a table (id, text, loc)."""
    spark = src.sparkSession
    norm = src.select("id", "loc", ascii_lower(F.coalesce("text", F.lit(""))).alias("text")) \
        .withColumn("digest", digest(F.col("text")))
    path = shared_path(spark, "dedup-log")
    norm.select("digest", "id", "loc").write.parquet(path)
    log = spark.read.schema(norm.select("digest", "id", "loc").schema).parquet(path)
    state = state_of(log, spark, path, files_per_batch) if not log.isEmpty() else \
        log.select("digest", F.struct("id", "loc").alias("keep"), F.lit(1).cast("long").alias("n"))

    hits = state.where("n > 1").select("digest")
    texts = checked_join(norm, hits, "digest", "left_semi")
    twins = cut(texts.groupBy("digest").agg(F.min("text").alias("lo"), F.max("text").alias("hi"))
                .where("lo <> hi").select("digest"))
    rows = log
    if twins.isEmpty():
        rows = rows.join(state, "digest")
    else:
        split = checked_join(norm, twins, "digest", "left_semi")
        classes = cut(split.groupBy("digest", "text").agg(
            F.max(F.struct("id", "loc")).alias("keep"), F.count(F.lit(1)).alias("n")))
        told = split.join(classes, ["digest", "text"]).select("digest", "id", "loc", "keep", "n")
        rows = rows.join(twins, "digest", "left_anti").join(state, "digest") \
            .select("digest", "id", "loc", "keep", "n").unionByName(told)
    return rows.select(F.col("id").alias("doc_id"), "loc", "digest", F.col("keep.id").alias("keep_id"),
                       F.col("n").alias("group_size"), (F.col("loc") == F.col("keep.loc")).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all columns of the input."""
    src = with_locator(docs, "__loc")
    rows = _classes(src.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                               F.col("__loc").alias("loc")))
    gone = cut(rows.where("not kept").select(F.col("loc").alias("__loc")))
    return checked_join(src, gone, "__loc", "left_anti").drop("__loc")


ORACLE = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size, sha256(t) AS text_sha256 FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (t)
"""
