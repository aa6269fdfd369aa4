"""Images by page over visits that keep arriving (A4 under revisits, D2 by URL).

A page that is visited again replaces the images of the earlier visit and keeps the
place of the first one. That needs state across batches: one streaming aggregation keyed
by URL holds the first visit and the image list of the last. Visits may arrive in any
order and at any time, so the state has no expiry; it grows with the distinct URLs, one
page's image list each, and lies in RocksDB, partitioned by URL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagelens.functions import html as H
from pagelens.sources.pages import PAGES_SCHEMA

VISITS_SCHEMA = PAGES_SCHEMA + ", visit BIGINT"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def image_lists(visits: DataFrame) -> DataFrame:
    """(url, visit, page_id, images) of visits (page_id, url, html, visit): the page's
    ``<img>`` links that begin with 'https' (F1), in order, as array<struct<pos, link>>.
    All in the row, so it is the same for a table and a stream; null HTML has none."""
    h = visits.select("url", F.col("visit").cast("bigint").alias("visit"), F.col("page_id").cast("bigint").alias("page_id"),
                      H.token_array(H.clean_html(F.coalesce("html", F.lit("")))).alias("_t"))
    tags = F.transform("_t", lambda x, i: F.struct(i.cast("bigint").alias("pos"), x.alias("raw")))
    tags = F.filter(tags, lambda x: (H.token_kind(x["raw"]) == "open") & (H.tag_name(x["raw"]) == "img"))
    links = F.expr(f"transform(_i, _m -> struct(_m.pos AS pos, {H.attr_sql('_m.raw', 'src')} AS link))")
    return h.withColumn("_i", tags).select("url", "visit", "page_id",
                                           F.filter(links, lambda x: x["link"].startswith("https")).alias("images"))


def latest_images(lists: DataFrame) -> DataFrame:
    """(url, ord, visit, images, seen): per URL the place of its first visit, the images of
    its last (of visits with one number, that of the largest page_id) and how many visits
    this was made of. A null visit comes
    before all others; a null URL is a key of its own. Combined on the map side; on a
    stream the aggregate is the keyed state."""
    last = F.max(F.struct("visit", "page_id", "images")).alias("_last")
    return lists.groupBy("url").agg(F.min("visit").alias("ord"), last, F.count(F.lit(1)).alias("seen")) \
        .select("url", "ord", F.col("_last.visit").alias("visit"), F.col("_last.images").alias("images"), "seen")


def image_rows(latest: DataFrame) -> DataFrame:
    """(url, ord, pos, link) as P2 gives them; a page without images has one row with a
    null link, so that a report keeps its section (S8)."""
    return latest.select("url", "ord", F.explode_outer("images").alias("_m")) \
        .select("url", "ord", F.col("_m.pos").alias("pos"), F.col("_m.link").alias("link"))


def start_image_stream(spark: SparkSession, visits_dir: str, out_dir: str, checkpoint: str,
                       max_files_per_trigger: int | None = None, once: bool = False) -> StreamingQuery:
    """Keep the images of every URL over Parquet files of visits that land in
    ``visits_dir``. Each batch writes the URLs it changed to its own folder, so a batch
    that is run again overwrites what it wrote; ``current_images`` reads the result.
    ``checkpoint`` must be a shared folder: files done and state are there."""
    reader = spark.readStream.schema(VISITS_SCHEMA).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    latest = latest_images(image_lists(reader.load(visits_dir)))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    w = latest.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    if once:
        w = w.trigger(availableNow=True)
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # a query takes its settings as it starts
    try:
        return w.start()
    finally:
        spark.conf.set(STATE_STORE, before)


def current_images(spark: SparkSession, out_dir: str) -> DataFrame:
    """(url, ord, visit, images, seen) as they stand: of every URL the row made of most
    visits. So batches of an earlier run do not hide what a run from the start found."""
    rows = spark.read.parquet(out_dir)
    row = F.struct("seen", "ord", "visit", "images")
    return rows.groupBy("url").agg(F.max(row).alias("_r")) \
        .select("url", *[F.col(f"_r.{c}").alias(c) for c in ("ord", "visit", "images", "seen")])
