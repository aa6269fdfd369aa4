"""The per-page labelling job over pages that keep arriving.

Labelling is per page (no state across pages), so a stream needs no
watermark or state store: each micro-batch of new page files is labelled
as a batch (``foreachBatch``) and written to the batch's own partition,
then by topic; a batch that is run again overwrites its partition. The checkpoint location must be a shared folder; the file source
tracks which page files are done, so a restarted query resumes where it
stopped and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pagelens.plans.label import V3, LabelOptions, label_by_topic
from pagelens.sources.pages import PAGES_SCHEMA


def label_batch(pages: DataFrame, topics: list[str], opts: LabelOptions = V3) -> DataFrame:
    """Label one batch of pages tagged by URL topic (the flagship job)."""
    return label_by_topic(pages, topics, opts)


def start_label_stream(spark: SparkSession, pages_dir: str, out_dir: str, checkpoint: str,
                       topics: list[str], opts: LabelOptions = V3,
                       max_files_per_trigger: int | None = None,
                       once: bool = False) -> StreamingQuery:
    """Label new Parquet page files as they land in ``pages_dir``."""
    reader = spark.readStream.schema(PAGES_SCHEMA).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(pages_dir)

    def write(batch: DataFrame, batch_id: int) -> None:
        (label_batch(batch, topics, opts).write.mode("overwrite")
         .partitionBy("topic").parquet(f"{out_dir}/batch_id={batch_id}"))

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if once:
        w = w.trigger(availableNow=True)
    return w.start()
