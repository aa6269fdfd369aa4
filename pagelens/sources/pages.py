"""Page scans (S1, S2) and the sink of HTML files."""

from __future__ import annotations

import sys
import uuid

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.sources.bulk import located

PAGES_SCHEMA = "page_id BIGINT, url STRING, html STRING"
#: HTML files that one folder holds, about.
FOLDER_FILES = 1000


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages ``(page_id, url, html)`` from Parquet, fixed schema.
    Column pruning and filters on ``url``/``page_id`` reach the scan."""
    return spark.read.schema(PAGES_SCHEMA).parquet(path)


def read_html_files(spark: SparkSession, path: str) -> DataFrame:
    """local/shared HTML files as pages: one row per file, the file path
    as URL, a stable 64-bit hash of it as ``page_id``. Folders are listed by a few
    tasks a core: by default each folder, which may hold a single file, takes a task."""
    conf, name = spark.conf, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = conf.get(name)
    conf.set(name, str(4 * spark.sparkContext.defaultParallelism))
    try:
        df = spark.read.text(path, wholetext=True)
    finally:
        conf.set(name, before)
    fp = F.col("_metadata.file_path")
    return df.select(F.xxhash64(fp).alias("page_id"), fp.alias("url"),
                     F.col("value").alias("html"))



def write_html_files(pages: DataFrame, path: str) -> None:
    """Pages ``(page_id, html)`` as HTML files below ``path``, a file
    ``folder=K/page_id=N.html`` for each id; every row ends with a line end, a null page
    is an empty line. The folder follows from the id, and tasks write a file under a
    passing name and rename it, so a repeated task replaces its own files and the driver
    moves none. Paths are those of the bulk pair files."""
    folders = pages.count() // FOLDER_FILES + 1
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    rows = pages.select(F.concat(F.lit("folder="), F.pmod(F.xxhash64("page_id"), F.lit(folders))).alias("folder"),
                        F.concat(F.lit("page_id="), name, F.lit(".html")).alias("name"), F.col("html").cast("binary").alias("html"))

    def run(batches):
        files, root = located(path)
        made, last, out, n = None, None, None, 0

        def done():
            out.close()
            files.move(passing, f"{root}/{last[0]}/{last[1]}")

        for b in batches:
            for folder, file, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if (folder, file) != last:
                    if out:
                        done()
                    if folder != made:
                        files.create_dir(f"{root}/{folder}", recursive=True)
                    made, last, n = folder, (folder, file), n + 1
                    passing = f"{root}/{folder}/.{file}-{uuid.uuid4().hex}"
                    out = files.open_output_stream(passing, compression=None)
                if html.is_valid:
                    out.write(html.as_buffer())
                out.write(b"\n")
        if out:
            done()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["files"])

    rows.repartition("folder").sortWithinPartitions("folder", "name").mapInArrow(run, "files long").agg(F.sum("files")).first()


cloudpickle.register_pickle_by_value(sys.modules[__name__])
