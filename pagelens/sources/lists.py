"""URL lists (S3, S4) and bulk NDJSON payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagelens.functions import text as X


# One cell of a CSV row that has a comma put before it.
CELL_RE = r',("(?:[^"]|"")*+"|[^,]*+)'


def url_cells(rows: DataFrame, line: str, order: list[str]) -> DataFrame:
    """S3 over lines: every non-empty cell of every CSV line, flattened in order:
    (url, ord), ``ord`` being the ``order`` columns and the cell number. A line
    may have any number of cells; quoted cells may hold commas and doubled quotes."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), F.col(line)), F.lit(CELL_RE), 1)
    out = rows.select(*order, F.posexplode(cells).alias("_c", "_v"))
    quoted = F.col("_v").rlike('(?s)^".*"$')
    url = F.when(quoted, F.replace(F.expr("substring(_v, 2, length(_v) - 2)"), F.lit('""'), F.lit('"'))) \
        .otherwise(F.col("_v"))
    out = out.select(*order, "_c", url.alias("url")).where(F.col("url") != "")
    return out.select("url", F.struct(*order, "_c").alias("ord"))


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """S3: the cells of a CSV file of URLs, in file order: (url, ord)."""
    df = spark.read.text(path)
    df = df.select(F.regexp_replace("value", "\\r$", "").alias("value"), F.col("_metadata.file_path").alias("_f"),
                   F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_r"))
    return url_cells(df, "value", ["_f", "_b", "_r"])


def write_url_list(urls: DataFrame, path: str, order: str = "ord") -> None:
    """One URL per line, in list order."""
    urls.orderBy(order).select("url").write.mode("overwrite").text(path)


def bulk_payload(lines: DataFrame) -> DataFrame:
    """(page_id, line_no, json) NDJSON pairs per article: an action line
    {"index":{"_id":"<n>"}} then {"content": <text>}, ``_id`` counting from 1
    per article as a string."""
    action = F.to_json(F.struct(F.struct(F.col("line_id").cast("string").alias("_id")).alias("index")))
    doc = X.json_document(F.col("text"))
    return lines.select("page_id", F.posexplode(F.array(action, doc)).alias("k", "json"),
                        "line_id").select(
        "page_id", ((F.col("line_id") - 1) * 2 + F.col("k") + 1).cast("bigint").alias("line_no"),
        "json")


def write_bulk_payload(payload: DataFrame, path: str) -> None:
    """S5 sink at scale: JSON records (page_id, line_no, json), each
    article's lines contiguous and in payload order inside one file; no
    directory per article."""
    (payload.repartition("page_id").sortWithinPartitions("page_id", "line_no")
     .write.mode("overwrite").json(path))


def write_bulk_payload_files(payload: DataFrame, path: str) -> None:
    """S5 in the reference's exact form: one NDJSON pair file per article
    (``path/page_id=<id>/``). Meant for a bounded set of articles, as each
    article becomes a directory."""
    (payload.repartition("page_id").sortWithinPartitions("page_id", "line_no")
     .select("page_id", "json").write.mode("overwrite").partitionBy("page_id").text(path))


ACTION_SCHEMA = "index STRUCT<_id: STRING>"
DOC_SCHEMA = "content STRING"


def bulk_documents(lines: DataFrame, source: str = "source", pos: str = "pos", line: str = "line") -> DataFrame:
    """S6 over lines: NDJSON pair lines -> documents (source, _id, pos, content), as
    the index stores them: an action line applies to the next line; a repeated _id
    replaces the earlier document but keeps its place (D2). ``source`` is one
    article's payload, so the pairing window is bounded by one article."""
    lines = lines.select(F.col(source).alias("source"), F.col(pos).alias("pos"), F.col(line).alias("line")) \
        .where(F.trim("line") != "")
    w = Window.partitionBy("source").orderBy("pos")
    paired = lines.withColumn("prev", F.lag("line").over(w)).withColumn(
        "prev_pos", F.lag("pos").over(w))
    act = F.from_json(F.col("prev"), ACTION_SCHEMA)
    docs = paired.where(act["index"].isNotNull()).select(
        "source", F.col("prev_pos").alias("pos"),
        act["index"]["_id"].alias("_id"),
        F.from_json(F.col("line"), DOC_SCHEMA)["content"].alias("content"))
    return (docs.groupBy("source", "_id")
            .agg(F.min("pos").alias("pos"),
                 F.max_by(F.struct("content"), F.col("pos")).alias("_last"))
            .select("source", "_id", "pos", F.col("_last.content").alias("content")))


def read_bulk_payload(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a payload written by ``write_bulk_payload`` (JSON records
    page_id, line_no, json): (source, _id, pos, content), source being the page."""
    rows = spark.read.schema("page_id BIGINT, line_no BIGINT, json STRING").json(path)
    return bulk_documents(rows, "page_id", "line_no", "json")


def read_bulk_files(spark: SparkSession, path: str) -> DataFrame:
    """S6 in the reference's exact form: one NDJSON pair file per article."""
    raw = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source"), "value")
    return bulk_documents(raw.select("source", F.posexplode(F.split("value", "\n")).alias("pos", "line")))


def match_all(docs: DataFrame, key: str = "page_id", order: str = "line_id",
              hits: int = 10) -> DataFrame:
    """The first ``hits`` stored documents of each article (the index's
    default page size), in an explicit order."""
    w = Window.partitionBy(key).orderBy(order)
    return docs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= hits).drop("_r")
