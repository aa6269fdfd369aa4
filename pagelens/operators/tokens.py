"""H1: pages -> tokens.

``prepare_pages`` is the job's single exchange: page rows ``(page_id, h, ends)``,
the cleaned HTML and the position where each of its elements ends,
hash-partitioned by ``page_id``. Everything after it is native and keyed by
page: tokens and elements are cut in-row from the page, and later windows,
aggregates and joins on ``page_id`` reuse that partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelens.functions import html as H
from pagelens.operators.stack import close_positions


def prepare_pages(pages: DataFrame, key: str = "page_id", html: str = "html",
                  partition: bool = True, partitions: int | None = None) -> DataFrame:
    """(page_id, h, ends): script/style/comment-free HTML with its element ends,
    partitioned by page.

    The partition count is explicit (``partitions``, else the session's
    ``spark.sql.shuffle.partitions``): everything after this exchange is
    CPU-bound per-page work that multiplies the data several times (tokens,
    element texts), so letting AQE coalesce the partitions by the shuffled
    HTML bytes would leave most cores idle. Set it to one partition per
    128 MB or so of HTML.
    """
    p = pages.select(F.col(key).cast("bigint").alias("page_id"),
                     H.clean_html(F.coalesce(F.col(html), F.lit(""))).alias("h"))
    p = p.withColumn("ends", close_positions(F.expr(H.marks_sql(H.TOKENS_SQL))))
    if not partition:
        return p
    n = partitions or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return p.repartition(n, "page_id")


def html_tokens(prepared: DataFrame) -> DataFrame:
    """Tokens of every page: (page_id, pos, kind, tag, tok, tlen).

    kind is 'open', 'close' or 'text'; ``tok`` is the raw tag for tags and the
    entity-decoded text for text; ``tlen`` is the text length (0 for tags).
    Doctype/processing-instruction tokens are dropped; script, style and
    comment bodies never become tokens.
    """
    t = prepared.select("page_id", F.posexplode(H.token_array(F.col("h"))).alias("pos", "raw"))
    t = t.select("page_id", F.col("pos").cast("bigint").alias("pos"), "raw",
                 H.token_kind(F.col("raw")).alias("kind")).where(F.col("kind") != "other")
    is_text = F.col("kind") == "text"
    t = t.select(
        "page_id", "pos", "kind",
        F.when(is_text, F.lit("")).otherwise(H.tag_name(F.col("raw"))).alias("tag"),
        F.when(is_text, H.decode_entities("raw")).otherwise(F.col("raw")).alias("tok"))
    return t.withColumn("tlen", F.when(is_text, F.length("tok")).otherwise(F.lit(0)))
