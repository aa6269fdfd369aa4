"""Term counting and top-k per article."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelens.functions import text as X


def line_terms(lines: DataFrame, analyzer: str = "words", text: str = "text") -> DataFrame:
    """(page_id, line_id, term): each term once per line.

    Each line is one document; a term is counted once per document, so
    duplicates inside a line are dropped in-row (no Expand, no shuffle).
    """
    return lines.select("page_id", "line_id",
                        F.explode(X.distinct_terms(F.col(text), analyzer)).alias("term"))


def term_doc_count(lines: DataFrame, analyzer: str = "words", text: str = "text") -> DataFrame:
    """(page_id, term, n): in how many lines of the article each term occurs
    (A1). The article is part of the key, so counts never mix (A2)."""
    return (line_terms(lines, analyzer, text)
            .groupBy("page_id", "term").agg(F.count(F.lit(1)).alias("n")))


def top_terms(counts: DataFrame, k: int = 3) -> DataFrame:
    """(page_id, term, n, rk) for the k best terms: count descending, then term
    ascending (T1; k=10 is T2). The planner turns the rank filter into a
    per-partition group limit before the window."""
    w = Window.partitionBy("page_id").orderBy(F.col("n").desc(), F.col("term").asc())
    return (counts.withColumn("rk", F.row_number().over(w).cast("bigint"))
            .where(F.col("rk") <= k))


def dealt(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows evenly before any per-line work, whatever the input's file layout. An
    article has no part in it, so one that holds most of the rows is spread like any
    other: each task counts the terms of its own lines (the map side of A1), the counts
    meet by (article, term), and the rank window gets at most k terms an article from
    each of these tasks. ``partitions=0`` leaves the rows where the scan put them, so
    that no text is shuffled: right for a table of many splits."""
    if partitions == 0:
        return df
    return df.repartition(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def text_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
               sep: str = "\n", partitions: int | None = None) -> DataFrame:
    """(page_id, line_id, text): one line per text line of each document,
    numbered from 0; the article is the document."""
    d = dealt(docs.select(F.col(key).alias("page_id"), F.col(text).alias("_t")), partitions)
    return d.select("page_id", F.posexplode(F.split("_t", sep)).alias("line_id", "text"))


def row_lines(rows: DataFrame, key: str, line: str, text: str = "text",
              partitions: int | None = None) -> DataFrame:
    """(page_id, line_id, text) when each row already is a line (a
    conversation turn): article = ``key``, line = ``line``."""
    return dealt(rows.select(F.col(key).alias("page_id"), F.col(line).alias("line_id"),
                             F.col(text).alias("text")), partitions)
