"""Sectioned text/CSV reports (R1, S7-S11) and the partitioned table sink.

A report is a DataFrame of lines ``(section_ord, part, row_ord, line)``:
per group a header (part 0), its rows (part 1) and a trailer (part 2);
groups in first-seen order. The section order comes from a map-side
combined ``min`` per group and a join with that small per-group table; the
final sort is range-partitioned on (section, part, row), so one big group
is still spread over many tasks. Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelens.functions import text as X

# --- fixed values -----------------------------------------------------------
# Header row of the article CSV report.
ARTICLE_FIELDS = ["descriptors", "image links", "article name", "article link"]
# ---------------------------------------------------------------------------

Header = Callable[[Column], Column]


def section_report(body: DataFrame, key: str, order: str, line: Column,
                   headers: list[Header] | None = None,
                   trailer: str | None = "") -> DataFrame:
    """Grouped rows -> report lines (section_ord, part, row_ord, line).

    ``part`` numbers the header lines 0..h-1, the rows h and the trailer
    h+1; ``row_ord`` orders the rows (null for headers and trailer). A null key is a
    section like any other."""
    headers = headers or []
    h = len(headers)
    # the per-section table is built from renamed columns and joined on an
    # explicit key, so the self-join never has to re-resolve body columns
    sec = (body.select(F.col(key).alias("_sk"), F.col(order).alias("_so"))
           .groupBy("_sk").agg(F.min("_so").alias("section_ord")))
    rows = body.join(sec, body[key].eqNullSafe(sec["_sk"])).select(  # a null key is a section of its own
        "section_ord", F.lit(h).alias("part"), F.col(order).alias("row_ord"), line.alias("line"))
    # header and trailer lines of every section from one explode of the
    # per-section table
    extra = [F.struct(F.lit(i).alias("part"), hd(F.col(key)).alias("line"))
             for i, hd in enumerate(headers)]
    if trailer is not None:
        extra.append(F.struct(F.lit(h + 1).alias("part"), F.lit(trailer).alias("line")))
    if not extra:
        return rows
    null_ord = F.lit(None).cast(rows.schema["row_ord"].dataType)
    frame = sec.withColumnRenamed("_sk", key).select(
        "section_ord", F.explode(F.array(*extra)).alias("_x")).select(
        "section_ord", F.col("_x.part").alias("part"), null_ord.alias("row_ord"),
        F.col("_x.line").alias("line"))
    return rows.unionByName(frame)


def write_lines(report: DataFrame, path: str, line_sep: str = "\n") -> None:
    """Write report lines in order as text (``\\r\\n`` for the CSV reports). Each file
    holds a range of the order and ends with a line end, so the files joined by name are
    the report."""
    (report.orderBy("section_ord", "part", "row_ord").select("line")
     .write.mode("overwrite").option("lineSep", line_sep).text(path))


def csv_field(x: Column) -> Column:
    """Minimal CSV quoting: quote a field holding a comma, quote or line
    break, doubling quotes; null writes as empty."""
    s = F.coalesce(x.cast("string"), F.lit(""))
    return F.when(s.rlike('[,"\r\n]'),
                  F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(s)


def csv_row(*cols: Column) -> Column:
    """One CSV record; a record of one empty field is written as ``""``."""
    if len(cols) == 1:
        return F.when(F.coalesce(cols[0].cast("string"), F.lit("")) == "", F.lit('""')).otherwise(
            csv_field(cols[0]))
    return F.concat_ws(",", *[csv_field(c) for c in cols])


def alt_src_lines(rows: DataFrame) -> DataFrame:
    """``alt: src`` per row, nulls printed as None, in row order."""
    return rows.select("page_id", "pos",
                       F.concat(X.to_string(F.col("alt")), F.lit(": "),
                                X.to_string(F.col("src"))).alias("line"))


def page_sections(images: DataFrame) -> DataFrame:
    """Per visited page, ``url:``, its non-empty image links, a blank line.
    ``images`` is (url, ord, pos, link); a page without images still gets
    its header (use a null link row)."""
    body = images.where(F.col("link").isNotNull() & (F.col("link") != "")) \
        .select("url", F.struct("ord", "pos").alias("o"), "link")
    sec_src = images.select("url", F.struct("ord", F.lit(-1).cast("bigint").alias("pos")).alias("o"),
                            F.lit(None).cast("string").alias("link"))
    allrows = body.unionByName(sec_src)
    rep = section_report(allrows, "url", "o", F.col("link"),
                         headers=[lambda k: F.concat(X.to_string(k), F.lit(":"))], trailer="")
    return rep.where(F.col("line").isNotNull())


def label_sections(rows: DataFrame) -> DataFrame:
    """Per label: the label, ``alt,src`` lines (not quoted, null alt as
    None), a blank line. ``rows`` is (label, ord, alt, src)."""
    line = F.concat(X.to_string(F.col("alt")), F.lit(","), F.col("src"))
    return section_report(rows, "label", "ord", line, headers=[X.to_string], trailer="")


def topic_sections(articles: DataFrame, list_form: str = "joined") -> DataFrame:
    """Per topic: the topic row, the header row, one CSV row per
    article, then a row holding one empty field. ``articles`` is (topic,
    ord, terms, images, title, url); lists rendered joined (``a, b``) or as
    list literals (S11)."""
    render = X.list_join if list_form == "joined" else X.list_literal
    line = csv_row(render(F.col("terms")), render(F.col("images")),
                   F.coalesce(F.col("title"), F.lit("")), F.col("url"))
    header = csv_row(*[F.lit(f) for f in ARTICLE_FIELDS])
    return section_report(articles, "topic", "ord", line,
                          headers=[lambda k: csv_row(k), lambda k: header], trailer='""')


#: Articles that one file of the topic tables holds, about.
FILE_ROWS = 1_000_000


def write_topic_tables(articles: DataFrame, path: str) -> None:
    """Everyday sink: the labelled articles as Parquet partitioned by topic. Rows are
    dealt by topic and a salt in proportion to the topic's size, so a topic has a
    few full files and a large one is written by many tasks."""
    size = articles.groupBy(F.col("topic").alias("_t")).agg(F.ceil(F.count(F.lit(1)) / FILE_ROWS).alias("_n"))
    salted = articles.join(size, articles["topic"].eqNullSafe(size["_t"])).withColumn(
        "_salt", F.pmod(F.xxhash64("page_id", "url"), F.col("_n")))
    (salted.repartition("topic", "_salt").drop("_t", "_n", "_salt")
     .write.mode("overwrite").partitionBy("topic").parquet(path))
