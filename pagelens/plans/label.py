"""Labelling jobs: images of an article plus its most common terms.

The whole job is one stream of element rows partitioned by page:

  pages (of the wanted articles: semi-join) -> element ends -> [exchange by
  page_id] -> elements (in-row) -> region / link ancestry / first h1, h2
  (windows) -> lines, images and title of each page (group by page_id) -> the
  page's texts again (join on page_id, the same exchange) -> terms counted by
  one sweep over them -> top terms (in-row) -> articles (join on page_id).

After the exchange every operator is keyed by ``page_id`` first, so the plan
has no second shuffle of page data; a huge page is one task's work, never a
group spanning pages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelens.functions import html as H
from pagelens.functions import text as X
from pagelens.functions import urls as U
from pagelens.operators.elements import (elements, inside,
                                         region_condition, with_ancestor_flag,
                                         with_region)
from pagelens.operators.images import IMAGE_TAGS
from pagelens.operators.sweep import line_term_counts
from pagelens.operators.tokens import prepare_pages


@dataclass(frozen=True)
class LabelOptions:
    """What differs between the three labelling versions of the reference."""
    region: tuple[str, str] | None = ("id", "frameInner")   # H2; None = whole page
    text_region: tuple[str, str] | None = None              # Q4: nested region for <p>
    analyzer: str = "words"                                  # X7 'letters' / X8 'words'
    link_mode: str = "http"                                  # F1/F2/F3
    stems: bool = True                                       # F13
    distinct_images: bool = True                             # D1
    parts: tuple[str, ...] = ("p", "h1", "h2", "alt")        # U1
    with_title: bool = True                                  # H4 h1 as article name
    strip_alt_markup: bool = False                           # F8 / Q3 (off as observed)
    top_k: int = 3                                           # T1
    image_tags: tuple[str, ...] = tuple(IMAGE_TAGS)


V1 = LabelOptions(analyzer="letters", link_mode="none", stems=False,
                  distinct_images=False, parts=("p",), with_title=False)
V2 = LabelOptions(analyzer="words", link_mode="http", stems=False,
                  distinct_images=False, parts=("p",), with_title=True)
V3 = LabelOptions()


def scoped_elements(prepared: DataFrame, opts: LabelOptions = V3,
                    tags: list[str] | None = None, with_text: bool = True) -> DataFrame:
    """Element rows of prepared pages inside the content region, with ``in_a`` and ``text``.

    Columns: page_id, open_pos, close_pos, tag, tok, in_a, in_text, text.
    """
    tags = tags or ["p", "h1", "h2", *opts.image_tags]
    regions = [r for r in (opts.region, opts.text_region) if r is not None]
    els = elements(prepared, sorted({*tags, "a", *(v for by, v in regions if by == "tag")}),
                   containing=[v for by, v in regions if by == "id"],
                   text_of=("p", "h1", "h2") if with_text else ())
    els = with_ancestor_flag(els, "a")       # ancestors may lie outside the region
    if opts.region is not None:
        els = with_region(els, *opts.region)
        scope = inside("r")
    else:
        scope = F.lit(True)
    if opts.text_region is not None:
        by, value = opts.text_region
        w = Window.partitionBy("page_id")
        cand = region_condition(by, value) & (scope if opts.region is not None else F.lit(True))
        first = F.min(F.when(cand, F.struct("open_pos", "close_pos"))).over(w)
        els = (els.withColumn("_t", first).withColumn("t_open", F.col("_t.open_pos"))
               .withColumn("t_close", F.col("_t.close_pos")).drop("_t"))
        in_text = inside("t")
    else:
        in_text = F.lit(True)
    return els.where(scope & F.col("tag").isin(tags)).withColumn("in_text", in_text)


def annotate(prepared: DataFrame, opts: LabelOptions = V3, with_text: bool = True) -> DataFrame:
    """Scoped element rows of prepared pages with what the jobs select on: ``src``/``alt``,
    ``kept`` (image passing H7 and the link filter), ``is_title``/``is_sub``
    (first h1/h2 of the region), ``is_line`` (U1 membership) and ``line``
    (its text; the alt for an alt line)."""
    s = scoped_elements(prepared, opts, with_text=with_text)
    w_page = Window.partitionBy("page_id")
    is_img = F.col("tag").isin(list(opts.image_tags))
    alt = H.attr("tok", "alt")
    if opts.strip_alt_markup:
        alt = F.replace(alt, F.lit("<p>"), F.lit(""))
    s = s.withColumns({
        "src": F.when(is_img, H.attr("tok", "src")),
        "alt": F.when(is_img, alt),
        "h1_first": F.min(F.when(F.col("tag") == "h1", F.col("open_pos"))).over(w_page),
        "h2_first": F.min(F.when(F.col("tag") == "h2", F.col("open_pos"))).over(w_page)})
    s = s.withColumn("kept", is_img & ~F.col("in_a") & U.link_filter(F.col("src"), opts.link_mode))
    w_alt = Window.partitionBy("page_id", "alt")
    s = s.withColumn("alt_first", F.min(F.when(F.col("kept"), F.col("open_pos"))).over(w_alt))
    is_title = F.coalesce(F.col("open_pos") == F.col("h1_first"), F.lit(False))
    is_sub = F.coalesce(F.col("open_pos") == F.col("h2_first"), F.lit(False))
    is_alt_line = (F.col("kept") & F.col("alt").isNotNull()
                   & (F.col("open_pos") == F.col("alt_first")))
    line = F.lit(False)
    if "p" in opts.parts:
        line = line | ((F.col("tag") == "p") & F.col("in_text"))
    if "h1" in opts.parts:
        line = line | is_title
    if "h2" in opts.parts:
        line = line | is_sub
    if "alt" in opts.parts:
        line = line | is_alt_line
    # U1 order: paragraphs, title, subtitle, then alts; position inside each
    part = (F.when(F.col("tag") == "p", 0).when(is_title, 1).when(is_sub, 2).otherwise(3))
    return s.withColumns({"is_title": is_title, "is_sub": is_sub, "is_line": line, "part": part,
                          "line": F.when(F.col("kept"), F.col("alt")).otherwise(F.col("text"))})


def article_lines(pages: DataFrame, opts: LabelOptions = V3) -> DataFrame:
    """(page_id, line_id, text): the lines an article is counted on (U1),
    numbered from 1 per article in payload order."""
    a = annotate(prepare_pages(pages), opts).where(F.col("is_line"))
    w = Window.partitionBy("page_id").orderBy("part", "open_pos")
    return a.select("page_id", F.row_number().over(w).cast("bigint").alias("line_id"),
                    F.col("line").alias("text"))


def article_images(pages: DataFrame, opts: LabelOptions = V3) -> DataFrame:
    """(page_id, images ARRAY<STRING>): kept images in document order, as
    stems and distinct when the options say so (P9)."""
    a = annotate(prepare_pages(pages), opts, with_text=False).where(F.col("kept"))
    image = U.url_stem(F.col("src")) if opts.stems else F.col("src")
    imgs = F.transform(F.array_sort(F.collect_list(F.struct("open_pos", image.alias("i")))),
                       lambda x: x["i"])
    if opts.distinct_images:
        imgs = F.array_distinct(imgs)
    return a.groupBy("page_id").agg(imgs.alias("images"))


def line_counts(pages: DataFrame, opts: LabelOptions = V3) -> DataFrame:
    """One row per page with scoped elements: page_id, counts (ARRAY<STRUCT<term, n>>, in how
    many lines each term occurs), imgs (kept images with their positions), title.

    Lines are element positions here; their terms are counted by one sweep over the
    page's token texts, so nested paragraphs are never written out. The pages meet their
    own lines again on ``page_id``, behind the exchange that both come from.
    """
    prepared = prepare_pages(pages)
    s = annotate(prepared, opts, with_text=False)
    image = U.url_stem(F.col("src")) if opts.stems else F.col("src")
    is_img = F.col("tag").isin(list(opts.image_tags))
    per_page = s.groupBy("page_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("is_line") & ~is_img, F.col("open_pos").cast("int")))).alias("opens"),
        F.collect_list(F.when(F.col("is_line") & is_img, F.col("alt"))).alias("alts"),
        F.collect_list(F.when(F.col("kept"), F.struct("open_pos", image.alias("image")))).alias("imgs"),
        F.min(F.when(F.col("is_title"), F.struct("open_pos", "close_pos"))).alias("h1"))
    p = prepared.withColumn("txt", F.expr(H.text_sql(H.TOKENS_SQL))).join(per_page, "page_id")
    title = F.array_join(F.slice("txt", (F.col("h1.open_pos") + 2).cast("int"),
                                 F.greatest(F.col("h1.close_pos") - F.col("h1.open_pos") - 1, F.lit(0)).cast("int")), "")
    return p.select("page_id", line_term_counts(F.col("txt"), F.col("ends"), F.col("opens"), F.col("alts"),
                                                opts.analyzer).alias("counts"),
                    "imgs", F.when(F.col("h1").isNotNull(), title).alias("title"))


def page_term_counts(pages: DataFrame, opts: LabelOptions = V3) -> DataFrame:
    """(page_id, term, n) of the pages' own lines (A1), by the sweep."""
    return line_counts(pages, opts).select("page_id", F.explode("counts").alias("c")).select("page_id", "c.*")


def page_labels(pages: DataFrame, opts: LabelOptions = V3) -> DataFrame:
    """(page_id, terms ARRAY, images ARRAY, title) for every page with elements in its
    content region; ``terms`` holds the top ``opts.top_k`` terms (T1)."""
    p = line_counts(pages, opts)
    ranked = F.array_sort(F.transform("counts", lambda c: F.struct((-c.n).alias("n"), c.term.alias("term"))))
    terms = F.transform(F.slice(ranked, 1, opts.top_k), lambda c: c.term)
    images = F.transform(F.array_sort("imgs"), lambda x: x["image"])
    if opts.distinct_images:
        images = F.array_distinct(images)
    title = F.col("title") if opts.with_title else F.lit("")
    return p.select("page_id", terms.alias("terms"), images.alias("images"), title.alias("title"))


def articles_by_url_topic(pages: DataFrame, topics: list[str]) -> DataFrame:
    """Articles = stored pages whose URL contains a topic, tagged with the
    first one (F6): (page_id, topic, url)."""
    return (pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url")
            .withColumn("topic", U.topic_first(F.col("url"), topics))
            .where(F.col("topic").isNotNull()))


def assemble(articles: DataFrame, labels: DataFrame) -> DataFrame:
    """Every article keeps its row (left join on page_id); a page
    without region, terms or images gets empty lists and a null title."""
    lab = labels.withColumnRenamed("page_id", "_lp")
    j = articles.join(lab, articles["page_id"] == lab["_lp"], "left")
    empty = F.array().cast("array<string>")
    return j.select("topic", articles["page_id"],
                    F.coalesce("terms", empty).alias("terms"),
                    F.coalesce("images", empty).alias("images"),
                    "title", "url", *[c for c in ("ord", "root") if c in articles.columns])


def label_articles(pages: DataFrame, articles: DataFrame,
                   opts: LabelOptions = V3) -> DataFrame:
    """Label a list of articles ``(page_id, topic, url[, ord])`` from stored pages:
    (topic, page_id, terms, images, title, url[, ord]), one row per entry of the
    list. Only the listed pages are parsed, each once; the measured size of the
    list decides how the semi-join runs."""
    wanted = articles.select(F.col("page_id").alias("_wp")).distinct()
    listed = pages.join(wanted, pages["page_id"].cast("bigint") == wanted["_wp"], "left_semi")
    return assemble(articles, page_labels(listed, opts))


def label_by_topic(pages: DataFrame, topics: list[str], opts: LabelOptions = V3) -> DataFrame:
    """Label every stored page whose URL contains a topic: the list is a filter of
    the pages themselves, so it is applied to the scan and needs no join."""
    listed = pages.where(U.topic_first(F.col("url"), topics).isNotNull())
    return assemble(articles_by_url_topic(pages, topics), page_labels(listed, opts))


def render_v3(df: DataFrame) -> DataFrame:
    """Output columns of the third version: lists joined with ', ' (X9); of crawls over
    many archives also the archive."""
    return df.select(*[c for c in ("root",) if c in df.columns], "topic",
                     X.list_join(F.col("terms")).alias("descriptors"),
                     X.list_join(F.col("images")).alias("image_links"),
                     F.col("title").alias("article_name"),
                     F.col("url").alias("article_link"))


def render_v1(df: DataFrame) -> DataFrame:
    """Output columns of the first versions: Python list literals."""
    return df.select("topic",
                     X.list_literal(F.col("terms")).alias("descriptors"),
                     X.list_literal(F.col("images")).alias("image_links"),
                     F.coalesce(F.col("title"), F.lit("")).alias("article_name"),
                     F.col("url").alias("article_link"))


