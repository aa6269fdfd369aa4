"""Composite jobs: the public API mirroring the reference's programs.

Each takes the stored-pages DataFrame ``(page_id, url, html)`` and returns a
DataFrame; writing is left to the sinks in ``pagelens.sources``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelens.functions import html as H
from pagelens.functions import urls as U
from pagelens.operators.elements import elements, inside, with_region
from pagelens.operators.images import keyed_upsert
from pagelens.operators.tokens import html_tokens, prepare_pages
from pagelens.plans.crawl import archive_crawls, bfs_crawl, link_table, stored_urls
from pagelens.plans.label import (V1, V2, V3, LabelOptions, article_images,
                                  article_lines, label_articles)
from pagelens.sources import lists as L


def page_images(pages: DataFrame) -> DataFrame:
    """Alt -> src of every ``<img>`` of each page, last value per alt at the
    alt's first position: (page_id, pos, alt, src). Void tags need no
    element intervals, so this is tokens only."""
    t = html_tokens(prepare_pages(pages))
    img = t.where((F.col("kind") == "open") & (F.col("tag") == "img")).select(
        "page_id", "pos", H.attr("tok", "alt").alias("alt"),
        H.attr("tok", "src").alias("src"))
    return keyed_upsert(img, ["page_id"], "alt", "src")


def _page_image_links(pages: DataFrame, region: tuple[str, str] | None,
                      keep) -> DataFrame:
    """(page_id, pos, alt, src) of ``<img>`` (region-scoped if asked) whose src
    passes ``keep``."""
    if region is None:
        t = html_tokens(prepare_pages(pages))
        img = t.where((F.col("kind") == "open") & (F.col("tag") == "img")).select(
            "page_id", "pos", "tok")
    else:
        els = with_region(elements(prepare_pages(pages), ["img", region[1]] if region[0] == "tag" else ["img"],
                                   containing=[region[1]] if region[0] == "id" else ()), *region)
        img = els.where((F.col("tag") == "img") & inside("r")).select(
            "page_id", F.col("open_pos").alias("pos"), "tok")
    img = img.select("page_id", "pos", H.attr("tok", "alt").alias("alt"),
                     H.attr("tok", "src").alias("src"))
    return img.where(keep(F.col("src")))


def crawl_images(pages: DataFrame, seed: str, budget: int | None = None) -> DataFrame:
    """Images of the pages a FIFO crawl visits (``budget`` of them, all if None):
    (url, ord, pos, link). Links and images must start with 'https' (F1); the
    seed is visited; a page without images has one row with a null link."""
    links = link_table(pages, keep=U.https_only)
    visited = bfs_crawl(pages, [seed], links, budget=budget)
    imgs = _page_image_links(_only(pages, visited), None, U.https_only)
    v = visited.select("url", "ord", F.col("page_id").alias("_vp"))
    return (v.join(imgs, v["_vp"] == imgs["page_id"], "left")
            .select("url", "ord", "pos", F.col("src").alias("link")))


def label_by_url(pages: DataFrame, base: str, budget: int | None = None,
                 prefix: str = "/sport/", region: tuple[str, str] = ("id", "frameInner")) -> DataFrame:
    """Crawl links under ``prefix`` from the base page (which only gives
    links, Q10), label each visited page's https images by its URL path
    (F11): (label, ord, alt, src), ``ord`` = (page order, image position)."""
    links = link_table(pages, region=region, keep=lambda h: U.site_prefix(h, prefix),
                       rewrite=lambda h: U.rebase(h, base, prefix))
    visited = bfs_crawl(pages, [base], links, budget=budget, include_seed=False)
    imgs = _page_image_links(_only(pages, visited), region, U.https_only)
    v = visited.select("url", "ord", F.col("page_id").alias("_vp"))
    return (v.join(imgs, v["_vp"] == imgs["page_id"])
            .select(U.label_from_url(F.col("url"), base).alias("label"),
                    F.struct("ord", "pos").alias("ord"), "alt", "src"))


def _crawl(pages: DataFrame, start: str | DataFrame, *args, **options) -> DataFrame:
    """C3 from one archive's URL (no ``root`` column) or from a table of them."""
    one = isinstance(start, str)
    roots = pages.sparkSession.createDataFrame([(start,)], "url string") if one else start
    rows = archive_crawls(pages, roots, *args, **options)
    return rows.drop("root") if one else rows


def extract_links(pages: DataFrame, start_url: str | DataFrame, topics: list[str], base: str = "",
                  max_days: int | None = None, region: tuple[str, str] | None = ("id", "frameInner")) -> DataFrame:
    """Links of the first ``max_days`` date pages (all if None) that contain
    any topic (F5), in order: (url, ord); with a table of archives (``url``) as start,
    those of every archive under its ``root``."""
    return _crawl(pages, start_url, topics, base=base, max_days=max_days, region=region).drop("topic")


def _only(pages: DataFrame, visited: DataFrame) -> DataFrame:
    """The pages that a crawl visited, so that no other page is parsed."""
    v = visited.select(F.col("page_id").alias("_only")).distinct()
    return pages.join(v, pages["page_id"].cast("bigint") == v["_only"], "left_semi")


def _crawled_articles(pages: DataFrame, start_url: str | DataFrame, topics: list[str], base: str,
                      max_days: int | None, region: tuple[str, str] | None) -> DataFrame:
    arts = _crawl(pages, start_url, topics, base=base, max_days=max_days, region=region)
    return arts.join(stored_urls(pages), "url")


def label_v1(pages: DataFrame, urls: DataFrame, budget: int | None = None,
             opts: LabelOptions = V1) -> DataFrame:
    """P5: label the first ``budget`` URLs (all if None) of a list (S3 output
    ``(url, ord)``) under the topic 'test': letters analyzer, every image link,
    no title. A URL that is listed twice is labelled twice."""
    arts = urls.join(stored_urls(pages), "url")
    if budget is not None:
        arts = arts.orderBy("ord").limit(budget)
    arts = arts.select("page_id", F.lit("test").alias("topic"), "url", "ord")
    return label_articles(pages, arts, opts)


def label_v2(pages: DataFrame, start_url: str | DataFrame, topics: list[str], base: str = "",
             max_days: int | None = None, opts: LabelOptions = V2) -> DataFrame:
    """Two-level crawl (the first ``max_days`` date pages, all if None), then
    words analyzer, 'http' images, title. One row per topic link, in ``ord``; an
    article linked from several date pages keeps each of its rows. With a table of
    archives (``url``) as start, one row per archive's link, under its ``root``."""
    return label_articles(pages, _crawled_articles(pages, start_url, topics, base, max_days, opts.region), opts)


def label_v3(pages: DataFrame, start_url: str | DataFrame, topics: list[str], base: str = "",
             max_days: int | None = None, opts: LabelOptions = V3) -> DataFrame:
    """P7 (flagship): v2 plus image stems, distinct images, alts and
    subtitle as text."""
    return label_v2(pages, start_url, topics, base, max_days, opts)


def article_text(pages: DataFrame, region: tuple[str, str] = ("id", "frameInner"),
                 text_region: tuple[str, str] | None = ("id", "main")) -> DataFrame:
    """Paragraphs under the nested text region, then title and subtitle:
    (page_id, line_id, text); ``pagelens.sources.lists.bulk_payload`` turns
    it into the NDJSON payload (S5)."""
    opts = replace(V3, region=region, text_region=text_region, parts=("p", "h1", "h2"))
    return article_lines(pages, opts)


def article_payload(pages: DataFrame, **kw) -> DataFrame:
    """P8 with S5: (page_id, line_no, json)."""
    return L.bulk_payload(article_text(pages, **kw))


def article_image_stems(pages: DataFrame, region: tuple[str, str] = ("id", "frameInner")) -> DataFrame:
    """Distinct image stems of each page's content region, in order."""
    return article_images(pages, replace(V3, region=region))
