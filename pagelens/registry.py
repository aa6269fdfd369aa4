"""Registered queries and their SQL oracles.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLES[name]`` is SQL
that DuckDB runs over the same Parquet tables (views ``pages``,
``documents``, ``conversations``). Column names are equal on both sides.

Text operators run on the stored ``pages`` (content region ``<article>``),
``documents`` (an article per document, a line per text line) and
``conversations`` (an article per conversation, a line per turn). The stored
pages have no images, ids or links to one another, so image, region, link and
crawl operators run on the stored HTML with a fragment spliced into its
``<article>`` (``spliced``): both engines build it with the same SQL and parse the
whole page.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagelens.functions import html as H
from pagelens.functions import text as X
from pagelens.functions import urls as U
from pagelens.operators import terms as T
from pagelens.operators.elements import (elements, inside, structural_join,
                                         with_ancestor_flag, with_region)
from pagelens.operators.links import filter_topic_any, first_n, nth_item, tag_topic_first, tag_topic_join
from pagelens.operators.tokens import html_tokens, prepare_pages
from pagelens.plans import jobs
from pagelens.plans.crawl import archive_crawls, bfs_crawl, dense_order, link_table, two_level_crawl
from pagelens.plans.label import (V1, V2, V3, article_images, article_lines,
                                  label_by_topic, page_term_counts, render_v1, render_v3)
from pagelens.sources import lists as L
from pagelens.sources import report as R
from pagelens.sources.bulk import read_bulk_pairs, write_bulk_pairs
from pagelens.session import scratch_path
from pagelens.sources.pages import read_html_files, read_pages, write_html_files
from pagelens.streaming import image_stream as I

Query = Callable[[SparkSession, str], DataFrame]

# --- fixed values -----------------------------------------------------------
LANG_TOPICS = ["/en/", "/fr/", "/de/", "/es/"]
ARTICLE = ("tag", "article")
FRAME = ("id", "frameInner")
LINK_TOPICS = ["/p/1", "/out", "/p/"]
BUDGET = 20
BASE = "https://b.example"
# ---------------------------------------------------------------------------


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_pages(spark, f"{sf}/pages.parquet")


def _text(e: str) -> str:
    return f"cast(({e}) as varchar(20))"


def page_link(e: str) -> str:
    return f"concat('/p/', {_text(e)})"


def https_link(e: str) -> str:
    return f"concat('https://s.example/p/', {_text(e)})"


SPORT = "https://s.example/sport/"


def sport_link(e: str) -> str:
    return f"concat('/sport/l', {_text(f'({e}) % 3')}, '/p', {_text(e)})"


def sport_url(e: str) -> str:
    """Page 0 is the base page."""
    return f"CASE WHEN {e} = 0 THEN '{SPORT}' ELSE concat('https://s.example', {sport_link(e)}) END"


def splice_sql(link: Callable[[str], str] = page_link, url: Callable[[str], str] | None = None) -> str:
    """(page_id, url, html): the stored pages with an id on the article and, in front
    of its content, links (two children, one of them twice, and the parent), a nested
    region, images of all kinds and elements whose tags cross. Runs on both engines."""
    k = "page_id"
    parent = f"CASE WHEN {k} = 0 THEN 0 ELSE ({k} - 1 - ({k} - 1) % 2) / 2 END"
    parent = f"cast({parent} as bigint)"
    return f"""select page_id, {(url or link)(k)} as url, replace(html, '<article>', concat(
'<article id="frameInner"><h2>Sub ', {_text(f'{k} % 4')}, '</h2>',
'<a href="', {link(f'2*{k}+1')}, '"><img src="https://s.example/l', {_text(f'{k} % 3')}, '.png?w=1"></a>',
'<a href="', {link(f'2*{k}+2')}, '">n</a><a href="', {link(f'2*{k}+1')}, '">again</a><a href="', {link(parent)}, '">up</a>',
'<a href="', {link('2')}, '">fixed</a><a href="/out">out</a><a name="none">no</a>',
'<div id="main"><p>alpha beta t', {_text(f'{k} % 5')}, '</p><p>alpha you’re ', CASE WHEN {k} % 2 = 0 THEN 'beta' ELSE 'gamma' END, '</p></div>',
'<div><p>one<b>two<p>three</b>four</p>five</div><ul><li><div>open</li></ul>',
'<img src="https://s.example/i', {_text(f'{k} % 7')}, '.jpg?w=982&amp;h=1" alt="<p>Alt ', {_text(f'{k} % 5')}, '</p>">',
'<amp-img src="https://s.example/i', {_text(f'{k} % 7')}, '.jpg?w=640"></amp-img>',
'<img src="/rel.svg" alt=""><img alt="nosrc">',
'<img src="http://s.example/j', {_text(f'{k} % 2')}, '.jpg" alt="<p>Alt ', {_text(f'{k} % 5')}, '</p>">')) as html
from pages"""


def spliced(spark: SparkSession, sf: str, link: Callable[[str], str] = page_link,
            url: Callable[[str], str] | None = None) -> DataFrame:
    return spark.sql(splice_sql(link, url).replace("from pages", "from {pages}"), pages=_pages(spark, sf))


def _article_opts(base=V3):
    return replace(base, region=ARTICLE)


# ---------------------------------------------------------------- text ops


def q_h1_html_tokens(spark, sf):
    t = html_tokens(prepare_pages(_pages(spark, sf)))
    return t.select("page_id", "pos", "kind", "tag", "tok", F.col("tlen").cast("bigint").alias("tlen"))


def q_h3_elements_by_tag(spark, sf):
    return elements(prepare_pages(spliced(spark, sf))).select("page_id", "open_pos", "close_pos", "tag")


def _scoped(spark, sf, tags):
    e = elements(prepare_pages(_pages(spark, sf)), [*tags, ARTICLE[1]], text_of=tags)
    return with_region(e, *ARTICLE).where(inside("r") & F.col("tag").isin(tags))


def q_h6_element_text(spark, sf):
    return _scoped(spark, sf, ["p"]).select("page_id", "open_pos", "text")


def q_h4_first_element(spark, sf):
    s = _scoped(spark, sf, ["h1"])
    return s.groupBy("page_id").agg(F.min_by("text", "open_pos").alias("title"))


def q_u1_line_union(spark, sf):
    return article_lines(_pages(spark, sf), _article_opts())


def q_a1_term_doc_count(spark, sf):
    return T.term_doc_count(article_lines(_pages(spark, sf), _article_opts()))


def q_t1_top_terms(spark, sf):
    return T.top_terms(page_term_counts(_pages(spark, sf), _article_opts()), 3)


def q_t2_top_buckets(spark, sf):
    return T.top_terms(page_term_counts(_pages(spark, sf), _article_opts()), 10)


def unclosed(pages: DataFrame) -> DataFrame:
    """The pages without the end tags of their paragraphs, which then nest."""
    return pages.withColumn("html", F.replace("html", F.lit("</p>"), F.lit("")))


def q_a1_unclosed_terms(spark, sf):
    return page_term_counts(unclosed(_pages(spark, sf)), _article_opts())


def q_p7_label_v3_unclosed(spark, sf):
    return render_v3(label_by_topic(unclosed(_pages(spark, sf)), LANG_TOPICS, _article_opts()))


def q_p7_label_v3(spark, sf):
    return render_v3(label_by_topic(_pages(spark, sf), LANG_TOPICS, _article_opts()))


def q_p6_label_v2(spark, sf):
    return render_v3(label_by_topic(_pages(spark, sf), LANG_TOPICS, _article_opts(V2)))


def q_p5_label_v1(spark, sf):
    p = _pages(spark, sf)
    urls = p.select("url", F.col("page_id").alias("ord"))
    return render_v1(jobs.label_v1(p, urls, opts=_article_opts(V1)))


def q_s10_topic_sections(spark, sf):
    lab = label_by_topic(_pages(spark, sf), LANG_TOPICS, _article_opts())
    return R.topic_sections(lab.withColumn("ord", F.col("page_id")))


def q_s5_bulk_payload(spark, sf):
    return L.bulk_payload(article_lines(_pages(spark, sf), _article_opts()))


def _doc_lines(spark, sf):
    return T.text_lines(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text")


def q_x8_documents_top_terms(spark, sf):
    return T.top_terms(T.term_doc_count(_doc_lines(spark, sf), "words"), 3)


def q_x7_documents_letter_terms(spark, sf):
    return T.top_terms(T.term_doc_count(_doc_lines(spark, sf), "letters"), 3)


def q_a1_conversation_terms(spark, sf):
    lines = T.row_lines(spark.read.parquet(f"{sf}/conversations.parquet"), "conv_id", "turn")
    return T.top_terms(T.term_doc_count(lines, "words"), 3)


def q_f14_keyword_copy(spark, sf):
    return _doc_lines(spark, sf).select("page_id", F.col("line_id").cast("bigint").alias("line_id"),
                                        X.keyword_copy(F.col("text")).alias("keyword"))


def q_f_url_functions(spark, sf):
    """The urls tested for F12 are made from the stored ones: as they are, with one
    more segment, and without their scheme."""
    u, k = F.col("url"), F.col("page_id") % 3
    tested = F.when(k == 0, u).when(k == 1, F.concat(u, F.lit("/x"))).otherwise(F.substring_index(u, "//", -1))
    return _pages(spark, sf).select(
        "page_id", U.url_stem(u).alias("stem"), U.label_from_url(u, "https://").alias("label"),
        U.url_valid(tested).alias("valid"), U.rebase(U.url_stem(u), "https://x.example", "/en/").alias("rebased"),
        U.absolutise(u, "https://y.example").alias("absolute"), U.https_only(u).alias("https"),
        U.site_prefix(u, "http://").alias("prefixed"), U.topic_first(u, LANG_TOPICS).alias("topic"))


# --------------------------------------------------------- spliced pages


def _frame_elements(spark, sf, tags):
    return elements(prepare_pages(spliced(spark, sf)), tags, containing=[FRAME[1]])


def q_h2_region_by_id(spark, sf):
    e = with_region(elements(prepare_pages(spliced(spark, sf))), *FRAME)
    return e.where(inside("r")).groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n"))


def _rank(df, pos="open_pos", by=("page_id",)):
    w = Window.partitionBy(*by).orderBy(pos)
    return df.withColumn("ord", F.row_number().over(w).cast("bigint"))


def q_h5_attribute(spark, sf):
    e = elements(prepare_pages(spliced(spark, sf)), ["img", "amp-img"])
    return _rank(e).select("page_id", "ord", "tag", H.attr("tok", "src").alias("src"),
                           H.attr("tok", "alt").alias("alt"))


def q_h7_not_inside_link(spark, sf):
    e = with_region(with_ancestor_flag(_frame_elements(spark, sf, ["a", "img", "amp-img"]), "a"), *FRAME)
    e = e.where(inside("r") & F.col("tag").isin("img", "amp-img") & ~F.col("in_a"))
    return _rank(e).select("page_id", "ord", H.attr("tok", "src").alias("src"))


def q_h8_entity_decode(spark, sf):
    refs = ("concat(url, ' &amp;amp; &eacute;&notit; &copy2020 &#0000', cast(65 + page_id % 26 as varchar(20)), "
            "';&#x', CASE WHEN page_id % 2 = 0 THEN '1F600' ELSE '80' END, '; &lbrace;&unknown; &#99999999999; & &')")
    return _pages(spark, sf).select("page_id", F.expr(refs).alias("t")).select(
        "page_id", H.decode_entities("t").alias("text"))


def q_j1_structural_anti(spark, sf):
    e = with_region(_frame_elements(spark, sf, ["a", "img", "amp-img"]), *FRAME)
    imgs = e.where(inside("r") & F.col("tag").isin("img", "amp-img")).withColumnRenamed("open_pos", "pos")
    a = e.where(F.col("tag") == "a").select("page_id", "open_pos", "close_pos")
    kept = structural_join(imgs, a, "left_anti", pos="pos")
    return _rank(kept, "pos").select("page_id", "ord", H.attr("tok", "src").alias("src"))


def q_j2_structural_containment(spark, sf):
    prepared = prepare_pages(spliced(spark, sf))
    e = elements(prepared, ["p"]).select("page_id", "open_pos", "close_pos")
    txt = html_tokens(prepared).where(F.col("kind") == "text")
    j = structural_join(txt, e, "inner", pos="pos")
    return j.groupBy("page_id", F.col("outer_open_pos").alias("p_pos")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "tok"))),
                                 lambda x: x["tok"]), "").alias("text"))


def q_p9_article_images(spark, sf):
    a = article_images(spliced(spark, sf), replace(V3, region=FRAME))
    return a.select("page_id", X.list_join(F.col("images")).alias("images"))


def q_p1_page_images(spark, sf):
    lines = R.alt_src_lines(jobs.page_images(spliced(spark, sf)))
    return _rank(lines, "pos").select("page_id", "ord", "line")


def q_p8_article_text(spark, sf):
    return jobs.article_text(spliced(spark, sf))


def q_p7_label_v3_spliced(spark, sf):
    return render_v3(label_by_topic(spliced(spark, sf), ["/p/"], V3))


def q_p6_label_v2_spliced(spark, sf):
    return render_v3(label_by_topic(spliced(spark, sf), ["/p/"], V2))


def q_p5_label_v1_list(spark, sf):
    """P5 over a list that names every page of an odd id twice, in falling order."""
    p = spliced(spark, sf)
    urls = p.select("url", F.explode(F.sequence(F.lit(0), F.col("page_id") % 2)).alias("i"), "page_id") \
        .select("url", (-2 * F.col("page_id") + F.col("i")).alias("ord"))
    lab = jobs.label_v1(p, urls)
    return render_v1(lab).select("*").withColumnRenamed("topic", "label")


def q_s9_label_sections(spark, sf):
    rows = jobs.label_by_url(spliced(spark, sf, sport_link, sport_url), SPORT)
    rep = R.label_sections(rows)
    return rep.select("part", F.col("section_ord.ord").alias("section_ord"), F.col("row_ord.ord").alias("page_ord"), "line")


def q_p3_label_by_url(spark, sf):
    rows = jobs.label_by_url(spliced(spark, sf, sport_link, sport_url), SPORT)
    rows = rows.select("label", F.col("ord.ord").alias("page_ord"), F.col("ord.pos").alias("pos"), "alt", "src")
    return _rank(rows, "pos", ("label", "page_ord")).drop("pos")


def q_p2_crawl_images(spark, sf):
    rows = jobs.crawl_images(spliced(spark, sf, https_link), "https://s.example/p/0")
    return _rank(rows.withColumnRenamed("ord", "visit"), "pos", ("url",)).select("url", "visit", "ord", "link")


def q_c1_link_table(spark, sf):
    return _rank(link_table(spliced(spark, sf)), "pos").select("page_id", "ord", "href")


def q_f5_topic_any(spark, sf):
    lt = link_table(spliced(spark, sf))
    return filter_topic_any(_rank(lt, "pos"), LINK_TOPICS[:2]).select("page_id", "ord", "href")


def q_f6_topic_first(spark, sf):
    lt = _rank(link_table(spliced(spark, sf)), "pos")
    return tag_topic_first(lt, LINK_TOPICS).select("page_id", "ord", "href", "topic")


def q_j4_topic_table(spark, sf):
    """Every page's own url is a topic, so their number grows with the table."""
    p = spliced(spark, sf)
    topics = p.select(F.col("url").alias("topic"), (-F.col("page_id")).alias("ord"))
    lt = _rank(link_table(p), "pos").drop("url")
    return tag_topic_join(lt, topics).select("page_id", "ord", "href", "topic")


def q_c2_bfs_crawl(spark, sf):
    d = spliced(spark, sf)
    return bfs_crawl(d, ["/p/0"], link_table(d, region=FRAME)).select("url", "level", "ord")


def q_c2_bfs_budget(spark, sf):
    """Repeated seeds, every url stored twice, and a budget; the seeds do not count."""
    d = spliced(spark, sf)
    d = d.unionByName(d.withColumn("page_id", F.col("page_id") + 1_000_000))
    v = bfs_crawl(d, ["/p/0", "/p/0"], link_table(d, region=FRAME), budget=BUDGET, include_seed=False)
    return v.select("url", "page_id", "level", "ord")


def _crawl_rows(df):
    return df.select("topic", "url", F.col("ord.day_pos").alias("day_pos"), F.col("ord.lpos").alias("lpos"))


def q_c3_two_level_crawl(spark, sf):
    return _crawl_rows(two_level_crawl(spliced(spark, sf), "/p/0", LINK_TOPICS))


def q_p4_extract_links(spark, sf):
    """Relative links, absolute urls: the base is put in front at both levels."""
    p = spliced(spark, sf, page_link, lambda k: f"concat('{BASE}', {page_link(k)})")
    rows = jobs.extract_links(p, f"{BASE}/p/0", LINK_TOPICS, base=BASE, max_days=2)
    return rows.select("url", F.col("ord.day_pos").alias("day_pos"), F.col("ord.lpos").alias("lpos"))


def q_p7_label_v3_crawl(spark, sf):
    """P7 through the crawl; the article /p/2 is linked from every date page."""
    return render_v3(jobs.label_v3(spliced(spark, sf), "/p/0", LINK_TOPICS))


def q_p6_label_v2_crawl(spark, sf):
    return render_v3(jobs.label_v2(spliced(spark, sf), "/p/0", LINK_TOPICS, max_days=2))


#: Every so many pages, one is an archive that lists the pages up to the next.
ARCHIVE_EVERY = 20


def archive_sql() -> str:
    """The spliced pages, each ARCHIVE_EVERY-th with links to the pages that follow it."""
    days = ", ".join(f"""'<a href="', {page_link(f'page_id + {i}')}, '">day</a>'""" for i in range(1, ARCHIVE_EVERY))
    mark = '<a name="none">no</a>'
    return (f"select page_id, url, replace(html, '{mark}', concat('{mark}', CASE WHEN page_id % {ARCHIVE_EVERY} = 0 "
            f"THEN concat({days}) ELSE '' END)) as html from ({splice_sql()}) s")


def archives(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(pages, the archives' URLs): their number grows with the table."""
    pages = spark.sql(archive_sql().replace("from pages", "from {pages}"), pages=_pages(spark, sf))
    return pages, pages.where(F.col("page_id") % ARCHIVE_EVERY == 0).select("url")


def _placed(rows):
    return rows.select("*", F.col("ord.day_pos").alias("day_pos"), F.col("ord.lpos").alias("lpos")).drop("ord")


def q_c3_many_archives(spark, sf):
    pages, roots = archives(spark, sf)
    return _placed(archive_crawls(pages, roots, LINK_TOPICS))


def q_p4_many_archives(spark, sf):
    """The first three date pages of every archive."""
    pages, roots = archives(spark, sf)
    return _placed(jobs.extract_links(pages, roots, LINK_TOPICS, max_days=3))


def q_p6_label_v2_archives(spark, sf):
    pages, roots = archives(spark, sf)
    return render_v3(jobs.label_v2(pages, roots, LINK_TOPICS))


def q_p7_label_v3_archives(spark, sf):
    pages, roots = archives(spark, sf)
    return render_v3(jobs.label_v3(pages, roots, LINK_TOPICS))


def q_l2_first_days(spark, sf):
    """The first links of every page's region."""
    return first_n(link_table(spliced(spark, sf), region=FRAME), "pos", 4, "page_id").select("page_id", "href")


def q_l3_nth_item(spark, sf):
    """The third link of every page's region."""
    return nth_item(link_table(spliced(spark, sf), region=FRAME), "pos", 2, "page_id").select("page_id", "href")


def q_l3_nth_of_all(spark, sf):
    """One link of the list of all pages' links."""
    return nth_item(link_table(spliced(spark, sf), region=FRAME), ["page_id", "pos"], 100).select("page_id", "href")


def q_s3_url_cells(spark, sf):
    """Lines of a URL list, one per page, of 1 to 100 cells, quoted ones among them."""
    line = ("concat(url, ',,\"', replace(url, '/', '\"\"'), ',q\"', repeat(concat(',', url), cast(page_id % 98 as int)))")
    rows = _pages(spark, sf).select("page_id", F.expr(line).alias("line"))
    return L.url_cells(rows, "line", ["page_id"]).select(F.col("ord.page_id").alias("page_id"),
                                                         F.col("ord._c").cast("bigint").alias("cell"), "url")


def q_s2_html_files(spark, sf):
    """Every page written as an HTML file of its own and read back as a page."""
    path = scratch_path(spark, "html")
    write_html_files(_pages(spark, sf), path)
    files = read_html_files(spark, path)
    text = F.expr("substring(html, 1, length(html) - 1)")  # the sink ends a file with a line end
    return files.select(F.regexp_extract("url", "/page_id=([0-9]+)[.]html", 1).cast("bigint").alias("page_id"),
                        (F.col("page_id") == F.xxhash64("url")).alias("keyed"),
                        F.length(text).cast("bigint").alias("chars"), F.sha2(text, 256).alias("sha256"))


def q_s4_url_list(spark, sf):
    """The topic links of all pages written as a URL list (P4's sink) and read back in order."""
    links = filter_topic_any(link_table(spliced(spark, sf)), LINK_TOPICS[:2])
    path = scratch_path(spark, "urls")
    L.write_url_list(links.select(F.col("href").alias("url"), F.struct("page_id", "pos").alias("ord")), path)
    return dense_order(L.read_url_list(spark, path), [F.col("ord")])[0].select("ord", "url")


def q_s6_bulk_source(spark, sf):
    """The payload of each article read back, its first document sent a second time."""
    pay = L.bulk_payload(article_lines(_pages(spark, sf), _article_opts()))
    again = pay.where("line_no <= 2").withColumn("line_no", F.col("line_no") + 1_000_000_000)
    docs = L.bulk_documents(pay.unionByName(again), "page_id", "line_no", "json")
    return docs.select(F.col("source").alias("page_id"), F.col("_id").alias("id"), "pos", "content")


def q_s6_bulk_pairs(spark, sf):
    """The lines of all articles written as compressed bulk pair files and read back."""
    path = scratch_path(spark, "bulk")
    write_bulk_pairs(article_lines(_pages(spark, sf), _article_opts()), path, by_page=True, compression="zstd")
    docs = read_bulk_pairs(spark, path)
    return docs.select(F.col("source").cast("bigint").alias("page_id"), F.col("_id").alias("id"), "content")


def q_s12_match_all(spark, sf):
    lines = article_lines(_pages(spark, sf), _article_opts())
    return L.match_all(lines).select("page_id", "line_id", "text")


def q_s8_page_sections(spark, sf):
    d = spliced(spark, sf)
    imgs = _rank(jobs._page_image_links(d, None, U.https_only), "pos").select(
        F.col("page_id").alias("_ip"), F.col("ord").alias("pos"), F.col("src").alias("link"))
    v = d.select("url", F.col("page_id").cast("bigint").alias("ord"))
    rows = v.join(imgs, v["ord"] == imgs["_ip"], "left").select(
        "url", "ord", F.coalesce("pos", F.lit(0)).cast("bigint").alias("pos"), "link")
    rep = R.page_sections(rows)
    return rep.select(F.col("section_ord.ord").alias("section_ord"), "part",
                      F.col("row_ord.pos").alias("row_ord"), "line")


def q_a4_revisited_images(spark, sf):
    """Every page visited once; of three, one is visited again later and has other
    images then, one was visited before. The keyed state of the stream, over a table."""
    first = spliced(spark, sf, https_link).withColumn("visit", F.col("page_id").cast("bigint"))
    later = first.where("page_id % 3 = 0").withColumn("visit", F.col("visit") + 1_000_000_000) \
        .withColumn("html", F.replace("html", F.lit("https://s.example/i"), F.lit("https://s.example/again")))
    before = first.where("page_id % 3 = 1").withColumn("visit", F.col("visit") - 1_000_000_000)
    rows = I.image_rows(I.latest_images(I.image_lists(first.unionByName(later).unionByName(before))))
    return _rank(rows.withColumnRenamed("ord", "visit"), "pos", ("url",)).select("url", "visit", "ord", "link")


# every q_<name> above, under its name
QUERIES: dict[str, Query] = {n[2:]: f for n, f in list(globals().items()) if n.startswith("q_")}
