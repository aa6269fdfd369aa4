import os
import random

from pyspark.sql import functions as F

from pagelens.functions import urls as U
from pagelens.plans import jobs
from pagelens.plans.crawl import QueuedUrls, bfs_crawl, link_table, two_level_crawl
from pagelens.session import placed
from pagelens.registry import https_link, page_link, splice_sql


def _dec(spark, n=40, link=page_link):
    base = spark.range(n).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                 F.concat(F.lit("<article><h1>Title "), F.col("id"), F.lit("</h1></article>")).alias("html"))
    return spark.sql(splice_sql(link).replace("from pages", "from {pages}"), pages=base)


def test_bfs_budget_is_fifo(spark):
    d = _dec(spark)
    lt = link_table(d, region=("id", "frameInner"))
    v = bfs_crawl(d, ["/p/0"], lt, budget=12).orderBy("ord").collect()
    assert [r.url for r in v] == [f"/p/{i}" for i in range(12)]
    v2 = bfs_crawl(d, ["/p/0"], lt, budget=5, include_seed=False).orderBy("ord").collect()
    assert [r.url for r in v2] == [f"/p/{i}" for i in range(1, 6)]


def test_bfs_visits_repeated_seeds_and_stored_urls_once(spark):
    pages = spark.createDataFrame([(1, "/a", '<a href="/b">b</a>'), (7, "/b", "x"), (4, "/b", "y")],
                                  "page_id long, url string, html string")
    v = bfs_crawl(pages, ["/a", "/a", "/b"], link_table(pages)).orderBy("ord").collect()
    assert [(r.url, r.page_id, r.ord) for r in v] == [("/a", 1, 0), ("/b", 4, 1)]


def test_bfs_order_on_a_long_chain(spark):
    pages = spark.createDataFrame([(i, f"/{i}", f'<a href="/{i + 1}">n</a><a href="/0">first</a>') for i in range(12)],
                                  "page_id long, url string, html string")
    v = bfs_crawl(pages, ["/0"], link_table(pages)).orderBy("ord").collect()
    assert [(r.url, r.level, r.ord) for r in v] == [(f"/{i}", i, i) for i in range(12)]


def _checkpoints(spark):
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return {f for f in os.listdir(root) if f.startswith("rdd-")}


def test_a_deep_crawl_leaves_no_files_behind(spark):
    pages = spark.createDataFrame([(i, f"/{i}", f'<a href="/{i + 1}">n</a><a href="/{i // 2}">b</a>') for i in range(20)],
                                  "page_id long, url string, html string")
    before = _checkpoints(spark)
    v = bfs_crawl(pages, ["/0"], link_table(pages))
    assert len(_checkpoints(spark) - before) == 1  # the numbered result
    assert [r.url for r in v.orderBy("ord").collect()] == [f"/{i}" for i in range(20)]
    before = _checkpoints(spark)
    v = bfs_crawl(pages, ["/0"], link_table(pages), budget=30, dedupe="none")
    assert len(_checkpoints(spark) - before) == 1 and v.count() == 30
    assert bfs_crawl(pages, ["/none"], link_table(pages)).count() == 0


def test_queued_urls_lie_in_few_pieces(spark):
    rnd, seen, all_, left = random.Random(3), QueuedUrls(4), set(), 0
    for size in (1, 1, 1, 50, 3, 9, 2, 2, 400, 1, 1):
        urls = [f"/{rnd.random()}" for _ in range(size)]
        all_ |= set(urls)
        seen.add(spark.createDataFrame([(u,) for u in urls], "url string").repartition(4, "url").checkpoint(), size)
        sizes = [n for _, n, _ in seen.pieces]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:])) and sum(sizes) == len(all_)
    tried = spark.createDataFrame([(u,) for u in [*all_, "/new"]], "url string")
    assert [r.url for r in seen.unseen(tried).collect()] == ["/new"]
    before = _checkpoints(spark)
    seen.close()
    assert before - _checkpoints(spark) and not seen.pieces


def test_a_lookup_shuffles_the_frontier_only(spark):
    seen = QueuedUrls(8)
    for n in (900, 800):
        seen.add(spark.range(n).select(F.col("id").cast("string").alias("url")).checkpoint(), n)
    assert len(seen.pieces) == 1
    seen.add(placed(spark.range(3).select((F.col("id") + 1000).cast("string").alias("url")), 8, "url"), 3)
    assert len(seen.pieces) == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        level = spark.range(2000).select(F.col("id").cast("string").alias("url"), F.array("id").alias("key"))
        found = seen.unseen(level.groupBy("url").agg(F.min("key").alias("key")))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and found.count() == 1097
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_two_level_crawl_and_label(spark):
    d = _dec(spark)
    arts = two_level_crawl(d, "/p/0", ["/p/3", "/p/5"], region=("id", "frameInner"))
    got = [(r.topic, r.url) for r in arts.orderBy("ord").collect()]
    # page 0 links to 1, 2, 1, 0, 2; 1 links twice to 3, and 2 twice to 5
    assert got == [("/p/3", "/p/3")] * 2 + [("/p/5", "/p/5")] * 2 + [("/p/3", "/p/3")] * 2 + [("/p/5", "/p/5")] * 2
    lab = jobs.label_v3(d, "/p/0", ["/p/3", "/p/5"], max_days=1).collect()
    assert [(r.topic, r.title) for r in lab] == [("/p/3", "Title 3")] * 2
    assert lab[0].images == ["https://s.example/i3.jpg", "http://s.example/j1.jpg"]


def test_an_article_on_three_date_pages_has_three_rows(spark):
    fr = '<div id="frameInner">'
    pages = spark.createDataFrame(
        [(0, "/arch", fr + "".join(f'<a href="/d{i}">d</a>' for i in range(3)) + "</div>")]
        + [(i + 1, f"/d{i}", fr + '<a href="/t/x">x</a></div>') for i in range(3)]
        + [(9, "/t/x", fr + "<h1>X</h1><p>one two</p></div>")], "page_id long, url string, html string")
    for job in (jobs.label_v2, jobs.label_v3):
        rows = job(pages, "/arch", ["/t/"]).orderBy("ord").collect()
        assert [(r.url, r.title) for r in rows] == [("/t/x", "X")] * 3
    urls = spark.createDataFrame([("/t/x", 0), ("/t/x", 1)], "url string, ord long")
    assert jobs.label_v1(pages, urls).count() == 2


def test_defaults_cover_everything(spark):
    d = _dec(spark, 40)
    urls = d.select("url", F.col("page_id").alias("ord"))
    assert jobs.label_v1(d, urls).count() == 40
    https = _dec(spark, 25, https_link)
    assert jobs.crawl_images(https, "https://s.example/p/0").select("url").distinct().count() == 25


def test_page_images_keyed_upsert(spark):
    d = _dec(spark, 3)
    rows = jobs.page_images(d).where(F.col("page_id") == 1).orderBy("pos").collect()
    assert [(r.alt, r.src) for r in rows] == [
        (None, "https://s.example/l1.png?w=1"), ("<p>Alt 1</p>", "http://s.example/j1.jpg"),
        ("", "/rel.svg"), ("nosrc", None)]


def test_crawl_images_https_only(spark):
    rows = jobs.crawl_images(_dec(spark, 5, https_link), "https://s.example/p/0", budget=1).collect()
    assert sorted(r.link for r in rows) == ["https://s.example/i0.jpg?w=982&h=1", "https://s.example/l0.png?w=1"]


def test_label_by_url(spark):
    base = "https://s.example/sport/"
    pages = spark.createDataFrame([
        (0, base, '<div id="frameInner"><a href="/sport/football/a1">x</a><a href="/news/x">n</a></div>'),
        (1, base + "football/a1", '<div id="frameInner"><img src="https://i/1.jpg" alt="A"></div>')],
        "page_id long, url string, html string")
    rows = jobs.label_by_url(pages, base, budget=5).collect()
    assert [(r.label, r.alt, r.src) for r in rows] == [("football", "A", "https://i/1.jpg")]
    assert U is not None


def test_topic_table_join_and_list_positions(spark):
    from pagelens.operators.links import first_n, nth_item, tag_topic_join, tag_topic_first
    links = spark.createDataFrame([(0, "/tech/a"), (1, "/news/science/tech/b"), (2, "/sport/c"), (1, "/news/science/tech/b"),
                                   (3, None), (4, ""), (5, "/téch/é")], "pos long, href string")
    topics = spark.createDataFrame([("/news/science/", 0), ("/tech/", 1), ("é", 2)], "topic string, ord long")
    got = sorted((r.pos, r.topic) for r in tag_topic_join(links, topics, key=("pos",)).collect())
    exp = sorted((r.pos, r.topic) for r in tag_topic_first(links, ["/news/science/", "/tech/", "é"]).collect())
    assert got == exp == [(0, "/tech/"), (1, "/news/science/"), (1, "/news/science/"), (5, "é")]
    assert [r.pos for r in first_n(links, "pos", 2).collect()] == [0, 1]
    assert [r.pos for r in nth_item(links, "pos", 3).collect()] == [2]
    assert tag_topic_join(links, topics.limit(0), key=("pos",)).count() == 0


def test_many_topics_without_a_forced_broadcast(spark):
    from pagelens.operators.links import tag_topic_join
    topics = spark.range(20_000).select(F.concat(F.lit("/t"), F.col("id"), F.lit("/")).alias("topic"), F.col("id").alias("ord"))
    links = spark.range(200).select(F.col("id").alias("page_id"), F.lit(0).alias("pos"),
                                    F.concat(F.lit("x/t"), F.col("id") * 99, F.lit("/y/t3/")).alias("href"))
    df = tag_topic_join(links, topics)
    assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()
    got = {r.page_id: r.topic for r in df.collect()}
    assert got == {i: f"/t{min(i * 99, 3)}/" for i in range(200)}


def test_bfs_without_dedupe_revisits(spark):
    pages = spark.createDataFrame([
        (0, "/a", '<a href="/b">b</a><a href="/b">again</a>'),
        (1, "/b", '<a href="/a">a</a>')], "page_id long, url string, html string")
    lt = link_table(pages)
    seen = [r.url for r in bfs_crawl(pages, ["/a"], lt, budget=5).orderBy("ord").collect()]
    assert seen == ["/a", "/b"]
    rep = [r.url for r in bfs_crawl(pages, ["/a"], lt, budget=5, dedupe="none").orderBy("ord").collect()]
    assert rep == ["/a", "/b", "/b", "/a", "/a"]
