"""Topic tables on long links, list positions, and crawls from many archives."""

import random
import time

import pytest
from pyspark.sql import functions as F

from pagelens.operators.links import GRAM, first_n, nth_item, tag_topic_first, tag_topic_join, topic_index
from pagelens.plans import jobs
from pagelens.plans.crawl import archive_crawls, two_level_crawl
from pagelens.plans.label import V3


def test_random_topics_equal_the_topic_list(spark):
    """Topics of 0 to 14 characters, overlapping, repeated and null, on links with and without them."""
    rng = random.Random(5)

    def word(n):
        return "".join(rng.choice("ab/é😀%_") for _ in range(n))
    links = [(i, word(rng.randint(0, 40))) for i in range(400)] + [(400, None), (401, "")]
    topics = [word(rng.randint(1, 14)) for _ in range(60)]
    for some in (topics, topics[:5] + ["no such topic", "q"], ["zz", ""]):
        t = spark.createDataFrame([(x, i) for i, x in enumerate(some)] + [(some[0], 99), (None, -1)], "topic string, ord long")
        df = spark.createDataFrame(links, "pos long, href string")
        got = {(r.pos, r.topic) for r in tag_topic_join(df, t, key=("pos",)).collect()}
        want = {(p, next(x for x in some if x in h)) for p, h in links if h is not None and any(x in h for x in some)}
        assert got == want


def test_topics_lie_under_their_rarest_piece(spark):
    t = spark.range(2_000).select(F.format_string("/topic/number-%04d/", "id").alias("topic"), F.col("id").alias("ord"))
    index, lengths = topic_index(t)
    assert lengths == [GRAM]
    assert index.groupBy("gram").count().agg(F.max("count")).first()[0] == 1


def _long(spark, size, topics=20_000):
    rng = random.Random(size)
    href = "https://x.example/" + "/".join(f"seg{rng.randint(0, 10 ** 9)}" for _ in range(size // 12))
    links = spark.createDataFrame([(0, 0, href + "/t777/"), (1, 0, href)], "page_id long, pos long, href string")
    # topics of many lengths, only one of which is in the link
    table = spark.range(topics).select(F.concat(F.lit("/t"), F.col("id"), F.lit("/"), F.repeat(
        F.lit("x"), F.when(F.col("id") == 777, 0).otherwise(F.col("id") % 40).cast("int"))).alias("topic"), F.col("id").alias("ord"))
    t = time.time()
    rows = tag_topic_join(links, table).collect()
    assert [(r.page_id, r.topic) for r in rows] == [(0, "/t777/")]
    return time.time() - t


def test_time_grows_with_the_link(spark):
    """A link of 100 KB against 20,000 topics takes seconds, one of 400 KB about four times as long."""
    _long(spark, 2_000)
    small, large = min(_long(spark, 100_000) for _ in range(2)), _long(spark, 400_000)
    assert small < 30 and large < 8 * small + 2


def test_a_link_that_holds_every_topic(spark):
    topics = spark.range(3_000).select(F.concat(F.lit("/t"), F.col("id"), F.lit("/")).alias("topic"), (-F.col("id")).alias("ord"))
    links = spark.createDataFrame([(0, 0, "".join(f"/t{i}/" for i in range(3_000)))], "page_id long, pos long, href string")
    assert [r.topic for r in tag_topic_join(links, topics).collect()] == ["/t2999/"]


def test_list_positions(spark):
    rows = [(g, i) for g in range(5) for i in range(g * 3)]
    df = spark.createDataFrame(rows, "g long, pos long").repartition(4)
    got = sorted(tuple(r) for r in first_n(df, "pos", 4, "g").collect())
    assert got == [(g, i) for g, i in rows if i < 4]
    assert sorted(tuple(r) for r in nth_item(df, "pos", 5, "g").collect()) == [(2, 5), (3, 5), (4, 5)]
    whole = sorted(rows)
    for n in (0, 1, 7, 29, 30):
        assert [tuple(r) for r in nth_item(df, ["g", "pos"], n).collect()] == whole[n:n + 1]
    assert nth_item(df.limit(0), "pos", 0).count() == 0
    plan = first_n(df, "pos", 4, "g")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.fixture(scope="module")
def archive_pages(spark):
    """Three archives; /d2 is listed by all of them, /d9 is not stored."""
    def page(i, url, links, text=""):
        return (i, url, '<div id="frameInner">' + "".join(f'<a href="{u}">x</a>' for u in links) + f"<p>{text}</p></div>")
    return spark.createDataFrame([
        page(0, "/a0", ["/d1", "/d2", "/d9", "/d1"]), page(1, "/a1", ["/d2", "/d3"]), page(2, "/a2", ["/d2"]),
        page(3, "/d1", ["/tech/1", "/other", "/tech/2"]), page(4, "/d2", ["/sci/1", "/tech/1"]), page(5, "/d3", ["/sci/2"]),
        page(6, "/tech/1", [], "apple pie"), page(7, "/sci/1", [], "atom"), page(8, "/sci/2", [], "quark")],
        "page_id long, url string, html string")


def test_many_archives_equal_each_alone(spark, archive_pages):
    topics = ["/tech/", "/sci/"]
    roots = spark.createDataFrame([("/a0",), ("/a1",), ("/a2",), ("/a1",), ("/none",)], "url string")
    for options in ({}, {"max_days": 1}, {"max_days": 2}, {"distinct_links": True}):
        rows = archive_crawls(archive_pages, roots, topics, **options).collect()
        got = sorted((r.root, r.topic, r.url, r.ord.day_pos, r.ord.lpos) for r in rows)
        want = sorted((a, r.topic, r.url, r.ord.day_pos, r.ord.lpos) for a in ("/a0", "/a1", "/a2")
                      for r in two_level_crawl(archive_pages, a, topics, **options).collect())
        assert got == want and got
    lab = jobs.label_v3(archive_pages, roots, topics)
    assert sorted((r.root, r.url, tuple(r.terms)) for r in lab.collect()) == sorted([
        *[("/a0", "/tech/1", ("apple", "pie"))] * 3, ("/a0", "/sci/1", ("atom",)), ("/a1", "/sci/1", ("atom",)),
        ("/a1", "/tech/1", ("apple", "pie")), ("/a1", "/sci/2", ("quark",)), ("/a2", "/sci/1", ("atom",)), ("/a2", "/tech/1", ("apple", "pie"))])
    assert V3.top_k == 3 and archive_crawls(archive_pages, roots.limit(0), topics).count() == 0


def test_the_first_topic_of_the_list_wins(spark):
    links = spark.createDataFrame([(0, "/news/tech/1")], "pos long, href string")
    assert tag_topic_first(links, ["/tech/", "/news/"]).first().topic == "/tech/"
