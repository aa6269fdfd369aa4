"""Element intervals and texts against an independent stdlib tree builder."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pagelens.operators.elements import elements, inside, structural_join, with_ancestor_flag, with_region
from pagelens.operators.tokens import prepare_pages
from pagelens.plans.label import V3, article_images, article_lines
from treebuilder import parse

PAGES = [
    # unclosed <p><b> nesting: the outer paragraph holds the rest of the region
    "<html><body><article><h1>T</h1><p><b>one<br><p>two</p><p>three</p></article><p>after</p></body></html>",
    # '</p>' inside a script, '>' in an attribute, comment, entity
    '<div id="x"><script>var t="</p>";</script><p title="a>b">x &amp; y<!-- c --></p></div>',
    # stray end tags, a link around an image, void tags, self-closing
    '</p><div><a href="/a"><img src="https://i/1.jpg"></a><img src="https://i/2.jpg"><br/><p/>z</div></b>',
    # p closed by its parent's end
    "<ul><li><p>item one</li><li>item two</li></ul><p>tail",
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, f"/u/{i}", h) for i, h in enumerate(PAGES)],
                                 "page_id long, url string, html string")


def test_p_texts_match_tree_builder(spark, pages):
    els = elements(prepare_pages(pages), ["p"], text_of=["p"])
    got = {}
    for r in els.orderBy("page_id", "open_pos").collect():
        got.setdefault(r.page_id, []).append(r.text)
    for i, h in enumerate(PAGES):
        exp = [p.text() for p in parse(h).find_all({"p"})]
        assert got.get(i, []) == exp, (i, got.get(i), exp)


def test_region_and_link_ancestor(spark, pages):
    els = with_region(with_ancestor_flag(elements(prepare_pages(pages)), "a"), "tag", "div")
    imgs = els.where(inside("r") & (F.col("tag") == "img")).select("page_id", "in_a").collect()
    assert sorted((r.page_id, r.in_a) for r in imgs) == [(2, False), (2, True)]
    # join form of the same test
    e = elements(prepare_pages(pages))
    im = e.where(F.col("tag") == "img").withColumnRenamed("open_pos", "pos")
    a = e.where(F.col("tag") == "a")
    assert structural_join(im, a, "left_anti").count() == 1


def _spliced(spark, ids):
    from pagelens.registry import splice_sql
    base = spark.createDataFrame([(i, "x", "<p>before</p><article><h1>T</h1><p>last</p></article><p>after</p>") for i in ids],
                                 "page_id long, url string, html string")
    return spark.sql(splice_sql().replace("from pages", "from {pages}"), pages=base)


def test_lines_and_images_of_spliced_page(spark):
    page = _spliced(spark, [6])
    lines = [r.text for r in article_lines(page, replace(V3, region=("id", "frameInner"))).orderBy("line_id").collect()]
    assert lines == ["alpha beta t1", "alpha you’re beta", "onetwothreefour", "three", "last", "T", "Sub 2", "<p>Alt 1</p>"]
    imgs = article_images(page, replace(V3, region=("id", "frameInner"))).first().images
    assert imgs == ["https://s.example/i6.jpg", "http://s.example/j0.jpg"]


def test_single_exchange_in_label_plan(spark):
    from pagelens.registry import q_p7_label_v3
    df = q_p7_label_v3(spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # exactly one shuffle of page rows (the texts reuse it), and no window frame that looks ahead
    final = plan.split("== Initial Plan ==")[0]
    assert len([ln for ln in final.splitlines() if "REPARTITION_BY" in ln and "ReusedExchange" not in ln]) == 1
    assert "unboundedfollowing" not in final.lower().replace("unboundedpreceding$(), unboundedfollowing$()", "")


def test_only_listed_pages_are_parsed(spark):
    """The article list meets the pages below the page exchange."""
    from pagelens.plans.label import label_articles
    pages = _spliced(spark, range(30))
    arts = pages.where("page_id IN (3, 5)").select("page_id", F.lit("t").alias("topic"), "url")
    df = label_articles(pages, arts.unionAll(arts), replace(V3, region=("id", "frameInner")))
    assert sorted(r.page_id for r in df.collect()) == [3, 3, 5, 5]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression"):]
    assert "LeftSemi" in below
