"""The structural join against a loop over all pairs, and its growth."""

import random
import time

import pytest
from pyspark.sql import functions as F

from pagelens.operators.elements import elements, structural_join
from pagelens.operators.tokens import html_tokens, prepare_pages

POINTS = "page_id long, pos long, tok string"
SPANS = "page_id long, open_pos long, close_pos long, tag string"


def _pairs(points, spans):
    return sorted((p, at, t, o, c, g) for p, at, t in points for q, o, c, g in spans
                  if None not in (p, at, o, c) and p == q and o < at < c)


def _tables(seed, crossing):
    r = random.Random(seed)
    points = [(r.randrange(4), r.randrange(40), str(i)) for i in range(150)]
    points += [(None, 5, "x"), (1, None, "y"), points[0], points[0]]
    if crossing:
        spans = [(r.randrange(5), o, o + r.randrange(30), "p") for o in (r.randrange(40) for _ in range(40))]
    else:
        def nested(page, lo, hi):  # spans within lo..hi, some equal, some that begin or end together
            if hi - lo > 1:
                a = r.randrange(lo, hi)
                b = r.randrange(a, hi) + 1
                m = r.randrange(a, b + 1)
                yield from ((page, a, b, f"n{i}") for i in range(r.randrange(1, 3)))
                for x, y in ((lo, a), (a, m), (m, b), (b, hi)):
                    if (x, y) != (lo, hi):
                        yield from nested(page, x, y)
        spans = [x for p in range(5) for x in nested(p, 0, 40)]
    return points, spans + [(None, 0, 50, "x"), (1, 3, None, "y"), (2, None, 9, "z"), (2, 9, 9, "void"), (2, 9, 3, "back")]


@pytest.mark.parametrize("crossing", [False, True])
def test_equals_all_pairs(spark, crossing):
    points, spans = _tables(3 + crossing, crossing)
    p, s = spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS)
    want = _pairs(points, spans)
    got = structural_join(p, s)
    assert got.columns == ["page_id", "pos", "tok", "outer_open_pos", "outer_close_pos", "outer_tag"]
    if crossing:
        with pytest.raises(Exception, match="intervals of a page cross"):
            got.collect()
    else:
        assert sorted(map(tuple, got.collect())) == want
    held = {w[:3] for w in want}
    key = lambda x: tuple(str(v) for v in x)
    for how, inside in (("left_semi", True), ("left_anti", False)):
        rows = sorted((tuple(x) for x in structural_join(p, s, how).collect()), key=key)
        assert rows == sorted((x for x in points if (x in held) is inside), key=key)


def test_empty_tables_and_names(spark):
    p, s = spark.createDataFrame([(1, 2, "a")], POINTS), spark.createDataFrame([(1, 1, 9, "p")], SPANS)
    assert structural_join(p.limit(0), s).count() == 0 and structural_join(p, s.limit(0)).count() == 0
    assert structural_join(p, s.limit(0), "left_anti").count() == 1
    # columns named as those the join uses inside, and a point column with a dot
    q = p.select("page_id", F.col("pos").alias("at"), F.lit(7).alias("n"), F.lit(8).alias("d"), F.lit(9).alias("a.b"))
    assert [tuple(x) for x in structural_join(q, s, pos="at").collect()] == [(1, 2, 7, 8, 9, 1, 9, "p")]
    assert structural_join(q, s, "left_semi", pos="at").columns == q.columns
    dotted = structural_join(q, s.withColumn("x.y", F.lit(3)), pos="at")
    assert dotted.columns[-2:] == ["outer_tag", "outer_x.y"] and dotted.collect()[0][-1] == 3
    with pytest.raises(ValueError):
        structural_join(p.withColumn("outer_tag", F.lit(1)), s)
    with pytest.raises(ValueError):
        structural_join(p, s, "left")


def test_deep_nesting(spark):
    """A point inside very many intervals, and repeated points."""
    spans = [(1, i, 1000 - i, "s") for i in range(300)]
    points = [(1, 301, "deep"), (1, 1, "flat"), (1, 1, "flat")]
    got = structural_join(spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS)).collect()
    assert sorted(map(tuple, got)) == _pairs(points, spans)


def test_rows_lie_by_page_already(spark):
    """Behind the page exchange neither the join nor a group by page adds one of its own."""
    pages = spark.createDataFrame([(1, "u", "<p>a</p><a><img></a>")], "page_id long, url string, html string")
    e = elements(prepare_pages(pages))
    im, a = e.where("tag = 'img'").withColumnRenamed("open_pos", "pos"), e.where("tag = 'a'")
    for how in ("inner", "left_anti"):
        j = structural_join(im, a.select("page_id", "open_pos", "close_pos"), how)
        assert j.count() == (1 if how == "inner" else 0)
        plan = j.groupBy("page_id", "pos").count()._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SortMergeJoin" not in plan
        assert "InArrow" not in plan and plan.count("Exchange") == 2 and plan.count("REPARTITION_BY_NUM") == 2  # the page exchange of either side


def test_time_grows_with_points_and_pairs(spark):
    """Four times the paragraphs of one page take far less than sixteen times as long."""
    def run(n):
        page = spark.createDataFrame([(1, "u", "<p>w</p>" * n)], "page_id long, url string, html string")
        prepared = prepare_pages(page)
        e = elements(prepared, ["p"]).select("page_id", "open_pos", "close_pos")
        t = time.time()
        assert structural_join(html_tokens(prepared).where("kind = 'text'"), e).count() == n
        return time.time() - t
    run(100)
    small, large = run(20_000), run(80_000)
    assert large < 8 * small + 2, (small, large)
