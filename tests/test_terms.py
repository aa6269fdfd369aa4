"""Terms of articles of very different sizes."""

from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from pagelens.operators import terms as T

WORDS = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]


def turns(n):
    """Every other row is a turn of conversation 0."""
    return [(0 if i % 2 else i, i, " ".join(WORDS[(i * j * j + i) % 200] for j in range(12))) for i in range(n)]


def brute(rows, k=None):
    counts: dict = {}
    for page, _, text in rows:
        counts.setdefault(page, Counter()).update(set(text.split()))
    return {(p, t, n) for p, c in counts.items() for t, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:k]}


@pytest.fixture()
def hot(spark):
    return spark.createDataFrame(turns(6000), "conv_id long, turn long, text string").coalesce(1)


def test_counts_of_a_hot_article_equal_brute_force(spark, hot):
    for partitions in (None, 0, 3):
        n = T.term_doc_count(T.row_lines(hot, "conv_id", "turn", partitions=partitions), "words")
        assert {tuple(r) for r in n.select("page_id", "term", "n").collect()} == brute(turns(6000))
        top = T.top_terms(n, 3).select("page_id", "term", "n").collect()
        assert {tuple(r) for r in top} == brute(turns(6000), 3)


def test_no_task_holds_the_hot_article(spark, hot):
    """Half the rows are one conversation: neither its lines nor its counts lie in one task."""
    lines = T.row_lines(hot, "conv_id", "turn")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as the sizes would join small partitions
    try:
        for rows in (lines, T.term_doc_count(lines, "words").where("page_id = 0")):
            sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            assert len(sizes) > 4 and max(sizes) <= 3 * median(sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_counts_meet_by_article_and_term_and_ranks_are_cut_before_their_shuffle(spark, hot):
    plan = T.top_terms(T.term_doc_count(T.row_lines(hot, "conv_id", "turn"), "words"), 3) \
        ._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("page_id" in e and "term" in e for e in exchanges)
    assert plan.count("WindowGroupLimit") == 2 and "partial_count" in plan


def test_many_rows_of_one_document(spark):
    docs = spark.createDataFrame([(1, f"alpha beta{i}\ngamma") for i in range(500)] + [(2, None), (3, "")],
                                 "doc_id long, text string")
    n = {(r.page_id, r.term): r.n for r in T.term_doc_count(T.text_lines(docs), "words").collect()}
    assert n[1, "alpha"] == 500 and n[1, "gamma"] == 500 and n[1, "beta7"] == 1
    assert {p for p, _ in n} == {1}
