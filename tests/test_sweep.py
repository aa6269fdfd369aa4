"""Term counts of nested lines against lines written out, and their growth with the page."""

import random
import re
import time
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pagelens.functions import text as X
from pagelens.operators.sweep import Analyzer, Sweep
from pagelens.plans.label import V1, V3, article_lines, page_labels, page_term_counts
from test_random_html import _doc
from treebuilder import parse

BLANK = re.compile("[\t\n\x0b\f\r\x1c-\x1f   -  -    　]+")


def brute_terms(text, analyzer):
    words = BLANK.split(text.lower()) if analyzer == "words" else re.split(r"[\W\d_]+", text.lower())
    words = [w[i:i + 255] for w in words for i in range(0, len(w), 255)]
    if analyzer == "letters":
        return {w for w in words if w and w not in X.STOP_ENGLISH}
    kept = [w for w in words if w not in X.STOP_ENGLISH + X.STOP_CUSTOM]
    return {t for t in (re.split("['’]", w)[0] for w in kept) if t}


def brute(html, analyzer):
    root = parse(html).find("article")
    if root is None:
        return {}
    lines = [p.text() for p in root.find_all({"p"})]
    if analyzer == "words":
        lines += [n.text() for n in (root.find("h1"), root.find("h2")) if n is not None]
    return dict(Counter(t for line in lines for t in brute_terms(line, analyzer)))


def counts(spark, docs, opts):
    pages = spark.createDataFrame([(i, f"/r/{i}", h) for i, h in enumerate(docs)], "page_id long, url string, html string")
    got = {}
    for r in page_term_counts(pages, replace(opts, region=("tag", "article"))).collect():
        got.setdefault(r.page_id, {})[r.term] = r.n
    return got


def random_page(rng):
    """Paragraphs and inline tags that cut words, nest and are left open."""
    out = []
    for _ in range(rng.randint(1, 60)):
        out.append(rng.choice(["<p>", "<p>", "<p>", "</p>", "<b>", "</b>", "<div>", "</div>", "<h1>", "</h1>", " ", " ", "\n", "&nbsp;",
                               "foo", "bar", "ba", "r", "The", "you’re", "it's", "'", "x" * 200, "é", "7", "can", "not"]))
    return f"<article>{''.join(out)}</article><p>after</p>"


@pytest.mark.parametrize("opts", [V3, V1])
def test_random_pages_equal_lines_written_out(spark, opts):
    rng = random.Random(11)
    docs = [random_page(rng) for _ in range(600)] + [f"<article>{_doc(rng)}</article>" for _ in range(150)]
    got = counts(spark, docs, opts)
    bad = [(h, got.get(i), exp) for i, h in enumerate(docs) for exp in [brute(h, opts.analyzer)] if got.get(i, {}) != exp]
    assert not bad, bad[:1]


def test_the_sweep_equals_the_native_count(spark):
    """Alt texts, titles and odd letters: the counts are those of the lines' own analyzer."""
    from pagelens.operators.terms import term_doc_count
    from pagelens.registry import spliced
    rng = random.Random(3)
    odd = ["İstanbul ΣΑΣ", "a'b\u0085c d’", "x y　z", "ﬁn ǅ ß", "w" * 600 + " end", "\U0001d49c\U0001d4b7 " * 3]
    docs = [f"<article><h1>{rng.choice(odd)}</h1><p>{a}<p>{b}<img src='http://i/1' alt='{c}'>{d}</article>"
            for a in odd for b in odd for c in odd[::5] for d in ["", "tail"]]
    pages = spark.createDataFrame([(i, "/", h.replace("a'b", "a&#39;b")) for i, h in enumerate(docs)],
                                  "page_id long, url string, html string")
    for df, region in ((pages, ("tag", "article")), (spliced(spark, "/root/testdata/sf0.001"), ("id", "frameInner"))):
        for base in (V3, replace(V1, region=None)):
            opts = replace(base, region=region)
            want = {tuple(r) for r in term_doc_count(article_lines(df, opts), opts.analyzer).collect()}
            assert {tuple(r) for r in page_term_counts(df, opts).collect()} == want


def test_one_page_by_hand():
    s = Sweep(Analyzer("words"))
    # <p>one tw<p>o three</p> one</p>: the outer line has "two", the inner one "o"
    s.run(["", "one tw", "", "o three", "", " one", ""], [6, None, 4, None, None, None, None], [0, 2])
    assert s.counts == {"one": 1, "two": 1, "o": 1, "three": 2}
    s = Sweep(Analyzer("words"))
    s.run(["", "x", "", "", "x y", ""], [5, None, 3, 5, None, None], [0, 2, 3])
    assert s.counts == {"xx": 1, "x": 1, "y": 2}


def test_unclosed_paragraphs_grow_with_the_page(spark):
    """Each of n unclosed paragraphs holds all that follow; labels take memory and time of the page's size."""
    def seconds(n):
        html = "<article><h1>T</h1>" + "".join(f"<p>par{i % 7} common w{i} text " for i in range(n)) + "</article>"
        pages = spark.createDataFrame([(0, "/x", html)], "page_id long, url string, html string").repartition(1)
        t = time.time()
        row = page_labels(pages, replace(V3, region=("tag", "article"))).collect()[0]
        assert row["terms"] == ["common", f"par{(n - 1) % 7}", "text"] and row["title"] == "T"
        return time.time() - t

    seconds(1_000)
    small, large = min(seconds(20_000) for _ in range(2)), seconds(80_000)
    assert large < 8 * small + 1


def test_texts_of_nested_elements_are_not_in_one_row(spark):
    """3,000 unclosed paragraphs of 100 characters: 450 MB of texts, one at a time."""
    from pagelens.operators.elements import elements
    from pagelens.operators.tokens import prepare_pages
    html = "".join(f"<p>{i:05d}{'y' * 95}" for i in range(3_000))
    pages = spark.createDataFrame([(0, "/x", html)], "page_id long, url string, html string")
    e = elements(prepare_pages(pages), ["p"], text_of=["p"])
    r = e.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("c")).first()
    assert (r.n, r.c) == (3_000, 100 * 3_000 * 3_001 // 2)


def test_lines_that_do_not_nest_are_not_swept(monkeypatch):
    """Lines with no other in them are counted by themselves, beside nests that are swept."""
    rnd = random.Random(9)
    for _ in range(300):
        texts, ends, opens, want = [], [], [], []
        for _ in range(rnd.randint(1, 6)):
            first, size, at = len(texts), rnd.randint(1, 5), len(texts)
            inner = rnd.choice([0, 0, 1])
            texts += ["".join(rnd.choice(["ab", "c", " ", "de "]) for _ in range(rnd.randint(0, 4))) if j else "" for j in range(size + 2)]
            ends += [None] * (size + 2)
            ends[at] = len(texts) - 1
            texts[-1] = ""
            opens.append(at)
            want.append("".join(texts[first + 1:-1]))
            if inner and size > 1:
                texts[at + 1], ends[at + 1] = "", len(texts) - 1
                opens.append(at + 1)
                want[-1] = "".join(texts[first + 1:-1])
                want.append("".join(texts[first + 2:-1]))
        page = Sweep(Analyzer("words"))
        page.run(texts, ends, opens)
        terms = Analyzer("words")
        assert page.counts == dict(Counter(t for line in want for t in {x for w in line.split(" ") for x in terms(w)}))
    monkeypatch.setattr(Sweep, "to_all", None)
    page = Sweep(Analyzer("words"))
    page.run(["", "apple pe", "ar ", "", "", "pear", ""], [3, None, None, None, 6, None, None], [0, 4])
    assert page.counts == {"apple": 1, "pear": 2}


def test_lists_are_converted_together():
    import pyarrow as pa
    from pagelens.operators.stack import pylists
    rows = [["a", None, "é"], None, [], ["b"]]
    assert pylists(pa.array(rows)) == [["a", None, "é"], [], [], ["b"]]
    assert pylists(pa.array(rows).slice(2)) == [[], ["b"]]
    assert pylists(pa.array([[1, None], None, [3]], pa.list_(pa.int32()))) == [[1, -1], [], [3]]
    assert pylists(pa.array([], pa.list_(pa.string()))) == []
