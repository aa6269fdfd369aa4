"""Random documents: element texts and ends equal the stdlib tree builder's.

Trees of nested elements where any end tag may be left out or stand at the
wrong place, with void and self-closing tags, entities and stray end tags.
"""

import random
import time

from pagelens.operators.elements import elements
from pagelens.operators.stack import ends
from pagelens.operators.tokens import prepare_pages
from treebuilder import parse

TAGS = ["div", "p", "b", "span", "li", "a"]
WORDS = ["alpha", "beta", "x &amp; y", "caf&eacute;", "q&#8217;s", "1 &lt; 2", " ", "\n"]


def _doc(rng: random.Random, depth: int = 0) -> str:
    out = []
    for _ in range(rng.randint(1, 4)):
        r = rng.random()
        if r < 0.35 or depth > 4:
            out.append(rng.choice(WORDS))
        elif r < 0.45:
            out.append(rng.choice(["<br>", "<img src='i.png'>", "<hr/>", "<p/>"]))
        elif r < 0.55:
            out.append(f"</{rng.choice(TAGS + ['i', 'br'])}>")  # closes what is open by chance, or nothing
        else:
            tag = rng.choice(TAGS)
            close = "" if rng.random() < 0.3 else f"</{tag}>"
            out.append(f"<{tag}>{_doc(rng, depth + 1)}{close}")
    return "".join(out)


def _elements(spark, docs, tags):
    pages = spark.createDataFrame([(i, f"/r/{i}", h) for i, h in enumerate(docs)],
                                  "page_id long, url string, html string")
    got = {}
    for r in elements(prepare_pages(pages), tags, text_of=tags).orderBy("page_id", "open_pos").collect():
        got.setdefault(r.page_id, []).append((r.tag, r.text))
    return got


def test_random_documents_match_tree_builder(spark):
    rng = random.Random(7)
    docs = [f"<body><div>{_doc(rng)}</div></body>" for _ in range(200)]
    got = _elements(spark, docs, TAGS)
    bad = [(h, got.get(i), exp) for i, h in enumerate(docs)
           for exp in [[(n.tag, n.text()) for n in parse(h).find_all(set(TAGS))]] if got.get(i, []) != exp]
    assert not bad, bad[:2]


def test_crossing_elements(spark):
    h = "<div><p>a<b>b<p>c</b>d</p>e</div>"
    assert _elements(spark, [h], ["p"])[0] == [("p", "abcd"), ("p", "c")]
    cell = "<div id='x'><table><tr><td><div>in</td></tr></table></div><p>out</p>"
    assert _elements(spark, [cell], ["div"])[0][0] == ("div", "in")


def test_scripts_quotes_and_custom_elements(spark):
    docs = ["<script-x>hidden</script-x><p>b</p><script>1</script>", "<p>a<script>var x='<p>z</p>'",
            '<p class="x>hello</p><b>c</b>', "<style a='>'>x</style >y<p>k"]
    tags = ["p", "b", "script", "style", "script-x"]
    got = _elements(spark, docs, tags)
    for i, h in enumerate(docs):
        assert got[i] == [(n.tag, n.text()) for n in parse(h).find_all(set(tags))], h


def test_a_tag_with_an_odd_quote_is_text(spark):
    """Decided on purpose: quotes pair within a tag, and a start without its closing
    quote is text, even where a later tag has quotes of its own."""
    assert _elements(spark, ['<p class="x>hello</p><b title="q">c</b>'], ["p", "b"])[0] == [("b", "c")]


def test_time_grows_with_the_page(spark):
    """A page four times as long takes about four times as long, not sixteen."""
    def seconds(n):
        html = "<article>" + "".join(f"<p>par <b>{i}</b> text" + ("</p>" if i % 5 else "</b></p>") for i in range(n)) + "</article>"
        pages = spark.createDataFrame([(0, "/x", html)], "page_id long, url string, html string").repartition(1)
        t = time.time()
        rows = elements(prepare_pages(pages), ["p"], text_of=["p"]).collect()
        assert len(rows) == n and rows[-1]["text"] == f"par {n - 1} text"
        return time.time() - t

    seconds(2_000)
    small, large = min(seconds(20_000) for _ in range(2)), seconds(80_000)
    assert large < 8 * small + 1


def test_the_stack_pass_is_linear():
    deep = ["p"] * 100_000 + ["/q"] * 100_000 + ["/p"] * 100_000
    t = time.time()
    assert ends(deep)[0] == 299_999 and ends(["p", "b", None, "/p", "/b", ""]) == [3, 3, None, None, None, 5]
    assert time.time() - t < 3
