import html
import html.entities

from pyspark.sql import functions as F

from pagelens.functions import html as H
from pagelens.functions import text as X
from pagelens.functions import urls as U


def test_entity_decoding_matches_stdlib(spark):
    cases = ["a &amp; b", "&amp;lt;", "caf&eacute; &#8217;s &#x41;&#65;", "&#146; &#0; &#xD800;",
             "AT&T &copy; &middot; &quot;q&quot;", "&nbsp;x&unknown;", "plain", "&lt;p&gt;",
             "&nbsp x", "&amp b", "&copy2020", "&notit;", "&ampamp;", "&#000000065;", "&#x00041 &#65a", "&#;&#x;&;& &",
             "&#99999999999;", "&#x110000;", "&#1;&#128;", "x&y=z &ltx"]
    # every named reference of the standard library, with and without what follows
    cases += [f"a &{n} b" for n in html.entities.html5] + [f"&{n.rstrip(';')}x1" for n in html.entities.html5]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r.d for r in df.select(H.decode_entities("s").alias("d")).collect()]
    assert [(c, g) for c, g in zip(cases, got) if g != html.unescape(c)] == []


def test_attributes_last_wins_and_quotes(spark):
    toks = ['<img src="a.jpg?x=1&amp;y=2" alt="x src=y" src="b.jpg">', "<img alt src='c'>",
            "<a href=/x/y>", '<img data-src="z" alt="">', '<img alt=">" src=d>']
    df = spark.createDataFrame([(t,) for t in toks], "tok string")
    rows = df.select(H.attr("tok", "src").alias("src"),
                     H.attr("tok", "alt").alias("alt")).collect()
    assert [(r.src, r.alt) for r in rows] == [
        ("b.jpg", "x src=y"), ("c", ""), (None, None), (None, ""), ("d", ">")]


def test_words_analyzer_stop_before_apostrophe(spark):
    df = spark.createDataFrame([("You’re the best; you're it January: – Sony’s",)], "t string")
    got = df.select(X.analyze(F.col("t"), "words").alias("a")).first().a
    # 'you’re' passes the stop list, then becomes 'you'; punctuation stays
    assert got == ["you", "best;", "you", "january:", "–", "sony"]
    d = df.select(X.distinct_terms(F.col("t"), "words").alias("a")).first().a
    assert sorted(d) == sorted(set(got))


def test_letters_analyzer(spark):
    df = spark.createDataFrame([("Sony’s new TV is a hit",)], "t string")
    assert df.select(X.analyze(F.col("t"), "letters").alias("a")).first().a == [
        "sony", "s", "new", "tv", "hit"]


def test_letters_are_lower_cased_one_by_one(spark):
    df = spark.createDataFrame([("İstanbul ΟΔΟΣ",)], "t string")
    r = df.select(X.letter_tokens(F.col("t")).alias("l"), X.distinct_terms(F.col("t"), "letters").alias("d"),
                  X.lowercase(X.space_tokens(F.col("t"))).alias("s"), X.distinct_terms(F.col("t"), "words").alias("w")).first()
    assert r.l == r.d == r.s == r.w == ["istanbul", "οδοσ"]


def test_url_functions(spark):
    df = spark.createDataFrame([("https://www.x.co.uk/sport/football/a.html?x=1",)], "u string")
    r = df.select(U.url_stem(F.col("u")).alias("stem"),
                  U.label_from_url(F.col("u"), "https://www.x.co.uk/sport/").alias("label"),
                  U.url_valid(F.col("u")).alias("ok"),
                  U.topic_first(F.col("u"), ["/news/", "/sport/", "/football"]).alias("topic"),
                  U.rebase(F.lit("/sport/rugby/sport/x"), "https://b/").alias("rebased")).first()
    assert r.stem == "https://www.x.co.uk/sport/football/a.html"
    assert r.label == "football/a.html".split("/")[0] or r.label == "a.html"
    assert r.ok is True and r.topic == "/sport/" and r.rebased == "https://b/rugbyx"


def test_list_render(spark):
    lists = [["a", "b"], [], ["it's", "b"], ['say "x"'], ["it's \"x\""], ["back\\slash", "line\nbreak\t"]]
    df = spark.createDataFrame([(x,) for x in lists], "x array<string>")
    rows = df.select("x", X.list_join(F.col("x")).alias("j"), X.list_literal(F.col("x")).alias("l")).collect()
    assert [(r.j, r.l) for r in rows] == [(", ".join(r.x), repr(r.x)) for r in rows]


def test_long_tokens_cut_at_255(spark):
    long = "x" * 600
    df = spark.createDataFrame([(f"a {long} b",)], "t string")
    got = df.select(X.space_tokens(F.col("t")).alias("s"), X.letter_tokens(F.col("t")).alias("l")).first()
    assert [len(t) for t in got.s] == [1, 255, 255, 90, 1]
    assert [len(t) for t in got.l] == [1, 255, 255, 90, 1]
