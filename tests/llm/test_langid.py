from pyspark.sql import functions as F

import numpy as np
from pagelens.llm import langid
from pagelens.llm.queries import op2_langid, remainder
from tests.llm.helpers import empty_docs, odd_docs

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op2_langid(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    r = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.min("score"), F.max("score")).first()
    assert r["a"] >= 0.97 and r[1] >= 0 and r[2] <= 1


def test_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = remainder("doc_id", 4) == 2
    noisy = docs.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang")))
    a, b = langid.fit(docs.where(~held)), langid.fit(noisy.where(~held))
    assert a.langs == b.langs and all((x == y).all() for x, y in zip(a.tables, b.tables))


def test_filters_against_plain_sets(spark):
    """Members are never missed, and the corrected counts are near those of exact sets."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    texts, sets = {}, {}
    for r in docs.collect():
        texts.setdefault(r["lang"], []).append(np.unique(langid.grams(r["text"].encode())))
    for lang, lists in texts.items():
        codes, n = np.unique(np.concatenate(lists), return_counts=True)
        sets[lang] = codes[n >= max(1, int(len(lists) * langid.SHARE))]
    bits = {lang: np.uint64(1 << i) for i, lang in enumerate(model.langs)}
    for lang, codes in sets.items():
        mask = np.bitwise_and.reduce([model.tables[0][p] for p in langid.probes(codes)])
        assert (mask & bits[lang] != 0).all()
    for r in docs.limit(30).collect():
        codes = langid.grams(r["text"].encode())
        found, n = model.counts(r["text"].encode())
        exact = np.array([np.isin(codes, sets[x]).sum() for x in model.langs])
        assert n == len(codes) and (np.abs(found - exact) <= 0.02 * n + 5).all()


def test_chunks_give_the_counts_of_the_whole(spark, monkeypatch):
    model = langid.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    text = "Étude of the thing and the ring ".encode() * 40
    whole, n = model.counts(text)
    monkeypatch.setattr(langid, "CHUNK", 97)
    parts, m = model.counts(text)
    assert n == m and np.allclose(whole, parts, atol=1e-6)


def test_odd_rows(spark):
    model = langid.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    df = odd_docs(spark).withColumn("lang_pred", F.lit("old"))
    rows = langid.identify(df, model).collect()
    assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (3, 4, 5)} == {"und"}
    digits = spark.createDataFrame([(1, "123 _ !!")], "doc_id long, text string")
    assert langid.identify(digits, model).first()["lang_pred"] == "und"
    assert langid.identify(empty_docs(spark), model).count() == 0
    none = langid.fit(empty_docs(spark))
    assert langid.identify(odd_docs(spark), none).count() == 12
    langid.identify(odd_docs(spark), langid.fit(odd_docs(spark))).collect()


def test_more_languages_than_a_mask_holds(spark):
    """150 languages with words of their own: each is found again."""
    def word(i, j):
        return "".join(chr(97 + (i * 7 + j * 3 + d * (i + 3)) % 26) for d in range(6)) + chr(97 + i % 26) + chr(97 + i // 26)

    rows = [(i * 10 + k, " ".join(word(i, (j + k) % 9) for j in range(30)), f"l{i:03d}") for i in range(150) for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert len(model.tables) == 3
    got = langid.identify(df, model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
