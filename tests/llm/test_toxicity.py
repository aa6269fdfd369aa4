from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from pagelens.llm import toxicity
from pagelens.llm.queries import op6_toxicity, remainder
from tests.llm.helpers import empty_docs, odd_docs

SF = "/root/testdata/sf0.1"


def model_of(spark, sf=SF):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fold = remainder("doc_id", 5) != 0
    return toxicity.fit(docs.where(fold).select("doc_id", "text"), labels.where(fold))


def test_held_out_accuracy(spark):
    got = op6_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    clean, toxic = n.get((0, 0), 0) + n.get((0, 1), 0), n.get((1, 0), 0) + n.get((1, 1), 0)
    assert n[1, 1] / toxic >= 0.85 and n.get((0, 1), 0) / clean <= 0.02


def test_nearest_are_those_of_a_full_scan(spark):
    parts = model_of(spark)
    index = toxicity.build(parts)
    dense = np.zeros((len(index.ids), len(index.idf)))
    for d, (ts, ns) in enumerate(parts[4]):
        t, w = index.vector(Counter(dict(zip(ts, ns))))
        dense[d, t] = w
    for d in range(0, len(index.ids), 7):
        q = dense[d] * (np.arange(len(index.idf)) % 3 > 0)
        ts = np.flatnonzero(q)
        near, cos = index.nearest(ts, q[ts])
        full = dense @ q
        best = sorted(((-full[i], index.ids[i]) for i in np.flatnonzero(full > 0)))[:toxicity.NEAREST]
        assert np.allclose([-s for s, _ in best], cos, atol=1e-12)
        assert len(near) == len(best)


def test_blocks_beyond_the_bound_are_not_scored(spark):
    """One term: the blocks whose largest weight is below the best one are left out."""
    n = 40 * toxicity.BLOCK
    ids, labels = np.arange(n), np.zeros(n)
    vectors = [([0], [1.0 if d < 3 else 0.2 + 0.5 * (d % 7) / 7]) for d in range(n)]
    index = toxicity.Index(np.ones(1), ids, labels, vectors)
    seen = []
    real = index.scored
    index.scored = lambda ts, ws, blocks: seen.append(len(blocks)) or real(ts, ws, blocks)
    near, cosines = index.nearest(np.array([0]), np.array([1.0]), k=3)
    assert near.tolist() == [0, 1, 2] and cosines.tolist() == [1, 1, 1] and sum(seen) == toxicity.PROBE
    near, _ = index.nearest(np.array([0]), np.array([1.0]), k=3, leave=1)
    assert near.tolist()[:2] == [0, 2] and near[2] == 6


def test_held_out_labels_are_not_read(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fold = remainder("doc_id", 5) != 0
    flipped = labels.withColumn("toxic", F.when(fold, F.col("toxic")).otherwise(1 - F.col("toxic")))
    a = toxicity.fit(docs.where(fold).select("doc_id", "text"), labels.where(fold))
    b = toxicity.fit(docs.where(fold).select("doc_id", "text"), flipped.where(fold))
    assert a[0] == b[0] and a[4] == b[4] and (a[5] == b[5]).all()


def test_every_example_is_in_the_index(spark):
    """Each labelled text, with all its words, is found as its own nearest example."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fold = remainder("doc_id", 5) != 0
    used = docs.where(fold).join(labels.where(fold & F.col("toxic").isin(0, 1)).select("doc_id", "toxic"), "doc_id").cache()
    parts = model_of(spark, sf)
    assert len(parts[2]) == used.select(F.coalesce("text", F.lit(""))).distinct().count()
    rows = toxicity.score(used.where(F.col("text").rlike("[a-z]")).select("doc_id", "text", "toxic"), parts).collect()
    assert sum(r["toxic"] for r in rows) >= 40
    assert all(r["evidence"] and abs(r["evidence"][0]["cosine"] - 1) < 1e-9 for r in rows)
    texts = [r["t"] for r in docs.where(fold).select(F.coalesce("text", F.lit("")).alias("t")).collect()]
    known = [set(toxicity.counted(t)) for t in texts]
    total, n = toxicity.document_frequencies(docs.where(fold).select("text"), parts[0])
    assert total == len(texts) and all(n[i] == sum(w in k for k in known) for w, i in list(parts[0].items())[::500])


def test_odd_rows(spark):
    model = model_of(spark, "/root/testdata/sf0.01")
    df = odd_docs(spark).withColumn("score", F.lit("old"))
    rows = toxicity.score(df, model).collect()
    assert len(rows) == 12 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    kept = toxicity.score(df, model, keep_text=True)
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == {(r["doc_id"], r["text"]) for r in df.collect()}
    assert toxicity.score(empty_docs(spark), model).count() == 0
    labels = spark.createDataFrame([(1, None), (None, 1), (1, 1), (1, 0), (2, 0), (2, 7), (77, 1)], "doc_id long, toxic int")
    tiny = toxicity.fit(odd_docs(spark), labels)
    assert toxicity.score(odd_docs(spark), tiny).count() == 12
    nothing = toxicity.fit(odd_docs(spark), labels.limit(0))
    assert {r["score"] for r in toxicity.score(odd_docs(spark), nothing).collect()} == {0.0}


def test_words_are_read_and_looked_up_once(monkeypatch):
    texts = [None, "", "It's 2 fine_days, NO-one\x00at Émile's ½ ² naïve", "Plain ASCII: a1b2_c\tD\n" + "".join(map(chr, range(128))),
             "".join(map(chr, range(0x250)))]
    assert [toxicity.words_of(t) for t in texts] == [toxicity.WORD.findall((t or "").lower()) for t in texts]

    class Once(dict):
        asked = 0

        def get(self, *args):
            Once.asked += 1
            return dict.get(self, *args)

        __contains__ = __getitem__ = None
    assert toxicity.numbered(toxicity.counted("b a b c"), Once(a=4, b=7)) == {7: 2, 4: 1} and Once.asked == 3
    monkeypatch.setattr(toxicity, "WORD", None)  # plain ASCII does without the pattern
    assert toxicity.counted("Ab, ab; c") == {"ab": 2, "c": 1}
