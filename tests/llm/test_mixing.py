import hashlib
import re

from pyspark.sql import functions as F

from pagelens.llm import mixing
from tests.llm.helpers import empty_docs, odd_docs


def brute(rows, most=3):
    size = {}
    for i, t, s in rows:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    total, over = sum(size.values()), set()
    while True:
        rest = sum(w[s] for s in order if s not in over)
        level = (total - sum(most * size[s] for s in over)) / rest if rest else 0
        new = {s for s in order if s not in over and most * size[s] < level * w[s]}
        if not new:
            break
        over |= new
    target = {s: min(float(most * size[s]), level * w[s]) for s in order}
    return size, target


def check(df, **options):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
    size, target = brute(rows)
    got = mixing.mix(df, **options).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["__source_size"] == size[r["source"]]
        assert abs(r["__target"] - target[r["source"]]) < 1e-6 * max(1, target[r["source"]])
        assert 0 <= r["__copies"] <= 3
        rate = r["__target"] / r["__source_size"] if r["__source_size"] else 0
        key = r["doc_id"] if r["doc_id"] is not None else hashlib.md5(r["text"].encode()).hexdigest() if r["text"] is not None else ""
        coin = int(hashlib.md5(f"17:{key}".encode()).hexdigest()[:12], 16) / 2 ** 48
        assert r["__copies"] == int(rate) + (coin < rate - int(rate))
    return got


def test_odd_rows(spark):
    check(odd_docs(spark).withColumn("rank", F.lit(1)).withColumn("weight", F.lit(1)).withColumn("target", F.lit(1)))
    assert mixing.mix(empty_docs(spark)).count() == 0
    assert mixing.mixed(empty_docs(spark)).count() == 0


def test_small_sources_stop_at_three_times_their_size(spark):
    rows = [(i, "w " * 50, "big") for i in range(400)] + [(1000 + i, "w " * 5, f"s{i}") for i in range(40)] + [(5000, "", "void")]
    got = check(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r["__copies"] for r in got if r["source"].startswith("s")} == {3}


def test_targets_are_met(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "source")
    per = mixing.mix(docs).groupBy("source").agg(
        F.first("__target").alias("t"), F.sum(F.col("__size") * F.col("__copies")).alias("n"),
        F.sqrt(F.sum(F.col("__size") ** 2)).alias("sd")).collect()
    assert all(abs(r["n"] - r["t"]) <= 3 * r["sd"] for r in per)
    taken, total = sum(r["n"] for r in per), sum(r["t"] for r in per)
    assert abs(taken - total) < 0.03 * total


def test_mixed_repeats_whole_rows(spark):
    df = odd_docs(spark)
    m = {(r["doc_id"], r["text"]): r["__copies"] for r in mixing.mix(df).collect()}
    out = mixing.mixed(df)
    assert out.columns == df.columns
    n = {}
    for r in out.collect():
        n[r["doc_id"], r["text"]] = n.get((r["doc_id"], r["text"]), 0) + 1
    twice = {(4, "")}
    assert n == {k: v * (2 if k in twice else 1) for k, v in m.items() if v}
