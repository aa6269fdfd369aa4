import math
import random

import numpy as np
from pyspark.sql import functions as F

from pagelens.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, q) in enumerate(ok):
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for n, (j, v) in enumerate(ok) if n != at)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def run(spark, df, **options):
    v = topk.integers(df)
    rows = topk.top_k(v.where("id % 50 = 0"), v, **options).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows)


def test_against_brute_force_in_many_blocks(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = brute(rows)
    assert run(spark, df) == want
    assert run(spark, df, block_vectors=60, block_queries=3) == want


def test_odd_vectors(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.uniform(-2, 2) for _ in range(3)]) for i in range(1, 40)]
    rows += [(0, [1.0, 1.0, 1.0]), (50, None), (100, [1.0, None, 2.0]), (150, [float("nan"), 0.0, 0.0]), (200, [float("inf"), 0.0, 0.0]),
             (None, [9.0, 9.0, 9.0]), (250, []), (300, [0.5]), (60, [1.0, 1.0, 1.0]), (61, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("x")).withColumn("id", F.lit("y"))
    for name in ("v", "n", "row", "copies", "score", "query_id"):
        df = df.withColumn(name, F.lit("z"))
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert run(spark, df) == brute(rows)
    assert run(spark, df.where("vec_id = 0")) == []
    assert run(spark, df.limit(0)) == []
    same = spark.createDataFrame([(i, [0.25, -0.5]) for i in range(120)], SCHEMA)
    assert run(spark, same) == brute([(r[0], r[1]) for r in same.collect()])


def test_rows_of_one_id_and_repeated_rows(spark):
    """Every row but the query's own is a candidate: others with its id, and its copies."""
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (51, [1.0, 1.0])]
    assert run(spark, spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    rows = [(50, [1.0, 0.5])] * 4 + [(50, [1.0])] + [(50, [1.0, 0.0])] * 2 + [(7, [2.0, 2.0])] * 3 + [(100, [1.0, 1.0]), (8, [0.0, 1.0])]
    for options in ({}, {"block_vectors": 2, "block_queries": 1}, {"k": 2}, {"k": 50}):
        assert run(spark, spark.createDataFrame(rows, SCHEMA), **options) == brute(rows, options.get("k", 5))


def test_a_query_with_very_many_copies(spark, monkeypatch):
    monkeypatch.setattr(topk, "RUN", 7)
    rows = [(0, [1.0, -1.0])] * 40 + [(1, [3.0, 0.0])]
    assert run(spark, spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_a_query_stops_before_the_last_segment():
    rnd = np.random.default_rng(2)
    x = rnd.integers(-100, 100, (3000, 32))
    q = x[:4] * 2
    index = topk.ImpactIndex(np.arange(3000), x)
    used = []

    class Seg(np.ndarray):
        pass
    index.segments = [s.view(Seg) for s in index.segments]
    Seg.T = property(lambda s: used.append(1) or np.asarray(s).transpose())
    i, j, s = index.search(np.array([-1, -2, -3, -4]), q, 5)
    assert len(used) < len(index.segments)
    want = sorted(zip((-(x @ q[0])).tolist(), range(3000)))[:5]
    assert [(-a, b) for a, b in zip(s[i == 0].tolist(), j[i == 0].tolist())] == want


def test_scores_beyond_64_bits():
    big = np.array([[2 ** 40, 2 ** 40]])
    assert topk.exact(big[0], big).tolist() == [2 ** 63 - 1]
