import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, pos=5, neg=5, low=80, high=100):
    """Rows of one id are rows of their own, so results are a sorted list."""
    ok = [(i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows if None not in (i, v, lab)
          and all(x is not None and math.isfinite(x) for x in v)]

    def dot(a, b):
        return max(min(sum(x * y for x, y in zip(a, b)), 2 ** 63 - 1), 1 - 2 ** 63)
    out = []
    for n, (i, lab, q) in enumerate(ok):
        if i % 100:
            continue
        others = sorted((-dot(q, v), j, m, l) for m, (j, l, v) in enumerate(ok) if m != n)
        for s, j, _, _ in [o for o in others if o[3] == lab][:pos]:
            inside = [o for o in others if o[3] != lab and low * -s <= 100 * -o[0] <= high * -s][:neg]
            out += [(i, j, r + 1, o[1], -s, -o[0]) for r, o in enumerate(inside)]
    return sorted(out)


def run(df, **options):
    v = hn.integers(df)
    cols = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[c] for c in cols) for r in hn.mine(v, F.col("id") % 100 == 0, **options).collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 64, 33), (40, 19, 51), (3, 100, 200), (64, 64, 64), (129, 65, 31)])
def test_strassen_is_exact(shape):
    n, d, m = shape
    rnd = np.random.default_rng(n)
    a, b = rnd.integers(-2 ** 28, 2 ** 28, (n, d)), rnd.integers(-2 ** 28, 2 ** 28, (d, m))
    assert (hn.strassen(a, b, 4) == a @ b).all()
    # sums inside the recursion that leave 64 bits come back
    a, b = np.full((n, d), 2 ** 62 // d), np.full((d, m), -1)
    assert (hn.strassen(a, b, 4) == a @ b).all()


def test_scores_beyond_64_bits():
    big = np.full((1, 40), 2 ** 40)
    assert hn.scores(big, np.concatenate([big, -big, big // 2 ** 30])).tolist() == [[2 ** 63 - 1, 1 - 2 ** 63, 40 * 2 ** 50]]


def test_against_brute_force_in_many_blocks(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding", "label")
    want = brute([tuple(r) for r in df.collect()])
    assert want and run(df) == want
    assert run(df, block=37) == want
    rows = [tuple(r) for r in df.collect()]
    assert run(df, positives=2, negatives=7, low=-50, high=140, block=100) == brute(rows, 2, 7, -50, 140)


def test_odd_rows(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.uniform(0, 2) for _ in range(3)], i % 3) for i in range(60)]
    rows += [(100, [1.0, 1.0, 1.0], 0), (100, [1.0, 1.0, 1.0], 0), (100, [0.5, 0.5, 2.0], 1), (200, None, 1), (300, [1.0, 1.0, 2.0], None),
             (400, [1.0, None, 2.0], 1), (500, [float("nan"), 0.0, 0.0], 1), (600, [float("-inf"), 0.0, 0.0], 1),
             (None, [1.0, 1.0, 1.0], 0), (700, [], 1), (800, [1.5], 2), (900, [-1.0, -1.0, -1.0], 1), (60, [1.0, 1.0, 1.0], 2),
             (61, [1.0, 1.0, 1.0], 2), (1000, [3e18, 1.0, 1.0], 2), (1001, [3e18, 2.0, 1.0], 1), (1002, [2.9e18, 0.0, 0.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    rows = [tuple(r) for r in df.collect()]
    # components beyond 64 bits count as the nearest that fits
    want = brute([(i, v and [x if x is None or abs(x) < 1e16 else x for x in v], l) for i, v, l in rows if i not in (1000, 1001, 1002)])
    clash = df.withColumns({c: F.lit("x") for c in ("id", "rid", "rank", "anchor", "block", "v")})
    assert run(clash.where("vec_id is null or vec_id < 1000")) == want
    assert len(run(df)) >= len(want)
    assert run(df.where("vec_id = 0")) == [] and run(df.limit(0)) == []
    same = [(i, [0.25, 0.5], i % 2) for i in range(130)]
    assert run(spark.createDataFrame(same, SCHEMA), block=10) == brute(same)
