import re

import pytest
import xxhash
from pyspark.sql import functions as F

from pagelens.llm import simhash

SF = "/root/testdata/sf0.001"


def brute_fp(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(fps):
    """{(id, fp)} -> component by comparing every pair."""
    ids = list(fps)
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in ids:
        for j in ids:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def got(df):
    return {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect()}


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r[0]: r[1] for r in docs.collect()}
    near = [(10_000 + k, t + f" tail{j}") for k, t in texts.items() for j in (1,) if k % 2] + \
           [(20_000, None), (20_001, ""), (20_002, " \t\n"), (20_003, "ÄÖ one"), (20_004, "äÖ ONE"), (20_005, "x")]
    texts |= dict(near)
    df = docs.unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    fps = {k: brute_fp(t) for k, t in texts.items()}
    comp = brute_groups(fps)
    assert got(df) == {k: (f"{fps[k]:016x}", comp[k]) for k in fps}


@pytest.mark.parametrize("list_rows", [2048, 7])
def test_links_lose_nothing_in_dense_groups(spark, list_rows):
    import random
    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(5)]
    fps = set(base)
    for b in base:
        for _ in range(60):
            x = b
            for _ in range(rnd.randint(1, 5)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps = {x - (1 << 64) if x >> 63 else x for x in fps}
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    edges = simhash.links(df, list_rows=list_rows)
    from pagelens.llm.components import connected_components
    root = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    want = brute_groups({x: x & (1 << 64) - 1 for x in fps})
    assert {x: root.get(x, x) for x in fps} == want


def test_edges_of_the_contract(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0
    odd = spark.createDataFrame([(None, "a b", "x"), (None, "a b", "y"), (3, "a b", None), (3, "a b", None)],
                                "doc_id long, text string, component_id string")
    out = simhash.near_duplicates(odd.withColumnRenamed("component_id", "lang")).collect()
    assert len(out) == 4 and {r["component_id"] for r in out} == {3}
    lone = spark.createDataFrame([(None, "z y")], "doc_id long, text string")
    assert simhash.near_duplicates(lone).first()["component_id"] is None


def test_long_text(spark):
    text = " ".join(f"w{i % 977}" for i in range(150_000))
    df = spark.createDataFrame([(1, text), (2, text + " end")], "doc_id long, text string")
    assert got(df)[1][0] == f"{brute_fp(text):016x}" and got(df)[2][1] == 1
    assert simhash.fingerprints(df).agg(F.count("fp")).first()[0] == 2
