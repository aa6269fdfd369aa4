import random

from pyspark.sql import functions as F

from pagelens.llm import packing
from tests.llm.helpers import LONG, empty_docs, odd_docs


def check(rows, lengths=packing.LENGTHS):
    """Bins are full of gapless pieces, within the least capacity that holds them."""
    bins = {}
    for r in rows:
        if r["bin_id"] is None:
            assert r["words"] == 0 and r["capacity"] is None
        else:
            bins.setdefault(r["bin_id"], []).append(r)
    for b in bins.values():
        b.sort(key=lambda r: r["slot"])
        at = 0
        for k, r in enumerate(b):
            assert r["slot"] == k and r["start"] == at
            at += r["words"]
        assert {r["fill"] for r in b} == {at}
        assert {r["capacity"] for r in b} == {min(c for c in lengths if c >= at)}
    return bins


def test_round_trip_and_odd_rows(spark):
    df = odd_docs(spark).withColumn("bin_id", F.lit("x")).withColumn("g", F.lit(1))
    rows = packing.pack(df, group_bytes=100_000).collect()
    check(rows)
    texts = {}
    for r in sorted(rows, key=lambda r: r["piece"]):
        if r["doc_id"] == 6:
            texts.setdefault(6, []).append(r["text"])
            assert r["words"] == len(r["text"].split()) and r["pieces"] == 15
    assert "".join(texts[6]) == LONG
    assert sum(r["doc_id"] == 4 for r in rows) == 2 and len(rows) == 12 + 14
    assert packing.pack(empty_docs(spark)).count() == 0


def test_same_result_for_any_input_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    a = packing.pack(docs, group_bytes=300_000).drop("text").collect()
    b = packing.pack(docs.repartition(4).orderBy("lang"), group_bytes=300_000).drop("text").collect()
    key = lambda rows: sorted((r["bin_id"], r["slot"], r["doc_id"], r["piece"]) for r in rows)
    assert key(a) == key(b)
    bins = check(a)
    fill = sum(b[0]["fill"] for b in bins.values()) / sum(b[0]["capacity"] for b in bins.values())
    assert fill > 0.97


def naive(sizes, opening, lengths):
    """Best-fit by trying every bin: the rooms that are left, in order. Which of the
    bins with equal room is taken does not change them."""
    fills, caps, where = [], [], []
    for s in sizes:
        fits = [(caps[b] - fills[b], b) for b in range(len(fills)) if caps[b] - fills[b] >= s]
        if fits:
            room = min(fits)[0]
            b = [x for r, x in fits if r == room]
        else:
            b = None
        where.append((s, room if fits else None))
        if b is None:
            caps.append(max(opening, min(c for c in lengths if c >= s)))
            fills.append(s)
        else:
            fills[b[0]] += s
    return sorted(c - f for c, f in zip(caps, fills))


def test_best_fit_against_trying_every_bin():
    rnd = random.Random(5)
    for _ in range(40):
        sizes = sorted((rnd.randint(1, 64) for _ in range(rnd.randint(0, 80))), reverse=True)
        for opening in (16, 32, 64):
            where, fills, caps = packing.best_fit(sizes, opening, (16, 32, 64))
            assert sorted(c - f for c, f in zip(caps, fills)) == naive(sizes, opening, (16, 32, 64))
            assert len(where) == len(sizes)


def test_joint_choice_is_the_cheapest_policy():
    sizes = [40] * 10 + [20] * 10 + [5] * 3
    lengths = (16, 32, 64)
    _, fills, caps = packing.pack_sizes(sizes, lengths, 8)
    cost = sum(caps) + 8 * len(caps)
    for opening in lengths:
        f = packing.best_fit(sizes, opening, lengths)[1]
        assert cost <= sum(min(c for c in lengths if c >= x) + 8 for x in f)
