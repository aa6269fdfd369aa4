import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelens.llm import collocations as co
from tests.llm.helpers import empty_docs, odd_docs

UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, top=2000, covered=100, longest=5):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f[lang][tuple(w[i:i + m])] += 1
    out = set()
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            score, k, l, r = min(((1000 * a * n[lang]) // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            longer = [q for q in cand if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if not any(100 * cand[q] >= covered * a for q in longer):
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top]):
            out.add((lang, rank + 1, p.decode(), -a, l, r, n[lang], -s))
    return out


def run(df, **options):
    return {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
            for r in co.collocations(df, **options).collect()}


def corpus(seed, docs=150):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["Été", "ÉTÉ", "x\x0fy", "don't", "a b"]
    fixed = ["to be or not to be", "New York City Hall", "one two three four five six", "la la la la la la"]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rnd.randint(0, 12)):
            parts.append(rnd.choice(fixed) if rnd.random() < 0.3 else
                         " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 9))))
            parts.append(rnd.choice([" ", ". ", ", ", "\n", "\t", "! ", "", ";"]))
        rows.append((rnd.choice(["en", "fr", None]), "".join(parts)))
    return rows


@pytest.mark.parametrize("options", [
    dict(least=3), dict(least=6, shards=1), dict(least=5, shards=7, slots=64, segment=100), dict(least=4, shards=3, slots=1 << 16, segment=37),
    dict(least=3, top=4, covered=60), dict(least=9, longest=3)])
def test_against_brute_force(spark, options):
    rows = corpus(1)
    got = run(spark.createDataFrame(rows, "lang string, text string").repartition(5), **options)
    want = brute(rows, **{k: v for k, v in options.items() if k not in ("shards", "slots", "segment")})
    assert want and got == want


def test_a_phrase_that_becomes_frequent_in_the_last_shard(spark):
    rows = [("en", "filler words here")] * 12 + [("en", "late one two three four")] * 5
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    assert run(df, least=5, shards=3) == brute(rows, 5)


def test_segments_lose_no_phrase():
    rnd = random.Random(4)
    data = "".join(rnd.choice(["a ", "bb ", "ccc\t", "dd\n", "e" * 50 + " ", " ", "\n"]) for _ in range(600)).encode()
    flags = np.ones((5, 1 << 12), dtype=bool)

    def counts(size):
        out = Counter()
        for part, limit in co.segments(data, size):
            for b in co.exactly(co.Segment(part, limit, "x"), "x", flags):
                out.update(dict(zip(b.column("key").to_pylist(), b.column("c").to_pylist())))
        return out
    assert counts(1 << 20) and all(counts(n) == counts(1 << 20) for n in (1, 7, 20, 64, 333))


def test_odd_documents(spark):
    docs = odd_docs(spark)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert run(docs, least=2) == brute(rows, 2)
    clash = docs.withColumns({c: F.lit(1) for c in ("phrase", "words", "slot", "begin", "c", "shard", "n", "rank")})
    assert run(clash, least=2, segment=5000) == brute(rows, 2)
    assert run(empty_docs(spark)) == set()
    assert run(docs.select("lang", F.lit(None).cast("string").alias("text"))) == set()


def test_a_third_of_the_rows_alike(spark):
    rows = corpus(2, 60) + [("en", "the very same text, the very same words")] * 30
    assert run(spark.createDataFrame(rows, "lang string, text string"), least=4) == brute(rows, 4)


def test_large_counts_are_exact(spark, monkeypatch):
    """Products beyond 64 bits: counts of 10**14 in a corpus of 10**16 words."""
    big = spark.createDataFrame([("en", "a b", 2, 3 * 10 ** 14 + 1), ("en", "a", 1, 10 ** 15 + 7), ("en", "b", 1, 3 * 10 ** 14 + 9)],
                                "lang string, phrase string, words int, c long")
    n = spark.createDataFrame([("en", 10 ** 16 + 1)], "lang string, n long")
    monkeypatch.setattr(co, "frequent", lambda *a, **k: (big, n))
    a, l, r = 3 * 10 ** 14 + 1, 10 ** 15 + 7, 3 * 10 ** 14 + 9
    assert run(None) == {("en", 1, "a b", a, l, r, 10 ** 16 + 1, 1000 * a * (10 ** 16 + 1) // (l * r))}


def test_counts_are_added_up_in_bounded_batches():
    import pyarrow as pa
    rnd = random.Random(6)
    rows = [(f"k{rnd.randint(0, 300)}".encode(), 1, rnd.randint(1, 5)) for _ in range(3000)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("key", "words", "c"), r)) for r in rows[i:i + 100]]) for i in range(0, 3000, 100)]
    want = Counter()
    for k, _, c in rows:
        want[k] += c
    for most in (50, 400, 10_000):
        got = Counter()
        out = list(co.combined(iter(batches), most))
        for b in out:
            got.update(Counter({r["key"]: r["c"] for r in b.to_pylist()}))
        assert got == want and sum(b.num_rows for b in out) < 3000
    assert list(co.combined(iter([]))) == []


def scanned(monkeypatch):
    """The rows that the scans hand on, by the names of their columns."""
    out, scan = [], co.scan

    def kept(shard, schema, *args, **options):
        df = co.cut(scan(shard, schema, *args, **options))
        out.append((schema, df))
        return df
    monkeypatch.setattr(co, "scan", kept)
    return out


def test_known_phrases_are_not_handed_on_by_every_task(spark, monkeypatch):
    rows = [("en", " ".join(f"w{(i * j) % 200}" for j in range(400))) for i in range(1, 65)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(16)
    made = scanned(monkeypatch)
    assert run(df, least=20) == brute(rows, 20)
    frequent = sum(c >= 20 for c in Counter(w for _, t in rows for w in t.split()).values())
    exact = [d for schema, d in made if schema == co.EXACT]
    assert frequent == 200 and len(exact) == 1 and exact[0].where("words = 1").count() < frequent


@pytest.mark.parametrize("bits", [0, 3, 40])
def test_counters_that_several_phrases_share(spark, monkeypatch, bits):
    """Hashes of few bits: no count may go by the hash."""
    hashed = co.word_hashes
    monkeypatch.setattr(co, "word_hashes", lambda words, seed: hashed(words, seed) & np.uint64((1 << bits) - 1))
    rows = corpus(3, 60)
    assert run(spark.createDataFrame(rows, "lang string, text string").repartition(3), least=4) == brute(rows, 4)
