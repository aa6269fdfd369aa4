import os
import shutil
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as P
from pagelens.llm import simhash, toxicity
from pagelens.llm.queries import remainder
from tests.llm.helpers import DOCS, empty_docs, odd_docs
from tests.llm.test_mixing import brute as brute_targets
from tests.llm.test_simhash import brute_fp, brute_groups

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
STAGE = dict(P.STAGES)


def folder(spark, path, docs):
    """A table folder with these documents and the labels of SF."""
    os.makedirs(path, exist_ok=True)
    docs.write.parquet(f"{path}/documents.parquet")
    shutil.copy(f"{SF}/labels.parquet", f"{path}/labels.parquet")
    return path


def rows(df):
    return [r.asDict() for r in df.collect()]


def check_run(spark, sf):
    """Every stage held against a brute-force version over its predecessor's rows."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    fold = remainder("doc_id", 5) != 0
    model = toxicity.fit(docs.where(fold).select("doc_id", "text"), labels.where(fold))
    toxic = {(r["doc_id"], r["text"]) for r in toxicity.score(docs, model, keep_text=True).where("score >= 0.5").collect()}

    kept = STAGE["toxicity"](spark, docs, sf)
    assert kept.columns == columns
    assert Counter(map(repr, rows(kept))) == Counter(repr(r) for r in rows(docs) if (r["doc_id"], r["text"]) not in toxic)

    docs = spark.createDataFrame(kept.collect(), kept.schema)
    kept = STAGE["exact dedup"](spark, docs, sf)
    best = {}
    for r in rows(docs):
        t = (r["text"] or "").translate(LOWER)
        best[t] = max(best.get(t, -1), -1 if r["doc_id"] is None else r["doc_id"])
    assert kept.columns == columns
    assert {(r["text"] or "").translate(LOWER): -1 if r["doc_id"] is None else r["doc_id"] for r in rows(kept)} == best
    assert kept.count() == len(best)

    docs = spark.createDataFrame(kept.collect(), kept.schema)
    kept = STAGE["simhash near-dedup"](spark, docs, sf)
    at = dict(enumerate(rows(docs)))
    comp = brute_groups({i: brute_fp(r["text"]) for i, r in at.items()})
    first = {}
    for i, r in at.items():
        key = (r["doc_id"] is None, r["doc_id"] or 0)
        if comp[i] not in first or key < first[comp[i]]:
            first[comp[i]] = key
    assert kept.columns == columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows(kept)) == sorted(first.values())

    docs = spark.createDataFrame(kept.collect(), kept.schema)
    kept = STAGE["mixing"](spark, docs, sf)
    size, target = brute_targets([(r["doc_id"], r["text"], r["source"]) for r in rows(docs)])
    times = Counter((r["doc_id"], r["text"]) for r in rows(kept))
    assert kept.columns == columns
    for r in rows(docs):
        rate = target[r["source"]] / size[r["source"]] if size[r["source"]] else 0
        assert int(rate) <= times[r["doc_id"], r["text"]] <= int(rate) + 1

    docs = spark.createDataFrame(kept.collect(), kept.schema)
    packed = STAGE["packing"](spark, docs, sf).collect()
    words = Counter()
    for r in packed:
        words[r["doc_id"]] += r["words"]
    want = Counter()
    for r in rows(docs):
        want[r["doc_id"]] += len((r["text"] or "").encode().split())
    assert words == want
    whole = spark.createDataFrame(P.run(spark, sf).collect(), packed and P.run(spark, sf).schema)
    assert Counter(map(repr, whole.collect())) == Counter(map(repr, packed))


def test_each_stage_against_brute_force(spark, tmpdir_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    near = docs.where("doc_id % 3 = 0").withColumns({"doc_id": F.col("doc_id") + 5000, "text": F.concat("text", F.lit(" end"))})
    copies = docs.where("doc_id % 4 = 0").withColumns({"doc_id": F.col("doc_id") + 9000, "text": F.upper("text")})
    check_run(spark, folder(spark, f"{tmpdir_path}/sf", docs.unionByName(near).unionByName(copies).repartition(3)))


def test_odd_rows_pass_every_stage(spark, tmpdir_path):
    check_run(spark, folder(spark, f"{tmpdir_path}/odd", odd_docs(spark)))


def test_empty_table_passes_every_stage(spark, tmpdir_path):
    sf = folder(spark, f"{tmpdir_path}/empty", empty_docs(spark))
    for _, stage in P.STAGES:
        assert stage(spark, empty_docs(spark), sf).count() == 0
    assert P.run(spark, sf).count() == 0


def test_extra_columns_with_clashing_names_go_through(spark, tmpdir_path):
    df = odd_docs(spark).withColumns({n: F.lit("mine") for n in ("fp", "component_id", "group_id", "score", "predicted", "evidence",
                                                                "loc", "digest", "id", "n", "k", "bin_id", "weight", "target")})
    sf = folder(spark, f"{tmpdir_path}/wide", df)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
        assert out.columns == df.columns, name
        assert {r["fp"] for r in out.collect()} <= {"mine"}
    assert STAGE["packing"](spark, df, sf).count() > 0


def test_near_duplicates_leave_one_of_each_group(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(300)) + f" t{i % 3}", "en", "a", 0) for i in range(40)], DOCS)
    out = STAGE["simhash near-dedup"](spark, docs, SF)
    groups = simhash.near_duplicates(docs).select("component_id").distinct().count()
    assert out.count() == groups < 40
