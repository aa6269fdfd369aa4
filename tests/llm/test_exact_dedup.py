import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from pagelens.llm import exact_dedup
from pagelens.llm.common import shared_path
from tests.llm.helpers import empty_docs, odd_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """Sorted (id, keep_id, size) by comparing texts, and the number of kept rows."""
    by = defaultdict(list)
    for i, t in rows:
        by[(t or "").translate(LOWER)].append(i)
    out = [(i, max((x for x in ids if x is not None), default=None), len(ids)) for ids in by.values() for i in ids]
    return sorted(out, key=repr), len(by)


def check(df, **options):
    got = exact_dedup.dedup(df, **options).collect()
    want, groups = brute([(r["doc_id"], r["text"]) for r in df.collect()])
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got), key=repr) == want
    assert sum(r["kept"] for r in got) == groups
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    return got


def test_odd_rows(spark):
    got = check(odd_docs(spark).withColumn("loc", F.lit("x")).withColumn("digest", F.lit(1)))
    d = {r["doc_id"]: bytes(r["digest"]).hex() for r in got if r["doc_id"]}
    assert d[2] == hashlib.sha256(b"alpha beta gamma").hexdigest()
    assert exact_dedup.dedup(empty_docs(spark)).count() == 0


def test_collisions_are_told_apart_by_the_bytes(spark):
    """With a digest of one hex digit nearly all texts collide, and none is lost."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    check(docs, digest=lambda t: F.substring(F.sha2(t.cast("binary"), 256), 1, 1).cast("binary"))


def test_many_batches_share_one_state(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").repartition(7)
    got = exact_dedup.dedup(docs, files_per_batch=2)
    want, _ = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got.collect()), key=repr) == want


def test_a_later_run_goes_on_from_the_state(spark):
    path, state = shared_path(spark, "log"), shared_path(spark, "state")

    def add(rows):
        df = spark.createDataFrame(rows, "digest binary, id long, loc struct<file: string, row: long>")
        df.write.mode("append").parquet(path)
        return {bytes(r["digest"]): (r["keep"]["id"], r["n"])
                for r in exact_dedup.state_of(df, spark, path, checkpoint=state).collect()}

    assert add([(b"a", 1, ("f", 1)), (b"b", 2, ("f", 2))]) == {b"a": (1, 1), b"b": (2, 1)}
    assert add([(b"a", 5, ("g", 1)), (b"c", 3, ("g", 2))]) == {b"a": (5, 2), b"b": (2, 1), b"c": (3, 1)}


def test_deduplicated_keeps_columns_and_one_row_per_text(spark):
    df = odd_docs(spark).withColumn("__id", F.lit(1))
    out = exact_dedup.deduplicated(df)
    assert out.columns == df.columns
    texts = [(r["text"] or "").translate(LOWER) for r in out.collect()]
    assert sorted(texts) == sorted({(r["text"] or "").translate(LOWER) for r in df.collect()})


def test_main_path_has_no_python(spark):
    plan = exact_dedup.dedup(odd_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
