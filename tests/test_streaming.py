import os
import shutil

from dataclasses import replace

from pagelens.plans.label import V3
from pagelens.streaming.label_stream import start_label_stream


def test_stream_labels_arriving_pages(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    shutil.copy("/root/testdata/sf0.001/pages.parquet", os.path.join(src, "part-0.parquet"))
    out = os.path.join(tmpdir_path, "out")
    q = start_label_stream(spark, src, out, os.path.join(tmpdir_path, "ck"), ["/en/", "/fr/", "/de/", "/es/"],
                           replace(V3, region=("tag", "article")), once=True)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
    assert set(r.topic for r in got.select("topic").distinct().collect()) <= {"/en/", "/fr/", "/de/", "/es/"}


def test_a_replayed_batch_adds_no_rows(spark, tmpdir_path):
    """The same input into the same output again, as after a lost checkpoint."""
    src, out = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "out")
    os.makedirs(src)
    shutil.copy("/root/testdata/sf0.001/pages.parquet", os.path.join(src, "part-0.parquet"))
    for run in ("a", "b"):
        q = start_label_stream(spark, src, out, os.path.join(tmpdir_path, f"ck-{run}"), ["/en/", "/fr/", "/de/", "/es/"],
                               replace(V3, region=("tag", "article")), once=True)
        q.awaitTermination(300)
        assert q.exception() is None
    assert spark.read.parquet(out).count() == spark.read.parquet(src).count()
