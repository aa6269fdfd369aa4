import os

import pytest

from pagelens.streaming import image_stream as I

VISITS = [  # batches of (page_id, url, html, visit)
    [(1, "u1", '<img src="https://a/1"><p>x</p><img src="https://a/2?a=1&amp;b">', 10), (2, "u2", '<img src="https://b/1">', 11),
     (3, "u3", None, 12), (4, None, '<img src="https://n/1"><img src="/rel"><img alt="x"><amp-img src="https://no">', 13)],
    [(5, "u1", '<script><img src="https://s"></script><img src=https://a/3>', 20), (6, "u4", "", 21), (7, "u2", "<p>none</p>", 22)],
    [(8, "u1", '<img src="https://late">', 5), (9, "u2", '<img src="https://late">', 15), (10, "u5", "<img src='https://e/1'>", 30)],
]


def brute(visits):
    """Repeated assignment in visit order into an insertion-ordered dictionary."""
    links = {1: ["https://a/1", "https://a/2?a=1&b"], 2: ["https://b/1"], 4: ["https://n/1"], 5: ["https://a/3"],
             8: ["https://late"], 9: ["https://late"], 10: ["https://e/1"]}
    out: dict = {}
    for page, url, _, visit in sorted(visits, key=lambda v: v[3]):
        out[url] = (out[url][0] if url in out else visit, links.get(page, []))
    return out


def as_dict(df):
    return {r.url: (r.ord, [m.link for m in r.images]) for r in df.collect()}


def land(spark, folder, rows):
    spark.createDataFrame(rows, I.VISITS_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture()
def folders(tmpdir_path):
    return [os.path.join(tmpdir_path, n) for n in ("in", "out", "ck")]


def run(spark, src, out, ck):
    q = I.start_image_stream(spark, src, out, ck, once=True)
    assert q.awaitTermination(300) and q.exception() is None


def test_table_equals_brute_force(spark):
    rows = sum(VISITS, [])
    df = spark.createDataFrame(rows, I.VISITS_SCHEMA)
    assert as_dict(I.latest_images(I.image_lists(df))) == brute(rows)
    flat = I.image_rows(I.latest_images(I.image_lists(df)))
    assert {(r.url, r.link) for r in flat.collect() if r.url in ("u2", "u3", "u5")} == {("u2", None), ("u3", None), ("u5", "https://e/1")}
    assert I.latest_images(I.image_lists(df.limit(0))).count() == 0


def test_revisits_and_late_pages_across_batches(spark, folders):
    """The query is stopped after every batch and goes on from its state."""
    done = []
    for rows in VISITS:
        land(spark, folders[0], rows)
        done += rows
        run(spark, *folders)
        assert as_dict(I.current_images(spark, folders[1])) == brute(done)


def test_a_batch_writes_only_what_it_changed(spark, folders):
    for rows in VISITS[:2]:
        land(spark, folders[0], rows)
        run(spark, *folders)
    assert {r.url for r in spark.read.parquet(f"{folders[1]}/batch_id=1").collect()} == {"u1", "u4", "u2"}


def test_a_run_from_the_start_over_the_same_folder(spark, folders, tmpdir_path):
    """The checkpoint is lost: all visits come again in other batches, with one more that
    the batches of the first run, numbered higher, know nothing of."""
    for rows in VISITS:
        land(spark, folders[0], rows)
        run(spark, *folders)
    more = [(5, "u5", '<script><img src="https://s"></script><img src=https://a/3>', 40)]
    land(spark, folders[0], more)
    run(spark, folders[0], folders[1], os.path.join(tmpdir_path, "ck2"))
    assert as_dict(I.current_images(spark, folders[1])) == brute(sum(VISITS, []) + more)


def test_the_last_batch_replayed_changes_nothing(spark, folders):
    """A batch whose commit was lost runs again from the state before it."""
    for rows in VISITS:
        land(spark, folders[0], rows)
        run(spark, *folders)
    for name in ("2", ".2.crc"):
        os.remove(os.path.join(folders[2], "commits", name))
    run(spark, *folders)
    assert as_dict(I.current_images(spark, folders[1])) == brute(sum(VISITS, []))
