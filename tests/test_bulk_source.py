"""The bulk pair source: round trips, byte ranges, and the commit in two steps."""

import io
import json
import os

import pytest
from pyspark.sql import functions as F

from pagelens.sources import bulk as B

LINES = "page_id long, line_id long, text string"


def _files(path):
    return sorted(f for _, _, names in os.walk(path) for f in names)


def test_every_split_reads_every_pair_once():
    """Ranges of any length own each pair once, in order."""
    docs = ["", "a", "\u00e9\u4e2d" * 40, 'x"index":', "b" * 300]
    data = b"".join(f'{{"index":{{"_id":"{i}"}}}}\n{json.dumps({"content": d}, ensure_ascii=False)}\n'.encode()
                    + b"\n" * (i % 2) for i, d in enumerate(docs * 3)).rstrip(b"\n")
    whole = list(B.pairs(io.BytesIO(data), 0, len(data)))
    assert [json.loads(d)["content"] for _, _, d in whole] == docs * 3
    assert all(data[at:at + len(a)] == a for at, a, _ in whole)
    for step in (1, 2, 7, 64, 333, len(data)):
        got = [p for s in range(0, len(data), step) for p in B.pairs(io.BytesIO(data), s, min(s + step, len(data)))]
        assert got == whole, step


@pytest.mark.parametrize("text", ['{"index":{"_id":"1"}}\n', '{"content":"x"}\n',
                                  '{"index":{"_id":"1"}}\n{"index":{"_id":"2"}}\n{"content":"x"}\n'])
def test_torn_pairs_are_errors(text):
    with pytest.raises(ValueError):
        list(B.pairs(io.BytesIO(text.encode()), 0, len(text)))


def test_round_trip_order_and_splits(spark, tmpdir_path):
    rows = [(p, i, f"text {i}\nof '{p}' \u4e2d" if i % 3 else "") for p in range(9) for i in range(1, 30 + 40 * p)]
    rows.append((3, 1000, None))
    path = os.path.join(tmpdir_path, "out")
    B.write_bulk_pairs(spark.createDataFrame(rows, LINES).orderBy(F.rand(5)), path)
    for split in (97, 1 << 20):
        docs = B.read_bulk_pairs(spark, path, split).collect()
        assert sorted((int(d.source), int(d._id), d.content) for d in docs if d.content is not None) == rows[:-1]
        by_place = [(int(d.source), int(d._id)) for d in sorted(docs, key=lambda d: d["at"])]
        starts = [i for i, (p, _) in enumerate(by_place) if i == 0 or by_place[i - 1][0] != p]
        assert len(starts) == 9  # an article's pairs lie together, in line order
        assert all(a[0] != b[0] or a[1] < b[1] for a, b in zip(by_place, by_place[1:]))
    raw = spark.read.format("bulk_pairs").option("splitBytes", 97).load(path)
    seen = [(r.file, r.pos) for r in raw.collect()]
    assert seen == sorted(seen) and len(seen) == len(rows)  # partitions come in file order
    assert raw.rdd.getNumPartitions() > 50


def test_repeated_ids_and_foreign_files(spark, tmpdir_path, monkeypatch):
    """A payload this source did not write: no list, no _index; a repeated id replaces."""
    with open(os.path.join(tmpdir_path, "a.ndjson"), "w") as f:
        f.write('{"index":{"_id":"1"}}\r\n{"content": "a"}\r\n\n{ "index" : {"_id":"2"}}\n{"content": "b"}\n'
                '{"index":{"_id":"1"}}\n{"content": "c"}\n{"index":{}}\n{"content": "d"}\n{"index":{}}\n{"content": "e"}')
    for rows in (B.BROADCAST_ROWS, 0):  # by broadcast and by shuffle
        monkeypatch.setattr(B, "BROADCAST_ROWS", rows)
        docs = B.read_bulk_pairs(spark, tmpdir_path).orderBy("at").collect()
        assert [(d.source, d._id, d.content) for d in docs] == [
            ("a.ndjson", "1", "c"), ("a.ndjson", "2", "b"), ("a.ndjson", None, "d"), ("a.ndjson", None, "e")]


@pytest.mark.parametrize("compression", ["none", "zstd", "gzip"])
def test_files_are_bounded(spark, tmpdir_path, compression):
    """A task begins a new file every so many bytes; a compressed file is one range."""
    path = os.path.join(tmpdir_path, "out")
    rows = spark.range(0, 3000, 1, 2).select(F.to_json(F.struct(F.struct(F.col("id").cast("string").alias("_id")).alias("index")))
                                             .alias("action"), F.to_json(F.struct(F.repeat(F.lit("x"), 100).alias("content"))).alias("document"))
    (rows.write.format("bulk_pairs").option("compression", compression).option("fileBytes", 20_000).mode("overwrite").save(path))
    ending = B.ENDINGS[compression]
    files = [f for f in _files(path) if f != B.LIST and not f.startswith(".")]
    assert len(files) > 15 and all(f.endswith(ending) for f in files)
    raw = spark.read.format("bulk_pairs").load(path)
    assert raw.rdd.getNumPartitions() == len(files)
    got = [json.loads(r.action)["index"]["_id"] for r in raw.collect()]
    assert got == [str(i) for i in range(3000)]


def test_modes_and_empty(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "out")
    one = spark.createDataFrame([(1, 1, "a")], LINES)
    B.write_bulk_pairs(one, path)
    B.write_bulk_pairs(one.withColumn("page_id", F.lit(2)), "file:" + path, mode="append")
    assert sorted(d.source for d in B.read_bulk_pairs(spark, path).collect()) == ["1", "2"]
    B.write_bulk_pairs(one.withColumn("page_id", F.lit(3)), path)
    assert [d.source for d in B.read_bulk_pairs(spark, path).collect()] == ["3"]
    assert len([f for f in _files(path) if f.endswith(B.ENDINGS["none"])]) == 1
    B.write_bulk_pairs(one.limit(0), path)
    assert B.read_bulk_pairs(spark, path).count() == 0


def test_failed_task_leaves_nothing_behind(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "out")
    B.write_bulk_pairs(spark.createDataFrame([(1, 1, "kept")], LINES), path)
    before = _files(path)
    bad = spark.range(0, 2000, 1, 8).select(F.col("id").alias("page_id"), F.lit(1).alias("line_id"),
                                            F.when(F.col("id") == 1777, F.raise_error(F.lit("lost"))).otherwise("x").alias("text"))
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception, match="lost"):
            B.write_bulk_pairs(bad, path, mode)
        assert _files(path) == before and not [f for f in os.listdir(path) if f.startswith("_waiting")]
    broken = spark.createDataFrame([("{}", "two\nlines")], "action string, document string")
    with pytest.raises(Exception, match="a pair is two lines"):
        broken.write.format("bulk_pairs").mode("append").save(path)
    assert _files(path) == before
    assert [d.content for d in B.read_bulk_pairs(spark, path).collect()] == ["kept"]


def test_uncommitted_files_are_not_read(spark, tmpdir_path):
    """A file moved by a commit that never came to its list is not part of the payload."""
    path = os.path.join(tmpdir_path, "out")
    B.write_bulk_pairs(spark.createDataFrame([(1, 1, "kept")], LINES), path)
    with open(os.path.join(path, "part-000009-x.ndjson"), "w") as f:
        f.write('{"index":{"_id":"1"}}\n{"content":"stray"}\n')
    assert [d.content for d in B.read_bulk_pairs(spark, path).collect()] == ["kept"]
