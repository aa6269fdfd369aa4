"""Bulk pair files as a Spark data source (S5, S6): ``format("bulk_pairs")``.

A file holds line pairs: an action ``{"index":{"_index":<article>,"_id":<n>}}`` and the
document it applies to. A row is one pair, so no writer and no split tears it apart. JSON
is made and read by Catalyst; the source only moves lines between files and Arrow batches.

Reading: files are cut into byte ranges, in order of name and offset. A range owns the
pairs whose action line begins in it. That needs no scan from the start of the file, as an
action line is told by its ``{"index":`` and no document may begin so (an error, as are
a document without an action and an action at the end without a document). A compressed
file is one range; the writer begins a new file every ``fileBytes``, so a range is bounded.

Writing in two steps: each task writes files of its own under a name that no reader sees;
the commit moves the files of the tasks that Spark counts and then replaces the list
of valid files, which is the one moment at which the new payload appears. A task that
fails takes its file away, a job that fails its folder. Readers follow the list where there
is one, so what a driver lost in mid-commit leaves behind is never read.
"""

from __future__ import annotations

import io
import json
import re
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from pagelens.functions import text as X
from pagelens.session import checkpoint_dir

SCHEMA = "file STRING, pos BIGINT, action STRING, document STRING"
ARROW = pa.schema([("file", pa.string()), ("pos", pa.int64()), ("action", pa.string()), ("document", pa.string())])
ACTION = re.compile(rb'\s*\{\s*"index"\s*:')
#: Bytes that one range of a file holds, and that a batch of lines holds, about.
SPLIT_BYTES = 128 << 20
#: Bytes of lines after which a task begins its next file.
FILE_BYTES = 128 << 20
BATCH_BYTES = 4 << 20
#: Repeated ids are broadcast up to this many rows and bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 16 << 20
#: The list of valid files, and the endings of payload files by compression.
LIST, ENDINGS = "_committed", {"none": ".ndjson", "zstd": ".ndjson.zst", "gzip": ".ndjson.gz"}


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a path or URI."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if re.match(r"[a-z0-9]+://", path):
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), path


def valid_files(files: fs.FileSystem, folder: str) -> list[tuple[str, int]]:
    """(name, size) of the payload files of a folder by name: those of the list, without
    one all with an ending of payload files."""
    if files.get_file_info(folder).type == fs.FileType.NotFound:
        return []
    found = {i.base_name: i.size for i in files.get_file_info(fs.FileSelector(folder)) if i.is_file}
    if LIST in found:
        with files.open_input_file(f"{folder}/{LIST}") as f:
            names = json.loads(f.read())
        return sorted((n, found[n]) for n in names)
    return sorted((n, s) for n, s in found.items() if n.endswith(tuple(ENDINGS.values())))


@dataclass
class Range(InputPartition):
    name: str
    start: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


def pairs(f, start: int, end: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(offset, action, document) of the pairs whose action begins in [start, end)."""
    at = start
    if start:
        f.seek(start - 1)
        at += len(f.readline()) - 1
    action, begun = None, 0
    first = start > 0
    while action is not None or at < end:
        line = f.readline()
        if not line:
            break
        if line.strip():
            is_action = ACTION.match(line) is not None
            if action is not None:
                if is_action:
                    raise ValueError(f"an action without a document at byte {begun}")
                yield begun, action, line.rstrip(b"\r\n")
                action = None
            elif is_action:
                action, begun = line.rstrip(b"\r\n"), at
            elif not first:
                raise ValueError(f"a document without an action at byte {at}")
            first = False
        at += len(line)
    if action is not None:
        raise ValueError(f"an action without a document at byte {begun}")


class PairReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self):
        files, folder = located(self.path)
        ranges = []
        for name, size in valid_files(files, folder):
            if name.endswith(ENDINGS["none"]):
                ranges += [Range(name, at, min(at + self.split, size)) for at in range(0, size, self.split)]
            else:
                ranges.append(Range(name, 0, sys.maxsize))
        return ranges or [Range("", 0, 0)]

    def read(self, part):
        if not part.name:
            return
        files, folder = located(self.path)
        path = f"{folder}/{part.name}"
        plain = part.name.endswith(ENDINGS["none"])
        with io.BufferedReader(files.open_input_file(path) if plain else files.open_input_stream(path), 1 << 20) as raw:
            rows, held = [], 0
            for at, action, document in pairs(raw, part.start, part.end):
                rows.append((part.name, at, action.decode(), document.decode()))
                held += len(action) + len(document)
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays(list(zip(*rows)), schema=ARROW)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays(list(zip(*rows)), schema=ARROW)


class PairWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path = options["path"]
        self.overwrite = overwrite
        self.compression = options.get("compression", "none")
        if self.compression not in ENDINGS:
            raise ValueError(f"compression is one of {sorted(ENDINGS)}")
        self.file_bytes = int(options.get("filebytes", FILE_BYTES))
        self.job = uuid.uuid4().hex
        self.waiting = f"_waiting-{self.job}"

    def write(self, iterator):
        task = TaskContext.get()
        files, folder = located(self.path)
        files.create_dir(f"{folder}/{self.waiting}", recursive=True)
        names, out, held = [], None, 0
        try:
            for b in iterator:
                for a, d in zip(b.column("action").to_pylist(), b.column("document").to_pylist()):
                    if a is None or d is None or "\n" in a or "\n" in d:
                        raise ValueError("a pair is two lines, neither null nor broken")
                    if out is None:
                        names.append(f"{task.taskAttemptId()}-part-{task.partitionId():06d}-{len(names):06d}-{self.job}"
                                     f"{ENDINGS[self.compression]}")
                        out, held = files.open_output_stream(f"{folder}/{self.waiting}/{names[-1]}",
                                                             None if self.compression == "none" else self.compression), 0
                    pair = f"{a}\n{d}\n".encode()
                    out.write(pair)
                    held += len(pair)
                    if held >= self.file_bytes:
                        out.close()
                        out = None
            if out is not None:
                out.close()
        except BaseException:
            if out is not None:
                out.close()
            for n in names:
                files.delete_file(f"{folder}/{self.waiting}/{n}")
            raise
        return Written(names)

    def commit(self, messages):
        files, folder = located(self.path)
        files.create_dir(f"{folder}/{self.waiting}", recursive=True)
        before = [n for n, _ in valid_files(files, folder)]
        new = []
        for m in messages:
            for n in m.names if m is not None else ():
                new.append(n.split("-", 1)[1])
                files.move(f"{folder}/{self.waiting}/{n}", f"{folder}/{new[-1]}")
        with files.open_output_stream(f"{folder}/{self.waiting}/{LIST}") as f:
            f.write(json.dumps(sorted(new if self.overwrite else before + new)).encode())
        files.move(f"{folder}/{self.waiting}/{LIST}", f"{folder}/{LIST}")
        if self.overwrite:
            for n in before:
                files.delete_file(f"{folder}/{n}")
        files.delete_dir(f"{folder}/{self.waiting}")

    def abort(self, messages):
        files, folder = located(self.path)
        if files.get_file_info(f"{folder}/{self.waiting}").type != fs.FileType.NotFound:
            files.delete_dir(f"{folder}/{self.waiting}")


class BulkPairs(DataSource):
    """Rows (file, pos, action, document); written are ``action`` and ``document``.
    Options: path; splitBytes to read; compression (none, zstd, gzip) and fileBytes to write."""

    @classmethod
    def name(cls):
        return "bulk_pairs"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return PairReader(self.options)

    def writer(self, schema, overwrite):
        return PairWriter(self.options, overwrite)


def write_bulk_pairs(lines: DataFrame, path: str, mode: str = "overwrite", by_page: bool = False,
                     compression: str = "none") -> None:
    """Lines (page_id, line_id, text) as pair files, each article's pairs together and
    in line order; ``_index`` is the article, so a file holds many. ``by_page`` says that
    the rows of a page lie in one partition already, as ``article_lines`` gives them. A null
    text is a document without content; an empty table is an empty payload."""
    lines.sparkSession.dataSource.register(BulkPairs)
    index = F.struct(F.col("page_id").cast("string").alias("_index"), F.col("line_id").cast("string").alias("_id"))
    lines = lines if by_page else lines.repartition("page_id")
    (lines.sortWithinPartitions("page_id", "line_id")
     .select(F.to_json(F.struct(index.alias("index"))).alias("action"), X.json_document(F.col("text")).alias("document"))
     .write.format("bulk_pairs").option("compression", compression).mode(mode).save(path))


def read_bulk_pairs(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Documents (source, _id, at, content) of pair files, as the index stores them: a
    repeated _id of an article replaces the earlier document but keeps its place (D2).
    ``at`` is that place, struct<file, pos>, in the order of the files. Actions without
    ``_index`` belong to the file they stand in; those without ``_id`` replace nothing.

    Documents are not shuffled to find what is replaced: only keys and places are counted
    per id, and what that leaves, the ids that repeat, meets the documents: by
    broadcast if counted to be small, else by a shuffle join."""
    spark.dataSource.register(BulkPairs)
    rows = spark.read.format("bulk_pairs").option("splitBytes", split_bytes).load(path)
    act = F.from_json("action", "index STRUCT<_index: STRING, _id: STRING>")["index"]
    docs = rows.select(F.coalesce(act["_index"], "file").alias("source"), act["_id"].alias("_id"),
                       F.struct("file", "pos").alias("at"), "document")
    checkpoint_dir(spark)
    again = (docs.where("_id IS NOT NULL").groupBy(F.col("source").alias("_s"), F.col("_id").alias("_i"))
             .agg(F.count(F.lit(1)).alias("_n"), F.min("at").alias("_first"), F.max("at").alias("_last"))
             .where("_n > 1").checkpoint())
    n, size = again.agg(F.count(F.lit(1)), F.sum(F.octet_length("_s") + F.octet_length("_i"))).first()
    if n:
        again = F.broadcast(again) if n <= BROADCAST_ROWS and size <= BROADCAST_BYTES else again
        docs = docs.join(again, (F.col("source") == F.col("_s")) & (F.col("_id") == F.col("_i")), "left") \
            .where("_last IS NULL OR at = _last").withColumn("at", F.coalesce("_first", "at"))
    return docs.select("source", "_id", "at", F.from_json("document", "content STRING")["content"].alias("content"))


# The source travels by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
