"""SimHash near-duplicates through a byte-position inverted index.

A 64-bit fingerprint has eight positional bytes. Two fingerprints that differ
in at most d bits (d <= 3) agree in at least 8 - d bytes, so count filtering
keeps the pairs that share at least 8 - d positional bytes and verifies their
distance.

Lists of one positional byte hold 1/256 of all rows, and tallying them pairwise
is quadratic. The index therefore posts three positional bytes at once: five
agreeing positions out of eight always leave three inside one half of the
fingerprint, so the eight triples inside the halves reach every pair that can
pass the filter. The tally over all eight positions is then taken per pair.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelens.llm.common import cut
from pagelens.llm.components import connected_components

SEED = 42
SHINGLE = 3
MAX_BITS = 3
#: Rows of an index list that one task compares; longer lists are cut in blocks
#: and every pair of blocks is compared.
LIST_ROWS = 2048
TRIPLES = tuple(t for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for t in combinations(half, 3))


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Majority vote of the XXH64 of the word shingles of one text (unsigned)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) <= shingle:
        spans = [(0, len(line))]
    else:
        spans = zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
    h64 = xxhash.xxh64_intdigest
    hashes = np.array([h64(line[s:e], SEED) for s, e in spans], dtype=">u8")
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 65536):
        part = np.unpackbits(hashes[i:i + 65536].view(np.uint8)).reshape(-1, 64)
        votes += part.sum(axis=0, dtype=np.int32)
    bits = votes * 2 > len(hashes)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The rows without their text, plus `fp` (the fingerprint as a signed long).
    Input columns with the names of results are replaced."""
    others = [c for c in docs.columns if c not in (text_col, "fp", "fingerprint", "component_id", "group_id")]
    src = docs.select(*[F.col(f"`{c}`") for c in others],
                      F.col(f"`{text_col}`").cast("binary").alias("__text"))
    schema = src.drop("__text").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(b.num_columns - 1)],
                          dtype=np.uint64).view(np.int64)
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(fp, pa.int64())],
                                             names=[*b.schema.names[:-1], "fp"])

    return src.mapInArrow(run, schema)


def _forest(fps: np.ndarray, max_bits: int):
    """Edges of a spanning forest of the links among `fps`."""
    rest = fps
    out_a, out_b = [], []
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            diff = rest ^ x
            tally = (diff.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            link = tally >= 8 - max_bits
            link &= np.bitwise_count(diff) <= max_bits
            if link.any():
                near = rest[link]
                rest = rest[~link]
                out_a += [x] * len(near)
                out_b += near.tolist()
                todo += list(near)
    return out_a, out_b


def links(fps: DataFrame, max_bits: int = MAX_BITS, list_rows: int = LIST_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints `fp`, spanning each list's links.

    Every pair within `max_bits` bits (0 to 3) meets in at least one list, and
    each list (or pair of blocks of a long list) emits a spanning forest of its
    verified links: the connectivity of all links, without a row per pair.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the index answers distances of 0 to 3 bits")

    def key(i, t):
        k = F.lit(i).cast("long")
        for p in t:
            k = F.shiftleft(k, 8).bitwiseOR(F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)))
        return k

    posts = fps.select("fp", F.explode(F.array(*[key(i, t) for i, t in enumerate(TRIPLES)])).alias("k"))
    long = cut(posts.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > list_rows))
    if long.isEmpty():
        work = posts.select("fp", "k", F.lit(0).alias("i"), F.lit(0).alias("j"))
    else:
        nb = F.coalesce(F.ceil(F.col("n") / list_rows).cast("int"), F.lit(1))
        cell = F.pmod(F.xxhash64("fp", F.lit(7)), nb).cast("int")
        work = (posts.join(long, "k", "left").select("fp", "k", nb.alias("nb"), cell.alias("c"))
                .select("fp", "k", "c", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("o"))
                .select("fp", "k", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j")))
    spark = fps.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = work.repartition(parts, "k", "i", "j").sortWithinPartitions("k", "i", "j")

    def run(batches):
        held = None
        for b in batches:
            k, f = b.column(1).to_numpy(), b.column(0).to_numpy().view(np.uint64)
            ij = (b.column(2).to_numpy().astype(np.int64) << 32) | b.column(3).to_numpy()
            if held is not None:
                k, ij, f = (np.concatenate(x) for x in zip(held, (k, ij, f)))
            ends = np.flatnonzero((k[1:] != k[:-1]) | (ij[1:] != ij[:-1])) + 1
            last = ends[-1] if len(ends) else 0
            held = (k[last:], ij[last:], f[last:])
            yield from emit(f[:last], ends[:-1], last)
        if held is not None:
            yield from emit(held[2], np.array([], dtype=np.int64), len(held[2]))

    def emit(f, ends, total):
        if not total:
            return
        starts = np.concatenate(([0], ends))
        sizes = np.diff(np.concatenate((starts, [total])))
        out_a, out_b = [], []
        for s, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            x, y = _forest(np.ascontiguousarray(f[s:s + n]), max_bits)
            out_a += x
            out_b += y
        if out_a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(z, dtype=np.uint64).view(np.int64)) for z in (out_a, out_b)],
                names=["a", "b"])

    return work.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """All rows without their text, plus `fingerprint` (16 hex digits), `fp` (the
    same as a long), `component_id`, the smallest id reachable over links, and
    `group_id`, the group's smallest `fp`.

    A null or wordless text has fingerprint zero and is linked like any other.
    Equal texts share a fingerprint and so a group. A group whose ids are all
    null has a null component_id. An empty table gives an empty table. Extra
    columns are carried along.
    """
    rows = cut(fingerprints(docs, text_col, shingle))
    nodes = rows.groupBy("fp").agg(F.min(F.col(f"`{id_col}`")).alias("__id"))
    roots = connected_components(links(nodes.select("fp"), max_bits))
    nodes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "__id", F.coalesce("root", "fp").alias("__root"))
    nodes = cut(nodes)
    label = cut(nodes.groupBy("__root").agg(F.min("__id").alias("component_id")))
    names = cut(nodes.select("fp", "__root").join(label, "__root").select("fp", "component_id", F.col("__root").alias("group_id")))
    return rows.join(names, "fp").withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))
