"""Exact top-k inner products over an impact-ordered index.

A block of vectors is indexed by impact: the postings (vector, component) fall in
segments by the quantised magnitude of their value. Queries process the segments
by descending impact and add their contributions to accumulators. After each
segment the unprocessed rest of a score is bounded by the norms of what is left;
a query stops only when the bounds prove which vectors can still be among its k
best, and those are rescored exactly in integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelens.llm.common import cut

K = 5
SCALE = 256
#: Quantised impact levels below the largest magnitude of a block.
LEVELS = 8
#: Vectors and queries that one task holds at a time, on average.
BLOCK_VECTORS = 4096
BLOCK_QUERIES = 1024
#: A query stops once at most this many vectors can still be among its k best.
POSSIBLE = 64
#: Copies of a query that one array stands for.
RUN = 4096


def integers(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, v) with components floor(scale * x), x as double; vectors that are null
    or hold null or non-finite components, and null ids, are left out."""
    x = F.col(f"`{vec_col}`").cast("array<double>")
    bad = F.exists(x, lambda y: y.isNull() | F.isnan(y) | (F.abs(y) == float("inf")))
    return vectors.where(x.isNotNull() & F.col(f"`{id_col}`").isNotNull() & ~bad).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.transform(x, lambda y: F.floor(y * scale)).alias("v"))


def matrix(col: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Integer rows of a list column, shorter ones filled with zeros."""
    arr = col.combine_chunks()
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks)
    out = np.zeros((len(arr), dims), dtype=np.int64)
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(arr.offsets.to_numpy())
    row = np.repeat(np.arange(len(arr)), sizes)
    pos = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, pos] = flat
    return out


class ImpactIndex:
    """Postings of a block of different rows (id, vector), cut in segments by quantised
    impact. ``sizes`` are the lengths before the filling with zeros, ``copies`` how often
    the table holds each row."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, levels: int = LEVELS, sizes: np.ndarray | None = None,
                 copies: np.ndarray | None = None):
        self.ids, self.x = ids, x
        self.sizes = np.full(len(x), x.shape[1]) if sizes is None else sizes
        self.copies = np.ones(len(x), dtype=np.int64) if copies is None else copies
        size = np.abs(x).astype(np.float64)
        level = np.floor(size * levels / (size.max() + 1)) if x.size else size
        self.segments, self.rest = [], []
        left = size ** 2
        for l in range(levels - 1, -1, -1):
            part = level == l
            if part.any():
                self.segments.append(np.where(part, x, 0).astype(np.float64))
                left = np.where(part, 0, left)
                self.rest.append(np.sqrt(left.sum(axis=1)))

    def same(self, qids: np.ndarray, q: np.ndarray, qsizes: np.ndarray | None = None):
        """(query numbers, vector numbers) of equal rows: a query's own and its copies."""
        i, j = np.nonzero(qids[:, None] == self.ids[None, :])
        equal = (q[i] == self.x[j]).all(axis=1) & ((q.shape[1] if qsizes is None else qsizes[i]) == self.sizes[j])
        return i[equal], j[equal]

    def search(self, qids: np.ndarray, q: np.ndarray, k: int = K, qsizes: np.ndarray | None = None):
        """(query numbers, vector numbers, scores) of the k best other rows per query; a
        query's equal row is among them where the table holds it more than once."""
        qf = q.astype(np.float64)
        norm = np.linalg.norm(qf, axis=1)
        own = np.zeros((len(q), len(self.ids)), dtype=bool)
        i, j = self.same(qids, q, qsizes)
        own[i, j] = self.copies[j] < 2
        open_ = np.arange(len(q))
        done: list[tuple] = []
        acc = np.zeros((len(q), len(self.ids)))
        for seg, rest in zip(self.segments, self.rest):
            acc[open_] += qf[open_] @ seg.T
            slack = norm[open_, None] * rest[None, :] * (1 + 1e-9) + 1e-6 * (1 + np.abs(acc[open_]) * 1e-6)
            low = np.where(own[open_], -np.inf, acc[open_] - slack)
            high = np.where(own[open_], -np.inf, acc[open_] + slack)
            if low.shape[1] > k:
                kth = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
            else:
                kth = np.full(len(open_), -np.inf)
            possible = (high >= kth[:, None]) & ~own[open_]
            final = seg is self.segments[-1]
            proved = (possible.sum(axis=1) <= max(POSSIBLE, k)) | final
            for i in np.flatnonzero(proved):
                done.append((open_[i], np.flatnonzero(possible[i])))
            open_ = open_[~proved]
            if not len(open_):
                break
        if not self.segments:  # no dimension at all: every score is zero
            done = [(i, np.flatnonzero(~own[i])) for i in range(len(q))]
        out = []
        for i, members in done:
            s = exact(q[i], self.x[members])
            best = np.lexsort((self.ids[members], -s))[:k]
            out.append((np.full(len(best), i), members[best], s[best]))
        return [np.concatenate(z) for z in zip(*out)] if out else [np.zeros(0, dtype=np.int64)] * 3


def exact(q: np.ndarray, xs: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond 64 bits they stop at the ends of the range."""
    if not xs.size or float(np.abs(q).max()) * float(np.abs(xs).max()) * len(q) < 2 ** 62:
        return xs @ q
    big = [sum(int(a) * int(b) for a, b in zip(q, row)) for row in xs]
    return np.array([min(max(b, -2 ** 63 + 1), 2 ** 63 - 1) for b in big], dtype=np.int64)


def top_k(queries: DataFrame, vectors: DataFrame, k: int = K, block_vectors: int = BLOCK_VECTORS,
          block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """The k best vectors of each query: query_id, rank (from 1), vec_id, score.

    Both sides are tables (id, v) as `integers` makes them, with or without columns of
    other names, which are left out. Candidates of a query are all rows but one that
    equals it, its own: other rows with its id stay, and so do its copies. Equal rows are
    counted first, searched once and come back as often as they are there, queries as
    well. Vectors and queries are dealt into blocks by a hash of id and vector, so rows
    of one id spread, and every pair of blocks is one group: each row is sent once per
    block of the other side, and a group is bounded by the two block sizes. Shorter
    vectors count as filled with zeros. Ties go to the smaller id. Empty tables give an
    empty table.
    """
    counted = lambda t: cut(t.groupBy("id", "v").agg(F.count(F.lit(1)).alias("n")))
    queries, vectors = counted(queries), counted(vectors)
    queries = queries.withColumn("row", F.monotonically_increasing_id())  # over fixed files: the same in every scan
    nq = max(1, -(-queries.count() // block_queries))
    nv = max(1, -(-vectors.count() // block_vectors))
    cell = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")
    left = vectors.select("id", "v", "n", cell(nv).alias("vb"), F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("qb"))
    right = queries.select("id", "v", "n", "row", cell(nq).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(nv - 1))).alias("vb"))

    def search(x: pa.Table, q: pa.Table) -> pa.Table:
        names = ["row", "queries", "query_id", "vec_id", "score", "copies"]
        kind = pa.schema([(c, pa.int64()) for c in names])
        if not x.num_rows or not q.num_rows:
            return kind.empty_table()
        sizes, qsizes = (pc.list_value_length(t.column("v")).to_numpy() for t in (x, q))
        dims = max(sizes.max(), qsizes.max())
        ids, qids = x.column("id").to_numpy(), q.column("id").to_numpy()
        copies, qx = x.column("n").to_numpy(), matrix(q.column("v"), dims)
        index = ImpactIndex(ids, matrix(x.column("v"), dims), sizes=sizes, copies=copies)
        i, j, s = index.search(qids, qx, k, qsizes)
        own = np.isin(i * len(ids) + j, (lambda a, b: a * len(ids) + b)(*index.same(qids, qx, qsizes)))
        cols = [q.column("row").to_numpy()[i], q.column("n").to_numpy()[i], qids[i], ids[j], s, copies[j] - own]
        return pa.table([pa.array(c.astype(np.int64)) for c in cols], schema=kind)

    found = left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")) \
        .applyInArrow(search, "row long, queries long, query_id long, vec_id long, score long, copies long")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    best = found.select("*", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))).alias("copy")) \
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    # as often as the query is there, in runs that bound the arrays
    runs = best.select("*", F.explode(F.expr(f"sequence(0L, queries - 1, {RUN}L)")).alias("run"))
    return runs.select("query_id", "rank", "vec_id", "score",
                       F.explode(F.expr(f"sequence(1L, least({RUN}L, queries - run))")).alias("again")).drop("again")


ORACLE = """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.r, q.vec_id AS query_id, v.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * v.e[i])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND q.r <> v.r),
t AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM t WHERE rank <= 5
"""
