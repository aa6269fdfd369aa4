"""Hard negatives: rows of another label that score just below an anchor's positives.

Candidates lie in blocks, and the anchors stream past each of them. The scores of a
tile of anchors and candidates are an exact integer matrix product by Strassen's
recursion. A tile leaves a bounded heap per anchor: first of its best rows with the same
label, then, per positive, of its best rows of another label inside the window that the
positive's score opens. Heaps of tiles are merged by rank.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelens.llm import tiles
from pagelens.llm.common import cut

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative scores between these shares of the positive's score, in per cent.
LOW, HIGH = 80, 100
#: Candidates of a block, on average.
BLOCK = 8192
#: A product with a side of at most this length is taken directly.
LEAF = 16
LEAST, MOST = -2 ** 63 + 1, 2 ** 63 - 1


def integers(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
             scale: int = SCALE) -> DataFrame:
    """(id, label, v) with components floor(scale * x), x as double. Rows with a null id,
    label or vector, or a component that is null or not finite, are left out."""
    x = F.col(f"`{vec_col}`").cast("array<double>")
    bad = F.exists(x, lambda y: y.isNull() | F.isnan(y) | (F.abs(y) == float("inf")))
    return vectors.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & x.isNotNull() & ~bad) \
        .select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("label"),
                F.transform(x, lambda y: F.floor(y * scale).cast("long")).alias("v"))


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b by seven half-size products a level; odd sides are filled with a zero row or
    column. Integer sums wrap alike on both sides, so the result is exact wherever the
    product itself fits the type."""
    n, d, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, d, m) <= leaf:
        return a @ b
    a = np.pad(a, ((0, n % 2), (0, d % 2)))
    b = np.pad(b, ((0, d % 2), (0, m % 2)))
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * k), dtype=a.dtype)
    out[:i, :k] = p1 + p4 - p5 + p7
    out[:i, k:] = p3 + p5
    out[i:, :k] = p2 + p4
    out[i:, k:] = p1 - p2 + p3 + p6
    return out[:n, :m]


def scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a with the rows of x. Where they may not fit 64 bits
    they are taken over Python integers, and those beyond count as the nearest that fits."""
    if not a.size or not x.size:
        return np.zeros((len(a), len(x)), dtype=np.int64)
    size = [max(int(y.max()), -int(y.min())) for y in (a, x)]
    if size[0] * size[1] * a.shape[1] <= MOST:
        return strassen(a, x.T)
    full = strassen(a.astype(object), x.T.astype(object))
    return np.clip(full, LEAST, MOST).astype(np.int64)


def best(score: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest allowed scores of each row; of equal ones the first columns."""
    if score.shape[1] > k:
        held = np.where(ok, score, LEAST - 1)
        ok = ok & (held >= np.partition(held, score.shape[1] - k, axis=1)[:, score.shape[1] - k, None])
    r, c = np.nonzero(ok)
    order = np.lexsort((c, -score[r, c], r))
    r, c = r[order], c[order]
    keep = np.arange(len(r)) - np.searchsorted(r, r) < k
    return r[keep], c[keep]


def load(block: pa.Table):
    """A block of candidates in the order of their ids."""
    block = block.combine_chunks().sort_by([("id", "ascending"), ("rid", "ascending")])
    v = block.column("v")
    return {"id": block.column("id").to_numpy(), "rid": block.column("rid").to_numpy(),
            "label": block.column("label").to_pylist(), "x": tiles.matrix(v, tiles.width(v), np.int64)}, ()


def tile(held: dict, anchors: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Scores of a batch of anchors against a block, and where the labels are equal."""
    v = anchors.column("v")
    dims = max(tiles.width(v), held["x"].shape[1])
    x = np.pad(held["x"], ((0, 0), (0, dims - held["x"].shape[1])))
    code = {}
    a = np.array([code.setdefault(y, len(code)) for y in anchors.column("label").to_pylist()])
    b = np.array([code.setdefault(y, len(code)) for y in held["label"]])
    return scores(tiles.matrix(v, dims, np.int64), x), a[:, None] == b[None, :]


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, block: int = BLOCK) -> DataFrame:
    """The first `negatives` hard negatives of every anchor and positive: anchor_id,
    positive_id, rank (from 1), negative_id, positive_score, negative_score.

    `vectors` is a table (id, label, v) as `integers` makes it; `is_anchor` is a condition
    on it. Higher scores come first, ties by smaller id. An anchor's positives are its
    first `positives` other rows of the same label; a negative has another label and
    low * positive_score <= 100 * negative_score <= high * positive_score. Rows are told
    apart by their place, so rows of one id are rows of their own. A pair without
    negatives gives no row, an empty table none. Shorter vectors count as filled with
    zeros. A score beyond 64 bits counts as the nearest that fits. Columns other than id,
    label and v are not read.

    Candidates are shuffled once; anchors once per block. A task holds one block and a
    batch of anchors, and a tile leaves at most `positives` (`positives * negatives`) rows
    an anchor, cut further before each merge.
    """
    rows = cut(vectors.where("id is not null and label is not null and v is not null").select(
        "id", F.col("label").cast("string").alias("label"), "v", is_anchor.alias("anchor"),
        F.monotonically_increasing_id().alias("rid")))
    n = rows.count()
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-n // block), min(parts, -(-n // 512)))
    own = rows.select(F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("role"),
                      "id", "rid", "label", "v")
    anchors = rows.where("anchor").select("id", "rid", "label", "v")

    def dealt(a: DataFrame) -> DataFrame:
        """The blocks with every anchor beside each of them."""
        a = a.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("role"), "*")
        return own.unionByName(a, allowMissingColumns=True)

    def ranked(df: DataFrame, key: list[str], by: str, k: int, name: str) -> DataFrame:
        """Merge the heaps of the tiles: the k best of each key."""
        w = Window.partitionBy(*key).orderBy(F.col(f"{by}_score").desc(), f"{by}_id", f"{by}_rid")
        return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)

    def same(held, a):
        score, alike = tile(held, a)
        rid = a.column("rid").to_numpy()
        r, c = best(score, alike & (rid[:, None] != held["rid"][None, :]), positives)
        yield pa.RecordBatch.from_arrays(
            [pa.array(z) for z in (rid[r], held["id"][c], held["rid"][c], score[r, c])],
            names=["rid", "positive_id", "positive_rid", "positive_score"])

    heaps = tiles.past_blocks(dealt(anchors), "rid long, positive_id long, positive_rid long, positive_score long",
                              load, same)
    first = ranked(heaps, ["rid"], "positive", positives, "p")
    windows = first.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("p", "positive_id", "positive_score"))).alias("w"))
    windows = cut(anchors.join(cut(windows), "rid").select(
        "id", "rid", "label", "v", F.col("w.positive_id").alias("pids"), F.col("w.positive_score").alias("pscores")))

    def inside(held, a):
        score, alike = tile(held, a)
        ids, rid = a.column("id").to_numpy(), a.column("rid").to_numpy()
        pids, pscores = a.column("pids").to_pylist(), a.column("pscores").to_pylist()
        for p in range(positives):
            has = np.array([i for i, s in enumerate(pscores) if p < len(s)], dtype=np.int64)
            if not len(has):
                break
            top = [pscores[i][p] for i in has]
            lo = np.array([min(max(-(-low * s // 100), LEAST), MOST) for s in top], dtype=np.int64)
            hi = np.array([min(max(high * s // 100, LEAST), MOST) for s in top], dtype=np.int64)
            part = score[has]
            r, c = best(part, ~alike[has] & (part >= lo[:, None]) & (part <= hi[:, None]), negatives)
            if len(r):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[has[r]]), pa.array(rid[has[r]]), pa.array(np.full(len(r), p, dtype=np.int32)),
                     pa.array([pids[i][p] for i in has[r]]), pa.array([pscores[i][p] for i in has[r]]),
                     pa.array(held["id"][c]), pa.array(held["rid"][c]), pa.array(part[r, c])],
                    names=["anchor_id", "rid", "p", "positive_id", "positive_score", "negative_id", "negative_rid",
                           "negative_score"])

    found = tiles.past_blocks(
        dealt(windows), "anchor_id long, rid long, p int, positive_id long, positive_score long, negative_id long, "
        "negative_rid long, negative_score long", load, inside)
    return ranked(found, ["rid", "p"], "negative", negatives, "rank").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * v.e[i])) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
    s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
