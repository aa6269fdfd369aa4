"""Toxicity scores from the nearest labelled examples.

Texts and examples are TF-IDF vectors over all words of the examples. Words that
stand in more toxic than clean examples weigh more; no word is left out. The examples
lie in an inverted index cut into blocks; per word and block the index keeps the
largest weight. Words that many examples share are rows of a matrix instead, whose
product with a batch of texts is exact, so the bound of a block is the best of that
part in the block plus one small dot product. The blocks with the highest bounds are
scored first, then those whose bounds reach the k-th best cosine so far, which makes
the k nearest exact. Their votes, weighted by cosine, are turned into a probability by
a map learnt from the examples' own votes.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelens.llm.common import cut

#: Bound of the training sample: labelled texts per label, the first by hash of the id.
TRAIN_TEXTS = 4000
#: A word that weighs more is in at least this many training texts.
LEAST_TEXTS = 4
#: Standard errors between such a word's shares of toxic and clean texts, at least.
SIGNIFICANCE = 5.0
#: Times its share of clean texts that its share of toxic texts is, at least: a word
#: that is merely frequent in the language of most toxic texts says nothing.
RATIO = 3.0
#: Times the weight of any other word of the same frequency.
STRESS = 3.0
NEAREST = 15
LONELY = 3.0
BLOCK = 64
#: Blocks that are scored first, for a k-th best cosine to hold the bounds against.
PROBE = 4
#: A word that at least one in this many examples holds is a row of the matrix.
COMMON = 16
#: Texts whose matrix product is taken at once.
BATCH = 256
WORD = re.compile(r"[^\W\d_]+")
#: What is not a letter of ASCII becomes a space.
LETTERS = {c: chr(c) if chr(c).isalpha() else " " for c in range(128)}


def words_of(text: str | None) -> list[str]:
    """The lower-cased words of a text; of plain ASCII they are split without the pattern."""
    text = (text or "").lower()
    return text.translate(LETTERS).split() if text.isascii() else WORD.findall(text)


def counted(text: str | None) -> Counter:
    """Occurrences of each lower-cased word."""
    return Counter(words_of(text))


def numbered(counts: Counter, vocabulary: dict) -> dict:
    """Occurrences by number of the word, words outside the vocabulary left out."""
    return {t: n for t, n in zip(map(vocabulary.get, counts), counts.values()) if t is not None}


def ranges(first, end):
    """The numbers first[0] .. end[0] - 1, first[1] .. end[1] - 1, ..., and the lengths."""
    size = end - first
    last = np.cumsum(size)
    return np.arange(last[-1] if len(last) else 0) + np.repeat(first - last + size, size), size


class Index:
    """Block-max inverted index over unit TF-IDF vectors of the examples."""

    def __init__(self, idf: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: list):
        n, v = len(ids), len(idf)
        blocks = -(-n // BLOCK)
        size = [len(ts) for ts, _ in vectors] + [0] * (n - len(vectors))  # read twice, never held at once
        d = np.repeat(np.arange(n, dtype=np.int32), size)
        t, w = np.zeros(len(d), dtype=np.int32), np.zeros(len(d))
        for end, (ts, ws) in zip(np.cumsum(size).tolist(), vectors):
            t[end - len(ts):end], w[end - len(ts):end] = ts, ws
        often = np.flatnonzero(np.bincount(t, minlength=v) * COMMON >= max(n, 1))
        row = np.full(v, -1, dtype=np.int64)
        row[often] = np.arange(len(often))
        dense, held = np.zeros((len(often), n)), row[t] >= 0
        dense[row[t[held]], d[held]] = w[held]
        order = np.argsort(t[~held], kind="stable")
        t, d, w = t[~held][order], d[~held][order], w[~held][order]
        key = t.astype(np.int64) * max(blocks, 1) + d // BLOCK
        at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, dtype=np.int64)
        best = np.maximum.reduceat(w, at) if len(at) else np.zeros(0)
        entries = np.concatenate(([0], np.cumsum(np.bincount(t[at], minlength=v))))
        smallest = np.minimum.reduceat(ids, np.arange(0, n, BLOCK)) if n else ids
        d = d.astype(np.intp)  # what bincount takes without a copy
        self.restore((idf, ids, labels, smallest, row, dense, entries, (d // BLOCK)[at], best,
                      np.concatenate(([0], np.cumsum(np.bincount(t, minlength=v)))), d, w))

    def restore(self, arrays):
        """idf, ids, labels, smallest id of each block, row of each common term, the matrix
        (term row, example); of the other terms: first entry of each, block and largest
        weight of each entry; first posting of each, example and weight of each posting."""
        self.arrays = arrays
        (self.idf, self.ids, self.labels, self.first, self.row, self.dense, self.entries, self.block, self.best,
         self.at, self.doc, self.weight) = arrays
        return self

    def common(self, vectors) -> np.ndarray:
        """The part of the cosines that the common terms give: a row for each vector."""
        q = np.zeros((len(vectors), len(self.dense)))
        for i, (ts, ws) in enumerate(vectors):
            held = self.row[ts] >= 0
            q[i, self.row[ts[held]]] = ws[held]
        return q @ self.dense

    def scored(self, ts, ws, blocks):
        """(example numbers, cosines above 0) of whole blocks, those surely below the
        k-th best so far left out. Cosines count to 12 digits, so that equal ones are
        equal however they were summed."""
        part, doc, x, level = self.query
        alive = np.zeros(len(self.first), dtype=bool)
        alive[blocks] = True
        here = np.repeat(alive, BLOCK)[:len(part)]
        if 2 * len(blocks) < len(alive):  # else what is left out costs more to find than to add
            held = here[doc]
            doc, x = doc[held], x[held]
        score = part + np.bincount(doc, x, len(part))
        hit = np.flatnonzero((score > max(0.0, level - 1e-11)) & here)
        return hit, np.round(score[hit], 12)

    def nearest(self, ts: np.ndarray, ws: np.ndarray, k: int = NEAREST, leave: int = -1, part=None):
        """(example numbers, cosines) of the k nearest with a cosine above 0, best
        first, ties to the smaller id; `leave` is left out. `part` is the row that
        `common` gives for the vector.

        The blocks with the highest bounds give a k-th best cosine; of the others
        only those whose bound reaches it (at the same cosine: that hold a smaller
        id) are scored.
        """
        if not len(ts):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        part = self.common([(ts, ws)])[0] if part is None else part
        entry, size = ranges(self.entries[ts], self.entries[ts + 1])
        bound = np.bincount(self.block[entry], np.repeat(ws, size) * self.best[entry], len(self.first))
        posting, size = ranges(self.at[ts], self.at[ts + 1])
        doc, x = self.doc[posting], np.repeat(ws, size) * self.weight[posting]
        bound = np.round(bound + np.maximum.reduceat(part, np.arange(0, len(part), BLOCK)) + 1e-12, 12)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        near, cosines, level = np.zeros(0, dtype=np.int64), np.zeros(0), 0.0
        for blocks in (order[:PROBE], order[PROBE:]):
            if len(near) == k:
                level, last = cosines[-1], self.ids[near[-1]]
                b = bound[blocks]
                blocks = blocks[(b > level) | (b == level) & (self.first[blocks] < last)]
            if not len(blocks):
                continue
            self.query = part, doc, x, level
            hit, c = self.scored(ts, ws, blocks)
            near, cosines = np.concatenate((near, hit[hit != leave])), np.concatenate((cosines, c[hit != leave]))
            if len(near) > k:  # only what reaches the k-th best is sorted
                good = cosines >= np.partition(cosines, -k)[-k]
                near, cosines = near[good], cosines[good]
            best = np.lexsort((self.ids[near], -cosines))[:k]
            near, cosines = near[best], cosines[best]
        return near, cosines

    def all_nearest(self, vectors, leave=None):
        """`nearest` of each vector, the common terms taken for BATCH vectors at once."""
        every = iter(vectors)
        for a in range(0, len(vectors), BATCH):
            some = list(islice(every, BATCH))
            for i, (v, part) in enumerate(zip(some, self.common(some))):
                yield self.nearest(*v, leave=-1 if leave is None else leave[a + i], part=part)

    def vector(self, counts: dict):
        """Terms and unit weights of a text, (1 + ln tf) * idf."""
        ts = np.fromiter(counts, np.int64, len(counts))
        if not len(ts):
            return ts, np.zeros(0)
        order = np.argsort(ts)
        ts = ts[order]
        ws = (1 + np.log(np.fromiter(counts.values(), np.float64, len(counts))[order])) * self.idf[ts]
        return ts, ws / np.linalg.norm(ws)

    def vote(self, near, cosines) -> float:
        """Share of the cosine weight that the toxic neighbours hold, -1 without
        neighbours; LONELY of weight goes to no label, so that few or distant
        neighbours say little."""
        return float(cosines @ self.labels[near] / (cosines.sum() + LONELY)) if len(near) else -1.0


def _sample(docs, labels, id_col, text_col, label_col, per_label):
    lab = labels.where(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).alias("y"))
    size = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not size:
        return None
    part = F.element_at(F.create_map(*[F.lit(v) for y, n in size.items() for v in (y, min(1.0, per_label / n))]), F.col("y"))
    u = F.pmod(F.xxhash64(F.lit("toxicity"), id_col), F.lit(1 << 30)) / float(1 << 30)
    picked = lab.where(u < part)  # at most about two times per_label rows
    return docs.select(F.col(id_col), F.col(text_col).alias("t")).join(F.broadcast(picked), id_col)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", per_label: int = TRAIN_TEXTS):
    """Learn index and calibration from the labelled rows given, and document
    frequencies from all rows of `docs`.

    Returns plain parts for `score` (bounded by per_label examples and their words).
    Every example of the sample is in the index, with all its words.
    A document with several labels counts as toxic if one says so; null labels and
    labels beside 0 and 1 are left out. Without labelled rows everything scores 0.
    """
    sample = _sample(docs, labels, id_col, text_col, label_col, per_label)
    if sample is None:
        return None
    parts = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # read several times, so materialised; its size is bounded by per_label;
    # and copies of a text count once, lest its words seem to be in many toxic texts
    sample = sample.groupBy(id_col).agg(F.max("y").alias("y"), F.max("t").alias("t"))
    sample = sample.groupBy(F.sha2(F.col("t").cast("binary"), 256).alias("d")).agg(
        F.min(id_col).alias(id_col), F.max("y").alias("y"), F.max("t").alias("t"))
    sample = cut(sample.repartition(parts, "d"))
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)

    def examples(batches):
        for b in batches:
            out = [(i, y, counted(t)) for i, y, t in zip(*(b.column(j).to_pylist() for j in range(3)))]
            yield pa.RecordBatch.from_arrays(  # words are letters only, so a space parts them
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()),
                 pa.array([" ".join(x[2]) for x in out], pa.string()),
                 pa.array([array("i", x[2].values()).tobytes() for x in out], pa.binary())], names=["id", "y", "ws", "ns"])

    rows = sample.select(F.col(id_col).cast("long").alias("id"), F.col("y").cast("int"), "t") \
        .mapInArrow(examples, "id long, y int, ws string, ns binary").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["id"] is None, r["id"] or 0))
    at: dict = {}
    own = []
    for r in rows:
        pairs = sorted(zip(r.pop("ws").split(), array("i", r.pop("ns"))))
        own.append((array("i", [at.setdefault(w, len(at)) for w, _ in pairs]), array("i", [n for _, n in pairs])))
    y = np.array([r["y"] for r in rows], dtype=np.float64)
    seen = np.concatenate([np.asarray(ts, dtype=np.int32) for ts, _ in own]) if own else np.zeros(0, dtype=np.int32)
    c1 = np.bincount(seen, np.repeat(y, [len(ts) for ts, _ in own]), len(at))
    c0 = np.bincount(seen, minlength=len(at)) - c1
    # A text is toxic for what it has, not for what it lacks: the words that weigh more
    # stand in more toxic than clean texts, beyond what chance gives among all words.
    p1, p0, mean = c1 / max(n1, 1), c0 / max(n0, 1), (c0 + c1) / max(n0 + n1, 1)
    z = (p1 - p0) / np.sqrt(mean * (1 - mean) * (1 / max(n1, 1) + 1 / max(n0, 1)) + 1e-12)
    bearing = (c0 + c1 >= LEAST_TEXTS) & (z >= SIGNIFICANCE) & ((c1 + 0.5) / max(n1, 1) >= RATIO * (c0 + 0.5) / max(n0, 1))
    total, n = document_frequencies(docs.select(F.col(text_col).alias("t")), at)
    idf = (np.log((1 + total) / (1 + n)) + 1) * np.where(bearing, STRESS, 1.0)
    parts = (at, idf, np.array([r["id"] or 0 for r in rows], dtype=np.int64), y, own)
    index = build(parts)
    votes = [(index.vote(*near), r["y"]) for near, r in zip(index.all_nearest(
        Vectors(index, own), range(len(own))), rows)]
    weight = {0: size_of(labels, label_col, 0) / max(n0, 1), 1: size_of(labels, label_col, 1) / max(n1, 1)}
    return (*parts, calibrate(votes, weight), index.arrays)


def document_frequencies(texts: DataFrame, at: dict):
    """(texts, how many of them hold each word of `at`), over all texts."""
    shared = texts.sparkSession.sparkContext.broadcast(at)  # bounded by the words of the examples

    def run(batches):
        held, n, number = np.zeros(len(shared.value) + 1, dtype=np.int64), 0, shared.value.get
        for b in batches:
            n += b.num_rows
            for a in range(0, b.num_rows, BATCH):
                seen: list[int] = []  # words outside `at` get the last number
                for t in b.column(0)[a:a + BATCH].to_pylist():
                    seen.extend(map(number, set(words_of(t)), repeat(len(held) - 1)))
                held += np.bincount(np.array(seen, dtype=np.intp), minlength=len(held))
        numbers = [(w, c) for w, c in enumerate(held[:-1].tolist()) if c] + [(-1, n)]
        for i in range(0, len(numbers), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in numbers[i:i + 50_000]], pa.int32()),
                                              pa.array([x[1] for x in numbers[i:i + 50_000]], pa.int64())], names=["w", "n"])

    got = texts.mapInArrow(run, "w int, n long").groupBy("w").agg(F.sum("n").alias("n")).toArrow()
    shared.destroy()
    out = np.zeros(len(at) + 1)  # the last one is -1, all texts
    out[got.column("w").to_numpy()] = got.column("n").to_numpy()
    return out[-1], out[:-1]


def size_of(labels, label_col, y):
    return labels.where(F.col(label_col) == y).count()


def calibrate(votes, weight, bins: int = 20):
    """Probability of the toxic label per vote: the smoothed, rising rate of the label
    in bins of the examples' own leave-one-out votes, with the sample drawn back to the
    label's true share. Bin 0 holds the texts without neighbours."""
    total, toxic = np.full(bins + 2, 1.0), np.zeros(bins + 2)
    prior = sum(weight[y] for v, y in votes if y) / max(1e-9, sum(weight[y] for _, y in votes))
    toxic += prior
    for v, y in votes:
        b = 0 if v < 0 else 1 + int(v * bins)
        total[b] += weight[y]
        toxic[b] += weight[y] * y
    rate = toxic / total
    blocks: list[list[float]] = []  # pooled until the rates rise
    for t, w in zip(rate, total):
        blocks.append([t, w, 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            t2, w2, n2 = blocks.pop()
            t1, w1, n1 = blocks.pop()
            blocks.append([(t1 * w1 + t2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([b[0] for b in blocks], [b[2] for b in blocks])


def build(parts) -> Index:
    _, idf, ids, labels, counts = parts[:5]
    index = Index(idf, ids, labels, [])
    return Index(idf, ids, labels, Vectors(index, counts))


class Vectors:
    """The vectors of (terms, counts) pairs, each made when it is read."""

    def __init__(self, index: Index, counts):
        self.index, self.counts = index, counts

    def __len__(self):
        return len(self.counts)

    def __iter__(self):
        return (self.index.vector(dict(zip(ts, ns))) for ts, ns in self.counts)


def score(docs: DataFrame, model, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """The rows (with their text only if `keep_text`), plus `score` (0 to 1), `predicted`
    and `evidence` (the nearest examples: id, label, cosine).

    Null and empty texts, and texts without a word of the examples, have no
    neighbours and get the label's rate among such examples. Whole texts are read.
    """
    others = [c for c in docs.columns if c not in (text_col, "score", "predicted", "evidence")]
    src = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text_col}`").alias("__text"))
    kind = "array<struct<id: bigint, label: int, cosine: double>>"
    kept = src if keep_text else src.drop("__text")
    schema = kept.withColumns({"score": F.lit(0.0), "predicted": F.lit(0),
                                             "evidence": F.lit(None).cast(kind)}).schema
    # bounded by per_label examples and their words
    shared = docs.sparkSession.sparkContext.broadcast((model[0], model[6], model[5]) if model else None)

    def run(batches):
        parts = shared.value
        index = Index.__new__(Index).restore(parts[1]) if parts else None
        near = pa.list_(pa.struct([("id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))
        for b in batches:
            texts, out = b.column(b.num_columns - 1), []
            if index is None:
                out = [(0.0, [])] * len(texts)
            for a in range(0, 0 if index is None else len(texts), BATCH):
                vectors = [index.vector(numbered(counted(t.as_py()), parts[0])) for t in texts[a:a + BATCH]]
                for n, c in index.all_nearest(vectors):
                    v, rate = index.vote(n, c), parts[2]
                    p = rate[0] if v < 0 else rate[1 + int(v * (len(rate) - 2))]
                    out.append((float(p), [{"id": i, "label": int(y), "cosine": x} for i, y, x in
                                           zip(index.ids[n].tolist(), index.labels[n].tolist(), c.tolist())]))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(b.num_columns - (not keep_text))), pa.array([o[0] for o in out], pa.float64()),
                 pa.array([int(o[0] >= 0.5) for o in out], pa.int32()), pa.array([o[1] for o in out], near)], names=names)

    names = schema.names
    return src.mapInArrow(run, schema).withColumnRenamed("__text", text_col)
