"""Language identification with bit-sliced Bloom filters over n-grams.

Every language has a Bloom filter over its frequent byte n-grams. The filters lie
across one table: row r holds bit r of all filters, one bit per language (64 to a
mask), so the AND of an n-gram's k rows is the mask of all languages that contain it. The set
bits are counted per language over the n-grams of a text, corrected for the
filter's false positives, and the highest count decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelens.llm.common import cut

#: Lengths of the n-grams in bytes (of the text with A-Z lower-cased).
GRAMS = (3, 4, 5)
#: Rows of the filter table and probes per n-gram.
ROWS = 1 << 18
PROBES = 3
#: An n-gram belongs to a language if at least this share of its training texts has it.
SHARE = 0.02
#: Texts of each language that the filters are learnt from, the first by hash of
#: the id; documented bound of the training sample.
TRAIN_TEXTS = 3000
#: Languages per mask; with more of them the table has one mask after another.
BITS = 64
CHUNK = 1 << 20


def grams(text: bytes, starts: int | None = None, sizes=GRAMS) -> np.ndarray:
    """One 64-bit code per n-gram occurrence: its bytes below its length. Only the
    n-grams of the first `starts` positions, if given."""
    b = np.frombuffer(text.lower(), dtype=np.uint8).astype(np.uint64)
    out = []
    for n in sizes:
        m = min(len(b) - n + 1, starts or len(b))
        if m > 0:
            code = np.full(m, n, dtype=np.uint64)
            for i in range(n):
                code = (code << np.uint64(8)) | b[i:m + i]
            out.append(code)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def probes(codes: np.ndarray, rows: int = ROWS, k: int = PROBES):
    """The k rows of each code (double hashing)."""
    h = codes * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    a, b = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return [((a + np.uint64(i) * b) % np.uint64(rows)).astype(np.int64) for i in range(k)]


def bits_of(masks: np.ndarray, n: int) -> np.ndarray:
    """The first n bits of each mask, as a row of zeros and ones."""
    return (masks[:, None] >> np.arange(n, dtype=np.uint64)) & np.uint64(1)


class Model:
    """Languages, filter table, false positive rate and mean share of members."""

    def __init__(self, langs, tables, fill, base):
        self.langs, self.tables, self.fill, self.base = langs, tables, fill, base

    def shared(self, spark):
        """Broadcast of the parts: ROWS masks per 64 languages."""
        return spark.sparkContext.broadcast((self.langs, self.tables, self.fill, self.base))

    def counts(self, text: bytes) -> tuple[np.ndarray, int]:
        """Members per language, corrected for false positives, and the n-grams."""
        found, n = np.zeros(len(self.langs)), 0
        for at in range(0, len(text), CHUNK):
            codes = grams(text[at:at + CHUNK + max(GRAMS) - 1], CHUNK)
            n += len(codes)
            if not len(codes):
                continue
            places = probes(codes)
            for w, table in enumerate(self.tables):
                mask = table[places[0]]
                for rows in places[1:]:
                    mask = mask & table[rows]
                kinds, times = np.unique(mask, return_counts=True)
                part = found[w * BITS:(w + 1) * BITS]
                part += times @ bits_of(kinds, len(part)).astype(np.int64)
        return np.maximum(0, found - n * self.fill) / (1 - self.fill), n

    def decide(self, text: bytes) -> tuple[str, float]:
        """(language, score); the score is the winner's share of the evidence, each
        language's count taken relative to what its own texts reach."""
        found, n = self.counts(text)
        if not n or not found.any():
            return (self.langs[0], 0.0) if self.langs else ("und", 0.0)
        rel = found / n / self.base
        top = int(np.argmax(rel))
        weight = np.exp(np.minimum(0, (rel - rel[top]) * np.sqrt(min(n, 400))))
        return self.langs[top], float(weight[top] / weight.sum())


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        texts: int = TRAIN_TEXTS) -> Model:
    """Learn the filters from labelled rows; rows without text or language are left out.

    Per language a sample of at most about `texts` rows is read (drawn by hash of
    the id). Counting n-grams and setting bits are aggregations; the driver gets the
    filter table, whose size is fixed (`ROWS` masks per 64 languages), and one row
    per language.
    """
    train = train.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    size = train.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")) \
        .collect()
    if not size:
        return Model([], [], np.zeros(0), np.ones(0))
    size = sorted((r["lang"], r["n"]) for r in size)
    langs = [x for x, _ in size]
    at = F.create_map(*[F.lit(v) for i, (x, _) in enumerate(size) for v in (x, i)])
    part = F.create_map(*[F.lit(v) for x, n in size for v in (x, min(1.0, texts / n))])
    u = F.pmod(F.xxhash64(F.lit("langid"), id_col), F.lit(1 << 30)) / float(1 << 30)
    sample = train.where(u < F.element_at(part, F.col(lang_col))) \
        .select(F.element_at(at, F.col(lang_col)).alias("l"), F.col(text_col).cast("binary").alias("t"),
                F.xxhash64(id_col, text_col).alias("h"))
    # dealt by id and text, so that copies of a text lie apart
    sample = sample.repartition(max(8, int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "h").drop("h")
    sample = cut(sample)  # read several times; its size is bounded by `texts` per language

    def count(batches):  # texts per n-gram and language within a task
        held: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for l, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(l, []).append(np.unique(grams(t)))
            if sum(len(x) for v in held.values() for x in v) > 4_000_000:
                yield from drain(held)
                held = {}
        yield from drain(held)

    def drain(held):
        for l, lists in held.items():
            codes, n = np.unique(np.concatenate(lists), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(codes), l, dtype=np.int32)), pa.array(codes.view(np.int64)),
                 pa.array(n.astype(np.int64))], names=["l", "g", "n"])

    seen = {r["l"]: r["n"] for r in sample.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    least = F.element_at(F.create_map(*[F.lit(v) for l, n in seen.items() for v in (l, max(1, int(n * SHARE)))]), F.col("l"))
    common = sample.mapInArrow(count, "l int, g long, n long").groupBy("l", "g").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= least)
    masks = common.groupBy("g", F.expr(f"l div {BITS}").cast("int").alias("w")) \
        .agg(F.bit_or(F.expr(f"shiftleft(1L, l % {BITS})")).alias("m"))

    def place(batches):
        for b in batches:
            codes, w, m = b.column(0).to_numpy().view(np.uint64), b.column(1), b.column(2)
            for rows in probes(codes):
                yield pa.RecordBatch.from_arrays([w, pa.array(rows), m], names=["w", "r", "m"])

    tables = [np.zeros(ROWS, dtype=np.uint64) for _ in range(-(-len(langs) // BITS))]
    placed = masks.mapInArrow(place, "w int, r long, m long").groupBy("w", "r").agg(F.bit_or("m").alias("m")).toPandas()
    for w, part in placed.groupby("w"):
        tables[w][part["r"].to_numpy(dtype=np.int64)] = part["m"].to_numpy(dtype=np.int64).view(np.uint64)
    set_bits = np.concatenate([bits_of(t, min(BITS, len(langs) - w * BITS)) for w, t in enumerate(tables)], axis=1)
    model = Model(langs, tables, set_bits.mean(axis=0) ** PROBES, np.ones(len(langs)))
    shared = model.shared(train.sparkSession)

    def reach(batches):
        m = Model(*shared.value)
        for b in batches:
            rows = [(l, float(c[l] / n)) for l, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                    for c, n in [m.counts(t)] if n]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                              pa.array([r[1] for r in rows], pa.float64())], names=["l", "x"])

    for r in sample.mapInArrow(reach, "l int, x double").groupBy("l").agg(F.avg("x").alias("x")).collect():
        model.base[r["l"]] = max(r["x"], 1e-6)
    return model


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows with their text replaced by `lang_pred` and `score`.

    A text that is null or has no letter is `und` with score 0. Whole texts are
    read, in chunks that overlap by an n-gram. Only the text decides.
    """
    shared = model.shared(docs.sparkSession)
    others = [c for c in docs.columns if c not in (text_col, "lang_pred", "score")]
    letter = F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False))
    src = docs.select(*[F.col(f"`{c}`") for c in others],
                      F.when(letter, F.col(f"`{text_col}`").cast("binary")).alias("__text"))
    schema = src.drop("__text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def run(batches):
        m = Model(*shared.value)
        for b in batches:
            got = [("und", 0.0) if not t.is_valid else m.decide(t.as_py()) for t in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(b.num_columns - 1)), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], names=[*b.schema.names[:-1], "lang_pred", "score"])

    return src.mapInArrow(run, schema)
