"""Phrase collocations by dynamic itemset counting.

The corpus lies in shards, and shards are scanned in a cycle, one a step. Words are counted
from the first step. A longer phrase becomes active at the step after both its
subphrases (all words but the last, all but the first) have reached the threshold, and is
counted wherever it occurs until it has seen every shard once. So phrases of all lengths
are counted in the same scans, and a cycle ends for each phrase on its own.

What reached the threshold when is known to the scans through a table of slots for each
length: a phrase is hashed to a slot, a byte with the step from which it is usable. A slot
is written once, so the step at which a phrase starts is the same in every scan. Phrases
that share a slot can only make others start that need not have: these see a full cycle
like all, and exact counts decide at the end. Counters are kept by the phrases' hashes; one
more scan holds the texts behind the counters that reached the threshold against the text
known for each counter, learnt from a share of the rows. A counter behind which all texts are equal
is that text's exact count; other texts are counted by themselves. The table's size is bounded; a fuller table
costs counters, never a phrase. Counts of a step are written once and summed only for
slots of phrases that had their share of the threshold in some shard of the cycle.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelens.llm.common import UPPER, LOWER, checked_join, clean_columns, cut, shared_path, stored

# --- fixed values: what separates pieces, and words within a piece ------------
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
GAPS = " \t"
# -----------------------------------------------------------------------------
TABLE = bytes.maketrans((UPPER + PIECE_ENDS).encode(), LOWER.encode() + b"\n" * len(PIECE_ENDS))
#: Words of the longest phrase, and how often a candidate occurs at least.
WORDS = 5
LEAST = 100
#: Shards of a cycle, 50 at most.
SHARDS = 2
#: Slots for each length of a subphrase: a power of two, one for some 256 bytes of text, within these.
FEWEST_SLOTS, MOST_SLOTS = 1 << 15, 1 << 22
#: Bytes of text that a task counts at a time.
SEGMENT = 4 << 20
#: Distinct phrases that a task adds up before it hands them on.
COMBINED = 1 << 18
#: Texts of counters are learnt from about so many bytes, at least one row in LEARN_SHARE, and
#: at most so many are held in a task; the others are counted by their texts in every task.
LEARN_BYTES, LEARN_SHARE, MOST_KNOWN = 32 << 20, 16, 1 << 20
TOP = 2000
#: A phrase goes if a longer candidate around it is seen in this share of its places, in per cent.
COVERED = 100
SEED = 42
POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, dtype=np.uint64))
#: A counter: hash of a phrase, step at which it began and words as one number, occurrences.
COUNTERS = "h long, meta long, c long"
#: An exact count: language, newline, phrase (which holds no newline); no words: all occurrences of words.
#: A negative number of words: the known phrase is not the only one behind its counter.
EXACT = "key binary, words int, c long"
#: The text of a flagged phrase, by its counter's hash.
TEXTS = "h long, words int, key binary"


def segments(data: bytes, size: int, words: int = WORDS):
    """Cut translated text into (bytes, limit): places below the limit start phrases here,
    the rest only completes them. Pieces are cut only where they are longer than `size`."""
    ahead = re.compile(rb"(?:[ \t]*[^ \t\n]+){0,%d}" % (words - 1))
    at = 0
    while len(data) - at > size:
        end = data.rfind(b"\n", at, at + size) + 1
        if end > at:
            yield data[at:end], end - at
        else:
            end = max(data.rfind(b" ", at, at + size), data.rfind(b"\t", at, at + size)) + 1
            if end <= at:  # a word longer than the segment
                m = re.compile(rb"[ \t\n]").search(data, at + size)
                end = m.end() if m else len(data)
            last = ahead.match(data, end).end() if data[end - 1:end] != b"\n" else end
            yield data[at:last], end - at
        at = end
    if at < len(data):
        yield data[at:], len(data) - at


def tokens(data: bytes):
    """(distinct words, code of each word, its piece, its place) of translated text."""
    arr = np.frombuffer(data, dtype=np.uint8)
    end = arr == 10
    inside = ~(end | (arr == 32) | (arr == 9))
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    at, stop = edge[::2], edge[1::2]
    offsets = np.concatenate(([0], np.cumsum(stop - at))).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(arr[inside])])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.cumsum(end, dtype=np.int32)[at], at


def word_hashes(words: pa.BinaryArray, seed: int) -> np.ndarray:
    """A hash of each word by its bytes and their places; it only chooses slots."""
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset:words.offset + len(words) + 1]
    raw = np.frombuffer(words.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(raw)) - np.repeat(offsets[:-1] - offsets[0], np.diff(offsets))
    h = np.add.reduceat(raw * POWERS[place & 4095], offsets[:-1] - offsets[0]) ^ np.uint64(seed)
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def slot_of(m: np.ndarray, slots: int) -> np.ndarray:
    return (m & np.uint64(slots - 1)).astype(np.int64)


class Segment:
    """The words of a segment, and the hashes of the phrases that start at each."""

    def __init__(self, data: bytes, limit: int, lang: str):
        self.words, self.code, self.piece, at = tokens(data)
        self.starts = at < limit
        if len(at):
            self.of_word = word_hashes(self.words, xxhash.xxh64_intdigest(lang.encode(), SEED))

    def phrases(self, longest: int):
        """(words, hashes, hashes of the phrases one word shorter, which places start one) by length."""
        if not len(self.code):
            return
        h, shorter = self.of_word[self.code], None
        for size in range(1, min(longest, len(self.code)) + 1):
            m = len(self.code) - size + 1
            if size > 1:
                shorter, h = mixed(h), h[:m] * np.uint64(0x100000001B3) + self.of_word[self.code[size - 1:]]
            yield size, h, shorter, (self.piece[:m] == self.piece[size - 1:]) & self.starts[:m]

    def texts(self, i: np.ndarray, size: int):
        """(distinct phrases of `size` words at places i, occurrences, which of i is the first)."""
        key = self.code[i]
        for j in range(1, size):
            if j > 1:
                key = np.unique(key, return_inverse=True)[1]
            key = key * len(self.words) + self.code[i + j]
        _, first, c = np.unique(key, return_index=True, return_counts=True)
        parts = [self.words.take(pa.array(self.code[i[first] + j])) for j in range(size)]
        return pc.binary_join_element_wise(*parts, b" ") if size > 1 else parts[0], c, first


def active(usable: np.ndarray, step: int, shards: int) -> list[int]:
    """The lengths of phrases that can be active at a step: a subphrase became usable within the last cycle."""
    return [1] * (step < shards) + [i + 2 for i, part in enumerate(usable) if (part > max(step - shards, 0)).any()]


def count(seg: Segment, step: int, usable: np.ndarray, shards: int, sizes: list[int]):
    """Counters of the active phrases of one segment. `usable` has one row of slots per
    length of a subphrase."""
    slots = usable.shape[1]
    for size, h, shorter, here in seg.phrases(max(sizes, default=0)):
        if size not in sizes:
            continue
        if size == 1:
            begin = np.zeros(len(h), dtype=np.uint8)
        else:
            since = usable[size - 2][slot_of(shorter, slots)]
            begin = np.maximum(since[:-1], since[1:])
            here = here & (since[:-1] > 0) & (since[1:] > 0) & (begin > step - shards)
        i = np.flatnonzero(here)
        if len(i):
            m, first, c = np.unique(mixed(h[i]), return_index=True, return_counts=True)
            meta = (begin[i[first]].astype(np.int64) << 3) | size
            yield pa.RecordBatch.from_arrays([pa.array(m.view(np.int64)), pa.array(meta), pa.array(c.astype(np.int64))],
                                             names=["h", "meta", "c"])


class Known:
    """Counters by length of the phrase: hashes in rising order, and the one text known for each."""

    def __init__(self, rows: pa.Table):
        self.of = {}
        words, hashes = rows["words"].to_numpy(), rows["h"].to_numpy().view(np.uint64)
        keys = rows["key"].combine_chunks()
        for size in np.unique(words).tolist():
            i = np.flatnonzero(words == size)
            i = i[np.argsort(hashes[i])]
            self.of[size] = hashes[i], keys.take(pa.array(i))

    def places(self, size: int, m: np.ndarray) -> np.ndarray:
        """Place of each hash among the known ones, -1 if it is not one."""
        if size not in self.of:
            return np.full(len(m), -1)
        h = self.of[size][0]
        at = np.minimum(np.searchsorted(h, m), len(h) - 1)
        return np.where(h[at] == m, at, -1)


def flagged_phrases(seg: Segment, flags: np.ndarray, known: Known | None = None):
    """(words, hashes, places) of the phrases of one segment whose slots are flagged, a row of
    slots per length, and whose subphrases' are; and of all that share a known counter's hash."""
    shorter = None
    for size, h, _, here in seg.phrases(len(flags)):
        m = mixed(h)
        flagged = slot = flags[size - 1][slot_of(m, flags.shape[1])]
        if size > 1:  # both subphrases of a frequent phrase are frequent
            flagged = slot & shorter[:-1] & shorter[1:]
        shorter = flagged
        i = np.flatnonzero(here & (flagged if known is None else slot))
        at = np.full(len(i), -1) if known is None else known.places(size, m[i])
        keep = flagged[i] | (at >= 0)
        if keep.any():
            yield size, m, i[keep], at[keep]


def learnt(seg: Segment, lang: str, flags: np.ndarray):
    """Texts of the flagged phrases of one segment."""
    prefix = pa.scalar(lang.encode() + b"\n", pa.binary())
    for size, m, i, _ in flagged_phrases(seg, flags):
        phrase, _, first = seg.texts(i, size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(m[i[first]].view(np.int64)), pa.array(np.full(len(first), size, dtype=np.int32)),
             pc.binary_join_element_wise(prefix, phrase, b"")], names=["h", "words", "key"])


def exactly(seg: Segment, lang: str, flags: np.ndarray, known: Known | None = None):
    """Exact counts of the phrases of one segment whose slots are flagged, a row of slots
    per length, and the number of its words. Phrases that are the text known for their
    counter are left to it; a known text that shares its counter with another one is named."""
    prefix = pa.scalar(lang.encode() + b"\n", pa.binary())

    def batch(keys, size, c):
        return pa.RecordBatch.from_arrays([keys, pa.array(np.full(len(c), size, dtype=np.int32)), pa.array(c.astype(np.int64))],
                                          names=["key", "words", "c"])

    yield batch(pa.array([prefix.as_py()], pa.binary()), 0, np.array([np.count_nonzero(seg.starts)]))
    for size, _, i, at in flagged_phrases(seg, flags, known):
        phrase, c, first = seg.texts(i, size)
        key, at = pc.binary_join_element_wise(prefix, phrase, b""), at[first]
        if (at >= 0).any():
            text = known.of[size][1].take(pa.array(at, mask=at < 0))
            own = pc.fill_null(pc.equal(key, text), False).to_numpy(zero_copy_only=False)
            shared = np.unique(at[~own & (at >= 0)])
            if len(shared):
                yield batch(known.of[size][1].take(pa.array(shared)), -size, np.ones(len(shared)))
            key, c = key.filter(pa.array(~own)), c[~own]
        if len(c):
            yield batch(key, size, c)


def combined(batches, most: int = COMBINED):
    """Exact counts with those of equal keys added up, over at most about `most` keys at a time."""
    held, rows = [], 0

    def added():
        t = pa.Table.from_batches(held).group_by(["key", "words"]).aggregate([("c", "sum")])
        return pa.table({"key": t["key"], "words": t["words"], "c": t["c_sum"]}).combine_chunks().to_batches()

    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows > most:
            held = added()
            rows = sum(x.num_rows for x in held)
            if rows > most // 2:
                yield from held
                held, rows = [], 0
    if held:
        yield from added()


def scan(shard: DataFrame, schema: str, counted, longest: int, segment: int, gather=iter) -> DataFrame:
    """What `counted(segment, language)` gives for the texts of (lang, text), segment by
    segment, as `gather` hands the batches on."""

    def run(batches):
        yield from gather(counts(batches))

    def counts(batches):
        texts: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def done(lang):
            size.pop(lang)
            for data, limit in segments(b"\n".join(texts.pop(lang)).translate(TABLE), segment, longest):
                yield from counted(Segment(data, limit, lang), lang)

        for b in batches:
            for lang, text in zip(b.column(0), b.column(1)):
                lang, text = lang.as_py(), text.as_py()
                texts.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text) + 1
                if size[lang] >= segment:
                    yield from done(lang)
                elif sum(size.values()) >= 2 * segment:  # many languages: the fullest goes
                    yield from done(max(size, key=size.get))
        for lang in list(texts):
            yield from done(lang)

    return shard.select("lang", "text").mapInArrow(run, schema)


def likely(live: DataFrame, step: int, least: int) -> DataFrame:
    """The counts of phrases that may have reached the threshold: a phrase seen `least` times
    in a number of shards has its share of them in one. Which slots hold such phrases goes
    out as masks of 64 slots, at most WORDS * MOST_SLOTS / 64 rows of two longs."""
    at = F.struct((F.col("words") * F.lit(1 << 40) + (F.col("slot") / 64).cast("long")).alias("k"),
                  (F.col("slot") % 64).cast("int").alias("bit"))
    live = live.withColumn("at", at)
    share = F.col("c") * (F.lit(step + 1) - F.col("begin")) >= least
    masks = live.where(share).groupBy(F.col("at.k").alias("k")).agg(F.bit_or(F.expr("shiftleft(1L, at.bit)")).alias("mask"))
    # the bound holds whatever the input: MOST_SLOTS slots a length
    return live.join(F.broadcast(masks), live["at.k"] == masks["k"]).where(F.expr("bit_get(mask, at.bit) = 1"))


def reached(phrases: DataFrame, lengths: int, slots: int) -> np.ndarray:
    """Flags of the slots of a table of phrases, a row per length: gathered as bitmaps of
    4 KB, `lengths * slots / 8` bytes in all."""
    bits = F.col("slot") % 32768
    rows = phrases.groupBy("words", (F.col("slot") / 32768).cast("long").alias("b")).agg(F.bitmap_construct_agg(bits).alias("m")).collect()
    flags = np.zeros((lengths, -(-slots // 32768) * 32768), dtype=bool)
    for r in rows:
        flags[r["words"] - 1, r["b"] * 32768:(r["b"] + 1) * 32768] = np.unpackbits(np.frombuffer(r["m"], dtype=np.uint8), bitorder="little")
    return flags[:, :slots]


def frequent(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = WORDS,
             shards: int = SHARDS, slots: int | None = None, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, c) of every phrase of 1 to `longest` words seen `least` times,
    (lang, n) with the number of word occurrences). See `collocations`."""
    if not 1 <= shards <= 50:
        raise ValueError("1 to 50 shards")
    spark = docs.sparkSession
    src = clean_columns(docs, lang_col, text_col)
    src = src.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                     F.col(f"`{text_col}`").cast("binary").alias("text"),
                     (F.monotonically_increasing_id() % shards).cast("int").alias("shard"))
    path = shared_path(spark, "shards")
    src.where("text is not null").write.partitionBy("shard").parquet(path)
    corpus = spark.read.schema("lang string, text binary, shard int").parquet(path)
    if slots is not None and slots & (slots - 1):
        raise ValueError("a power of two of slots")
    size = corpus.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if slots is None:
        slots = min(max(1 << (size // 256).bit_length(), FEWEST_SLOTS), MOST_SLOTS)
    usable = np.zeros((longest - 1, slots), dtype=np.uint8)
    keys = ["h", "words", "begin", "slot"]
    counts, whole, step, until = [], [], 0, shards
    while step < until:
        held, sizes, now = spark.sparkContext.broadcast(usable), active(usable, step, shards), step
        seen = scan(corpus.where(F.col("shard") == step % shards), COUNTERS,
                    lambda seg, _: count(seg, now, held.value, shards, sizes), longest, segment)
        seen = seen.groupBy("h", "meta").agg(F.sum("c").alias("c")).select(
            "h", (F.col("meta") % 8).cast("int").alias("words"), F.shiftright("meta", 3).cast("int").alias("begin"),
            F.col("h").bitwiseAND(F.lit(slots - 1)).alias("slot"), "c")
        counts.append(stored(seen, "counts"))
        held.destroy()
        live = reduce(DataFrame.unionByName, counts[-shards:]).where(F.col("begin") > step - shards)
        enough = cut(likely(live, step, least).groupBy(*keys).agg(F.sum("c").alias("c")).where(F.col("c") >= least))
        whole.append(enough.where(F.col("begin") == step - shards + 1))
        new = reached(enough.where(F.col("words") < longest), longest - 1, slots) & (usable == 0)
        if new.any():
            usable[new] = step + 1
            until = max(until, step + 1 + shards)
        step += 1
    # a counter is a hash, so it is never below its phrase's count; the phrases behind those
    # that reached the threshold are compared by their texts in one more scan
    whole = cut(reduce(DataFrame.unionByName, whole))
    held = spark.sparkContext.broadcast(reached(whole, longest, slots))
    alone = whole.groupBy("h", "words").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("k")).where("k = 1").drop("k")
    share = max(min(size // LEARN_BYTES, LEARN_SHARE), 1)
    some = corpus.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).repartition(max(-(-size // share // segment), 1))
    known = scan(some, TEXTS, lambda seg, lang: learnt(seg, lang, held.value), longest, segment) \
        .groupBy("h", "words").agg(F.min("key").alias("key"))
    known = cut(known.join(alone, ["h", "words"]))
    if known.count() > MOST_KNOWN:  # the most frequent ones
        known = cut(known.orderBy(F.col("c").desc(), "h").limit(MOST_KNOWN))
    while True:
        texts = spark.sparkContext.broadcast(Known(known.toArrow()))  # at most MOST_KNOWN
        exact = cut(scan(corpus, EXACT, lambda seg, lang: exactly(seg, lang, held.value, texts.value), longest, segment, combined)
                    .groupBy("key", "words").agg(F.sum("c").alias("c")).where((F.col("words") <= 0) | (F.col("c") >= least)))
        texts.destroy()
        shared = exact.where("words < 0").select("key", (-F.col("words")).alias("words"))
        if shared.isEmpty():
            break
        known = cut(known.join(shared, ["key", "words"], "left_anti"))  # these are counted by their texts as well
    exact = exact.unionByName(known.select("key", "words", "c"))
    key = F.col("key").cast("string")
    phrase = F.substring_index(key, "\n", -1)
    exact = cut(exact.select(F.left(key, F.char_length(key) - F.char_length(phrase) - 1).alias("lang"),
                             phrase.alias("phrase"), "words", "c"))
    held.destroy()
    return exact.where("words > 0"), exact.where("words = 0").select("lang", F.col("c").alias("n"))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = TOP,
                 covered: int = COVERED, **options) -> DataFrame:
    """The `top` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and cut at `PIECE_ENDS` into pieces, these at blanks and
    tabs into words; null and empty texts have none, a null language is `und`. A candidate
    has 2 to WORDS words and a = f(phrase) >= `least`, overlapping occurrences included.
    Its score is that of its worst cut, floor(1000 * a * n / (l * r)), ties to the shorter
    first part; it is taken in decimals, exact for n below 10**17. A candidate inside a
    longer one that is seen in `covered` per cent of its places goes. Order: score
    descending, a descending, phrase by its bytes. Repeated rows count each time. Other
    columns are not read; an empty table gives an empty table. Very long texts, pieces and
    words are cut for counting so that a task holds one segment, without losing a phrase.
    """
    f, words = frequent(docs, lang_col, text_col, least, **options)
    phrases = f.where("words > 1")
    part = F.split("phrase", " ")

    def joined(start, length):
        return F.array_join(F.slice(part, start, length), " ")

    cuts = phrases.select("lang", "phrase", "words", F.col("c").alias("a"),
                          F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"),
                       joined(F.col("k") + 1, F.col("words")).alias("rest"))
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("first"), F.col("c").alias("l")), ["lang", "first"]) \
        .join(f.select("lang", F.col("phrase").alias("rest"), F.col("c").alias("r")), ["lang", "rest"])
    cuts = checked_join(cuts, words, "lang", "inner")
    score = ("(cast(1000 as decimal(4,0)) * cast(a as decimal(15,0)) * cast(n as decimal(17,0)))"
             " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    worst = cuts.withColumn("score", F.expr(score)).groupBy("lang", "phrase", "a", "n") \
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("w"))
    # what lies inside each longer candidate
    w = phrases.where("words > 2").select("lang", "c", part.alias("p"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("p") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.size("p") - m + 1), lambda i: F.array_join(F.slice("p", i, m), " "))))
    inside = w.select("lang", "c", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("c").alias("longer"))
    kept = worst.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * covered))
    kept = kept.select("lang", "phrase", "a", "w.l", "w.r", "n", "w.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top) \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
o AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, range(1, 6) AS s(m) WHERE len(w) >= m),
f AS (SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, count(*) AS c FROM o GROUP BY 1, 2, 3),
n AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
k AS (SELECT lang, m, phrase, c AS a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m > 1 AND c >= 100),
s AS (SELECT k.*, l.c AS l, r.c AS r, n.n,
    CAST((CAST(1000 AS HUGEINT) * a * n.n) // (CAST(l.c AS HUGEINT) * r.c) AS BIGINT) AS score
  FROM k JOIN n USING (lang) JOIN f AS l ON l.lang = k.lang AND l.phrase = array_to_string(list_slice(k.w, 1, k.k), ' ')
  JOIN f AS r ON r.lang = k.lang AND r.phrase = array_to_string(list_slice(k.w, k.k + 1, k.m), ' ')),
worst AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM worst AS x WHERE NOT EXISTS (SELECT 1 FROM f AS y WHERE y.lang = x.lang AND y.m > x.m AND y.c >= 100
    AND 100 * y.c >= 100 * x.a AND contains(concat(' ', y.phrase, ' '), concat(' ', x.phrase, ' '))))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""
