"""Best-fit packing into sequences of several permitted lengths."""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelens.llm.common import total_bytes

#: Permitted sequence lengths in words, and what a sequence costs beside its length.
LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD = 16
SEED = 31
#: UTF-8 bytes of text that a group packed in one task holds on average.
GROUP_BYTES = 16 << 20
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def pieces(text: bytes, longest: int):
    """(first word, words, piece of the text) of at most `longest` words each; the
    pieces joined are the text."""
    n = len(text.split())
    if n <= longest:
        return [(0, n, text)]
    out, at = [], 0
    for k, m in enumerate(WORD.finditer(text)):
        if k and k % longest == 0:
            out.append((k - longest, longest, text[at:m.start()]))
            at = m.start()
    last = len(out) * longest
    return [*out, (last, n - last, text[at:])]


def best_fit(sizes: list[int], opening: int, lengths=LENGTHS):
    """Best-fit over sizes in falling order, opening bins of `opening` (or the
    least length that holds the piece). Returns the bin of each piece, the fills and
    the lengths opened."""
    where, fills, caps = [], [], []
    rooms: dict[int, list[int]] = {}
    mask = 0
    for s in sizes:
        fits = mask >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask &= ~(1 << room)
        else:
            b, cap = len(fills), max(opening, lengths[bisect_left(lengths, s)])
            fills.append(0)
            caps.append(cap)
            room = cap
        fills[b] += s
        where.append(b)
        if room - s:
            rooms.setdefault(room - s, []).append(b)
            mask |= 1 << (room - s)
    return where, fills, caps


def pack_sizes(sizes: list[int], lengths=LENGTHS, overhead: int = OVERHEAD):
    """The cheapest of one best-fit per permitted opening length, each bin cut down
    to the least length that holds its contents. Returns (bin of each piece, fills,
    capacities); cost is the sum of capacity plus overhead over the bins."""
    best = None
    for opening in lengths:
        where, fills, _ = best_fit(sizes, opening, lengths)
        caps = [lengths[bisect_left(lengths, f)] for f in fills]
        cost = sum(caps) + overhead * len(caps)
        if best is None or cost < best[0]:
            best = (cost, where, fills, caps)
    return best[1:]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lengths=LENGTHS,
         overhead: int = OVERHEAD, seed: int = SEED, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per piece of a document: doc_id, piece, pieces, first_word, words,
    bin_id, capacity, fill, slot, start (word offset in the bin), text.

    A document of more words than the longest length is cut into pieces, a
    shorter one is one piece; the pieces joined in order are the whole text. Pieces
    are dealt to groups by a seeded hash, so that a group fits a task; each group
    is packed by best-fit in falling order of size, trying every permitted opening
    length and keeping the cheapest result, with every bin cut down to its contents.
    A document without words (null and empty texts too) has one row with null bin
    columns. Repeated rows are packed as often as they occur. The output does not
    depend on the order of the input rows, as equal rows are interchangeable.
    """
    lengths = tuple(sorted(lengths))
    longest = lengths[-1]
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("binary").alias("text"))
    groups = max(1, -(-total_bytes(src)[1] // group_bytes))

    def split(batches):
        for b in batches:
            for part in range(0, b.num_rows, 256):
                p = b.slice(part, 256)
                out = [(i, k, n, *x) for i, t in zip(p.column(0).to_pylist(), p.column(1).to_pylist())
                       for ps in [pieces(t or b"", longest)] for n in [len(ps)] for k, x in enumerate(ps)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[j] for r in out], t) for j, t in enumerate(
                        (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                    names=["doc_id", "piece", "pieces", "first_word", "words", "text"])

    parts = src.mapInArrow(split, "doc_id long, piece int, pieces int, first_word long, words long, text binary")
    group = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "piece", F.crc32("text")), F.lit(groups)).cast("int")
    parts = parts.withColumn("g", group).repartitionById(groups, F.col("g"))

    def place(batches):
        held = list(batches)
        if not held:
            return
        t = pa.Table.from_batches(held)
        order = pc.sort_indices(t, sort_keys=[
            ("words", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("text", "ascending")])
        t = t.take(order)
        sizes, g = t.column("words").to_pylist(), t.column("g")[0].as_py()
        full = sum(1 for s in sizes if s)
        where, fills, caps = pack_sizes(sizes[:full], lengths, overhead)
        at, count, slots, starts = [0] * len(fills), [0] * len(fills), [], []
        for b, s in zip(where, sizes):
            slots.append(count[b])
            starts.append(at[b])
            count[b] += 1
            at[b] += s
        none = [None] * (len(sizes) - full)
        more = [([g << 32 | b for b in where] + none, pa.int64()), ([caps[b] for b in where] + none, pa.int32()),
                ([fills[b] for b in where] + none, pa.int32()), (slots + none, pa.int32()), (starts + none, pa.int32())]
        t = pa.table([*(t.column(c) for c in names[:5]), *(pa.array(v, k) for v, k in more), t.column("text")], names=names)
        yield from t.to_batches(max_chunksize=512)

    names = ["doc_id", "piece", "pieces", "first_word", "words", "bin_id", "capacity", "fill", "slot", "start", "text"]
    return parts.mapInArrow(place, "doc_id long, piece int, pieces int, first_word long, words long, bin_id long, "
                                   "capacity int, fill int, slot int, start int, text binary") \
        .withColumn("text", F.col("text").cast("string"))
