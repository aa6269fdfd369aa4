"""Global shuffle into shards: seeded scatter into buckets, then Fisher-Yates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED = 23
SHARDS = 8
#: UTF-8 bytes of text that a bucket holds on average; one task holds one bucket.
BUCKET_BYTES = 32 << 20
#: What a record counts for besides its text, so that rows without text fill buckets too.
ROW_BYTES = 64


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniformly random order of 0..n-1, the same for the same seed and bucket."""
    order = np.arange(n)
    rng = np.random.Generator(np.random.PCG64([seed, bucket]))
    picks = rng.integers(0, np.arange(n, 0, -1)) if n else ()
    for i, j in zip(range(n - 1, 0, -1), picks):
        order[i], order[j] = order[j], order[i]
    return order


def shuffle(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id",
            text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows in a seeded random order, with `shard` and `slot` added.

    The number of buckets follows from the size of the table, without a limit, so
    that a bucket holds about `bucket_bytes` at any size. Pass one scatters whole
    records into them by a seeded hash of the id and a hash of the text; the counts
    of the buckets give each one its place in the global order. Pass two holds one
    bucket per task, orders it by id and record and shuffles it with Fisher-Yates.
    The global order is cut in equal runs, so shard sizes are at most one row apart and slots
    have no gaps. Reruns agree. Equal rows (all columns) fall into one bucket;
    copies with different ids do not. Null ids and texts are hashed like any
    other value; an empty table gives an empty table; input columns named `shard`
    or `slot` are replaced.
    """
    docs = docs.drop("shard", "slot")
    h = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.crc32(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")))
    held = F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)) + ROW_BYTES
    size = docs.agg(F.sum(held.cast("long")).alias("b")).first()["b"] or 0
    buckets = max(1, -(-size // bucket_bytes))
    bucket = F.pmod(h, F.lit(buckets)).cast("int")
    # one number per bucket, so 8 bytes here for every `bucket_bytes` of text
    counted = docs.groupBy(bucket.alias("c")).agg(F.count(F.lit(1)).alias("n")).toPandas()
    rows = np.zeros(buckets, dtype=np.int64)
    rows[counted["c"].to_numpy(dtype=np.int64)] = counted["n"].to_numpy(dtype=np.int64)
    total = int(rows.sum())
    first = np.concatenate(([0], np.cumsum(rows)))
    dealt = docs.withColumn("__bucket", bucket).repartitionById(buckets, F.col("__bucket"))
    schema = docs.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long")).schema
    names = schema.names
    # Of rows with one id the other plain columns decide; rows equal in all of them are alike.
    by = [id_col, *(f.name for f in docs.schema if f.name != id_col and isinstance(f.dataType, T.AtomicType))]

    def run(batches):
        held = list(batches)
        if not held:
            return
        t = pa.Table.from_batches(held)
        b = t.column("__bucket")[0].as_py()
        t = t.drop_columns(["__bucket"])
        order = pc.sort_indices(t.select(by), sort_keys=[(c, "ascending") for c in by])
        order = order.to_numpy()[fisher_yates(t.num_rows, seed, b)]
        at = int(first[b]) + np.arange(t.num_rows, dtype=np.int64)
        shard = at * shards // total
        slot = at - -(-shard * total // shards)
        for i in range(0, t.num_rows, 512):
            part = t.take(pa.array(order[i:i + 512])).combine_chunks()
            cols = [c.combine_chunks() for c in part.columns]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(shard[i:i + 512].astype(np.int32)), pa.array(slot[i:i + 512])], names=names)

    return dealt.mapInArrow(run, schema)


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Write one folder per shard; its files hold the slots in rising order."""
    shuffled.write.partitionBy("shard").parquet(path)
