"""Blocks of rows that stay in a task while other rows stream past them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows of a stream that meet a block at a time.
STREAM_ROWS = 512


def matrix(col: pa.Array, dims: int, dtype) -> np.ndarray:
    """Rows of a list column, shorter ones filled with zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    out = np.zeros((len(col), dims), dtype=dtype)
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    sizes = np.diff(col.offsets.to_numpy())
    row = np.repeat(np.arange(len(col)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def width(col: pa.Array) -> int:
    """The longest list of a list column."""
    sizes = np.diff(col.offsets.to_numpy()) if isinstance(col, pa.Array) else [width(c) for c in col.chunks]
    return int(max(sizes, default=0))


def past_blocks(rows: DataFrame, schema: str, load: Callable, visit: Callable, close: Callable | None = None,
                stream: int = STREAM_ROWS) -> DataFrame:
    """Let rows stream past the blocks they are dealt to.

    `rows` has an int `block` and an int `role`: rows of role 0 are the block itself (a
    bounded number, chosen by the caller), rows of role 1 stream past it in batches of at
    most `stream` rows. `load(table)` gives (state, batches) of a block, `visit(state,
    batch)` yields batches, `close(state)` ends a block. A block is one sorted run of one
    task, so a task holds one block and one batch however long its stream is.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [c for c in ("block", "role", "home") if c in rows.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, state = None, [], None

        def loaded():
            nonlocal state
            state, out = load(pa.Table.from_batches(held))
            held.clear()
            yield from out

        def done():
            if held:
                yield from loaded()
            if state is not None and close:
                yield from close(state)

        for b in batches:
            if not b.num_rows:
                continue
            block, role = b.column("block").to_numpy(), b.column("role").to_numpy()
            ends = np.flatnonzero((block[1:] != block[:-1]) | (role[1:] != role[:-1])) + 1
            for s, e in zip([0, *ends.tolist()], [*ends.tolist(), b.num_rows]):
                if block[s] != at:
                    yield from done()
                    at, state = block[s], None
                if role[s] == 0:
                    held.append(b.slice(s, e - s))
                    continue
                if held:
                    yield from loaded()
                if state is not None:
                    for i in range(s, e, stream):
                        yield from visit(state, b.slice(i, min(stream, e - i)))
        yield from done()

    return rows.repartition(parts, "block").sortWithinPartitions(*order).mapInArrow(run, schema)
