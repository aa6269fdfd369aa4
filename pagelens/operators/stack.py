"""Where elements end: one pass over a page's tags with a stack.

The tree builder closes everything opened after the element that an end tag
names, so a close tag must see only the elements still open at that point.
That is inherently sequential within a page; the pass works on one small
array of marks per page (``functions.html.marks_sql``) in Arrow batches and
returns positions only. Token text, attributes and all counting stay native.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType


def ends(marks: list[str | None]) -> list[int | None]:
    """For each opening mark the position of the token that ends it (its own for
    an element without content, the number of tokens if nothing ends it)."""
    out: list[int | None] = [None] * len(marks)
    stack: list[tuple[str, int]] = []
    still: dict[str, int] = {}
    for i, m in enumerate(marks):
        if m is None:
            continue
        if not m:
            out[i] = i
        elif m[0] != "/":
            stack.append((m, i))
            still[m] = still.get(m, 0) + 1
        elif still.get(m[1:]):
            tag = None
            while tag != m[1:]:
                tag, j = stack.pop()
                still[tag] -= 1
                out[j] = i
    for _, j in stack:
        out[j] = len(marks)
    return out


def pylists(lists: pa.Array) -> list[list]:
    """The lists of a batch, their values converted all at once; a null list is empty, a
    null number -1."""
    stop = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)).tolist()
    flat = lists.flatten()
    if pa.types.is_integer(flat.type):
        flat = flat.fill_null(-1)
    values = flat.to_numpy(zero_copy_only=False).tolist()
    return [values[a:b] for a, b in zip([0, *stop], stop)]


def close_positions(marks: Column) -> Column:
    """``ends`` of a column of mark arrays."""

    @arrow_udf(ArrayType(IntegerType()))
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([ends(m) if ok else None for m, ok in zip(pylists(batch), batch.is_valid().to_pylist())],
                        pa.list_(pa.int32()))

    return run(marks)


# The function travels by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
