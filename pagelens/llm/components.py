"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelens.llm.common import cut


def _state(e: DataFrame):
    r = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge to another node; root is the
    smallest node of the component.

    Each round joins every node's neighbours to the smallest one seen: first
    from the side of the smaller end, then from the larger. The number of rounds
    grows with the logarithm of the longest path, no component is gathered in a
    task, and the driver sees one row count and hash per round. Nulls and loops
    are ignored; no edges give an empty table.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where("u <> v").distinct())
    e = cut(e)
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the small sides are materialised, so that a join may split the rows of a hub
        low = cut(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m")))
        big = cut(e.join(low, "v").select("u", F.col("m").alias("v")))
        low = cut(big.groupBy("u").agg(F.min("v").alias("m")))
        small = big.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        e = cut(small.select("e.u", "e.v").where("u <> v").distinct())
        new = _state(e)
        if new == state:
            break
        state = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
