"""Image tags and the keyed upsert (D2); images themselves are in ``plans.label``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IMAGE_TAGS = ["img", "amp-img"]


def keyed_upsert(df: DataFrame, keys: list[str], key: str, value: str,
                 pos: str = "pos") -> DataFrame:
    """Last value per key at the position of the key's first occurrence (D2),
    like repeated assignment into an insertion-ordered dict. A null key is a
    key of its own; a null last value is kept (struct wrapping)."""
    return (df.groupBy(*keys, key)
            .agg(F.min(pos).alias(pos),
                 F.max_by(F.struct(F.col(value).alias("v")), F.col(pos)).alias("_last"))
            .select(*keys, key, pos, F.col("_last.v").alias(value)))
