"""Helpers shared by the operators: locators, lineage cuts, checked joins."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.session import checkpoint_dir

# --- fixed values: the word rule and the letters that are lower-cased --------
WORD_RE = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# -----------------------------------------------------------------------------

#: A side of a join is broadcast only when it was counted and has at most this
#: many rows (of a few dozen bytes each); beyond it the join is a shuffle join.
BROADCAST_ROWS = 100_000


def ascii_lower(col):
    """Lower-case A-Z only, other characters untouched."""
    return F.translate(col, UPPER, LOWER)


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder and cut the lineage there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def settings(spark: SparkSession, conf: dict):
    """Session settings for what runs inside, put back afterwards."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write as Parquet in the shared folder and read it back."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_locator(df: DataFrame, name: str = "locator") -> DataFrame:
    """Add the place of each row as struct<file, row>, equal in every scan.

    A table that does not come straight from files is stored first, so the
    locator is always a real file position.
    """
    loc = F.struct(F.col("_metadata.file_path").alias("file"),
                   F.col("_metadata.row_index").alias("row")).alias(name)
    try:
        return df.select("*", loc)
    except AnalysisException:
        return stored(df, "rows").select("*", loc)


def checked_join(left: DataFrame, right: DataFrame, on, how: str,
                 limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a materialised `right`: broadcast it when its counted rows are
    within `limit`, else a shuffle join, whose hot keys AQE splits."""
    if right.limit(limit + 1).count() <= limit:
        right = F.broadcast(right)
    return left.join(right, on, how)


def clean_columns(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, looked up by exact name; a missing one is null."""
    have = set(docs.columns)
    return docs.select(*[F.col(f"`{n}`") if n in have else F.lit(None).cast("string").alias(n)
                         for n in names])


def total_bytes(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(rows, UTF-8 bytes of text) of the whole table, two numbers on the driver."""
    r = docs.agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.octet_length(F.col(text_col))).alias("b")).first()
    return r["n"], r["b"] or 0
