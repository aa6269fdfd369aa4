"""Links of pages, topic tagging and list positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelens.functions import urls as U
from pagelens.session import checkpoint_dir


def tag_topic_first(links: DataFrame, topics: list[str], col: str = "href") -> DataFrame:
    """Tag each link with the first topic (list order) it contains; links with
    no topic are dropped (F6)."""
    return (links.withColumn("topic", U.topic_first(F.col(col), topics))
            .where(F.col("topic").isNotNull()))


def filter_topic_any(links: DataFrame, topics: list[str], col: str = "href") -> DataFrame:
    """Keep links containing any topic."""
    return links.where(U.topic_any(F.col(col), topics))


#: Characters of the pieces by which texts and topics meet, at most.
GRAM = 8


def grams(text: Column, n: int) -> Column:
    """The distinct substrings of ``n`` characters, in time linear in the text."""
    if n == 0:
        return F.array(F.lit(""))
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)))


def topic_index(topics: DataFrame) -> tuple[DataFrame, list[int]]:
    """((topic, ord, gram), lengths of grams): every topic under one of its substrings of
    ``GRAM`` characters (a shorter topic under itself), the one that fewest topics hold.
    Of a repeated topic the first ``ord`` counts; null topics are left out."""
    t = topics.where("topic IS NOT NULL").groupBy("topic").agg(F.min("ord").alias("ord")) \
        .withColumn("_n", F.least(F.char_length("topic"), F.lit(GRAM)))
    lengths = sorted(r[0] for r in t.select("_n").distinct().collect())  # GRAM + 1 values at most
    if not lengths:
        return t.select("topic", "ord", F.lit("").alias("gram")), lengths
    own = F.coalesce(*[F.when(F.col("_n") == n, grams(F.col("topic"), n)) for n in lengths])
    pieces = t.select("topic", "ord", F.explode(own).alias("gram"))
    spread = pieces.groupBy("gram").agg(F.count(F.lit(1)).alias("_c"))
    return pieces.join(spread, "gram").groupBy("topic", "ord").agg(
        F.min(F.struct("_c", "gram")).alias("_g")).select("topic", "ord", F.col("_g.gram").alias("gram")), lengths


def tag_topic_join(links: DataFrame, topics: DataFrame, col: str = "href",
                   key: tuple[str, ...] = ("page_id", "pos")) -> DataFrame:
    """Table form of F6 (J4): each link keeps its first matching topic of
    ``topics(topic, ord)``, any number of them, by ``ord``; links without one go.

    The topics are indexed by their rarest short substring. A link is cut into its
    substrings of these few lengths, meets the index by equality, and only topics whose
    substring it holds are searched in it. So work follows the length of a link, not its
    square nor the number of topics, and nothing is broadcast by force. ``key``
    identifies a link row; rows with equal keys are the same link and each keeps its row.
    """
    index, lengths = topic_index(topics)
    if not lengths:
        return links.select("*", F.lit(None).cast("string").alias("topic")).where(F.lit(False))
    one = links.where(F.col(col).isNotNull()).select(*key, F.col(col).alias("_text")).dropDuplicates(list(key))
    parts = one.select(*key, F.explode(F.concat(*[grams(F.col("_text"), n) for n in lengths])).alias("gram"))
    likely = parts.join(index, "gram").select(*[F.col(k).alias(f"_{k}") for k in key], "topic", "ord")
    # the search is a condition of the join: a link is not written out once per topic
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in key])
    hits = one.join(likely, same & F.col("_text").contains(F.col("topic"))) \
        .groupBy(*key).agg(F.min_by("topic", "ord").alias("topic"))
    return links.join(hits, list(key))


def first_n(df: DataFrame, order: str | list[str], n: int, group: str | list[str] | None = None) -> DataFrame:
    """L1/L2: the first ``n`` rows in list order (a visit budget or the first archive
    days), of the whole list or of each ``group``'s. Ranks are cut at ``n`` before the
    shuffle, so a long list sends n rows per task."""
    by = [order] if isinstance(order, str) else list(order)
    if group is None:
        return df.orderBy(*by).limit(n)
    w = Window.partitionBy(*([group] if isinstance(group, str) else group)).orderBy(*by)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def nth_item(df: DataFrame, order: str | list[str], n: int, group: str | list[str] | None = None) -> DataFrame:
    """L3: the item at 0-based position ``n`` (``pop(n)``) of the whole list or of each
    ``group``'s; a list too short has none.

    The whole list is dealt into ranges of the order, the ranges' row counts (one number
    each) tell which holds the item, and only that one is sorted.
    """
    by = [order] if isinstance(order, str) else list(order)
    if group is not None:
        w = Window.partitionBy(*([group] if isinstance(group, str) else group)).orderBy(*by)
        return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n + 1) \
            .where(F.col("_rank") == n + 1).drop("_rank")
    spark = df.sparkSession
    checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *by).withColumn("_range", F.spark_partition_id()).checkpoint()
    before = 0
    for r in dealt.groupBy("_range").count().orderBy("_range").collect():
        if n < before + r["count"]:
            return dealt.where(F.col("_range") == r["_range"]).drop("_range").orderBy(*by).offset(n - before).limit(1)
        before += r["count"]
    return dealt.drop("_range").limit(0)
