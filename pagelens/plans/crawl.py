"""Crawls over stored pages.

The reference walks a FIFO queue of URLs one page at a time. Here a crawl is
level by level: the frontier of one level is a DataFrame, fetched by joining
it with the stored pages (J3), and its out-links, in (parent order, link
position) order, minus every URL already queued (J6), form the next level.
Level order with a dense ordinal is exactly FIFO order. Each level is
checkpointed to the cluster's checkpoint folder, which cuts the lineage and
survives lost executors. The only driver-side values are per-level counts
and per-partition row counts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelens.functions import html as H
from pagelens.functions import urls as U
from pagelens.operators.elements import elements, inside, with_region
from pagelens.operators.links import first_n
from pagelens.operators.tokens import html_tokens, prepare_pages
from pagelens.session import checkpoint_dir, placed, release

#: Link positions that a page's place in the queue is made of, at most.
KEY_STEPS = 8

LinkRewrite = Callable[[Column], Column]


class QueuedUrls:
    """What a crawl queued so far, in pieces hash-partitioned by url, in which a level's
    frontier is looked up where they lie: a level shuffles its own rows only.

    Pieces are kept like the runs of a merge sort: a piece that has not at least twice
    the rows of the next one is merged with it. So there are at most about log2 of the
    urls of them, a url is dealt anew about as often however many levels the crawl has,
    and the files of merged pieces are removed.
    """

    def __init__(self, partitions: int):
        self.partitions = partitions
        self.pieces: list[tuple[DataFrame, int, bool]] = []  # (urls, rows, made by a merge)

    def add(self, urls: DataFrame, rows: int) -> None:
        """``urls`` is a checkpoint placed by url; its files belong to the caller."""
        self.pieces.append((urls, rows, False))
        while len(self.pieces) > 1 and self.pieces[-2][1] < 2 * self.pieces[-1][1]:
            two = [self.pieces.pop(), self.pieces.pop()]
            both = placed(two[1][0].unionByName(two[0][0]), self.partitions, "url")
            for piece, _, merged in two:
                if merged:
                    release(piece)
            self.pieces.append((both, two[0][1] + two[1][1], True))

    def unseen(self, urls: DataFrame) -> DataFrame:
        for piece, _, _ in self.pieces:
            urls = urls.join(piece, "url", "left_anti")
        return urls

    def close(self) -> None:
        for piece, _, merged in self.pieces:
            if merged:
                release(piece)
        self.pieces = []


def link_table(pages: DataFrame, region: tuple[str, str] | None = None,
               keep: Callable[[Column], Column] | None = None,
               rewrite: LinkRewrite | None = None) -> DataFrame:
    """(page_id, pos, href, url) for every ``<a>`` of every page.

    ``region`` limits links to the content region; ``keep`` filters hrefs
    (F1/F4, default: non-null); ``rewrite`` turns an href into the URL to
    visit (F9/F10, default: unchanged).
    """
    prepared = prepare_pages(pages)
    if region is None:
        t = html_tokens(prepared)
        a = t.where((F.col("kind") == "open") & (F.col("tag") == "a")).select(
            "page_id", "pos", "tok")
    else:
        els = with_region(elements(prepared, ["a", region[1]] if region[0] == "tag" else ["a"],
                                   containing=[region[1]] if region[0] == "id" else ()), *region)
        a = els.where((F.col("tag") == "a") & inside("r")).select(
            "page_id", F.col("open_pos").alias("pos"), "tok")
    href = H.attr("tok", "href")
    out = a.select("page_id", "pos", href.alias("href"))
    out = out.where(keep(F.col("href")) if keep else F.col("href").isNotNull())
    return out.withColumn("url", rewrite(F.col("href")) if rewrite else F.col("href"))


def dense_order(df: DataFrame, key: list[Column], offset: int = 0,
                name: str = "ord", spent: list[DataFrame] | None = None) -> tuple[DataFrame, int]:
    """Number rows 0.. in ``key`` order (plus ``offset``) without a
    single-partition window: a global sort, per-partition counts (one small
    row per partition to the driver), then offsets added in place. Returns
    the numbered rows and their count; the checkpoint they lie in is added to ``spent``."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    s = (df.orderBy(*key)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint())
    if spent is not None:
        spent.append(s)
    counts = sorted((r["_pid"], r["n"]) for r in
                    s.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, acc = [], offset
    for pid, n in counts:
        starts.append((pid, acc))
        acc += n
    # one row per partition: a proven size bound, so it is broadcast
    off = F.broadcast(spark.createDataFrame(starts or [(0, offset)], "_pid int, _start long"))
    # ids are (partition index << 33) + row index inside the partition
    rank = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    out = (s.join(off, "_pid")
           .withColumn(name, (F.col("_start") + rank).cast("bigint"))
           .drop("_pid", "_mid", "_start"))
    return out, acc - offset


def bfs_crawl(pages: DataFrame, seeds: list[str], links: DataFrame,
              budget: int | None = None, include_seed: bool = True,
              max_levels: int | None = None, dedupe: str = "seen") -> DataFrame:
    """FIFO crawl from ``seeds``; at most ``budget`` stored pages.

    Returns (url, page_id, level, ord) of the visited pages, ``ord`` being
    the visit order. A URL with no stored page is skipped and costs no
    budget; links are de-duplicated against everything queued before
    (Q1/Q2, ``dedupe='seen'``); ``dedupe='none'`` queues every link occurrence
    again, so a page can be visited more than once (needs a budget). With
    ``include_seed=False`` the seeds only provide links (Q10).

    FIFO order is carried as a key: the parent's key followed by the link
    position (arrays compare lexicographically), so a level needs no sort. Every
    KEY_STEPS levels the level's pages are numbered in order and the number
    becomes their key, so it does not grow with depth; the visited pages are
    numbered once at the end. Repeated seeds count once, and a URL that is
    stored more than once is visited once (``stored_urls``).
    """
    if dedupe not in ("seen", "none"):
        raise ValueError(f"unknown dedupe {dedupe!r}")
    if dedupe == "none" and budget is None and max_levels is None:
        raise ValueError("dedupe='none' revisits pages: give a budget or max_levels")
    spark = pages.sparkSession
    checkpoint_dir(spark)
    # every level looks URLs up in the stored pages: materialise (url, page_id)
    # once, hash-partitioned by url so each level's lookup shuffles only the
    # frontier
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = placed(stored_urls(pages), parts, "url")
    frontier = spark.createDataFrame([(u, [i]) for i, u in enumerate(dict.fromkeys(seeds))],
                                     "url string, key array<bigint>")
    start = placed(frontier.select("url"), parts, "url")
    spent = [stored, start]  # checkpoints that are read until the visited pages are numbered
    seen = QueuedUrls(parts)
    seen.add(start, len(set(seeds)))
    # the link table is read once per level: materialise it once, placed by its page
    lk = placed(links.select(F.col("page_id").alias("_src"), F.col("pos").alias("_lpos"),
                             F.col("url").alias("_out")), parts, "_src")
    spent.append(lk)
    levels: list[DataFrame] = []
    n_visited, level, steps = 0, 0, 1
    while True:
        fetched = frontier.join(stored, "url")
        if steps == KEY_STEPS:
            fetched, k = dense_order(fetched, [F.col("key")], spent=spent)
            fetched, steps = fetched.withColumn("key", F.array("ord")).drop("ord"), 1
        else:
            k = fetched.count()
        if k == 0:
            break
        if include_seed or level > 0:
            if budget is not None and n_visited + k > budget:
                fetched, _ = dense_order(fetched, [F.col("key")], spent=spent)
                k = budget - n_visited
                fetched = fetched.where(F.col("ord") < k).drop("ord")
            levels.append(fetched.select("url", "page_id", F.lit(level).cast("bigint").alias("level"), "key"))
            n_visited += k
        if budget is not None and n_visited >= budget:
            break
        level, steps = level + 1, steps + 1
        if max_levels is not None and level > max_levels:
            break
        out = fetched.join(lk, fetched["page_id"] == lk["_src"]).select(
            F.col("_out").alias("url"), F.concat("key", F.array(F.col("_lpos").cast("bigint"))).alias("key"))
        if dedupe == "none":
            frontier = placed(out)
            spent.append(frontier)
            continue
        frontier = placed(seen.unseen(out.groupBy("url").agg(F.min("key").alias("key"))))
        spent.append(frontier)
        rows = frontier.count()
        if rows == 0:
            break
        seen.add(frontier.select("url"), rows)
    out = None
    if levels:
        out, _ = dense_order(reduce(DataFrame.unionByName, levels), [F.col("level"), F.col("key")])
    seen.close()
    for df in spent:
        release(df)
    if out is None:
        return spark.createDataFrame([], "url string, page_id long, level long, ord long")
    return out.select("url", "page_id", "level", "ord")


def stored_urls(pages: DataFrame) -> DataFrame:
    """(url, page_id) with one row per URL: of pages stored under the same URL the
    one with the smallest page_id stands for it."""
    return pages.groupBy("url").agg(F.min(F.col("page_id").cast("bigint")).alias("page_id"))


def archive_crawls(pages: DataFrame, roots: DataFrame, topics: list[str], base: str = "",
                   region: tuple[str, str] | None = ("id", "frameInner"), max_days: int | None = None,
                   distinct_links: bool = False) -> DataFrame:
    """C3 over any number of archives at once: archive page -> its date pages (the first
    ``max_days`` of each, L2) -> topic links.

    ``roots`` has the archives' URLs as ``url``; a repeated one counts once, one that is
    not stored gives nothing. Returns (root, topic, url, ord): every link of an archive's
    date pages that contains a topic, tagged with the first topic (F6), absolutised with
    ``base`` (F9), ``ord`` = (place of the date link, link position). Duplicates are kept
    unless ``distinct_links`` (Q7, per archive). All archives advance together: two
    rounds of joins whatever their number. A page is parsed once a round however many
    archives list it, archives first, then date pages, and no other page.
    """
    stored = stored_urls(pages)
    checkpoint_dir(pages.sparkSession)

    def links_of(listed: DataFrame) -> DataFrame:
        """Links of a list of stored pages only: the rest is not parsed."""
        ids = listed.select(F.col("page_id").alias("_id")).distinct()
        some = pages.join(ids, pages["page_id"].cast("bigint") == ids["_id"], "left_semi")
        return link_table(some, region=region, rewrite=lambda h: U.absolutise(h, base))

    archives = roots.select("url").distinct().join(stored, "url").select(F.col("url").alias("root"), "page_id")
    days = archives.join(links_of(archives).select("page_id", "url", F.col("pos").alias("day_pos")), "page_id") \
        .select("root", "url", "day_pos").join(stored, "url").select("root", "day_pos", "page_id")
    if max_days is not None:
        days = first_n(days, "day_pos", max_days, "root")
    days = days.checkpoint()
    links = links_of(days).select("page_id", F.col("pos").alias("lpos"), "href", "url")
    rel = (days.join(links, "page_id").withColumn("topic", U.topic_first(F.col("href"), topics))
           .where(F.col("topic").isNotNull()))
    if distinct_links:
        rel = rel.groupBy("root", "topic", "url").agg(F.min(F.struct("day_pos", "lpos")).alias("ord"))
        return rel.select("root", "topic", "url", "ord")
    return rel.select("root", "topic", "url", F.struct("day_pos", "lpos").alias("ord"))


def two_level_crawl(pages: DataFrame, start_url: str, topics: list[str],
                    base: str = "", region: tuple[str, str] | None = ("id", "frameInner"),
                    max_days: int | None = None, distinct_links: bool = False) -> DataFrame:
    """C3 from one archive page: (topic, url, ord), see ``archive_crawls``."""
    root = pages.sparkSession.createDataFrame([(start_url,)], "url string")
    return archive_crawls(pages, root, topics, base, region, max_days, distinct_links).drop("root")
