"""Elements as intervals over token positions.

An element is ``(page_id, open_pos, close_pos, tag, tok)``: its start-tag
token, and the position of the token that ends it. Content is every token
strictly between the two.

How an element ends follows the tree builder of the reference's parser:
  * void tags and ``<x/>`` end where they start;
  * an end tag closes the most recent open element of its tag and everything
    opened after it; one with no open element of its tag is ignored;
  * an element that nothing closes ends at the end of the page.
The positions come with the page (``tokens.prepare_pages``). Elements and
their texts are cut in-row, so there is no window, no join and no row that
carries a page beside an element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelens.functions import html as H
from pagelens.functions.literals import sql_string

_UNB = Window.unboundedPreceding


def elements(prepared: DataFrame, tags: list[str] | None = None, containing: list[str] | tuple[str, ...] = (),
             text_of: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Elements of all pages: (page_id, open_pos, close_pos, tag, tok, text).

    ``tags`` keeps these tags only, ``containing`` also start tags that contain
    one of the strings (say, an id). ``text`` (H6) is all text under the element, in
    order, for the tags in ``text_of``, else null: a slice of the page's token
    texts, joined behind the explode, so that one text at a time is held and a page of
    nested elements never lies in one row with all their texts. Jobs that only count
    terms do not write texts out at all (``operators.sweep``).
    """
    p = prepared.select("page_id", "ends", F.expr(H.TOKENS_SQL).alias("raw"))
    keep = "_e.close_pos IS NOT NULL"
    if tags is not None:
        among = f"_e.tag IN ({', '.join(map(sql_string, tags))})" if tags else "false"
        for s in containing:
            among += f" OR contains(_e.tok, {sql_string(s)})"
        keep += f" AND ({among})"
    text = F.lit(None).cast("string")
    if text_of:
        p = p.withColumn("txt", F.expr(H.text_sql("raw")))
        own = F.slice("txt", (F.col("_x.open_pos") + 2).cast("int"),
                      F.greatest(F.col("_x.close_pos") - F.col("_x.open_pos") - 1, F.lit(0)).cast("int"))
        text = F.when(F.col("_x.tag").isin(list(text_of)), F.array_join(own, ""))
    rows = (f"filter(transform(raw, (_t, _i) -> named_struct('open_pos', CAST(_i AS BIGINT), "
            f"'close_pos', CAST(get(ends, _i) AS BIGINT), 'tag', {H.tag_sql('_t')}, 'tok', _t)), _e -> {keep})")
    # the array is a column of its own, so that explode and slice are one generated loop
    # and no row carries the page's texts; outer, lest a filter on its size be inferred,
    # which would cut the page a second time, below the page exchange
    x = p.withColumn("els", F.expr(rows)).select("page_id", *(["txt"] if text_of else []), F.explode_outer("els").alias("_x"))
    x = x.where("_x IS NOT NULL")
    return x.select("page_id", "_x.*", text.alias("text"))


def region_condition(by: str, value: str) -> Column:
    """Predicate on element rows selecting region candidates (H2).

    ``by='id'`` matches the id attribute (``find(id=...)``); ``by='tag'``
    matches a tag name (the driver pages mark content with ``<article>``).
    """
    if by == "id":
        return F.col("tok").contains(value) & (H.attr("tok", "id") == value)
    if by == "tag":
        return F.col("tag") == value
    raise ValueError(f"unknown region selector {by!r}")


def with_region(els: DataFrame, by: str, value: str, prefix: str = "r") -> DataFrame:
    """Add ``{prefix}_open``/``{prefix}_close``: the first matching element of
    the page (document order), null if none. A window, not a join."""
    w = Window.partitionBy("page_id")
    first = F.min(F.when(region_condition(by, value),
                         F.struct("open_pos", "close_pos"))).over(w)
    return (els.withColumn(f"_{prefix}", first)
               .withColumns({f"{prefix}_open": F.col(f"_{prefix}.open_pos"),
                             f"{prefix}_close": F.col(f"_{prefix}.close_pos")})
               .drop(f"_{prefix}"))


def inside(prefix: str = "r", pos: str = "open_pos") -> Column:
    """Strictly inside the region interval (descendants only)."""
    return (F.col(pos) > F.col(f"{prefix}_open")) & (F.col(pos) < F.col(f"{prefix}_close"))


def with_ancestor_flag(els: DataFrame, tag: str = "a", name: str = "in_a") -> DataFrame:
    """Flag elements that have an ancestor ``tag`` anywhere in the page (H7).

    Running sum of +1 at each ``tag`` start and -1 at its end, per page in
    position order: one window, no pairs. ``structural_join(.., 'left_anti')``
    is the join form of the same test.
    """
    ev_row = F.struct(F.col("open_pos").alias("epos"), F.lit(0).alias("d"), F.lit(True).alias("row"))
    ev_open = F.struct(F.col("open_pos").alias("epos"), F.lit(1).alias("d"), F.lit(True).alias("row"))
    ev_close = F.struct(F.col("close_pos").alias("epos"), F.lit(-1).alias("d"), F.lit(False).alias("row"))
    events = F.when(F.col("tag") == tag, F.array(ev_open, ev_close)).otherwise(F.array(ev_row))
    w = Window.partitionBy("page_id").orderBy(F.col("_e.epos"), F.col("_e.d"))
    out = (els.withColumn("_e", F.explode(events))
              .withColumn("_depth", F.sum(F.col("_e.d")).over(w.rowsBetween(_UNB, 0)))
              .where(F.col("_e.row")))
    own = F.when(F.col("tag") == tag, 1).otherwise(0)
    return out.withColumn(name, (F.col("_depth") - own) > 0).drop("_e", "_depth")


def structural_join(points: DataFrame, intervals: DataFrame, how: str = "inner",
                    pos: str = "pos") -> DataFrame:
    """Points strictly inside intervals of the same page: J1 with how='left_anti' (or
    'left_semi'), J2 with how='inner'.

    All windows over the page in position order, in time proportional to points,
    intervals and pairs. How many intervals a point is inside is a running count and makes
    no pairs. Intervals that nest have a level, the count at their start; a point inside n
    of them is put in n rows, and what it is inside at each level is the last interval
    that started there. Rows stay where their page lies: nothing is shuffled that lies
    by page already, and what follows by page needs no shuffle either.

    Intervals of a page must nest, as elements do, for 'inner'. That is checked on every
    pair: the last starts at n levels that all hold the point are all that hold it. So
    crossing ones are an error, never a wrong row; the other two take them as they are.
    Inner rows are the point's columns, then outer_open_pos, outer_close_pos and the
    interval's other columns as outer_*. Null pages and positions are inside nothing;
    intervals without content and those with a null end hold nothing. Repeated points
    and intervals count as often as they occur.
    """
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError(f"unknown kind of structural join {how!r}")
    more = [c for c in intervals.columns if c not in ("page_id", "open_pos", "close_pos")]
    added = ["outer_open_pos", "outer_close_pos", *(f"outer_{c}" for c in more)] if how == "inner" else []
    clash = set(added) & set(points.columns)
    if clash:
        raise ValueError(f"columns of the points named as those of the join: {sorted(clash)}")
    # at one position: ends, then points, then starts
    start, end = F.col("open_pos").cast("bigint"), F.col("close_pos").cast("bigint")
    # columns go by number: names may hold dots or be those used here
    iv = F.struct(start.alias("v0"), end.alias("v1"), *(F.col(f"`{c}`").alias(f"v{i + 2}") for i, c in enumerate(more)))
    marks = F.explode(F.array(
        F.struct(start.alias("at"), F.lit(1).alias("d"), end.alias("until"), iv.alias("iv")),
        F.struct(end.alias("at"), F.lit(-1).alias("d"), F.lit(None).cast("bigint").alias("until"),
                 F.when(F.lit(False), iv).alias("iv")))).alias("m")
    spans = intervals.where("page_id IS NOT NULL AND open_pos < close_pos").select("page_id", marks).select("page_id", "m.*")
    pt = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(points.columns) if c != "page_id"]
    events = points.select("page_id", F.col(f"`{pos}`").cast("bigint").alias("at"), F.lit(0).alias("d"), *pt) \
        .unionByName(spans, allowMissingColumns=True)
    order = ["at", "d", F.col("until").desc()]
    w = Window.partitionBy("page_id").orderBy(*order).rowsBetween(_UNB, 0)
    events = events.withColumn("depth", F.sum("d").over(w))
    own = [F.col("page_id") if c == "page_id" else F.col(f"c{i}").alias(c) for i, c in enumerate(points.columns)]
    if how != "inner":
        return events.where("d = 0").where("depth > 0" if how == "left_semi" else "depth = 0").select(*own)
    levels = F.when(F.col("d") == 0, F.sequence(F.lit(1).cast("bigint"), F.col("depth"))).otherwise(F.array("depth"))
    events = events.where("d >= 0 AND depth > 0").select("*", F.explode(levels).alias("level"))
    w = Window.partitionBy("page_id", "level").orderBy(*order).rowsBetween(_UNB, 0)
    found = events.withColumn("iv", F.last("iv", ignorenulls=True).over(w)).where("d = 0")
    crossing = F.raise_error(F.lit("intervals of a page cross, which an inner structural join does not take")).cast("boolean")
    return found.where(F.when(F.col("iv.v1") > F.col("at"), True).otherwise(crossing)) \
        .select(*own, *(F.col(f"iv.v{i}").alias(c) for i, c in enumerate(added)))
