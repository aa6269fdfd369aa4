"""Link predicates and rewrites as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def https_only(link: Column) -> Column:
    """Non-null links starting with 'https' (F1)."""
    return link.startswith("https")


def http_anywhere(link: Column) -> Column:
    """Links containing 'http' anywhere (F2)."""
    return link.contains("http")


def link_filter(link: Column, mode: str) -> Column:
    """'https' (F1), 'http' (F2) or 'none' (F3: only a non-null link)."""
    if mode == "https":
        return F.coalesce(https_only(link), F.lit(False))
    if mode == "http":
        return F.coalesce(http_anywhere(link), F.lit(False))
    if mode == "none":
        return link.isNotNull()
    raise ValueError(f"unknown link filter {mode!r}")


def site_prefix(link: Column, prefix: str) -> Column:
    """Links starting with a path prefix such as '/sport/' (F4)."""
    return F.coalesce(link.startswith(prefix), F.lit(False))


def topic_any(link: Column, topics: list[str]) -> Column:
    """True if the link contains any of the topic strings."""
    cond = F.lit(False)
    for t in topics:
        cond = cond | F.coalesce(F.instr(link, t) > 0, F.lit(False))
    return cond


def topic_first(link: Column, topics: list[str]) -> Column:
    """First topic, in list order, that the link contains; null if none.

    A CASE chain over the (short, configured) topic list rather than a
    lambda over an array: expressions without lambdas stay codegen'd and are
    safe to rewrite when the plan joins a relation with itself.
    """
    out = None
    for t in topics:
        out = (F.when(F.instr(link, t) > 0, F.lit(t)) if out is None
               else out.when(F.instr(link, t) > 0, F.lit(t)))
    return out if out is not None else F.lit(None).cast("string")


def absolutise(link: Column, base: str) -> Column:
    """Base URL + link, plain concatenation."""
    return F.concat(F.lit(base), link)


def rebase(path: Column, base: str, strip: str = "/sport/") -> Column:
    """Remove every occurrence of ``strip`` then prefix the base."""
    return F.concat(F.lit(base), F.replace(path, F.lit(strip), F.lit("")))


def label_from_url(url: Column, base: str) -> Column:
    """Base removed, split on '/': the second part if there are more than two
    parts, else the first (F11)."""
    parts = F.split(F.replace(url, F.lit(base), F.lit("")), "/")
    return F.when(F.size(parts) > 2, F.element_at(parts, 2)).otherwise(
        F.element_at(parts, 1))


URL_RE = r"^https?://[^\s/?#]+\.[^\s/?#]+(?:[/?#]\S*)?$"


def url_valid(url: Column) -> Column:
    """A well-formed absolute http(s) URL with a dotted host."""
    return F.coalesce(url.rlike(URL_RE) & F.try_parse_url(url, F.lit("HOST")).isNotNull(),
                      F.lit(False))


def url_stem(link: Column) -> Column:
    """Text before the first '?' (F13)."""
    return F.substring_index(link, "?", 1)
