"""URL filter: host and path rules, and a tree of path templates per host.

Paths are walked level by level. At a node of a host's tree a segment value that
holds a fair share of the host's urls stays a literal branch; the other values are
variable and fall into a wildcard of their shape. Literal branches that do not
differ in the share of blocked examples are merged. A template (the branches
from the root to the end of a path) rejects its urls if its share of blocked
examples, smoothed by the share over all examples, is high enough.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelens.llm.common import checked_join, cut

# --- fixed values: the rules (host, path), each with its verdict ---------------
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"))
# -----------------------------------------------------------------------------

#: Levels of a tree; the segments from the last level on are one segment together.
DEPTH = 5
#: Urls a literal branch holds at least: this many, and this share of its host's.
LEAST_URLS = 8
LEAST_SHARE = 0.002
#: Examples each of two branches needs to be compared, and the standard errors
#: by which the shares of merged branches differ at most.
LEAST_EXAMPLES = 8
ALIKE = 2.0
#: Pseudo-examples of the smoothing, and the purity that rejects.
PSEUDO = 4.0
PURITY = 0.9
END = ""


def parts(url):
    """(host, path) columns of a url column."""
    rule = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    lower = F.translate(F.regexp_extract(url, rule, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(F.regexp_extract(url, rule, 2), F.lit(""))


def rule_of(host, path, rules=RULES):
    """The longest rule that fits, as struct<size, rule, verdict>, or null. Equal
    lengths: block before allow, then the smaller rule."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(-len(h + p)).alias("size"), F.lit({"block": 0, "allow": 1}[v]).alias("o"),
                            F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for h, p, v in rules]
    return F.array_min(F.array(*fits)) if fits else F.lit(None).cast(
        "struct<size: int, o: int, rule: string, verdict: string>")


def shape(seg):
    """Wildcard of a variable segment: its kind and its extension."""
    stem = F.regexp_extract(seg, r"^(.*?)(\.[A-Za-z]{1,5})?$", 1)
    ext = F.lower(F.regexp_extract(seg, r"^(.*?)(\.[A-Za-z]{1,5})?$", 2))
    kind = (F.when(stem.rlike(r"^[0-9]+$"), "{n}").when(stem.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{8,}$"), "{x}")
            .when(stem.rlike(r"[0-9]"), "{m}").otherwise("{s}"))
    return F.concat(kind, ext)


def segment(path, level: int, depth: int = DEPTH):
    """Segment `level` (from 0) of a path, all the rest at the last level, `END` below the last one."""
    segs = F.filter(F.split(path, "/"), lambda s: s != "")
    if level == depth - 1:
        return F.array_join(F.slice(segs, level + 1, F.greatest(F.size(segs), F.lit(1))), "/")
    return F.coalesce(F.get(segs, F.lit(level)), F.lit(END))


def judge(pages: DataFrame, url_col: str = "url", rules=RULES, depth: int = DEPTH) -> DataFrame:
    """All rows with `host`, `path`, `rule`, `verdict`, and of the method `template`,
    `examples` (its urls that a rule decides) and `purity` (smoothed blocked share).

    The examples are the urls that a rule decides. Null urls and urls without
    `://` have an empty host and path, and are a host like any other. Input
    columns with the names of results are replaced; an empty table gives an
    empty table.
    """
    out = ["host", "path", "rule", "verdict", "template", "examples", "purity"]
    rows = pages.drop(*out)
    host, path = parts(F.col(f"`{url_col}`"))
    rows = rows.withColumns({"host": host, "path": path})
    rows = rows.withColumn("__r", rule_of(F.col("host"), F.col("path"), rules))

    tree = rows.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.col("__r")).alias("e"),
        F.count(F.when(F.col("__r.verdict") == "block", 1)).alias("b"))
    tree = cut(tree.withColumn("t", F.lit("")))
    hosts = cut(tree.groupBy("host").agg(F.sum("n").alias("hn")))
    deepest = tree.agg(F.max(F.size(F.split("path", "/")))).first()[0] or 0
    for level in range(min(depth, deepest)):
        at = tree.withColumn("s", segment(F.col("path"), level, depth))
        nodes = cut(at.where(F.col("s") != END).groupBy("host", "t", "s").agg(*[F.sum(c).alias(c) for c in "neb"])
                    .where(F.col("n") >= LEAST_URLS))
        nodes = checked_join(nodes, hosts, "host", "inner").where(F.col("n") >= F.col("hn") * LEAST_SHARE)
        named = cut(merged(nodes).select("host", "t", "s", "branch"))
        at = checked_join(at, named, ["host", "t", "s"], "left")
        branch = F.when(F.col("s") == END, F.lit("")).otherwise(
            F.concat(F.lit("/"), F.coalesce("branch", shape(F.col("s")))))
        tree = cut(at.select("host", "path", "n", "e", "b", F.concat("t", branch).alias("t")))
    prior = tree.agg(F.sum("b").alias("b"), F.sum("e").alias("e")).first()
    prior = (prior["b"] or 0) / max(1, prior["e"] or 0)
    judged = tree.groupBy("host", "t").agg(F.sum("e").alias("examples"), F.sum("b").alias("b"))
    judged = cut(judged.select("host", "t", "examples", ((F.col("b") + PSEUDO * prior) / (F.col("examples") + PSEUDO)).alias("purity")))
    named = cut(checked_join(tree.select("host", "path", "t"), judged, ["host", "t"], "inner"))
    rows = rows.join(named.withColumnRenamed("t", "template"), ["host", "path"])
    method = F.when((F.col("examples") >= LEAST_EXAMPLES) & (F.col("purity") >= PURITY), "block").otherwise("allow")
    rows = rows.withColumns({"rule": F.col("__r.rule"), "verdict": F.coalesce(F.col("__r.verdict"), method)})
    return rows.select(*[F.col(f"`{c}`") for c in pages.columns if c not in out], *out)


def merged(nodes: DataFrame) -> DataFrame:
    """Add `branch`: a literal segment, or the joined names of the sibling segments
    whose blocked shares are alike. A host has at most 1 / LEAST_SHARE literals
    below one node, so a window over siblings is bounded."""
    known = F.col("e") >= LEAST_EXAMPLES
    sib = Window.partitionBy("host", "t").orderBy(F.col("p"), F.col("s"))
    p = F.when(known, F.col("b") / F.col("e"))
    m = nodes.where(known).withColumn("p", p)
    m = m.withColumns({"lp": F.lag("p").over(sib), "le": F.lag("e").over(sib), "lb": F.lag("b").over(sib)})
    mean = (F.col("b") + F.col("lb")) / (F.col("e") + F.col("le"))
    gap = F.col("p") - F.col("lp")
    apart = gap > ALIKE * F.sqrt(mean * (1 - mean) * (1 / F.col("e") + 1 / F.col("le")))
    m = m.withColumn("g", F.sum(F.when(F.col("lp").isNull() | apart, 1).otherwise(0)).over(
        sib.rowsBetween(Window.unboundedPreceding, 0)))
    name = F.array_join(F.sort_array(F.collect_set("s").over(Window.partitionBy("host", "t", "g"))), "|")
    m = m.withColumn("branch", name).select("host", "t", "s", "branch")
    return m.unionByName(nodes.where(~known).select("host", "t", "s", F.col("s").alias("branch")))


def oracle_sql() -> str:
    """DuckDB SQL of query op5: the same tree, level by level, written on its own."""
    rules = ", ".join(f"('{h}', '{p}', '{v}', {int(v != 'block')})" for h, p, v in RULES)
    sql = f"""WITH
u AS (SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
r(h, p, v, o) AS (VALUES {rules}),
f AS (SELECT u.page_id, h || p AS rule, v, row_number() OVER (PARTITION BY u.page_id ORDER BY length(h || p) DESC, o, h || p) AS k
      FROM u JOIN r ON (u.host = h OR ends_with(u.host, '.' || h)) AND starts_with(u.path, p)),
a AS (SELECT u.*, f.rule, f.v, list_filter(string_split(u.path, '/'), lambda x: x <> '') AS segs
      FROM u LEFT JOIN f ON f.page_id = u.page_id AND f.k = 1),
hosts AS (SELECT host, count(*) AS hn FROM a GROUP BY host),
t0 AS (SELECT page_id, host, segs, v, '' AS t FROM a)"""
    for k in range(DEPTH):
        seg = f"coalesce(segs[{k + 1}], '')" if k < DEPTH - 1 else f"array_to_string(segs[{k + 1}:], '/')"
        sql += f""",
s{k} AS (SELECT *, {seg} AS s FROM t{k}),
n{k} AS (SELECT host, t, s, count(v) AS e, count(*) FILTER (WHERE v = 'block') AS b FROM s{k} JOIN hosts USING (host) WHERE s <> ''
         GROUP BY host, t, s HAVING count(*) >= {LEAST_URLS} AND count(*) >= any_value(hn) * {LEAST_SHARE}),
l{k} AS (SELECT *, b::DOUBLE / e AS p, lag(b::DOUBLE / e) OVER w AS lp, lag(e) OVER w AS le, lag(b) OVER w AS lb
         FROM n{k} WHERE e >= {LEAST_EXAMPLES} WINDOW w AS (PARTITION BY host, t ORDER BY b::DOUBLE / e, s)),
g{k} AS (SELECT *, sum(CASE WHEN lp IS NULL OR p - lp > {ALIKE} * sqrt((b + lb)::DOUBLE / (e + le) * (1 - (b + lb)::DOUBLE / (e + le))
             * (1.0::DOUBLE / e + 1.0::DOUBLE / le)) THEN 1 ELSE 0 END) OVER (PARTITION BY host, t ORDER BY p, s) AS g FROM l{k}),
b{k} AS (SELECT host, t, s, string_agg(s, '|') OVER (PARTITION BY host, t, g ORDER BY s
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS branch FROM g{k}
         UNION ALL SELECT host, t, s, s FROM n{k} WHERE e < {LEAST_EXAMPLES}),
t{k + 1} AS (SELECT s{k}.page_id, s{k}.host, s{k}.segs, s{k}.v, s{k}.t || CASE WHEN s{k}.s = '' THEN '' ELSE '/' || coalesce(branch,
             CASE WHEN regexp_matches(stem, '^[0-9]+$') THEN '{{n}}'
                  WHEN regexp_matches(stem, '^[0-9a-fA-F-]{{8,}}$') AND regexp_matches(stem, '[0-9]') THEN '{{x}}'
                  WHEN regexp_matches(stem, '[0-9]') THEN '{{m}}' ELSE '{{s}}' END || lower(ext)) END AS t
           FROM (SELECT *, regexp_extract(s, '^(.*?)(\\.[A-Za-z]{{1,5}})?$', 1) AS stem,
                        regexp_extract(s, '^(.*?)(\\.[A-Za-z]{{1,5}})?$', 2) AS ext FROM s{k}) s{k}
           LEFT JOIN b{k} USING (host, t, s))"""
    return sql + f""",
pr AS (SELECT coalesce(count(*) FILTER (WHERE v = 'block')::DOUBLE / nullif(count(v), 0), 0) AS prior FROM a),
j AS (SELECT host, t, count(v) AS examples, (count(*) FILTER (WHERE v = 'block') + {PSEUDO} * any_value(prior)) / (count(v) + {PSEUDO}) AS purity
      FROM t{DEPTH}, pr GROUP BY host, t)
SELECT a.page_id, a.host, a.path, a.rule, coalesce(a.v, CASE WHEN examples >= {LEAST_EXAMPLES} AND purity >= {PURITY}
         THEN 'block' ELSE 'allow' END) AS verdict, j.t AS template, j.examples, j.purity
FROM a JOIN t{DEPTH} t ON t.page_id = a.page_id JOIN j ON j.host = t.host AND j.t = t.t"""
