"""DuckDB SQL oracles for the registered queries (see ``registry``).

They state every constant again and compute the answers another way: tokens
with another regex library (RE2), element ends by a recursive query that
carries the stack of open elements from tag to tag, texts by joining tokens
to intervals, and crawls in closed form from ``page_id``.
"""

from __future__ import annotations

from pagelens.registry import (ARCHIVE_EVERY, BASE, BUDGET, LANG_TOPICS, LINK_TOPICS, archive_sql, https_link, page_link,
                               splice_sql, sport_link, sport_url)

# --- fixed values, stated independently of the code under test ----------------
_ATTRS = r"""(?:[\s/](?:[^>"']|"[^"]*"|'[^']*')*)?>"""
CLEAN = (rf"(?is)(<script{_ATTRS}).*?(</script\s*>|\z)|(<style{_ATTRS}).*?(</style\s*>|\z)|<!--.*?-->")
TOKEN = r"""(?s)<[a-zA-Z/!?](?:[^>"']|"[^"]*"|'[^']*')*>|<|[^<]+"""
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta",
        "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame", "image", "isindex",
        "nextid", "spacer"]
STOP_33 = ("a an and are as at be but by for if in into is it no not of on or such that the their then "
           "there these they this to was will with").split()
STOP_10 = "you from have can been were has your its than".split()
SPACE_RUN = (r"[^\t\n\x0B\f\r\x1C-\x1F \x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}"
             r"\x{205F}\x{3000}]{1,255}")
LETTER_RUN = r"\p{L}{1,255}"
# -------------------------------------------------------------------------------


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(words: list[str]) -> str:
    return ", ".join(_q(w) for w in words)


def _decode(col: str) -> str:
    out = col
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                    ("&apos;", "'"), ("&nbsp;", " "), ("&copy;", "©"),
                    ("&middot;", "·"), ("&amp;", "&")]:
        out = f"replace({out}, {_q(ent)}, {_q(ch)})"
    return out


def _topic_case(col: str, topics: list[str]) -> str:
    whens = " ".join(f"WHEN contains({col}, {_q(t)}) THEN {_q(t)}" for t in topics)
    return f"CASE {whens} END"


def parse_ctes(src: str) -> str:
    """CTEs tkw (tokens), el (elements) and eltext (texts of p, h1, h2) from a CTE or
    table ``src(page_id, html)``. Needs WITH RECURSIVE."""
    return f"""
pg AS (SELECT page_id, regexp_replace(html, {_q(CLEAN)}, '\\1\\2\\3\\4', 'g') AS h FROM {src}),
tk0 AS (SELECT page_id, t.raw, (t.pos - 1)::BIGINT AS pos
        FROM pg, unnest(regexp_extract_all(h, {_q(TOKEN)})) WITH ORDINALITY AS t(raw, pos)),
ntok AS (SELECT page_id, count(*) AS n FROM tk0 GROUP BY page_id),
tk1 AS (SELECT page_id, pos, raw,
          CASE WHEN regexp_matches(raw, '^<[a-zA-Z]') THEN 'open'
               WHEN regexp_matches(raw, '^</[a-zA-Z]') THEN 'close'
               WHEN NOT starts_with(raw, '<') OR raw = '<' THEN 'text' ELSE 'other' END AS kind
        FROM tk0),
tkw AS (SELECT page_id, pos, kind,
          CASE WHEN kind = 'text' THEN '' ELSE lower(regexp_extract(raw, '^</?([a-zA-Z][^\\s/>]*)', 1)) END AS tag,
          CASE WHEN kind = 'text' THEN {_decode('raw')} ELSE raw END AS tok,
          CASE WHEN kind = 'text' THEN length({_decode('raw')}) ELSE 0 END AS tlen
        FROM tk1 WHERE kind <> 'other'),
mk AS (SELECT page_id, pos, tag, kind = 'open' AS opens, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn
       FROM tkw WHERE kind <> 'text' AND tag NOT IN ({_in(VOID)}) AND NOT (kind = 'open' AND ends_with(tok, '/>'))),
st AS (SELECT page_id, 0::BIGINT AS rn, []::VARCHAR[] AS tags, []::BIGINT[] AS poss, []::BIGINT[] AS ended, 0::BIGINT AS cpos FROM pg
       UNION ALL
       SELECT page_id, rn, CASE WHEN opens THEN list_append(tags, tag) WHEN k > 0 THEN tags[1:k - 1] ELSE tags END,
              CASE WHEN opens THEN list_append(poss, pos) WHEN k > 0 THEN poss[1:k - 1] ELSE poss END,
              CASE WHEN NOT opens AND k > 0 THEN poss[k:] ELSE [] END, pos
       FROM (SELECT m.*, s.tags, s.poss, CASE WHEN list_contains(s.tags, m.tag)
                      THEN len(s.tags) + 1 - list_position(list_reverse(s.tags), m.tag) ELSE 0 END AS k
             FROM st s JOIN mk m ON m.page_id = s.page_id AND m.rn = s.rn + 1)),
en AS (SELECT page_id, unnest(ended) AS open_pos, cpos AS close_pos FROM st),
el AS (SELECT t.page_id, t.pos AS open_pos, t.tag, t.tok,
          CASE WHEN t.tag IN ({_in(VOID)}) OR ends_with(t.tok, '/>') THEN t.pos ELSE coalesce(en.close_pos, ntok.n) END AS close_pos
       FROM tkw t JOIN ntok ON ntok.page_id = t.page_id LEFT JOIN en ON en.page_id = t.page_id AND en.open_pos = t.pos
       WHERE t.kind = 'open'),
eltext AS (SELECT e.page_id, e.open_pos, any_value(e.close_pos) AS close_pos, any_value(e.tag) AS tag,
             coalesce(string_agg(t.tok, '' ORDER BY t.pos), '') AS text
           FROM el e LEFT JOIN tkw t ON t.page_id = e.page_id AND t.kind = 'text' AND t.pos > e.open_pos AND t.pos < e.close_pos
           WHERE e.tag IN ('p', 'h1', 'h2') GROUP BY e.page_id, e.open_pos)"""


def attr(name: str) -> str:
    """An attribute of ``tok``; those of the pages are double-quoted and hold no other reference."""
    return (f"CASE WHEN contains(tok, ' {name}=\"') THEN "
            f"replace(regexp_extract(tok, ' {name}=\"([^\"]*)\"', 1), '&amp;', '&') END")


def article_ctes(parts: tuple[str, ...] = ("p", "h1", "h2"), region: str = "tag = 'article'",
                 nested: str | None = None) -> str:
    """Content region (reg), scoped elements with text (sc), unlinked images (im), lines
    and titles. ``nested`` is the condition of the region that paragraphs must lie in."""
    conds = {"p": "sc.tag = 'p'" + (" AND sc.in_text" if nested else ""),
             "h1": "sc.open_pos = fh.h1p", "h2": "sc.open_pos = fh.h2p"}
    chosen = " OR ".join(f"({c})" for p, c in conds.items() if p in parts)
    inner = (f"nreg AS (SELECT el.page_id, min(el.open_pos) AS o, arg_min(el.close_pos, el.open_pos) AS c FROM el JOIN reg r "
             f"ON r.page_id = el.page_id AND el.open_pos > r.r_open AND el.open_pos < r.r_close WHERE {nested} GROUP BY el.page_id),"
             if nested else "nreg AS (SELECT page_id, r_open AS o, r_close AS c FROM reg),")
    alts = """
       UNION ALL SELECT page_id, 3, min(open_pos), alt FROM im
       WHERE alt IS NOT NULL AND contains(src, 'http') GROUP BY page_id, alt""" if "alt" in parts else ""
    return f"""
reg AS (SELECT page_id, min(open_pos) AS r_open, arg_min(close_pos, open_pos) AS r_close
        FROM el WHERE {region} GROUP BY page_id),
{inner}
sc AS (SELECT e.page_id, e.open_pos, e.tag, e.text, coalesce(e.open_pos > n.o AND e.open_pos < n.c, false) AS in_text
       FROM eltext e JOIN reg r ON e.page_id = r.page_id AND e.open_pos > r.r_open AND e.open_pos < r.r_close
       LEFT JOIN nreg n ON n.page_id = e.page_id),
im AS (SELECT e.page_id, e.open_pos, e.tag, {attr('src')} AS src, {attr('alt')} AS alt
       FROM el e JOIN reg r ON e.page_id = r.page_id AND e.open_pos > r.r_open AND e.open_pos < r.r_close
       WHERE e.tag IN ('img', 'amp-img') AND NOT EXISTS (SELECT 1 FROM el a WHERE a.page_id = e.page_id AND a.tag = 'a'
             AND a.open_pos < e.open_pos AND e.open_pos < a.close_pos)),
fh AS (SELECT page_id, min(open_pos) FILTER (WHERE tag = 'h1') AS h1p,
              min(open_pos) FILTER (WHERE tag = 'h2') AS h2p FROM sc GROUP BY page_id),
ln AS (SELECT sc.page_id, CASE WHEN sc.tag = 'p' THEN 0 WHEN sc.open_pos = fh.h1p THEN 1 ELSE 2 END AS part,
              sc.open_pos, sc.text
       FROM sc JOIN fh ON sc.page_id = fh.page_id WHERE {chosen}{alts}),
lines AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY part, open_pos) AS line_id, text FROM ln),
titles AS (SELECT page_id, arg_min(text, open_pos) AS title FROM sc WHERE tag = 'h1' GROUP BY page_id)"""


def term_ctes(lines: str = "lines", analyzer: str = "words") -> str:
    """(page_id, term, n) as cnt and ranked as rk, from ``lines(page_id, line_id, text)``."""
    if analyzer == "words":
        stops = _in(STOP_33 + STOP_10)
        body = f"""
wt AS (SELECT page_id, line_id, unnest(regexp_extract_all(text, {_q(SPACE_RUN)})) AS w FROM {lines}),
wt2 AS (SELECT DISTINCT page_id, line_id, regexp_replace(lower(w), '[''’].*$', '') AS term
        FROM wt WHERE w <> '' AND lower(w) NOT IN ({stops})),"""
    else:
        stops = _in(STOP_33)
        body = f"""
wt AS (SELECT page_id, line_id, unnest(regexp_extract_all(lower(text), {_q(LETTER_RUN)})) AS w FROM {lines}),
wt2 AS (SELECT DISTINCT page_id, line_id, w AS term FROM wt WHERE w NOT IN ({stops})),"""
    return body + """
cnt AS (SELECT page_id, term, count(*)::BIGINT AS n FROM wt2 WHERE term <> '' GROUP BY page_id, term),
rk AS (SELECT page_id, term, n, row_number() OVER (PARTITION BY page_id ORDER BY n DESC, term ASC) AS rk FROM cnt)"""


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(c.strip().rstrip(",") for c in ctes) + "\n"


PAGES_TEXT = _with(parse_ctes("pages"), article_ctes(), term_ctes())
FRAME = "contains(tok, 'id=\"frameInner\"')"


def dec(link=page_link, url=None) -> str:
    return f"dec AS ({splice_sql(link, url)})"


def _py(col: str) -> str:
    """A string as Python prints it."""
    esc = f"replace(replace({col}, '\\', '\\\\'), chr(10), '\\n')"
    return (f"CASE WHEN contains({col}, '''') AND NOT contains({col}, '\"') THEN '\"' || {esc} || '\"' "
            f"ELSE '''' || replace({esc}, '''', '\\''') || '''' END")


V_PARTS = {1: ("p",), 2: ("p",), 3: ("p", "h1", "h2", "alt")}


def label_sql(version: int, arts: str, src: str = "pages", region: str = "tag = 'article'",
              head: tuple = (), more: tuple = ()) -> str:
    """Labels of ``arts(page_id, topic, url)``, a SELECT, as version 1, 2 or 3 renders them."""
    analyzer = "letters" if version == 1 else "words"
    keep = "src IS NOT NULL" if version == 1 else "contains(src, 'http')"
    image = "split_part(src, '?', 1)" if version == 3 else "src"
    group = "GROUP BY page_id, i" if version == 3 else "GROUP BY page_id, i, open_pos"
    term, pic = (_py("term"), _py("i")) if version == 1 else ("term", "i")

    def shown(x):
        return f"'[' || coalesce({x}, '') || ']'" if version == 1 else f"coalesce({x}, '')"

    title = "''" if version == 1 else "ti.title"
    ctes = [*head, parse_ctes(src), article_ctes(V_PARTS[version], region), term_ctes("lines", analyzer),
            f"pics AS (SELECT page_id, {image} AS i, min(open_pos) AS o FROM im WHERE {keep} {group})", *more]
    return _with(*ctes) + f"""
SELECT a.topic, {shown('d.terms')} AS descriptors, {shown('g.images')} AS image_links, {title} AS article_name, a.url AS article_link
FROM ({arts}) a
LEFT JOIN (SELECT page_id, string_agg({term}, ', ' ORDER BY rk) AS terms FROM rk WHERE rk <= 3 GROUP BY page_id) d ON d.page_id = a.page_id
LEFT JOIN (SELECT page_id, string_agg({pic}, ', ' ORDER BY o) AS images FROM pics GROUP BY page_id) g ON g.page_id = a.page_id
LEFT JOIN titles ti ON ti.page_id = a.page_id"""


_TOPIC = _topic_case("url", LANG_TOPICS)
LANG_ARTS = f"SELECT page_id, url, {_TOPIC} AS topic FROM pages WHERE {_TOPIC} IS NOT NULL"


def _csv(col: str) -> str:
    return (f"CASE WHEN regexp_matches(coalesce({col}, ''), '[,\"\\r\\n]') "
            f"THEN '\"' || replace({col}, '\"', '\"\"') || '\"' ELSE coalesce({col}, '') END")


TOPIC_SECTIONS = _with(parse_ctes("pages"), article_ctes(), term_ctes(), f"""
arts AS (SELECT p.page_id, p.topic, coalesce(d.terms, '') AS descriptors, ti.title, p.url
         FROM (SELECT page_id, url, {_topic_case('url', LANG_TOPICS)} AS topic FROM pages) p
         LEFT JOIN (SELECT page_id, string_agg(term, ', ' ORDER BY rk) AS terms FROM rk WHERE rk <= 3 GROUP BY page_id) d
           ON d.page_id = p.page_id
         LEFT JOIN titles ti ON ti.page_id = p.page_id
         WHERE p.topic IS NOT NULL),
sec AS (SELECT topic, min(page_id) AS section_ord FROM arts GROUP BY topic)""") + f"""
SELECT s.section_ord, 2 AS part, a.page_id AS row_ord,
       {_csv('a.descriptors')} || ',' || '' || ',' || {_csv('a.title')} || ',' || {_csv('a.url')} AS line
FROM arts a JOIN sec s ON a.topic = s.topic
UNION ALL SELECT section_ord, 0, NULL, {_csv('topic')} FROM sec
UNION ALL SELECT section_ord, 1, NULL, 'descriptors,image links,article name,article link' FROM sec
UNION ALL SELECT section_ord, 3, NULL, '""' FROM sec"""


def _doc_lines_cte() -> str:
    return """
lines AS (SELECT doc_id AS page_id, (t.i - 1)::BIGINT AS line_id, t.text
          FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY AS t(text, i))"""


# The links of a spliced page's content region in closed form, in order.
LINKS = f"""
lk AS (SELECT page_id, v.ord::BIGINT AS ord, v.href FROM pages, (VALUES
  (1, {page_link('2*page_id+1')}), (2, {page_link('2*page_id+2')}), (3, {page_link('2*page_id+1')}),
  (4, {page_link('CASE WHEN page_id = 0 THEN 0 ELSE (page_id - 1) // 2 END')}), (5, '/p/2'), (6, '/out')) v(ord, href))"""
# The links of the whole page, and those of the region with their token positions, as parsed.
ALL_LINKS = f"""
al AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY open_pos) AS ord, {attr('href')} AS href
       FROM el WHERE tag = 'a' AND contains(tok, 'href='))"""
FRAME_LINKS = f"""
fl AS (SELECT e.page_id, e.open_pos AS pos, {attr('href')} AS href FROM el e JOIN reg r ON e.page_id = r.page_id
       AND e.open_pos > r.r_open AND e.open_pos < r.r_close WHERE e.tag = 'a' AND contains(tok, 'href='))"""
STORED = f"su AS (SELECT {page_link('page_id')} AS url, page_id FROM pages)"
_LINK_TOPIC = _topic_case("href", LINK_TOPICS)


def spliced_sql(select: str, *more: str, parts=("p", "h1", "h2"), nested: str | None = None) -> str:
    return _with(dec(), parse_ctes("dec"), article_ctes(parts, FRAME, nested), *more) + select


def crawl_ctes(days: int | None = None, base: str = "") -> tuple[str, ...]:
    """Two-level crawl from /p/0: ar(topic, url, day_pos, lpos). A page's url is its
    link with ``base`` in front."""
    limit = f"LIMIT {days}" if days else ""
    return FRAME_LINKS, STORED, f"""
dy AS (SELECT f.pos AS day_pos, su.page_id FROM fl f JOIN su ON su.url = f.href WHERE f.page_id = 0 ORDER BY f.pos {limit}),
ar AS (SELECT * FROM (SELECT {_LINK_TOPIC} AS topic, '{base}' || href AS url, dy.day_pos, f.pos AS lpos FROM dy JOIN fl f ON f.page_id = dy.page_id)
       WHERE topic IS NOT NULL)"""


def crawl_label_sql(version: int, days: int | None = None) -> str:
    return label_sql(version, "SELECT su.page_id, ar.topic, ar.url FROM ar JOIN su ON su.url = ar.url",
                     "dec", FRAME, (dec(),), crawl_ctes(days))


def archive_ctes(days: int | None = None) -> tuple[str, ...]:
    """The crawl from every archive at once: ar(root, topic, url, day_pos, lpos)."""
    keep = f"QUALIFY row_number() OVER (PARTITION BY f.page_id ORDER BY f.pos) <= {days}" if days else ""
    return FRAME_LINKS, STORED, f"""
dy AS (SELECT {page_link('f.page_id')} AS root, f.pos AS day_pos, su.page_id FROM fl f JOIN su ON su.url = f.href
       WHERE f.page_id % {ARCHIVE_EVERY} = 0 {keep}),
ar AS (SELECT * FROM (SELECT dy.root, {_LINK_TOPIC} AS topic, href AS url, dy.day_pos, f.pos AS lpos FROM dy JOIN fl f ON f.page_id = dy.page_id)
       WHERE topic IS NOT NULL)"""


ARCHIVES = f"dec AS ({archive_sql()})"


def archive_oracle(select: str, days: int | None = None) -> str:
    return _with(ARCHIVES, parse_ctes("dec"), article_ctes(region=FRAME), *archive_ctes(days)) + select


def archive_label_sql(version: int) -> str:
    labels = label_sql(version, "SELECT ar.root, su.page_id, ar.topic, ar.url FROM ar JOIN su ON su.url = ar.url",
                       "dec", FRAME, (ARCHIVES,), archive_ctes())
    return labels.replace("SELECT a.topic,", "SELECT a.root, a.topic,")


def sport_sql(select: str, *more: str) -> str:
    """Image rows pi of the crawl below the base page, which itself only gives links."""
    return _with(dec(sport_link, sport_url), parse_ctes("dec"), article_ctes(region=FRAME), f"""
pi AS (SELECT * FROM (SELECT 'l' || (e.page_id % 3)::VARCHAR AS label, e.page_id - 1 AS page_ord, {attr('alt')} AS alt,
         {attr('src')} AS src, e.open_pos AS pos FROM el e JOIN reg r ON e.page_id = r.page_id AND e.open_pos > r.r_open
         AND e.open_pos < r.r_close WHERE e.tag = 'img' AND e.page_id > 0) WHERE starts_with(src, 'https'))""", *more) + select


_LEVEL = "(bit_length(bin(page_id + 1)) / 8 - 1)::BIGINT AS level"

UNCLOSED = "unclosed AS (SELECT page_id, url, replace(html, '</p>', '') AS html FROM pages)"

ORACLES: dict[str, str] = {
    "h1_html_tokens": _with(parse_ctes("pages")) + "SELECT page_id, pos, kind, tag, tok, tlen FROM tkw",
    "h3_elements_by_tag": _with(dec(), parse_ctes("dec")) + "SELECT page_id, open_pos, close_pos, tag FROM el",
    "h6_element_text": PAGES_TEXT + "SELECT page_id, open_pos, text FROM sc WHERE tag = 'p'",
    "h4_first_element": PAGES_TEXT + "SELECT page_id, title FROM titles",
    "u1_line_union": PAGES_TEXT + "SELECT page_id, line_id, text FROM lines",
    "a1_term_doc_count": PAGES_TEXT + "SELECT page_id, term, n FROM cnt",
    "t1_top_terms": PAGES_TEXT + "SELECT page_id, term, n, rk::BIGINT AS rk FROM rk WHERE rk <= 3",
    "t2_top_buckets": PAGES_TEXT + "SELECT page_id, term, n, rk::BIGINT AS rk FROM rk WHERE rk <= 10",
    "p7_label_v3": label_sql(3, LANG_ARTS),
    "a1_unclosed_terms": _with(UNCLOSED, parse_ctes("unclosed"), article_ctes(), term_ctes()) +
        "SELECT page_id, term, n FROM cnt",
    "p7_label_v3_unclosed": label_sql(3, LANG_ARTS, "unclosed", head=(UNCLOSED,)),
    "p6_label_v2": label_sql(2, LANG_ARTS),
    "p5_label_v1": label_sql(1, "SELECT page_id, url, 'test' AS topic FROM pages"),
    "s10_topic_sections": TOPIC_SECTIONS,
    "s5_bulk_payload": PAGES_TEXT + """
SELECT page_id, ((line_id - 1) * 2 + 1)::BIGINT AS line_no,
       json_object('index', json_object('_id', cast(line_id as varchar)))::VARCHAR AS json FROM lines
UNION ALL
SELECT page_id, ((line_id - 1) * 2 + 2)::BIGINT, json_object('content', text)::VARCHAR FROM lines""",
    "s6_bulk_source": PAGES_TEXT + """
SELECT page_id, cast(line_id as varchar) AS id, ((line_id - 1) * 2 + 1)::BIGINT AS pos, text AS content FROM lines""",
    "s6_bulk_pairs": PAGES_TEXT + """
SELECT page_id, cast(line_id as varchar) AS id, text AS content FROM lines""",
    "s12_match_all": PAGES_TEXT + "SELECT page_id, line_id, text FROM lines WHERE line_id <= 10",
    "s3_url_cells": """
SELECT page_id, v.cell::BIGINT AS cell, v.url FROM pages, (VALUES (0, url), (2, replace(url, '/', '"') || ',q')) v(cell, url)
UNION ALL SELECT page_id, (2 + i)::BIGINT, url FROM pages, range(1, page_id % 98 + 1) r(i)""",
    "x8_documents_top_terms": _with(_doc_lines_cte(), term_ctes()) +
        "SELECT page_id, term, n, rk::BIGINT AS rk FROM rk WHERE rk <= 3",
    "x7_documents_letter_terms": _with(_doc_lines_cte(), term_ctes("lines", "letters")) +
        "SELECT page_id, term, n, rk::BIGINT AS rk FROM rk WHERE rk <= 3",
    "a1_conversation_terms": _with(
        "lines AS (SELECT conv_id AS page_id, turn AS line_id, text FROM conversations)", term_ctes()) +
        "SELECT page_id, term, n, rk::BIGINT AS rk FROM rk WHERE rk <= 3",
    "f14_keyword_copy": _with(_doc_lines_cte()) +
        "SELECT page_id, line_id, CASE WHEN length(text) <= 256 THEN text END AS keyword FROM lines",
    "f_url_functions": f"""
SELECT page_id, split_part(url, '?', 1) AS stem,
       CASE WHEN len(string_split(replace(url, 'https://', ''), '/')) > 2
            THEN string_split(replace(url, 'https://', ''), '/')[2]
            ELSE string_split(replace(url, 'https://', ''), '/')[1] END AS label,
       page_id % 3 < 2 AS valid,
       'https://x.example' || replace(split_part(url, '?', 1), '/en/', '') AS rebased,
       'https://y.example' || url AS absolute, starts_with(url, 'https') AS https, starts_with(url, 'http://') AS prefixed,
       {_TOPIC} AS topic
FROM pages""",
    "h8_entity_decode": """
SELECT page_id, url || ' &amp; é¬it; ©2020 ' || chr((65 + page_id % 26)::INTEGER) ||
       CASE WHEN page_id % 2 = 0 THEN '😀' ELSE '€' END || ' {&unknown; ' || chr(65533) || ' & &' AS text FROM pages""",
    # ---- the stored pages with a fragment spliced in
    "h2_region_by_id": spliced_sql("""
SELECT e.page_id, e.tag, count(*)::BIGINT AS n FROM el e JOIN reg r ON e.page_id = r.page_id AND e.open_pos > r.r_open
  AND e.open_pos < r.r_close GROUP BY ALL"""),
    "h5_attribute": spliced_sql(f"""
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY open_pos) AS ord, tag, {attr('src')} AS src, {attr('alt')} AS alt
FROM el WHERE tag IN ('img', 'amp-img')"""),
    "h7_not_inside_link": spliced_sql(
        "SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY open_pos) AS ord, src FROM im"),
    "j2_structural_containment": _with(dec(), parse_ctes("dec")) +
        "SELECT page_id, open_pos AS p_pos, text FROM eltext WHERE tag = 'p' AND text <> ''",
    "p9_article_images": spliced_sql("""
SELECT page_id, string_agg(i, ', ' ORDER BY o) AS images FROM (SELECT page_id, split_part(src, '?', 1) AS i, min(open_pos) AS o
  FROM im WHERE contains(src, 'http') GROUP BY ALL) GROUP BY page_id"""),
    "p1_page_images": spliced_sql(f"""
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY o) AS ord, coalesce(alt, 'None') || ': ' || coalesce(src, 'None') AS line
FROM (SELECT page_id, alt, min(open_pos) AS o, list(src ORDER BY open_pos)[-1] AS src
      FROM (SELECT page_id, open_pos, {attr('alt')} AS alt, {attr('src')} AS src FROM el WHERE tag = 'img') GROUP BY page_id, alt)"""),
    "p8_article_text": spliced_sql("SELECT page_id, line_id, text FROM lines", nested="contains(tok, 'id=\"main\"')"),
    "p7_label_v3_spliced": label_sql(3, "SELECT page_id, url, '/p/' AS topic FROM dec", "dec", FRAME, (dec(),)),
    "p6_label_v2_spliced": label_sql(2, "SELECT page_id, url, '/p/' AS topic FROM dec", "dec", FRAME, (dec(),)),
    "p5_label_v1_list": label_sql(1, "SELECT page_id, url, 'test' AS topic FROM dec, range(page_id % 2 + 1)",
                                  "dec", FRAME, (dec(),)).replace("SELECT a.topic,", "SELECT a.topic AS label,"),
    "c1_link_table": _with(dec(), parse_ctes("dec"), ALL_LINKS) + "SELECT * FROM al",
    "f5_topic_any": _with(dec(), parse_ctes("dec"), ALL_LINKS) +
        f"SELECT * FROM al WHERE contains(href, '{LINK_TOPICS[0]}') OR contains(href, '{LINK_TOPICS[1]}')",
    "f6_topic_first": _with(dec(), parse_ctes("dec"), ALL_LINKS) +
        f"SELECT *, {_LINK_TOPIC} AS topic FROM al WHERE {_LINK_TOPIC} IS NOT NULL",
    "j4_topic_table": _with(dec(), parse_ctes("dec"), ALL_LINKS) + """
SELECT al.page_id, al.ord, al.href, arg_max(d.url, d.page_id) AS topic FROM al JOIN dec d ON contains(al.href, d.url) GROUP BY ALL""",
    "c2_bfs_crawl": f"SELECT {page_link('page_id')} AS url, {_LEVEL}, page_id::BIGINT AS ord FROM pages",
    "c2_bfs_budget": f"""
SELECT {page_link('page_id')} AS url, page_id, {_LEVEL}, page_id - 1 AS ord FROM pages WHERE page_id BETWEEN 1 AND {BUDGET}""",
    "c3_two_level_crawl": spliced_sql("SELECT topic, url, day_pos, lpos FROM ar", *crawl_ctes()),
    "p4_extract_links": spliced_sql("SELECT url, day_pos, lpos FROM ar", *crawl_ctes(2, BASE)),
    "p7_label_v3_crawl": crawl_label_sql(3),
    "p6_label_v2_crawl": crawl_label_sql(2, 2),
    "c3_many_archives": archive_oracle("SELECT root, topic, url, day_pos, lpos FROM ar"),
    "p4_many_archives": archive_oracle("SELECT root, url, day_pos, lpos FROM ar", 3),
    "p6_label_v2_archives": archive_label_sql(2),
    "p7_label_v3_archives": archive_label_sql(3),
    "l2_first_days": _with(LINKS) + "SELECT page_id, href FROM lk WHERE ord <= 4",
    "l3_nth_item": _with(LINKS) + "SELECT page_id, href FROM lk WHERE ord = 3",
    "l3_nth_of_all": _with(LINKS) + "SELECT page_id, href FROM lk ORDER BY page_id, ord LIMIT 1 OFFSET 100",
    "s8_page_sections": spliced_sql(f"""
SELECT page_id::BIGINT AS section_ord, 0 AS part, NULL::BIGINT AS row_ord, url || ':' AS line FROM dec
UNION ALL SELECT page_id, 1, row_number() OVER (PARTITION BY page_id ORDER BY open_pos), src
  FROM (SELECT page_id, open_pos, {attr('src')} AS src FROM el WHERE tag = 'img') WHERE starts_with(src, 'https')
UNION ALL SELECT page_id, 2, NULL, '' FROM dec"""),
    "p2_crawl_images": _with(dec(https_link), parse_ctes("dec")) + f"""
SELECT url, page_id AS visit, row_number() OVER (PARTITION BY page_id ORDER BY open_pos) AS ord, src AS link
FROM (SELECT dec.url, el.page_id, open_pos, {attr('src')} AS src FROM el JOIN dec USING (page_id) WHERE tag = 'img')
WHERE starts_with(src, 'https')""",
    "a4_revisited_images": _with(dec(https_link), parse_ctes("dec")) + f"""
SELECT url, CASE WHEN page_id % 3 = 1 THEN page_id - 1000000000 ELSE page_id END AS visit,
  row_number() OVER (PARTITION BY page_id ORDER BY open_pos) AS ord,
  CASE WHEN page_id % 3 = 0 THEN replace(src, 'https://s.example/i', 'https://s.example/again') ELSE src END AS link
FROM (SELECT dec.url, el.page_id, open_pos, {attr('src')} AS src FROM el JOIN dec USING (page_id) WHERE tag = 'img')
WHERE starts_with(src, 'https')""",
    "s2_html_files": "SELECT page_id, true AS keyed, length(html) AS chars, sha256(html) AS sha256 FROM pages",
    "s4_url_list": _with(dec(), parse_ctes("dec"), ALL_LINKS) + f"""
SELECT row_number() OVER (ORDER BY page_id, ord) - 1 AS ord, href AS url FROM al
WHERE contains(href, '{LINK_TOPICS[0]}') OR contains(href, '{LINK_TOPICS[1]}')""",
    "p3_label_by_url": sport_sql(
        "SELECT label, page_ord, alt, src, row_number() OVER (PARTITION BY page_ord ORDER BY pos) AS ord FROM pi"),
    "s9_label_sections": sport_sql("""
SELECT 1 AS part, section_ord, page_ord, coalesce(alt, 'None') || ',' || src AS line FROM pi JOIN s USING (label)
UNION ALL SELECT 0, section_ord, NULL, label FROM s UNION ALL SELECT 2, section_ord, NULL, '' FROM s""",
                                   "s AS (SELECT label, min(page_ord) AS section_ord FROM pi GROUP BY label)"),
}
ORACLES["j1_structural_anti"] = ORACLES["h7_not_inside_link"]
