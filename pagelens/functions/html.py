"""HTML as Catalyst string expressions.

A page is cut into tokens with one regular expression (tags and text runs),
classified by a few more, and attributes are read from the tag token with a
left-to-right walk that never looks inside quoted values. Character
references are decoded per token, after tokenising, by native expressions:
no row leaves the JVM.
"""

from __future__ import annotations

import html as _stdlib_html
import html.entities as _entities
import re as _re

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelens.functions.literals import long_string_map_sql, packed_map_sql, sql_string

# --- fixed values -----------------------------------------------------------
# Script and style bodies and comments carry no text and no tags; the elements
# themselves stay. A body that is never closed reaches to the end of the page.
_RAW_OPEN = r"""(?=[\s/>])[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>"""
CLEAN_RE = (r"(?is)(<script" + _RAW_OPEN + r").*?(</script\s*>|\z)|(<style" + _RAW_OPEN
            + r").*?(</style\s*>|\z)|<!--.*?-->")
# A tag (a '>' inside a quoted value does not end it), a lone '<' that starts
# no tag, or a run of text. Written unrolled: Java's regex engine recurses per
# repetition of an alternation and would overflow on long tags otherwise. A tag
# with a quote that is never closed is no tag: it stays text, as for the parser.
TAG_RE = r"""<[a-zA-Z/!?][^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>"""
TOK_RE = r"(?s)" + TAG_RE + r"|<|[^<]+"
# Elements that never have content (the tree builder closes them at once).
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input",
             "keygen", "link", "menuitem", "meta", "param", "source", "track",
             "wbr", "basefont", "bgsound", "command", "frame", "image",
             "isindex", "nextid", "spacer"]
# Named references decoded natively, in this order; '&amp;' last so that the
# replacement is single-pass ('&amp;lt;' gives '&lt;').
FAST_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                 ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&copy;", "©"),
                 ("&middot;", "·"), ("&amp;", "&")]
# Any reference that is not one of the above (also legacy ones without ';').
RARE_ENTITY_RE = (r"&(?!(?:lt|gt|quot|#39|apos|nbsp|copy|middot|amp);)"
                  r"(?:#[0-9]|#[xX][0-9a-fA-F]|[^\t\n\f <&#;])")
# ---------------------------------------------------------------------------

_TAGNAME_RE = r"^</?([a-zA-Z][^\s/>]*)"
# One attribute: name, optional '=' and a quoted or bare value.
_ATTR = r"""[^\s/>="'][^\s/=>]*(?:\s*=+\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*))?"""
_VALUE = r"""(?:\s*=+\s*("[^"]*"|'[^']*'|[^\s>"'][^\s>]*))?"""


def clean_html(html: Column) -> Column:
    """Drop script/style bodies and comments (they hold no text or tags)."""
    return F.regexp_replace(html, CLEAN_RE, "$1$2$3$4")


def token_array(html: Column) -> Column:
    """All tokens of a page, in document order, as ARRAY<STRING>."""
    return F.regexp_extract_all(html, F.lit(TOK_RE), 0)


def token_kind(tok: Column) -> Column:
    """'open', 'close', 'text' or 'other' (doctype, processing instruction)."""
    return (F.when(tok.rlike(r"^<[a-zA-Z]"), F.lit("open"))
             .when(tok.rlike(r"^</[a-zA-Z]"), F.lit("close"))
             .when(~tok.startswith("<") | (tok == "<"), F.lit("text"))
             .otherwise(F.lit("other")))


def tag_name(tok: Column) -> Column:
    """Lower-cased tag name of a tag token, '' for text."""
    return F.lower(F.regexp_extract(tok, _TAGNAME_RE, 1))


def tag_sql(tok: str) -> str:
    return f"lower(regexp_extract({tok}, {sql_string(_TAGNAME_RE)}, 1))"


TOKENS_SQL = f"regexp_extract_all(h, {sql_string(TOK_RE)}, 0)"


def marks_sql(tokens: str) -> str:
    """SQL of what each token does to the stack of open elements: the tag name
    opens one, '/' and the name closes one, '' is an element without content,
    null neither."""
    tag = tag_sql("_t")
    void = ", ".join(sql_string(v) for v in VOID_TAGS)
    opens = f"CASE WHEN endswith(_t, '/>') OR {tag} IN ({void}) THEN '' ELSE {tag} END"
    return (f"transform({tokens}, _t -> CASE WHEN _t RLIKE '^<[a-zA-Z]' THEN {opens} "
            f"WHEN _t RLIKE '^</[a-zA-Z]' THEN concat('/', {tag}) END)")


def text_sql(tokens: str) -> str:
    """SQL of the decoded text of each token, '' for tags."""
    return f"transform({tokens}, _t -> CASE WHEN NOT startswith(_t, '<') OR _t = '<' THEN {decode_sql('_t')} ELSE '' END)"


def is_self_closing(tok: Column) -> Column:
    return tok.endswith("/>")


def _decode_common(s: Column) -> Column:
    out = s
    for ent, ch in FAST_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


_PIECE_RE = r"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[^\t\n\f <&#;]{1,32};?|[^&]+|&"
# Tables built from the standard library: all named references of HTML 5, those
# that also count without ';' (the longest that fits), and the replacements the
# parser uses for invalid numeric ones.
_NAMED = {f"&{k}": v for k, v in _entities.html5.items()}
_LEGACY = sorted((k for k in _entities.html5 if not k.endswith(";")), key=lambda k: (-len(k), k))
_LEGACY_RE = "^&(?:" + "|".join(_LEGACY) + ")"


def _decode_common_sql(x: str) -> str:
    out = x
    for ent, ch in FAST_ENTITIES:
        out = f"replace({out}, {sql_string(ent)}, {sql_string(ch)})"
    return out


def _numeric_ref_sql(p: str) -> str:
    """A numeric reference -> its character, with the parser's replacements
    for invalid code points (``_n`` is bound once by a one-element array)."""
    # leading zeros say nothing; with more digits than that the number is out of range
    digits = f"regexp_extract({p}, {sql_string(r'^&#[xX]?0*([0-9a-fA-F]*)')}, 1)"
    n = (f"CASE WHEN {digits} = '' THEN 0L WHEN length({digits}) > 8 THEN 1114112L "
         f"WHEN {p} RLIKE '^&#[xX]' THEN CAST(conv({digits}, 16, 10) AS BIGINT) "
         f"ELSE CAST({digits} AS BIGINT) END")
    fixed = f"try_element_at({_charref_map_sql()}, _n)"
    invalid = ("(_n BETWEEN 1 AND 8 OR _n = 11 OR _n BETWEEN 14 AND 31 OR _n BETWEEN 127 AND 159"
               " OR _n BETWEEN 64976 AND 65007 OR pmod(_n, 65536) >= 65534)")
    body = (f"CASE WHEN {fixed} IS NOT NULL THEN {fixed} "
            f"WHEN _n BETWEEN 55296 AND 57343 OR _n > 1114111 THEN {sql_string(chr(0xFFFD))} "
            f"WHEN {invalid} THEN '' "
            f"ELSE decode(unhex(lpad(hex(_n), 8, '0')), 'UTF-32') END")
    return f"element_at(transform(array({n}), _n -> {body}), 1)"


def decode_sql(x: str) -> str:
    """SQL of H8 for the SQL expression ``x`` (a column name or a lambda
    variable): common names replaced natively in a single pass; a value with
    any other reference is split into references and plain runs and each
    reference is decoded by rule (numeric to its code point, named from the
    HTML 5 table, else the longest legacy name it begins with). Deterministic
    Catalyst expressions only."""
    named = f"try_element_at({_named_map_sql()}, _p)"
    legacy = f"regexp_extract(_p, {sql_string(_LEGACY_RE)}, 0)"
    one = (f"CASE WHEN NOT startswith(_p, '&') OR _p = '&' THEN _p WHEN _p RLIKE '^&#' THEN {_numeric_ref_sql('_p')} "
           f"ELSE coalesce({named}, CASE WHEN {legacy} <> '' THEN "
           f"concat(try_element_at({_named_map_sql()}, {legacy}), substring(_p, length({legacy}) + 1)) END, _p) END")
    rare = f"array_join(transform(regexp_extract_all({x}, {sql_string(_PIECE_RE)}, 0), _p -> {one}), '')"
    return (f"CASE WHEN {x} RLIKE {sql_string(RARE_ENTITY_RE)} THEN {rare} "
            f"WHEN instr({x}, '&') > 0 THEN {_decode_common_sql(x)} ELSE {x} END")


def decode_entities(col: str) -> Column:
    """Decode character references of the text column ``col`` (H8)."""
    return F.expr(decode_sql(col))


def _named_map_sql() -> str:
    return packed_map_sql(_NAMED)


def _charref_map_sql() -> str:
    return long_string_map_sql(_stdlib_html._invalid_charrefs)


def _walk(name: str) -> str:
    # last occurrence wins (greedy walk over the attributes before it)
    return (r"(?s)^<[a-zA-Z][^\s/>]*(?:[\s/]+" + _ATTR + r")*[\s/]+(?i:"
            + _re.escape(name) + r")" + _VALUE + r"(?=[\s/>])")


_DQUOTED = r'(?s)^".*"$'
_SQUOTED = r"(?s)^'.*'$"


def attr_sql(tok: str, name: str) -> str:
    """SQL of H5 for the start-tag column ``tok``."""
    pat = sql_string(_walk(name))
    raw = f"regexp_extract({tok}, {pat}, 1)"
    quoted = f"({raw} RLIKE {sql_string(_DQUOTED)} OR {raw} RLIKE {sql_string(_SQUOTED)})"
    unq = f"CASE WHEN {quoted} THEN substring({raw}, 2, length({raw}) - 2) ELSE {raw} END"
    return (f"CASE WHEN {tok} RLIKE {pat} THEN "
            f"element_at(transform(array({unq}), _v -> {decode_sql('_v')}), 1) END")


def attr(tok: str, name: str) -> Column:
    """Attribute ``name`` of the start-tag column ``tok``: null if absent, ''
    if it has no value, quotes stripped, references decoded (H5)."""
    return F.expr(attr_sql(tok, name))
