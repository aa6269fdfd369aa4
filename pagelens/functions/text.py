"""Text analysis as array expressions (tokenizers, filters, analyzers).

An analyzer maps a text column to ARRAY<STRING> of terms; everything is a
Catalyst expression (split / regexp / filter / transform), so it runs inside
whole-stage code generation next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelens.functions.literals import string_array

# --- fixed values -----------------------------------------------------------
# Built-in English stop list of the analyzers (33 words).
STOP_ENGLISH = ["a", "an", "and", "are", "as", "at", "be", "but", "by", "for",
                "if", "in", "into", "is", "it", "no", "not", "of", "on", "or",
                "such", "that", "the", "their", "then", "there", "these",
                "they", "this", "to", "was", "will", "with"]
# Extra stop words of the second analyzer.
STOP_CUSTOM = ["you", "from", "have", "can", "been", "were", "has", "your",
               "its", "than"]
# Characters the whitespace tokenizer splits on (Java's isWhitespace set).
WHITESPACE_CLASS = (r"\t\n\x0B\f\r\x1C-\x1F \x{1680}\x{2000}-\x{2006}"
                    r"\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}")
# Both tokenizers cut a longer token into pieces of at most this length.
MAX_TOKEN_LENGTH = 255
# The apostrophe filter cuts a term at the first of these.
APOSTROPHE_RE = "['’].*$"
# Longest exact copy a keyword sub-field keeps.
KEYWORD_IGNORE_ABOVE = 256
# ---------------------------------------------------------------------------
WHITESPACE_RE = f"[{WHITESPACE_CLASS}]+"
# a token: a run of non-whitespace, cut every MAX_TOKEN_LENGTH characters
SPACE_TOKEN_RE = f"[^{WHITESPACE_CLASS}]{{1,{MAX_TOKEN_LENGTH}}}"
LETTER_TOKEN_RE = f"\\p{{L}}{{1,{MAX_TOKEN_LENGTH}}}"


def lower(text: Column) -> Column:
    """Lower-case character by character, as the index's filters do: the two letters
    whose lower case depends on their surroundings or grows are mapped first."""
    special = text.contains("\u0130") | text.contains("\u03a3")
    return F.when(special, F.lower(F.translate(text, "\u0130\u03a3", "i\u03c3"))).otherwise(F.lower(text))


def letter_tokens(text: Column) -> Column:
    """Runs of letters, lower-cased."""
    return F.regexp_extract_all(lower(text), F.lit(LETTER_TOKEN_RE), 0)


def space_tokens(text: Column) -> Column:
    """Split on whitespace only; punctuation stays in the token."""
    return F.regexp_extract_all(text, F.lit(SPACE_TOKEN_RE), 0)


def lowercase(terms: Column) -> Column:
    """Lower-case every term."""
    return F.transform(terms, lower)


def stop_filter(terms: Column, words: list[str]) -> Column:
    """Remove terms in a fixed stop list (X4/X5, J7 for a literal list)."""
    stop = string_array(words)
    return F.filter(terms, lambda t: ~F.array_contains(stop, t))


def apostrophe(terms: Column) -> Column:
    """Cut each term at its first apostrophe; drop terms left empty."""
    cut = F.transform(terms, lambda t: F.regexp_replace(t, APOSTROPHE_RE, ""))
    return F.filter(cut, lambda t: t != "")


def analyze(text: Column, analyzer: str = "words") -> Column:
    """Terms of a text.

    ``letters`` (X7): letter runs, lower-cased, English stop words removed.
    ``words``   (X8): whitespace split, lower-cased, English and extra stop
                      words removed, then cut at apostrophes (the stop filter
                      runs first, so "you're" passes and becomes "you").
    """
    if analyzer == "letters":
        return stop_filter(letter_tokens(text), STOP_ENGLISH)
    if analyzer == "words":
        terms = lowercase(space_tokens(text))
        terms = stop_filter(terms, STOP_ENGLISH + STOP_CUSTOM)
        return apostrophe(terms)
    raise ValueError(f"unknown analyzer {analyzer!r}")


def distinct_terms(text: Column, analyzer: str = "words") -> Column:
    """The distinct terms of one text, the same set as
    ``array_distinct(analyze(text, analyzer))`` but built from native array
    functions: ``array_except`` removes stop words and duplicates in one
    hash pass, leaving a single lambda (the apostrophe cut) over distinct
    tokens only. ``lower`` works character by character, so the whole text may be
    lower-cased before it is cut.
    """
    if analyzer == "letters":
        toks = letter_tokens(text)
        return F.array_except(toks, string_array(STOP_ENGLISH))
    if analyzer == "words":
        toks = space_tokens(lower(text))
        kept = F.array_except(toks, string_array(STOP_ENGLISH + STOP_CUSTOM + [""]))
        cut = F.transform(kept, lambda t: F.regexp_replace(t, APOSTROPHE_RE, ""))
        # the lambda and the second de-duplication only where a cut can happen
        return F.when(text.rlike("['’]"), F.array_remove(F.array_distinct(cut), "")).otherwise(kept)
    raise ValueError(f"unknown analyzer {analyzer!r}")


def list_join(arr: Column, sep: str = ", ") -> Column:
    """Join a list for output (X9 / S11 joined form)."""
    return F.array_join(arr, sep)


def _quoted(x: Column) -> Column:
    """A string as Python prints it: double quotes only around a text that has an
    apostrophe and no double quote; backslash and line breaks escaped."""
    s = x
    for plain, escaped in [("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")]:
        s = F.replace(s, F.lit(plain), F.lit(escaped))
    double = x.contains("'") & ~x.contains('"')
    return F.when(double, F.concat(F.lit('"'), s, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(s, F.lit("'"), F.lit("\\'")), F.lit("'")))


def list_literal(arr: Column) -> Column:
    """Render a list as a Python-style literal: ['a', "it's"] (S11 list form)."""
    return F.concat(F.lit("["), F.array_join(F.transform(arr, _quoted), ", "), F.lit("]"))


def to_string(x: Column) -> Column:
    """null prints as None."""
    return F.coalesce(x.cast("string"), F.lit("None"))


def json_document(content: Column) -> Column:
    """One bulk document line {"content": ...} (X11)."""
    return F.to_json(F.struct(content.alias("content")))


def keyword_copy(text: Column) -> Column:
    """Exact copy of a line when short enough, else null."""
    return F.when(F.length(text) <= KEYWORD_IGNORE_ABOVE, text)
