"""Term counts of nested lines without writing the lines out.

The lines of an article are elements, and paragraphs whose end tags are left out nest: the
text of each holds the texts of all that follow. Written out they grow with the square of
the page. Here the page's text is read once, token by token, with a stack of the lines that
are open. A word gives its terms to all open lines at once: those that opened after the
term's last occurrence have not counted it yet, and as the stack is sorted by where lines
open, a binary search tells how many they are. Only a word that a line cuts in two, at its
start or end, is told apart for that line. A line in which no other opens is counted by itself.

As for where elements end, this is sequential within a page, so it runs over Arrow
batches of pages; token texts, lower-casing and all later work stay native.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from pagelens.functions import text as X
from pagelens.operators.stack import pylists

# the apostrophe cut (X6) as the native expression does it: not across a line break
_APOSTROPHE = re.compile("['’][^\n\r\u0085  ]*(?=[\n\r\u0085  ]?\\Z)")


class Analyzer:
    """Terms of the words of a text in which every run of separators is one blank."""

    def __init__(self, analyzer: str):
        self.stop = frozenset(X.STOP_ENGLISH if analyzer == "letters" else X.STOP_ENGLISH + X.STOP_CUSTOM)
        self.cuts = analyzer == "words"
        self.known: dict[str, tuple[str, ...]] = {}

    def __call__(self, word: str) -> tuple[str, ...]:
        terms = self.known.get(word)
        if terms is None:
            n = X.MAX_TOKEN_LENGTH
            pieces = [word] if len(word) <= n else [word[i:i + n] for i in range(0, len(word), n)]
            pieces = [p for p in pieces if p and p not in self.stop]
            if self.cuts and ("'" in word or "’" in word):
                pieces = [p for p in (_APOSTROPHE.sub("", p) for p in pieces) if p]
            terms = tuple(dict.fromkeys(pieces))
            if len(self.known) < 200_000 and len(word) <= n:
                self.known[word] = terms
        return terms


class Sweep:
    """The lines of one page in which each term occurs."""

    def __init__(self, terms: Analyzer):
        self.terms = terms
        self.counts: dict[str, int] = {}
        self.starts: list[int] = []            # where the open lines start, in falling age
        self.ids: list[int] = []
        self.last: dict[str, int] = {}         # start of the last word that gave a term to all open lines
        self.own: dict[str, list[tuple[int, int]]] = {}  # lines (start, id) that got a term by themselves
        self.got: set[tuple[str, int]] = set()

    def to_all(self, word: str, start: int) -> None:
        """A word that begins at `start` and ended: its terms go to the lines that were open by then."""
        starts = self.starts
        upto = bisect_right(starts, start)
        if upto:
            for t in self.terms(word):
                before = self.last.get(t, -1)
                n = upto - (bisect_right(starts, before) if before >= 0 else 0)
                if t in self.own:
                    n -= sum(before < s <= start and self.is_open(s, i) for s, i in self.own[t])
                    self.own[t] = [x for x in self.own[t] if x[0] > start]
                self.counts[t] = self.counts.get(t, 0) + n
                self.last[t] = start
        for k in range(len(starts) - 1, upto - 1, -1):  # lines that opened inside the word
            self.to_one(self.ids[k], starts[k], word[starts[k] - start:])

    def is_open(self, start: int, line: int) -> bool:
        k = bisect_right(self.starts, start) - 1
        while k >= 0 and self.starts[k] == start and self.ids[k] > line:
            k -= 1
        return k >= 0 and self.ids[k] == line

    def to_one(self, line: int, start: int, word: str) -> None:
        for t in self.terms(word):
            if self.last.get(t, -1) < start and (t, line) not in self.got:
                self.counts[t] = self.counts.get(t, 0) + 1
                self.own.setdefault(t, []).append((start, line))
                self.got.add((t, line))

    def run(self, texts: list[str], ends: list[int | None], opens: list[int]) -> None:
        """Texts of a page's tokens, where elements end, and the tokens that open lines, in order."""
        at, start, word = 0, 0, ""   # places read, where the unfinished word starts, and the word
        closes: list[int] = []       # where the open lines end
        i, k, n = 0, 0, len(texts)
        while i < n:
            if not closes:  # nothing is open: on to the next line
                if k == len(opens):
                    break
                i = max(i, opens[k])
                end = ends[i]
                if opens[k] == i and end is not None and end > i + 1 and (k + 1 == len(opens) or opens[k + 1] >= end):
                    self.alone("".join(texts[i + 1:end]))  # no other line opens in this one
                    k, i = k + 1, end
                    continue
            while closes and closes[-1] == i:
                closes.pop()
                s, line = self.starts.pop(), self.ids.pop()
                if word:
                    self.to_one(line, s, word if s <= start else word[s - start:])
                if not closes:
                    word = ""
            if k < len(opens) and opens[k] == i:
                if ends[i] is not None and ends[i] > i + 1:
                    if not closes:
                        start = at
                    self.starts.append(at)
                    self.ids.append(k)
                    closes.append(ends[i])
                k += 1
            elif closes and texts[i]:
                first, *rest = texts[i].split(" ")
                if not word:
                    start = at
                word += first
                at += len(first)
                for piece in rest:
                    if word:
                        self.to_all(word, start)
                    at += 1
                    word, start = piece, at
                    at += len(piece)
            i += 1
        while self.starts:
            s, line = self.starts.pop(), self.ids.pop()
            if word:
                self.to_one(line, s, word if s <= start else word[s - start:])

    def alone(self, text: str) -> None:
        """A line of its own."""
        for t in {t for w in text.split(" ") for t in self.terms(w)}:
            self.counts[t] = self.counts.get(t, 0) + 1


def blanked(text: Column, analyzer: str) -> Column:
    """Lower-case text with one blank for each run of what separates words."""
    other = r"\P{L}+" if analyzer == "letters" else X.WHITESPACE_RE
    return F.regexp_replace(X.lower(text), other, " ")


def line_term_counts(texts: Column, ends: Column, opens: Column, alone: Column, analyzer: str = "words") -> Column:
    """ARRAY<STRUCT<term, n>>: in how many lines of a page each term occurs (A1).

    ``texts`` are the decoded texts of the page's tokens ('' for tags), ``ends`` where its
    elements end, ``opens`` the tokens that open a line, in order, and ``alone`` lines
    that are no elements. Time and space grow with the page, however lines nest.
    """

    @arrow_udf("array<struct<term: string, n: bigint>>")
    def run(t: pa.Array, e: pa.Array, o: pa.Array, a: pa.Array) -> pa.Array:
        terms = Analyzer(analyzer)
        sizes, names, counts = [0], [], []
        for texts, ends, opens, lines in zip(*map(pylists, (t, e, o, a))):
            page = Sweep(terms)
            page.run(texts, ends, opens)
            for line in lines:
                page.alone(line)
            names += page.counts.keys()
            counts += page.counts.values()
            sizes.append(len(names))
        rows = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["term", "n"])
        return pa.ListArray.from_arrays(pa.array(np.array(sizes, dtype=np.int32)), rows)

    return run(F.transform(texts, lambda x: blanked(x, analyzer)), ends, opens,
               F.transform(alone, lambda x: blanked(x, analyzer)))


# The functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
