"""Independent check: a small tree builder on the standard library parser.

Mirrors the tree building the reference relies on: void elements have no
content, an end tag closes the most recent open element of its tag (and
everything opened after it), an end tag with no open element is ignored,
script/style/comment text is not element text. Used only by the tests.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "keygen",
        "link", "menuitem", "meta", "param", "source", "track", "wbr",
        "basefont", "bgsound", "command", "frame", "image", "isindex",
        "nextid", "spacer"}


class Node:
    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children = []

    def iter(self):
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.iter()

    def text(self):
        out = []
        for c in self.children:
            out.append(c.text() if isinstance(c, Node) else c)
        return "".join(out)

    def find_all(self, tags):
        return [n for n in self.iter() if n.tag in tags]

    def find(self, tag=None, id=None):
        for n in self.iter():
            if (tag is None or n.tag == tag) and (id is None or n.attrs.get("id") == id):
                return n
        return None

    def has_ancestor(self, tag):
        p = self.parent
        while p is not None:
            if p.tag == tag:
                return True
            p = p.parent
        return False


class Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]", {}, None)
        self.stack = [self.root]
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        d = {}
        for k, v in attrs:
            d[k] = "" if v is None else v
        n = Node(tag, d, self.stack[-1])
        self.stack[-1].children.append(n)
        if tag in ("script", "style"):
            self.skip += 1
        if tag not in VOID:
            self.stack.append(n)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        if not self.skip:
            self.stack[-1].children.append(data)


def parse(html: str) -> Node:
    b = Builder()
    b.feed(html)
    b.close()
    return b.root


STOP_ENGLISH = set("a an and are as at be but by for if in into is it no not of on or such "
                   "that the their then there these they this to was will with".split())
STOP_CUSTOM = set("you from have can been were has your its than".split())
WS = re.compile(r"[\t\n\x0b\x0c\r\x1c-\x1f   -  -    　]+")


def analyze_words(text: str) -> list[str]:
    out = []
    for t in WS.split(text):
        if not t:
            continue
        t = t.lower()
        if t in STOP_ENGLISH or t in STOP_CUSTOM:
            continue
        t = re.sub(r"['’].*$", "", t, flags=re.S)
        if t:
            out.append(t)
    return out


def analyze_letters(text: str) -> list[str]:
    return [t for t in re.findall(r"[^\W\d_]+", text.lower()) if t not in STOP_ENGLISH]


def top_terms(lines, analyzer=analyze_words, k=3):
    counts = {}
    for line in lines:
        for t in set(analyzer(line)):
            counts[t] = counts.get(t, 0) + 1
    ranked = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0].encode("utf-8")))
    return [t for t, _ in ranked[:k]]
