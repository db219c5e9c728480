"""Main text of web pages by composite text density.

A page is read into a list of nodes (implied ends of p, li and table parts, raw script and style, unclosed tags).  Parts
that are never article text (menus, headers, footers, asides, forms, notices, adverts, reader comments, scripts) are cut
off by element name, role, or a word of their class or id (not by a name for the state of a page, as has-sidebar); but a
box, a form or a header around the largest main or article stays open, and on a page without these also a box or form
that holds most of the text, unless it is named for readers' comments or consent.  For every remaining node:

  density = C/T * log_b(C/LC * T/LT),  b = ln(C/(C - LC) * LC + LCbody/Cbody * C + e)

with C characters, T tags, LC characters in links, LT links of its subtree (zero denominators count as 1; plain C/T
where the page has no links).  The density sum of a node is the sum over its children.  The node with the largest sum
lies in the article and is content with all that is in it (with the article or main around it, where there is one).  The
least density on its path up to the body is the threshold: at every level of that path, whatever wrappers there are, the
parts beside the path stay where their density reaches it, and headings without links where what follows them stays.  Beside
that node, lists and boxes that are mostly links go as menus; inside it nothing does.

Reading takes time in proportion to the page: where an element of a name is open is looked up, not searched for.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.textops import annotate, struct

_TAG = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)([^>]*)>|!--(?:.*?-->|.*)|[!?][^>]*>|[!?/a-zA-Z][^>]*\Z)", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_NAME = re.compile(r"[A-Za-z]+")
_HUMP = re.compile(r"[a-z]+|[A-Z][a-z]*")
_QUOTED = re.compile(r"""(?:[^"'>]|"[^"]*"|'[^']*')*>""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
FOREIGN = frozenset("svg math".split())   # may close themselves; without an end tag, only the start tag goes
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
                  "table tbody td tfoot th thead tr ul".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"}}
FENCE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
         "tbody": {"table"}, "option": {"select"}}
NEVER = frozenset("nav footer aside form menu search button select dialog head object audio video canvas map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb "
                  "breadcrumbs sidebar aside footer masthead comment comments disqus respond reply replies cookie cookies consent notice notices "
                  "alert popup modal newsletter subscribe signup login share sharing social related widget pagination pager toolbar".split())
READERS = frozenset("comment comments disqus respond reply replies cookie cookies consent".split())
STATE_PREFIX = frozenset("has no with without not".split())   # has-sidebar, no-sidebar: about a part, not the part itself
STATE_SUFFIX = frozenset("open opened closed active enabled disabled visible hidden collapsed expanded".split())
LISTS = frozenset("ul ol dl div table section".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())


ALWAYS, UNLESS_MAIN, UNLESS_MOST = 3, 2, 1   # never open; open around the main article; open also around most of the text


def _marks(value: str) -> set[str]:
    """Listed words of a class or id, without those in the names of a page's state."""
    out = set()
    for name in value.split():
        parts = [w.lower() for w in _HUMP.findall(name)]
        if len(parts) > 1 and (parts[0] in STATE_PREFIX or (len(parts) == 2 and parts[1] in STATE_SUFFIX)):
            continue
        out.update(w for w in (*map(str.lower, _NAME.findall(name)), *parts) if w in WORDS)
    return out


def _cut_off(name: str, attributes: str, inside_article: bool) -> int:
    """How firmly an element is marked as no part of the article (0: not marked)."""
    if name in NEVER and name != "form":
        return ALWAYS
    mark = UNLESS_MOST if name == "form" else UNLESS_MAIN if name == "header" and not inside_article else 0
    if "=" not in attributes or name in ("body", "html", "main", "article"):
        return mark
    for kind, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'")
        if kind.lower() == "role":
            if value.lower() in ROLES:
                mark = max(mark, UNLESS_MOST if value.lower() == "form" else UNLESS_MAIN)
        elif words := _marks(value):
            mark = max(mark, UNLESS_MAIN if words & READERS else UNLESS_MOST)
    return mark


def _ends(source: str, name: str) -> dict[int, int]:
    """Where each element of this name ends, by the place of its start tag; only those that have an end tag."""
    out, stack = {}, []
    for m in re.finditer(rf"""<(/?){name}(?=[\s/>])(?:[^"'>]|"[^"]*"|'[^']*')*>""", source, re.I):
        if not m[1]:
            if not m[0].endswith("/>"):
                stack.append(m.start())
        elif stack:
            out[stack.pop()] = m.end()
    return out


class Page:
    """Nodes in page order: name, parent, end (first node behind the subtree); texts as (node, text) in page order."""

    def __init__(self, source: str):
        self.name, self.parent, self.end, self.cut = ["html"], [-1], [0], [0]
        self.events: list[tuple[int, str | None]] = []   # (node, text), (node, None) where a block begins or ends
        self.open: dict[str, list[int]] = defaultdict(list)   # of each name, where its open elements are on the stack
        stack, at, n, body = [0], 0, len(source), False
        add = self.events.append
        ends: dict[str, dict[int, int]] = {}
        while at < n:
            m = _TAG.search(source, at)
            if m is None:
                add((stack[-1], source[at:]))
                break
            if m.start() > at:
                add((stack[-1], source[at:m.start()]))
            name, rest, at = m[2], m[3], m.end()
            if not name:
                continue
            name = name.lower()
            if m[1]:
                if self.open[name]:
                    self._close(stack, self.open[name][-1])
                continue
            if rest.count('"') % 2 or rest.count("'") % 2:   # a > inside a quoted value
                whole = _QUOTED.match(source, m.start(3))
                if whole:
                    rest, at = whole[0][:-1], whole.end()
            if name in BLOCK and self.open["p"]:   # no block is open inside a paragraph
                self._close(stack, self.open["p"][-1])
            if name in CLOSED_BY:
                fence = max((self.open[f][-1] for f in FENCE.get(name, ()) if self.open[f]), default=0)
                ended = [self.open[c] for c in CLOSED_BY[name] if self.open[c] and self.open[c][-1] > fence]
                if ended:   # a row ends all of the row before, another part the innermost one
                    self._close(stack, min(o[bisect_right(o, fence)] for o in ended) if name in ("tr", "tbody")
                                else max(o[-1] for o in ended))
            if name in RAW:
                if name in FOREIGN:
                    if name not in ends:
                        ends[name] = _ends(source, name)
                    at = max(at, ends[name].get(m.start(), at))
                    continue
                close = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(source, at)
                at = n if close is None else source.find(">", close.start()) + 1 or n
                continue
            if name == "html" or (name == "body" and body):
                continue
            body = body or name == "body"
            parent = stack[-1]
            node = len(self.name)
            self.name.append(name)
            self.parent.append(parent)
            self.end.append(node + 1)
            self.cut.append(_cut_off(name, rest, bool(self.open["article"] or self.open["main"])))
            if name in BLOCK:
                add((node, None))
            elif name == "br":
                add((parent, " "))
            if name not in VOID and not rest.endswith("/"):
                self.open[name].append(len(stack))
                stack.append(node)
        self._close(stack, 1)
        self.end[0] = len(self.name)
        self._cut()

    def _close(self, stack: list[int], k: int) -> None:
        for node in reversed(stack[k:]):
            self.end[node] = len(self.name)
            if self.name[node] in BLOCK:
                self.events.append((self.parent[node], None))
            self.open[self.name[node]].pop()
        del stack[k:]

    def _cut(self) -> None:
        """``cut`` from marks to whole subtrees; a mark does not count where it would take the article or most of the text."""
        size = len(self.name)
        chars = [0] * size      # of the subtree
        left = [0] * size       # without the marked subtrees in it
        firm = [0] * size       # without those that may not open around most of the text
        for node, text in self.events:
            if text:
                c = sum(map(len, text.split()))
                chars[node] += c
                left[node] += c
                firm[node] += c
        for i in range(size - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
            left[self.parent[i]] += 0 if self.cut[i] else left[i]
            firm[self.parent[i]] += 0 if self.cut[i] > UNLESS_MOST else firm[i]
        mains = [max((i for i in range(size) if self.name[i] == "main"), key=lambda i: chars[i], default=None)]
        within = range(size) if mains[0] is None else range(mains[0], self.end[mains[0]])
        mains.append(max((i for i in within if self.name[i] == "article"), key=lambda i: chars[i], default=None))
        for i in mains:
            while i is not None and i > 0:
                i = self.parent[i]
                if self.cut[i] in (UNLESS_MAIN, UNLESS_MOST):
                    self.cut[i] = 0
        if "body" in self.name:
            i = self.name.index("body")
            while i > 0:
                i = self.parent[i]
                self.cut[i] = 0
        if mains == [None, None]:
            most = left[0]      # what stands outside all marks
            for i in range(1, size):
                if self.cut[i] == UNLESS_MOST and firm[i] > most and 2 * chars[i] > chars[0]:
                    self.cut[i] = 0
                    most = max(most, left[i])
        cut = [False] * size
        for i in range(1, size):
            cut[i] = cut[self.parent[i]] or self.cut[i] > 0
        self.cut = cut

    def measures(self) -> tuple[list[int], list[int], list[int], list[int]]:
        """Characters, tags, link characters and links of every subtree, without what is cut off."""
        size = len(self.name)
        chars, tags, link_chars, links = ([0] * size for _ in range(4))
        linked = [False] * size
        for i in range(1, size):
            linked[i] = linked[self.parent[i]] or self.name[i] == "a"
        for node, text in self.events:
            if text and not self.cut[node]:
                c = sum(map(len, text.split()))
                chars[node] += c
                if linked[node]:
                    link_chars[node] += c
        for i in range(size - 1, 0, -1):
            if not self.cut[i]:
                p = self.parent[i]
                chars[p] += chars[i]
                link_chars[p] += link_chars[i]
                tags[p] += tags[i] + 1
                links[p] += links[i] + (self.name[i] == "a")
        return chars, tags, link_chars, links


def densities(page: Page, body: int, chars, tags, link_chars, links) -> list[float]:
    share = link_chars[body] / max(1, chars[body])
    out = [0.0] * len(chars)
    for i, (c, t, lc, lt) in enumerate(zip(chars, tags, link_chars, links)):
        if c:
            t = t or 1
            plain = c / t
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            inner = c / max(1, lc) * t / max(1, lt)
            out[i] = plain * math.log(inner) / math.log(base) if base > 1 + 1e-9 else plain
    return out


def main_text(source: str) -> str:
    """Blocks of the main text, one per line."""
    if not source:
        return ""
    page = Page(source)
    body = page.name.index("body") if "body" in page.name else 0
    chars, tags, link_chars, links = page.measures()
    density = densities(page, body, chars, tags, link_chars, links)
    size = len(page.name)
    sums = list(density)          # a leaf's sum is its own density
    first = [True] * size
    for i in range(size - 1, 0, -1):
        if not page.cut[i] and page.name[i] not in VOID:
            p = page.parent[i]
            sums[p] = density[i] + (0.0 if first[p] else sums[p])
            first[p] = False
    inside = range(body, page.end[body])
    best = max(inside, key=lambda i: (not page.cut[i], sums[i], -i))
    threshold, at, path = density[best], best, [best]
    while at != body:
        at = page.parent[at]
        threshold = min(threshold, density[at])
        path.append(at)
    whole = next((i for kind in ("article", "main") for i in reversed(path) if page.name[i] == kind), best)
    on_path = set(path[path.index(whole) + 1:])   # above what is content as a whole
    keep = [False] * size
    beside = defaultdict(list)
    for i in inside:
        if i != body and page.parent[i] in on_path and not page.cut[i] and page.name[i] not in VOID:
            beside[page.parent[i]].append(i)
    for parts in beside.values():
        follows = False
        for i in reversed(parts):
            keep[i] = i in on_path or i == whole or density[i] >= threshold \
                or (follows and page.name[i] in HEADINGS and not links[i])
            follows = keep[i] if chars[i] else follows
    keep[body] = True   # text that stands in the body itself
    for i in inside:
        if i != body and page.parent[i] not in on_path:
            keep[i] = keep[page.parent[i]]
        if keep[i] and i != body and (page.cut[i] or (page.name[i] in LISTS and links[i] > 1 and 2 * link_chars[i] > chars[i]
                                                       and not i <= best < page.end[i] and not best < i < page.end[best])):
            keep[i] = False
    blocks, parts = [], []
    for node, text in [*page.events, (body, None)]:
        if text is None:
            block = " ".join(html.unescape("".join(parts)).split()) if parts else ""
            if block:
                blocks.append(block)
            parts = []
        elif keep[node]:
            parts.append(text)
    return "\n".join(blocks)


def extract(pages: DataFrame, html_col: str = "html", into: str = "main") -> DataFrame:
    """``pages`` plus a struct (text, n_chars).

    A null or empty page has an empty text.  Repeated pages are extracted each; an empty table gives an empty result; an
    input column named like ``into`` is replaced, other columns pass unchanged.  Pages are read whole, whatever their size.
    """
    def fn(b: pa.RecordBatch) -> pa.StructArray:
        texts = [main_text(x.as_py() or "") for x in b.column(html_col)]
        return struct(text=pa.array(texts, pa.string()), n_chars=pa.array([len(t) for t in texts], pa.int64()))
    return annotate(pages, fn, into, "text string, n_chars long")


def contract(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "main.text", "main.n_chars")
