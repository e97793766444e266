"""Main text of web pages by tag-path ratios.

Every run of text belongs to a block, and every block has a root-to-leaf path of block elements with
their classes. Paths are numbered as they appear, each by its parent's number, so deep pages stay small. For
each path of a page the text length, punctuation and link text of its blocks are summed; ratios are those
sums by number of blocks. Length, punctuation and links are fused to one score, smoothed along the page
over neighbouring blocks and averaged by path, times PRIOR inside an article or main element. Paths whose
score reaches THRESHOLD of the mean of the page's characters are content. Paths through elements that hold menus, headers, footers,
sidebars, notices, adverts, forms or comments take no part.

Content paths select nodes: the article or main elements around them, whose other blocks go with them
(in main, not those that are mostly links); and, outside such elements, the parent of most content text,
whose headings, paragraphs, quotations, lists and tables go with it.

Defined results: null and empty pages, and pages without text, give the empty text. Character references
are decoded; white space in a block is one space; blocks are joined by one line feed in page order.
Unclosed elements end where the next block of their kind begins or an outer element closes; a link has an
href and ends with its block at the latest. A "<" that starts no tag is text; a comment or script without an end
hides the rest. Repeated rows are extracted each for itself. Time and memory are linear in the page's length.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from . import base

#: Share of the mean score from which a path is content; factor of paths inside an article or main element.
THRESHOLD, PRIOR = 0.5, 10.0
#: Smoothing weights of a block and its neighbours at distance 1 and 2.
SMOOTH = (0.6, 0.15, 0.05)
#: Share of link text from which a path is mostly links; what is left of the score of nothing but links.
LINKS, LINKED = 0.5, 0.05

NAME = re.compile(r"[A-Za-z][^\s/>]*")
#: What matters on the way to the end of a tag: a quoted value, or the end.
VALUE = re.compile(r"=\s*([\"'])|>")
ATTRIBUTE = re.compile(r"(?<![A-Za-z-])([A-Za-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
HREF = re.compile(r"(?:^|\s)href\s*=", re.I)
HIDE = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true")
PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？…—–-]")

#: Elements by what they do (fixed values of HTML).
RAW = frozenset(("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
INLINE = frozenset(("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"))
HIDDEN = frozenset(("head", "nav", "footer", "aside", "form", "button", "select", "option", "noscript", "template", "svg", "math", "object", "audio", "video", "canvas", "dialog", "menu", "fieldset"))
CONTAINERS = ("article", "main")
PLAIN = frozenset(("html", "body", "article", "main"))
#: A start tag that ends an open element of these kinds, unless a SCOPE element was opened since.
ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BREAKS_P = frozenset(("address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul"))
SCOPE = ("table", "ul", "ol", "dl", "div", "section", *CONTAINERS)
BESIDE = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "ul", "ol", "dl", "table", "figure", "p"))
#: Words of a class, id or role that mark a part as not the article.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar sidenav aside footer masthead header topbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing social related recommended comment comments commentlist disqus respond reply replies discussion widget pagination pager copyright disclaimer toolbar search contentinfo complementary dialog".split()
)


def _noise(tag: str, named: list[tuple[str, str]], attributes: str) -> bool:
    if tag in HIDDEN:
        return True
    if not attributes or tag in PLAIN:
        return False
    return any(not NOISE.isdisjoint(re.split(r"[^a-z]+", v.lower())) for _, v in named) or bool(HIDE.search(attributes))


class Paths:
    """The root-to-leaf paths of a page, numbered parents first; 0 is the root."""

    def __init__(self):
        self.known: dict[tuple[int, str, bool], int] = {}
        self.parent, self.tag = [0], [""]
        self.quiet = [False]  # holds no article text
        self.loud = [True]  # no noise above but headers
        self.header = [False]  # inside a header
        self.box = [0]  # the innermost article or main element, itself included

    def child(self, of: int, tag: str, attributes: str) -> int:
        named = [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)] if attributes else []
        noise = _noise(tag, [x for x in named if x[0] in ("class", "id", "role")], attributes)
        label = tag + "".join(f".{v}" for k, v in named if k in ("class", "id"))
        key = (of, label, noise)
        if key not in self.known:
            n = self.known[key] = len(self.parent)
            loud = self.loud[of] and not noise
            self.parent.append(of)
            self.tag.append(tag)
            self.loud.append(loud)
            self.header.append(self.header[of] or tag == "header")
            self.box.append(n if tag in CONTAINERS else self.box[of])
            # the headline in the header of an article is text
            self.quiet.append((self.quiet[of] or noise or tag == "header") and not (tag == "h1" and self.header[of] and self.box[of] and loud))
        return self.known[key]


class Page:
    """Paths and blocks (path, text, characters of links) of a page, in page order."""

    def __init__(self, html: str):
        self.paths, self.blocks = Paths(), []
        self._stack = [0]
        self._at: dict[str, list[int]] = defaultdict(list)  # places in the stack by tag
        self._parts: list[str] = []
        self._links, self._in_link = 0, False
        self._read(html)
        self._flush()

    def _flush(self) -> None:
        text = " ".join(unescape("".join(self._parts)).split())
        if text:
            self.blocks.append((self._stack[-1], text, self._links))
        self._parts.clear()
        self._links, self._in_link = 0, False

    def _add(self, text: str) -> None:
        self._parts.append(text)
        if self._in_link:
            self._links += len(text)

    def _close(self, place: int) -> None:
        for p in self._stack[place:]:
            self._at[self.paths.tag[p]].pop()
        del self._stack[place:]

    def _last(self, tags: tuple[str, ...]) -> int:
        return max([self._at[t][-1] for t in tags if self._at[t]], default=-1)

    def _start(self, tag: str, attributes: str) -> None:
        self._flush()
        for kinds in (ENDS.get(tag, ()), ("p",) if tag in BREAKS_P else ()):
            if (place := self._last(kinds)) > self._last(SCOPE):
                self._close(place)
        if not attributes.endswith("/") or tag in ("p", "div", "article"):
            self._at[tag].append(len(self._stack))
            self._stack.append(self.paths.child(self._stack[-1], tag, attributes))

    def _read(self, html: str) -> None:
        last = {c: html.rfind(c) for c in "\"'>"}
        at = 0
        while (i := html.find("<", at)) >= 0:
            if i > at:
                self._add(html[at:i])
            at = i
            if html.startswith("<!--", i):
                at = html.find("-->", i + 2) + 3
                if at < i:
                    return
                continue
            if html.startswith("<![CDATA[", i):
                end = html.find("]]>", i)
                self._add(html[i + 9 : end if end >= 0 else len(html)].replace("&", "&amp;"))
                if end < 0:
                    return
                at = end + 3
                continue
            ends = html.startswith("/", i + 1)
            m = NAME.match(html, i + 1 + ends)
            if not m:
                if (ends or html[i + 1 : i + 2] in ("!", "?")) and last[">"] > i:
                    at = html.find(">", i) + 1  # a declaration or a broken end tag
                else:
                    self._add("<")
                    at = i + 1
                continue
            if last[">"] < i:
                break
            end = m.end()
            while (v := VALUE.search(html, end)) and v[1] and last[v[1]] >= v.end():
                end = html.find(v[1], v.end()) + 1
            end = v.start() if v and not v[1] else html.find(">", end)
            if end < 0:
                break
            at = self._tag(html, m[0].lower(), ends, html[m.end() : end], end + 1)
            if at < 0:
                return
        self._add(html[at:])

    def _tag(self, html: str, tag: str, ends: bool, attributes: str, at: int) -> int:
        """Where to go on; -1 if nothing follows."""
        if tag == "a":
            self._in_link = not ends and bool(HREF.search(attributes))
        elif tag in ("br", "wbr"):
            self._add(" " if tag == "br" else "")
        elif tag in RAW and not ends:  # nothing but the end tag counts; none of these elements holds article text
            m = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
            return (html.find(">", m.start()) + 1 or -1) if m else -1
        elif tag in INLINE:
            pass
        elif tag in VOID:
            self._flush()
        elif ends:
            self._flush()
            if self._at[tag]:
                self._close(self._at[tag][-1])
        else:
            self._start(tag, attributes)
        return at


def path_scores(page: Page) -> tuple[dict[int, float], set[int], float]:
    """The score of each path that may be content, the paths that are mostly links, and the mean score of a character."""
    found = [b for b in page.blocks if not page.paths.quiet[b[0]]]
    sums: dict[int, list[int]] = defaultdict(lambda: [0, 0, 0, 0])
    for path, text, links in found:
        s = sums[path]
        s[0] += 1
        s[1] += len(text)
        s[2] += len(PUNCTUATION.findall(text))
        s[3] += links
    fused = {p: (chars / n) * (1 + punctuation / n) * max(LINKED, 1 - links / chars) for p, (n, chars, punctuation, links) in sums.items()}
    along = [fused[b[0]] for b in found]
    n = len(along)
    smooth = [sum(SMOOTH[abs(d)] * along[i + d] for d in range(-2, 3) if 0 <= i + d < n) for i in range(n)]
    total: dict[int, float] = defaultdict(float)
    for b, s in zip(found, smooth, strict=True):
        total[b[0]] += s * (PRIOR if page.paths.box[b[0]] else 1)
    return {p: s / sums[p][0] for p, s in total.items()}, {p for p, s in sums.items() if s[3] > LINKS * s[1]}, sum(total[p] / s[0] * s[1] for p, s in sums.items()) / max(1, sum(s[1] for s in sums.values()))


def select(page: Page, threshold: float = THRESHOLD) -> set[int]:
    """The paths whose blocks are the main text."""
    score, linked, mean = path_scores(page)
    paths = page.paths
    if not score:
        return set()
    chosen = {p for p, s in score.items() if s >= threshold * mean and (p not in linked or paths.box[p])} or {max(score, key=lambda p: (score[p], -p))}
    around = [False] * len(paths.parent)  # nodes with content below
    for p in chosen:
        around[p] = True
    for p in range(len(around) - 1, 0, -1):
        around[paths.parent[p]] |= around[p]
    weight: dict[int, int] = defaultdict(int)
    for path, text, _ in page.blocks:
        if path in chosen and not paths.box[path]:
            weight[paths.parent[path]] += len(text)
    parent = max(weight, key=lambda p: (weight[p], -p)) if weight else -1
    beside = [False] * len(around)  # below an element that goes with the content next to it
    for p in range(1, len(beside)):
        up = paths.parent[p]
        beside[p] = beside[up] or (up == parent and paths.tag[p] in BESIDE)
    out = set(chosen)
    for p in score:
        box = paths.box[p]
        if box and around[box]:
            if p not in linked or paths.tag[box] == "article":
                out.add(p)
        elif not box and beside[p] and p not in linked:
            out.add(p)
    return out


def main_text(html: str) -> str:
    """The blocks of the selected paths, joined by line feeds."""
    page = Page(html)
    chosen = select(page)
    return "\n".join(text for path, text, _ in page.blocks if path in chosen)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h.as_py()) if h.is_valid else "" for h in b["html"]]
        return pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return base.map_arrow(base.texts_of(pages, "page_id", "url", "html"), fn, "page_id long, url string, text string, n_chars long")
