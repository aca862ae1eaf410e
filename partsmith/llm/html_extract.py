"""Main-text extraction by composite text density.

The page is parsed into a tree of elements (unclosed paragraphs, list items and table
cells are closed as browsers do).  For every element the composite density is its
characters per tag, raised or lowered by the share of its characters and tags that are
links, relative to the share in the whole body.  An element's sum is that of its
children's densities.  The element with the largest sum is the core; the threshold is
the smallest density on the path from the core up to the body.  Every element that
reaches the threshold marks its own largest-sum descendant as content.  What is marked tells
where the article is: where the core stands in an article or main element, all of that
element is kept; else all of the smallest element that holds everything marked, unless
that is the body.

Menus, page headers and footers, side bars, forms, scripts, styles, hidden elements and
elements whose class, id or role names an advert, notice, comment list and the like
take no part in the choice and are left out of the text.  The id of a heading or paragraph
names nothing; inside the article a name that only begins with such a word ("related-work",
"social-contract") counts only on an element that is mostly links.

Quotes open an attribute's value only after "=", and every scan goes on from where the last
one ended, so parsing takes time in proportion to the page.

Text: character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined by a line feed in page order.

Defined cases: null and empty pages give ""; a page without a body element is read as
if it stood in one; repeated rows give equal rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to the end tag, and never article text.
RAW = frozenset("script style noscript template textarea iframe title xmp noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section"
    " summary table tbody tfoot thead tr ul".split())
LEFT_OUT = frozenset(
    "nav footer aside form button select option input label fieldset svg canvas object head"
    " dialog menu audio video map applet embed".split()) | RAW
_NAMES = (
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent|gdpr|notice\w*"
    r"|alert\w*|popup|modal|overlay|sidebar|side-bar|aside|nav|navbar|navigation|menu|breadcrumbs?"
    r"|footer|masthead|topbar|toolbar|comments?|commentlist|disqus|replies|respond|share|sharing"
    r"|social|related|recommend\w*|newsletter|subscribe|signup|login|search|widget|skip-link"
    r"|site-header|page-header|pagination|pager)")
_NOISE = re.compile(_NAMES + r"(?=$|[\s_-])", re.I)
#: Not only the first part of a slug like "related-work" (which headings and sections have),
#: but its end, or a reader's comments.
_NOISE_END = re.compile(
    _NAMES + r"(?=$|\s)|(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|respond)(?=[_-])", re.I)
_TEXT_TAGS = frozenset("h1 h2 h3 h4 h5 h6 p".split())
_NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert dialog menu menubar".split())
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_TAG = re.compile(
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']?+))*+)>""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPACE = re.compile(r"\s+")
#: A start tag closes an open element of these names, up to the named borders.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
           "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
           "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}
_P_BORDERS = frozenset({"table", "td", "th", "button", "object", "caption"})


class Page:
    """Elements in page order (index 0 is the root) and the texts between them."""

    def __init__(self, html: str):
        self.tag, self.parent, self.own = ["#root"], [-1], [""]
        self.last = [0]              # index of the last descendant
        self.texts: list[tuple[int, int, str]] = []  # (element, elements before it, text)
        self.open: Counter[str] = Counter()  # open elements by name, so no search is in vain
        self._parse(html)
        # a name like "with-sidebar" on what holds the page's (first) article says nothing
        first = next((i for i, t in enumerate(self.tag) if t in ("article", "main")), None)
        while first is not None and first > 0:
            if self.own[first] == "name":
                self.own[first] = ""
            first = self.parent[first]
        self._drop_slugs()
        self.noise, self.block = [False], [0]  # whether left out; the nearest block
        for i, p in enumerate(self.parent[1:], 1):
            self.noise.append(bool(self.own[i]) or self.noise[p])
            self.block.append(i if self.tag[i] in BLOCKS else self.block[p])

    def _drop_slugs(self) -> None:
        """A name like "related-posts" counts only on what is mostly links."""
        if "slug" not in self.own:
            return
        n = len(self.tag)
        chars, links = [0] * n, [0] * n
        for i, _, text in self.texts:
            if self.tag[i] not in RAW:
                chars[i] += len(_SPACE.sub(" ", text).strip())
        for i in range(n - 1, 0, -1):
            if self.tag[i] == "a":
                links[i] = chars[i]
            chars[self.parent[i]] += chars[i]
            links[self.parent[i]] += links[i]
        for i, own in enumerate(self.own):
            if own == "slug":
                self.own[i] = "name" if 2 * links[i] > chars[i] else ""

    def _noise_kind(self, tag: str, attrs: str) -> str:
        """Why an element is no article text: "tag", "hidden", "name", "slug" (a name
        if it holds links) or nothing."""
        if tag in LEFT_OUT:
            return "tag"
        inside = self.open["article"] + self.open["main"] > 0
        if tag == "header":  # an article's own header holds its heading
            return "" if inside else "tag"
        if not attrs or tag in ("html", "body", "article", "main"):
            return ""
        kind = ""
        for m in _ATTR.finditer(attrs):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return "hidden"
            if name == "style" and _HIDDEN.search(value):
                return "hidden"
            if name == "id" and tag in _TEXT_TAGS:
                continue  # a link's target, made of the heading's words
            if name in ("class", "id") and _NOISE.search(value):
                if inside and not _NOISE_END.search(value):
                    kind = "slug"
                    continue
                return "name"
            if name == "role" and value.lower() in _NOISE_ROLES:
                return "name"
        return kind

    def _close(self, stack: list[int], depth: int) -> None:
        """Close all elements from place ``depth`` of the stack on."""
        end = len(self.tag) - 1
        for i in stack[depth:]:
            self.last[i] = end
            self.open[self.tag[i]] -= 1
        del stack[depth:]

    def _open(self, stack: list[int], tag: str, attrs: str) -> None:
        if tag in _CLOSES and any(self.open[x] for x in _CLOSES[tag][0]):
            names, borders = _CLOSES[tag]
            for d in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[d]]
                if t in borders:
                    break
                if t in names:
                    self._close(stack, d)
                    if tag != "tr":
                        break
        elif tag in BLOCKS and self.open["p"]:
            for d in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[d]]
                if t == "p":
                    self._close(stack, d)
                    break
                if t in _P_BORDERS:
                    break
        i = len(self.tag)
        self.tag.append(tag)
        self.parent.append(stack[-1])
        self.own.append(self._noise_kind(tag, attrs))
        self.last.append(i)
        if tag not in VOID:
            stack.append(i)
            self.open[tag] += 1

    def _end(self, stack: list[int], tag: str) -> None:
        if not self.open[tag]:
            return
        for d in range(len(stack) - 1, 0, -1):
            t = self.tag[stack[d]]
            if t == tag:
                self._close(stack, d)
                return
            if tag not in BLOCKS and t in BLOCKS:
                return  # an inline end tag doesn't close a block

    def _text(self, stack: list[int], raw: str) -> None:
        if raw:
            self.texts.append((stack[-1], len(self.tag), unescape(raw) if "&" in raw else raw))

    def _parse(self, html: str) -> None:
        stack, at, end = [0], 0, len(html)
        while at < end:
            lt = html.find("<", at)
            if lt < 0:
                self._text(stack, html[at:])
                break
            if html.startswith("<!--", lt):
                self._text(stack, html[at:lt])
                close = html.find("-->", lt + 4)
                at = end if close < 0 else close + 3
                continue
            nxt = html[lt + 1:lt + 2]
            if nxt in ("!", "?"):
                self._text(stack, html[at:lt])
                close = html.find(">", lt)
                at = end if close < 0 else close + 1
                continue
            m = _TAG.match(html, lt)
            if not m:
                if nxt == "/" or nxt.isalpha() and nxt.isascii():
                    # "</" without a name is no text up to ">"; an unfinished tag ends the page
                    self._text(stack, html[at:lt])
                    close = html.find(">", lt) if nxt == "/" else -1
                    at = end if close < 0 else close + 1
                else:  # a bare <
                    self._text(stack, html[at:lt + 1])
                    at = lt + 1
                continue
            self._text(stack, html[at:lt])
            at, tag = m.end(), m[2].lower()
            if m[1]:
                self._end(stack, tag)
                continue
            self._open(stack, tag, m[3])
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                self._close(stack, len(stack) - 1)
                at = close.end() if close else end
        self._close(stack, 0)


def densities(page: Page) -> tuple[list[float], list[float]]:
    """Composite density of every element and the sum over its children."""
    n = len(page.tag)
    chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for i, _, text in page.texts:
        if page.tag[i] not in RAW:
            chars[i] += len(_SPACE.sub(" ", text).strip())
    for i in range(n - 1, -1, -1):
        if page.tag[i] == "a":
            links[i], link_tags[i] = chars[i], link_tags[i] + 1
        p = page.parent[i]
        if p >= 0 and page.tag[i] not in RAW and page.tag[i] != "head":
            chars[p] += chars[i]
            links[p] += links[i]
            tags[p] += tags[i] + 1
            link_tags[p] += link_tags[i]
    share = links[0] / max(chars[0], 1)
    density = [0.0] * n
    for i in range(n):
        c, t = chars[i], max(tags[i], 1)
        if not c:
            continue
        if not links[0]:  # no link in the page: plain characters per tag
            density[i] = c / t
            continue
        x = c / max(links[i], 1) * t / max(link_tags[i], 1)
        base = math.log(c / max(c - links[i], 1) * links[i] + share * c + math.e)
        density[i] = c / t * max(math.log(x) if x > 0 else 0.0, 0.0) / math.log(base)
    sums = [0.0] * n
    for i in range(1, n):
        sums[page.parent[i]] += density[i]
    return density, sums


def content_elements(page: Page) -> tuple[int, list[int]]:
    """The core (-1: none) and the elements marked as content, by the body-path threshold."""
    n = len(page.tag)
    density, sums = densities(page)
    body = next((i for i in range(n) if page.tag[i] == "body"), 0)
    inside = range(body, page.last[body] + 1)
    usable = [i for i in inside if not page.noise[i]]
    if not usable:
        return -1, []
    core = max(usable, key=lambda i: sums[i])
    if sums[core] <= 0:
        return body, [body]
    threshold, i = density[core], core
    while i != body and i > 0:
        i = page.parent[i]
        threshold = min(threshold, density[i])
    # the largest-sum element of every subtree, children before parents
    best = list(range(n))
    for i in range(page.last[body], body, -1):
        p = page.parent[i]
        if not page.noise[i] and p >= body and (sums[best[i]] > sums[best[p]] or
                                                best[p] != p and sums[best[i]] == sums[best[p]]):
            best[p] = best[i]
    return core, sorted({best[i] for i in usable if i != body and density[i] >= threshold} | {core})


def article_elements(page: Page) -> list[int]:
    """The elements whose text is the article: whole ones around what is marked."""
    core, marked = content_elements(page)
    i = core
    while i > 0:
        if page.tag[i] in ("article", "main"):
            return sorted({i, *marked})
        i = page.parent[i]
    if len(marked) > 1:
        around = marked[0]
        while around > 0 and page.last[around] < marked[-1]:
            around = page.parent[around]
        if around > 0 and page.tag[around] not in ("body", "html"):
            return [around]
    return marked


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    page = Page(html)
    chosen = article_elements(page)
    spans: list[tuple[int, int]] = []
    for i in chosen:  # page order; an element inside a chosen one adds nothing
        if not spans or i > spans[-1][1]:
            spans.append((i, page.last[i]))
    blocks: list[str] = []
    parts: list[str] = []
    block_of: int | None = None
    k, before_last = 0, 0
    for element, before, text in page.texts:
        while k < len(spans) and spans[k][1] < element:
            k += 1
        if k == len(spans):
            break
        if element < spans[k][0] or page.noise[element]:
            continue
        owner = page.block[element]
        # a block element that began since the last text breaks the block, too
        broke = block_of is not None and (owner != block_of or any(
            page.tag[j] in BLOCKS for j in range(before_last, before)))
        if broke:
            blocks.append("".join(parts))
            parts = []
        elif parts and any(page.tag[j] in ("br", "td", "th") for j in range(before_last, before)):
            parts.append(" ")
        block_of, before_last = owner, before
        parts.append(text)
    blocks.append("".join(parts))
    return "\n".join(b for b in (_SPACE.sub(" ", x).strip() for x in blocks) if b)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per page row: ``page_id, url, text, n_chars`` (code points of the text)."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), 256):
                part = f.iloc[at:at + 256]
                texts = [main_text(h) for h in part["html"]]
                out = part[["page_id", "url"]].copy()
                out["text"] = texts
                out["n_chars"] = [len(t) for t in texts]
                yield out

    return pages.select("page_id", "url", "html").mapInPandas(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
