"""Main text of web pages by tree scoring.

Paragraphs earn points for their length and their commas; the points pass
up to the ancestors (whole to the parent, half to the next, less above) and
are discounted by the ancestor's link density.  If the best container stands
in an ``article`` or ``main`` element, that whole element is the container;
an article in ``main`` has the running text beside it (lead and closing
paragraphs, sections, other articles), others have the articles beside them.
Else the best container is kept
with the running text beside it: paragraphs, lists and sections by their own
text and link density, headings of what is kept, loose text of the parent;
and so on upwards while most of the text beside it is running text.  Menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out wherever they stand.

Markup may be broken: missing end tags are implied, stray ones ignored, and
unclosed scripts or comments run to the end of the page.

Text: character references are decoded, white space becomes one space,
blocks are joined in page order by one space.

Edge cases: null or empty html gives an empty text; a page without any
scored paragraph gives its ``article`` or ``main``, else all that is not left
out; plain text without tags is its own text; repeated rows are kept; an
empty table gives an empty result; other columns are kept whatever their
names, but one named ``text`` or ``n_chars`` is replaced.  Work and memory are
linear in the page: open elements are found by name, not by a search of all.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import extended, map_batches, without

LEAST_PARAGRAPH = 25
CHARS_PER_POINT = 100
MOST_LENGTH_POINTS = 3
LINK_LIST = 0.6
#: A block with a larger share of linked text is no running text.
MOST_LINKED = 0.5

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[a-z]+")

# Fixed sets of element names.
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "template", "svg", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt",
    "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
LEFT_OUT = {
    "aside", "audio", "button", "canvas", "dialog", "embed", "footer", "form", "head", "header", "input", "map", "menu", "nav", "object", "option", "select", "video", *RAW,
}
PARAGRAPH = {"p", "pre", "td", "blockquote", "li", "dd"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: An opening tag of the key ends open elements of the values.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
#: Elements that an implied end does not reach beyond.
SCOPE = {"ul", "ol", "dl", "table", "select", "article", "section", "div", "main", "body", "html", "td", "th", "blockquote", "nav", "aside", "header", "footer", "form"}
#: Words for parts of any page.
LAYOUT_PARTS = {
    "a", "about", "after", "all", "and", "area", "article", "articles", "aside", "bar", "before", "block", "blog", "body", "bottom", "box", "btn", "button", "buttons", "by", "col", "column",
    "container", "content", "contents", "count", "entries", "entry", "facebook", "feed", "floating", "follow", "for", "form", "group", "heading", "icon", "icons", "inner", "input", "item",
    "items", "js", "label", "left", "legal", "link", "links", "list", "main", "media", "meta", "more", "news", "outer", "page", "pages", "panel", "post", "posts", "read", "reading", "right",
    "row", "section", "side", "single", "site", "sticky", "stories", "story", "text", "the", "this", "title", "to", "tool", "tools", "top", "topics", "twitter", "us", "view", "with", "wrap",
    "wrapper", "you", "your",
}
#: Words of class, id and role that mark page furniture.
FURNITURE = {
    "ad", "ads", "adsense", "advert", "advertisement", "adverts", "aside", "banner", "breadcrumb", "breadcrumbs", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "dialog",
    "disclaimer", "footer", "gdpr", "header", "login", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pager",
    "pagination", "popup", "promo", "promoted", "promotion", "recommended", "related", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored",
    "subscribe", "subscription", "tags", "toolbar", "widget", "widgets",
}
#: Of these, words that also name subjects: beside a word that is not one of
#: ``PARTS`` (market-share, related-work) they mark nothing.
SUBJECTS = {"notice", "notices", "promotion", "recommended", "related", "search", "share", "sharing", "skip", "social", "tags"}
PARTS = FURNITURE | LAYOUT_PARTS
READERS = {"comment", "commentlist", "comments", "discussion", "disqus", "replies", "reply", "respond", "responses"}
#: A class of these words tells of the page's layout or the post's data, and
#: its furniture words (with-sidebar, has-menu, category-social) mark nothing.
LAYOUT = {"category", "disabled", "enabled", "format", "has", "have", "layout", "no", "tag", "type", "with", "without"}
KEPT_ANYWAY = {"html", "body", "article", "main"}


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(text)}


def _furniture(tag: str, attributes: str) -> bool:
    """Whether the element's name or attributes say it is no article text."""
    if tag in LEFT_OUT:
        return True
    if not attributes.strip():
        return False
    found = _attributes(attributes)
    names = [set(_NAME.findall(name)) for k in ("class", "id", "role") for name in found.get(k, "").split()]
    words = set().union(*(n - SUBJECTS if n - PARTS - READERS else n for n in names if not n & LAYOUT))
    if tag in ("html", "body", "main"):
        return False
    if words & READERS:
        return True
    if tag not in KEPT_ANYWAY and words & FURNITURE:
        return True
    return "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")


class Page:
    """Elements in page order (a parent before its children) and the text
    runs between them; ``None`` marks the edge of a block."""

    def __init__(self, source: str):
        self.tag, self.parent, self.out = ["#page"], [0], [False]
        self.runs: list[tuple[int, str | None]] = []
        # Places in the stack of the open elements, by name, of the blocks and
        # of those that an implied end does not reach beyond.
        self.opened: dict[str, list[int]] = {}
        self.blocks, self.scopes = [0], [0]
        self._parse(source)

    def _push(self, stack: list[int], node: int) -> None:
        tag = self.tag[node]
        self.opened.setdefault(tag, []).append(len(stack))
        if tag not in INLINE:
            self.blocks.append(len(stack))
        if tag in SCOPE:
            self.scopes.append(len(stack))
        stack.append(node)

    def _cut(self, stack: list[int], depth: int) -> None:
        """Close the elements from ``depth`` on."""
        while len(stack) > depth:
            self.opened[self.tag[stack.pop()]].pop()
        for held in (self.blocks, self.scopes):
            while held[-1] >= depth:
                held.pop()

    def _innermost(self, tag: str) -> int:
        held = self.opened.get(tag)
        return held[-1] if held else 0

    def _parse(self, source: str) -> None:
        stack, at, end = [0], 0, len(source)
        while at < end:
            match = _TAG.search(source, at)
            if match is None:
                self._text(stack[-1], source[at:])
                return
            if match.start() > at:
                self._text(stack[-1], source[at : match.start()])
            at = match.end()
            name = match[2] or match[5]
            if not name:
                continue
            tag, attributes = name.lower(), match[3] or match[6] or ""
            if match[1] or match[4]:
                self._close(stack, tag)
            elif tag in RAW:
                close = re.compile(f"</{tag}", re.I).search(source, at)
                at = end if close is None else close.start()
                self._open(stack, tag, attributes)
                if close is None:
                    return
            else:
                self._open(stack, tag, attributes)
                if tag in VOID or attributes.rstrip().endswith("/") and tag not in INLINE and tag not in SCOPE:
                    self._cut(stack, len(stack) - 1)

    def _text(self, node: int, text: str) -> None:
        self.runs.append((node, html.unescape(text) if "&" in text else text))

    def _edge(self, node: int) -> None:
        self.runs.append((node, None))

    def _open(self, stack: list[int], tag: str, attributes: str) -> None:
        if tag not in INLINE:
            if tag not in ("br", "hr") and tag not in RAW:
                self._end(stack, {"p"})
            if tag in ENDS:
                self._end(stack, ENDS[tag])
            self._edge(stack[-1])
        self.tag.append(tag)
        self.parent.append(stack[-1])
        self.out.append(self.out[stack[-1]] or _furniture(tag, attributes))
        self._push(stack, len(self.tag) - 1)

    def _end(self, stack: list[int], tags: set[str]) -> None:
        """Imply the end of the innermost open element of ``tags``."""
        depth = max(map(self._innermost, tags))
        if depth and depth >= self.scopes[-1]:
            self._edge(stack[depth])
            self._cut(stack, depth)

    def _close(self, stack: list[int], tag: str) -> None:
        depth = self._innermost(tag)
        if not depth or tag in INLINE and depth < self.blocks[-1]:
            return
        if tag not in INLINE:
            self._edge(stack[depth])
        self._cut(stack, depth)

    def text(self, kept: list[bool]) -> str:
        return " ".join("".join(" " if run is None else run for node, run in self.runs if kept[node]).split())


def _scores(page: Page) -> tuple[list[float], list[int], list[int], list[int], list[int]]:
    """Points, text length, linked text length, links and own text length
    (without that of blocks inside) of each element."""
    n = len(page.tag)
    chars, linked, links, commas = [0] * n, [0] * n, [0] * n, [0] * n
    home = list(range(n))  # the paragraph or block that inline text belongs to
    in_link = [False] * n
    for i in range(1, n):
        above = page.parent[i]
        in_link[i] = in_link[above] or page.tag[i] == "a"
        links[i] = page.tag[i] == "a"
        if page.tag[i] in INLINE:
            home[i] = home[above]
    own = [0] * n
    for node, run in page.runs:
        if run is None or page.out[node]:
            continue
        size = len(" ".join(run.split()))
        chars[node] += size
        linked[node] += size * in_link[node]
        own[home[node]] += size
        commas[home[node]] += run.count(",")
    score = [0.0] * n
    for i in range(1, n):
        if page.out[i] or own[i] < LEAST_PARAGRAPH:
            continue
        points = 1 + commas[i] + min(own[i] / CHARS_PER_POINT, MOST_LENGTH_POINTS)
        at, share = page.parent[i] if page.tag[i] in PARAGRAPH else i, 1.0
        for level in range(6):
            score[at] += points * share
            if at == 0:
                break
            at, share = page.parent[at], 1 / 2 if level == 0 else 1 / (3 * (level + 1))
    for i in range(n - 1, 0, -1):
        above = page.parent[i]
        if not page.out[i]:
            chars[above] += chars[i]
            linked[above] += linked[i]
            links[above] += links[i]
    return [s * (1 - linked[i] / max(1, chars[i])) for i, s in enumerate(score)], chars, linked, links, own


def main_text(source: str | None) -> str:
    """Main text of one page."""
    if not source:
        return ""
    page = Page(source)
    n = len(page.tag)
    score, chars, linked, links, own = _scores(page)
    best = max(range(n), key=lambda i: (score[i] if not page.out[i] else -1.0, -i))
    keep, loose = _container(page, best, score, chars, linked, own)
    kept, whole, named = [False] * n, [False] * n, [False] * n
    for i in range(n):
        above = page.parent[i]
        named[i] = named[above] or page.tag[i] in ("article", "main")
        if page.out[i]:
            continue
        # In an article or main, only lists marked as navigation go.
        list_of_links = not named[i] and page.tag[i] in ("ul", "ol", "div", "section", "table") and links[i] >= 3 and linked[i] > LINK_LIST * chars[i]
        whole[i] = i in keep or (i > 0 and whole[above] and not list_of_links)
        kept[i] = whole[i] or i in loose or (i > 0 and kept[above] and not whole[above] and page.tag[i] in INLINE)
    return page.text(kept)


def _container(page: Page, best: int, score: list[float], chars: list[int], linked: list[int], own: list[int]) -> tuple[set[int], set[int]]:
    """Elements kept whole (the best container and what belongs to it), and
    those of which only the loose text between their blocks is kept."""
    n = len(page.tag)
    if score[best] <= 0:
        whole = [i for i in range(n) if page.tag[i] in ("article", "main") and not page.out[i]]
        return {max(whole, key=lambda i: (chars[i], -i))} if whole else {0}, set()
    at, named = best, None
    while at:
        if page.tag[at] == "article" or page.tag[at] == "main" and named is None:
            named = at
        at = page.parent[at]
    if named is not None:
        # Outside ``main`` (or another article) only other articles belong to it.
        within = at_or_above(page, page.parent[named], ("article", "main"))
        keep, loose = _beside(page, named, chars, linked, own, levels=1)
        return {i for i in keep if i == named or within or page.tag[i] == "article"}, loose if within else set()
    return _beside(page, best, chars, linked, own)


def at_or_above(page: Page, at: int, tags: tuple[str, ...]) -> bool:
    while at and page.tag[at] not in tags:
        at = page.parent[at]
    return at > 0


def _beside(page: Page, best: int, chars: list[int], linked: list[int], own: list[int], levels: int | None = None) -> tuple[set[int], set[int]]:
    """The best container, and the running text beside it and above (in
    ``levels`` of its ancestors at most)."""
    n = len(page.tag)
    path, at = set(), best
    while at and (levels is None or len(path) < levels):
        at = page.parent[at]
        path.add(at)
    below: dict[int, list[int]] = {i: [] for i in path}
    running = [0] * n  # text of an element's blocks that are running text
    plain = page.tag[best] if own[best] >= LEAST_PARAGRAPH else ""  # paragraphs are such elements here
    for i in range(n - 1, 0, -1):
        above = page.parent[i]
        if page.out[i]:
            continue
        if above in below and chars[i]:
            below[above].append(i)
        if linked[i] <= MOST_LINKED * chars[i]:
            least = 1 if page.tag[i] in HEADING else LEAST_PARAGRAPH if page.tag[i] in PARAGRAPH or page.tag[i] == plain else CHARS_PER_POINT
            running[i] += own[i] * (own[i] >= least)
        running[above] += running[i]
    keep, loose, at = {best}, set(), best
    while at and page.parent[at] in path:
        above, beside, headed = page.parent[at], 0, False
        for i in below[above]:  # the last one first
            if i == at:
                headed = True
            elif page.tag[i] in HEADING:
                if headed and linked[i] <= MOST_LINKED * chars[i]:
                    keep.add(i)
                    beside += chars[i]
            elif page.tag[i] not in INLINE or running[i]:
                headed = _is_text(page.tag[i], chars[i], linked[i], own[i], running[i])
                if headed:
                    keep.add(i)
                    beside += chars[i]
        if own[above] >= LEAST_PARAGRAPH and linked[above] <= MOST_LINKED * chars[above]:
            loose.add(above)
            beside += own[above]
        if 2 * beside < chars[above] - chars[at]:
            break
        at = above
    return keep, loose


def _is_text(tag: str, chars: int, linked: int, own: int, running: int) -> bool:
    """Whether a block beside the best container belongs to the text."""
    if linked > MOST_LINKED * chars:
        return False
    if tag in PARAGRAPH and own == chars and not linked:
        return True
    if tag in PARAGRAPH or tag in ("ul", "ol", "dl"):
        return chars >= LEAST_PARAGRAPH
    return 2 * running >= chars


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages`` (or its columns ``keep``) with ``text`` and ``n_chars``."""
    kept = [c for c in (keep if keep is not None else pages.columns) if c.lower() not in ("text", "n_chars")]
    taken = {c.lower() for c in kept}
    name = next(n for n in ("source", *(f"source_{i}" for i in range(len(taken) + 1))) if n not in taken)
    source = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html_col}`").cast("binary").alias(name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(None if (s := x.as_py()) is None else s.decode("utf-8", "replace")) for x in batch.column(name)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*kept, "text", "n_chars"],
            )

    return map_batches(source, run, extended(without(source, name).schema, "text string, n_chars bigint"))
