"""Main text of web pages by line-block distribution.

1. Markup is stripped to lines, one per block element. Scripts, styles,
   comments, head, and everything inside elements that never hold article text
   (navigation, page footer, sidebar, form, ..., by element name or role),
   that are hidden, or that are marked as adverts or reader comments is no
   line at all; outside the article it leaves a gap.
2. A line has the length of its text without link text, weighted: lines
   outside ``article`` or ``main`` weigh a twentieth where a page has one, and
   lines in an element whose class or id names a page part (share, notice,
   search, related, ...) a fifth. Markup only weighs; the next step decides.
3. The weighted lengths are summed over sliding windows of ``window`` lines. A
   region runs from the point where that sum surges to the point where it
   dives to nothing (a gap is as long as a window). A region stays when its
   largest sum is ``surge`` characters or more and, where its lines are
   weighted down, also a quarter of the page's largest sum. A page in which
   nothing surges keeps the region with the most weighted text.
4. Inside a region, an element whose class names a page part goes when its
   own sums dive below the same mark. Headings, paragraphs, lists and tables
   are not judged by their class, and a name is only taken whole there
   (``related`` is one, ``related-work`` is not).

Character references are decoded, white space inside a line becomes one
space, and lines are joined in page order by one space. Nothing is capped.
Null and empty pages, and pages without text, give the empty text. Broken
markup is taken as it comes, in linear time: unclosed elements end with their
parent, an unclosed menu or sidebar ends where the article starts, a comment
without end runs to the end of the page, a ``<`` without any ``>`` after it is
text, quotes count only behind ``=``. Rows with equal ids are handled one by
one, very long pages like any other.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cairn.llm import textbuf as tb

WINDOW = 3
SURGE = 20
RELATIVE = 0.25  # of the page's largest window sum, for lines weighted down
OUTSIDE = 0.05  # weight of lines outside the article of a page that has one
PART = 0.2  # weight of lines in an element that is named like a page part

# no two alternatives start alike, and what was taken is never given back
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>",
    re.S,
)
ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)

RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "template", "xmp"}
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I) for name in RAW}
# behind the last ">" only comments and declarations without end are markup
BEYOND = re.compile(r"<!--.*\Z|<[!?].*\Z", re.S)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROP = {"head", "nav", "footer", "aside", "form", "menu", "button", "select", "svg", "canvas", "object", "dialog", "audio", "video", "map", "fieldset", "label", "datalist"}
MAIN = {"article", "main"}
BLOCK = {
    "address", "article", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl", "dt", "figcaption",
    "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "ol", "option",
    "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
} | DROP
# classes and ids of what is never the article, and of page parts
STRONG_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "advertorial", "adsense", "comment", "comments", "commentlist", "disqus", "replies"}
PART_WORDS = {
    "banner", "banners", "breadcrumb", "breadcrumbs", "consent", "cookie", "cookies", "disclaimer", "footer", "gdpr", "header", "masthead", "menu",
    "menus", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "overlay", "pagination", "pager", "popup",
    "popover", "promo", "promotion", "related", "respond", "reviews", "search", "share", "sharing", "sidebar", "sidebars", "signup",
    "sitemap", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "toc", "toolbar", "topbar", "widget", "widgets",
}
DROP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar", "status"}
MAIN_WORDS = {"article", "main", "content", "post", "entry", "story"}
# elements that hold other blocks; only these are judged by a page part's name
CONTAINERS = {"div", "section", "header", "center", "details", "figure", "hgroup", "address"}
NO_TEXT, A_PART, A_LINE = "no text", "part", "line"


def _kind(name: str, attrs: str, inside: bool) -> str:
    """Is the element without article text, named like a page part, or
    neither?"""
    if name in DROP or (name == "header" and not inside):
        return NO_TEXT
    if not attrs or name in {"html", "body"}:
        return A_LINE
    kind = A_LINE
    for m in ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return NO_TEXT
        if key == "role" and value in DROP_ROLES:
            return NO_TEXT
        if key in ("class", "id"):
            words = set(re.split(r"[^a-z0-9]+", value))
            if words & STRONG_WORDS and (name not in MAIN or words & {"comment", "comments"}):
                return NO_TEXT
            named = set(value.split()) if inside else words
            if name in CONTAINERS and named & PART_WORDS and not words & MAIN_WORDS:
                kind = A_PART
    return kind


class Line:
    __slots__ = ("text", "size", "inside", "part")

    def __init__(self, text: str, size: int, inside: bool, part: int):
        self.text, self.size, self.inside, self.part = text, size, inside, part


def lines_of(page: str) -> list[Line | None]:
    """Lines with their length without link text, whether they stand in the
    article, and the number of the page part they stand in (0: none); a gap is
    ``None``."""
    out: list[Line | None] = []
    buf: list[str] = []
    linked = 0
    depth_main = depth_link = 0
    skip: str | None = None  # name of the element without text we are in
    nested = 0
    parts: list[list] = []  # open page parts: name, depth, number
    n_parts = 0
    unclosed: set[str] = set()  # raw elements that no end tag closes
    last = page.rfind(">")  # no tag ends after it
    pos = 0

    def flush():
        nonlocal linked
        if buf:
            text = "".join(buf)
            if "&" in text:
                text = html.unescape(text)
            text = " ".join(text.split())
            if text:
                out.append(Line(text, max(0, len(text) - linked), depth_main > 0, parts[-1][2] if parts else 0))
            buf.clear()
        linked = 0

    def gap():
        flush()
        if not depth_main:
            out.append(None)

    while True:
        m = TOKEN.search(page, pos) if pos <= last else BEYOND.search(page, pos)
        if skip is None:
            chunk = page[pos : m.start() if m else len(page)]
            if chunk:
                buf.append(chunk)
                if depth_link:
                    linked += len(chunk)
        if m is None:
            break
        pos = m.end()
        if m.lastgroup is None:
            continue
        name, end = m["name"].lower(), bool(m["end"])
        if not end and name in RAW:
            # raw text up to its end tag (no end tag: only the tag goes)
            close = None if name in unclosed else RAW_END[name].search(page, pos, last + 1)
            if close:
                pos = close.end()
            else:
                unclosed.add(name)
            continue
        if skip is not None:
            if name == skip and name not in VOID:
                nested += -1 if end else 1
                if nested == 0:
                    skip = None
                elif skip in ("p", "li") and not end:
                    nested -= 1  # these close themselves
                continue
            if name in MAIN and not end and skip not in ("form", "dialog") and _kind(name, m["attrs"], False) is A_LINE and skip in DROP | {"header"}:
                skip = None  # an unclosed menu or sidebar ends here
            elif end and name in ("body", "html", "article", "main") and name != skip:
                skip = None
            elif skip == "head" and name == "body":
                skip = None
            else:
                continue
        kind = A_LINE if end or name in VOID else _kind(name, m["attrs"], depth_main > 0)
        if kind is NO_TEXT:
            gap()
            if not m["attrs"].rstrip().endswith("/") or name not in ("svg",):
                skip, nested = name, 1
            continue
        if name in BLOCK:
            flush()
        if parts and name == parts[-1][0]:
            parts[-1][1] += -1 if end else 1
            if parts[-1][1] == 0:
                gap()
                parts.pop()
        elif kind is A_PART:
            gap()
            n_parts += 1
            parts.append([name, 1, n_parts])
        if name == "a":
            depth_link = max(0, depth_link + (-1 if end else 1))
        elif name in MAIN:
            if not end:
                if depth_main == 0:
                    gap()
                    parts.clear()
                depth_main += 1
            elif depth_main:
                depth_main -= 1
                if depth_main == 0:
                    parts.clear()
                    gap()
    flush()
    return out


def window_sums(size: np.ndarray, window: int) -> np.ndarray:
    """Sum of the ``window`` lines from each line on."""
    total = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(len(size))
    return total[np.minimum(at + window, len(size))] - total[at]


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    lines = lines_of(page or "")
    has_main = any(x and x.inside for x in lines)
    # a gap is as long as a window, so that no sum reaches across it
    flat: list[Line | None] = []
    for x in lines:
        flat += [x] if x else [None] * window
    if not flat:
        return ""
    inside = np.array([bool(x and x.inside) for x in flat])
    part = np.array([x.part if x else 0 for x in flat])
    weight = np.where(inside | (not has_main), 1.0, OUTSIDE) * np.where(inside | (part == 0), 1.0, PART)
    size = np.array([x.size if x else 0 for x in flat]) * weight
    sums = window_sums(size, window)
    mark = max(surge, RELATIVE * sums.max())

    # regions: from where a window holds text to where it dives to a gap
    text = np.array([x is not None for x in flat])
    within = np.concatenate([text, np.zeros(window, bool)])
    ahead = np.lib.stride_tricks.sliding_window_view(within, window)[: len(flat)].any(axis=1)
    regions = np.flatnonzero(np.diff(np.concatenate([[0], (ahead | text).astype(np.int8), [0]]))).reshape(-1, 2)
    stays = [sums[a:b].max() >= (surge if weight[a:b][text[a:b]].max() == 1.0 else mark) for a, b in regions]
    if not any(stays):
        # nothing surges: a short page is its region with the most text
        volume = [size[a:b].sum() for a, b in regions]
        stays = [v == max(volume) and v > 0 and volume.index(v) == i for i, v in enumerate(volume)]
    keep = np.zeros(len(flat), bool)
    for (a, b), on in zip(regions, stays):
        keep[a:b] = on
    # page parts inside the article whose own sums dive; they stand in a row
    own = np.flatnonzero(inside & (part > 0))
    for group in np.split(own, np.flatnonzero(np.diff(part[own])) + 1) if len(own) else ():
        if window_sums(size[group], window).max() < mark:
            keep[group] = False
    return " ".join(x.text for x, on in zip(flat, keep) if on and x is not None)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """id, url, text of every page; one pass, no shuffle."""
    rows = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = [main_text(x.as_py(), window, surge) for x in tb.column(batch, "html")]
            yield pa.RecordBatch.from_arrays(
                [tb.column(batch, "id"), tb.column(batch, "url"), pa.array(texts, pa.string())], names=["id", "url", "text"]
            )

    return rows.mapInArrow(run, f"id {kind}, url {rows.schema['url'].dataType.simpleString()}, text string")
