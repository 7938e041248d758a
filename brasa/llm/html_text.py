"""Main text of HTML pages by line-block distribution.

Markup is stripped to lines (one per block element or line break). Lines in
containers that are never article text (navigation, page header and footer,
sidebar, advert, notice, form, comments, script, style, hidden parts) get
length zero, as do lines that are mostly links outside of an article element.
A main element in a container that its class, id or role or a form would drop
is kept; so is an article element, if the page has no article text elsewhere.
Text lengths are summed over sliding windows of ``WINDOW`` lines: the sum
surges where text begins and dives to zero where a gap as long as the window
follows. The lines between surge and dive points form a text region. Regions
whose sum peaks at ``SURGE`` or more are kept; if none does, the one with the
highest peak; smaller ones between two kept ones stay. On a page with article (or main) elements their lines weigh
a surge more and the lines outside nothing, so the windows choose among the article's lines.

Each page is one row of an Arrow batch: no shuffle, no state. Defined results:
null, empty and textless pages give an empty text; a very long page is read
once, from tag to tag, in time linear in its length and depth; unclosed elements end with
their parent or the page, a tag cut off by the end of the page is dropped;
repeated rows give repeated results; an empty table gives an empty result;
only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import table

WINDOW = 3
SURGE = 80
LINK_SHARE = 0.5

# Element names of the HTML standard, by the part they play here.
BLOCK = frozenset("address article aside blockquote body br button caption center col colgroup dd details dialog dir div dl dt "
                  "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
                  "ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "audio", "video", "textarea", "title")
DROPPED = frozenset("nav footer aside form menu dialog head button select search header".split())
#: Elements that a new block of their kind, or the end of their parent, closes.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}}
# Class, id and role names, or last words of them, of a part which is not the article.
BOILER = frozenset("nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars side aside footer masthead banner ad ads "
                   "advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
                   "alert popup modal overlay newsletter subscribe subscription signup login search searchbox share sharing social "
                   "related recommended comment comments disqus replies respond complementary contentinfo toolbar pagination pager "
                   "widget hidden form header".split())
#: A name that starts so tells what an element has or does, not what part it is.
STATES = frozenset("has is no not with without overflow show hide toggle open close on off can use js enable disable".split())
#: What becomes of the text of an element: kept, kept if there is no other article text, dropped (by name, by kind).
KEPT, SPARE, BY_NAME, BY_KIND = range(4)
_SPLIT = re.compile(r"[^a-z0-9]+")
_MARK = re.compile(r"""(?P<comment><!--)|(?P<cdata><!\[CDATA\[|\]\]>)|(?P<other><(?:![a-zA-Z]|\?))"""
                   r"""|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>"']|"[^"]*"|'[^']*')*)>""")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
_CUT = re.compile(r"<(?:/?[a-zA-Z][^>]*|/|!|!-+)?$")
_ATTR = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)


def _names_part(value: str) -> bool:
    """Whether one of the names in an attribute value, or its last word, is in BOILER."""
    for name in value.split():
        parts = [x for x in _SPLIT.split(name.split("--")[0]) if x]
        if parts and parts[-1] in BOILER and parts[0] not in STATES:
            return True
    return False


def _off(name: str, attrs: str, in_article: bool) -> int:
    """BY_KIND or BY_NAME for an element that is a part which is never article text, else KEPT."""
    if name in DROPPED and not (name == "header" and in_article):
        return BY_NAME if name == "form" else BY_KIND
    if name in ("article", "main", "body", "html") or not attrs:
        return KEPT
    off = KEPT
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return BY_KIND
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return BY_KIND
        elif _names_part(value) and not (in_article and name in ("h1", "h2", "header")):
            off = BY_NAME
    return off


def _within(parent: tuple[str, int, bool], name: str, attrs: str) -> int:
    """What becomes of an element's text, given that of its parent."""
    if parent[1] == BY_NAME and not parent[2] and name in ("article", "main"):
        return KEPT if name == "main" else SPARE
    return max(parent[1], _off(name, attrs, parent[2]))


def marks(html: str):
    """(text before, closing?, name, attributes) of each tag in page order, then the text that is left.

    Comments, declarations and raw elements (scripts and the like) count as a
    space; each is left by one search from where it starts, so a page is read
    once. Without its end a comment or raw element runs to the end of the page.
    """
    # a tag that the end of the page cuts off
    last = html.rfind(">") + 1
    cut = _CUT.search(html, last)
    html, text, at = html[:cut.start()] if cut else html, [], 0
    while m := _MARK.search(html, at):
        text.append(html[at:m.start()])
        at = m.end()
        if m["name"]:
            name = m["name"].lower()
            if name not in RAW or m["end"]:
                yield "".join(text), bool(m["end"]), name, m["attrs"]
                text = []
                continue
            if not m["attrs"].endswith("/"):
                end = _RAW_END[name].search(html, at)
                at = end.end() if end else len(html)
        elif m["comment"]:
            end = html.find("-->", at)
            at = end + 3 if end >= 0 else len(html)
        elif m["other"]:
            if at >= last:
                text.append(m[0])
                continue
            at = html.find(">", at) + 1
        text.append(" ")
    text.append(html[at:])
    yield "".join(text), False, "", ""


def lines_of(html: str) -> list[tuple[str, int, bool, float]]:
    """(text, what becomes of it, in an article element, share of link text) of each line with text, and of each dropped element."""
    out, buf, linked, size = [], [], 0, 0
    stack: list[tuple[str, int, bool]] = []  # name, off, article
    depth: Counter = Counter()
    off, article = KEPT, False
    link = 0

    def flush():
        nonlocal buf, linked, size
        text = " ".join(unescape("".join(buf)).split())
        if text:
            out.append((text, off, article, linked / max(size, 1)))
        buf, linked, size = [], 0, 0

    for text, closing, name, attrs in marks(html):
        buf.append(text)
        n = len(text.strip())
        size += n
        linked += n if link else 0
        if name == "a":
            link = 0 if closing else 1
        if name in BLOCK or not name:
            flush()
        if closing:
            if depth[name]:
                popped = None
                while popped != name:
                    popped = stack.pop()[0]
                    depth[popped] -= 1
        elif name and name not in VOID and not attrs.endswith("/"):
            if (name == "p" or name in CLOSED_BY) and stack and stack[-1][0] in CLOSED_BY.get(name, {"p"}):
                depth[stack.pop()[0]] -= 1
            parent = stack[-1] if stack else ("", KEPT, False)
            stack.append((name, _within(parent, name, attrs), parent[2] or name in ("article", "main")))
            depth[name] += 1
        off, article = (stack[-1][1], stack[-1][2]) if stack else (KEPT, False)
    return out


def regions(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(surge, dive, peak): stretches of lines between gaps of ``window`` empty lines, and their highest window sum."""
    n = len(lengths)
    sums = [sum(lengths[i:i + window]) for i in range(n)]  # WINDOW is a small number
    out, start = [], None
    for i in range(n + 1):
        if i < n and sums[i] > 0:
            start = i if start is None else start
        elif start is not None:
            out.append((start, min(n, i + window - 1), max(sums[start:i])))
            start = None
    return out


def main_text(html: str | None) -> str:
    lines = lines_of(html or "")
    level = min((off for _, off, article, _ in lines if article), default=BY_KIND)
    inside = level <= SPARE
    use = [off <= (level if inside else KEPT) and (article if inside else share <= LINK_SHARE) for _, off, article, share in lines]
    # an article element weighs as much as a surge, so that none of its lines is too short for one
    found = regions([len(x[0]) + SURGE * inside if ok else 0 for x, ok in zip(lines, use)])
    if found:
        peak = max(r[2] for r in found)
        high = [i for i, r in enumerate(found) if r[2] >= min(SURGE, peak)]
        found = found[high[0]:high[-1] + 1]
    return " ".join(lines[i][0] for a, b, _ in found for i in range(a, b) if use[i])


def extract(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars``."""
    pages = df.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            text = [main_text(h if isinstance(h, str) else None) for h in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": text, "n_chars": [len(t) for t in text]})

    return pages.mapInPandas(run, f"page_id {kind}, url string, text string, n_chars long")


def query(spark, sf_dir) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
