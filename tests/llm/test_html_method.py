"""HTML extraction against an independent slow version, on pages where only the windows decide, and on very long pages."""

import re
import time
from html.parser import HTMLParser

import pytest

from brasa.llm import html_text as H


class Slow(HTMLParser):
    """The lines of a page by the standard library's tokenizer, one list of open elements, no shortcuts."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.lines, self.buf, self.links = [], [], [], []
        self.raw = self.link = 0

    def state(self):
        off, article = H.KEPT, False
        for name, attrs in self.open:
            off = H._within((name, off, article), name, attrs)
            article = article or name in ("article", "main")
        return off, article

    def flush(self):
        text = "".join(self.buf)
        if text.split():
            size = sum(len(b.strip()) for b in self.buf)
            linked = sum(len(b.strip()) for b, k in zip(self.buf, self.links) if k)
            self.lines.append((" ".join(text.split()), *self.state(), linked / max(size, 1)))
        self.buf, self.links = [], []

    def handle_starttag(self, name, attrs):
        if name in H.RAW:
            self.raw += 1
        if self.raw:
            return
        if name in H.BLOCK:
            self.flush()
        self.link = 1 if name == "a" else self.link
        if name not in H.VOID:
            if name in ("p", *H.CLOSED_BY) and self.open and self.open[-1][0] in H.CLOSED_BY.get(name, {"p"}):
                self.open.pop()
            self.open.append((name, " " + " ".join(k if v is None else f'{k}="{v}"' for k, v in attrs)))

    def handle_endtag(self, name):
        if name in H.RAW:
            self.raw = max(0, self.raw - 1)
            return
        if self.raw:
            return
        if name in H.BLOCK:
            self.flush()
        self.link = 0 if name == "a" else self.link
        if name in [n for n, _ in self.open]:
            while self.open.pop()[0] != name:
                pass

    def handle_data(self, data):
        if not self.raw:
            self.buf.append(data)
            self.links.append(self.link)


def slow_text(html):
    p = Slow()
    p.feed(html)
    p.close()
    p.flush()
    article = [off for _, off, inside, _ in p.lines if inside and off <= H.SPARE]
    use, weight = [], []
    for text, off, inside, share in p.lines:
        ok = inside and off <= min(article) if article else off == H.KEPT and share <= H.LINK_SHARE
        use.append(ok)
        weight.append((len(text) + (H.SURGE if article else 0)) * ok)
    sums = [sum(weight[i:i + H.WINDOW]) for i in range(len(weight))]
    # a region goes on as long as its windows hold text; its peak decides
    of, k = [], 0
    for i, s in enumerate(sums):
        k += s == 0
        of.append(k if s else None)
    peaks = {r: max(s for s, o in zip(sums, of) if o == r) for r in set(of) - {None}}
    if not peaks:
        return ""
    high = [r for r in peaks if peaks[r] >= min(H.SURGE, max(peaks.values()))]
    first = min(i for i, o in enumerate(of) if o in high)
    last = max(i for i, o in enumerate(of) if o in high)
    return " ".join(p.lines[i][0] for i in range(first, min(len(use), last + H.WINDOW)) if use[i])


def without_articles(html):
    return re.sub(r"<(/?)(article|main)\b", r"<\1div", html or "", flags=re.I)


@pytest.mark.parametrize("change", [lambda h: h, without_articles])
def test_equals_slow_version_on_all_pages(spark, sf, change):
    pages = [change(r.html or "") for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert len(pages) >= 50
    for html in pages:
        assert H.main_text(html) == slow_text(html)


def test_windows_find_the_article_without_its_element(spark, sf):
    """Recall and precision in words where no article element helps: all of the text, and nothing else."""
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").where("html is not null").collect()]
    same = sum(H.main_text(without_articles(h)) == H.main_text(h) for h in pages)
    assert same >= 0.99 * len(pages)


@pytest.mark.parametrize("part", ["<svg ", "<div>", "<!-- ", "<? ", '<a "', "<a ", "<p>x", "</i><b>", "&amp;", "<script>", "]]>"])
def test_long_pages_in_linear_time(part):
    began = time.time()
    H.main_text(part * (1_000_000 // len(part)) + ">")
    assert time.time() - began < 20


def test_raw_elements_and_cut_tags():
    body = "Some text of the article that is long enough to be kept by the windows of lines, as it should be. " * 2
    for page in (f"<p>{body}</p><script>if (a < b) {{ '<p>no</p>' }}</script>", f"<p>{body}</p><!-- <p>no</p> -->",
                 f"<p>{body}</p><svg/><style>p {{}}</style>", f"<p>{body}</p><script>no end", f"<p>{body}</p><a href='x", f"<p>{body}<!-- no"):
        assert H.main_text(page) == body.strip()
    assert H.main_text(f"<p>{body}a < b &lt; c</p>") == f"{body}a < b < c"
