"""Main text of web pages: parser events, text-to-tag ratios per line, Gaussian smoothing, threshold clustering.

The standard library's parser streams a page's events. A line is what stands between two block borders; its ratio is
its characters outside links by its tags. Ratios are smoothed along the page with a Gaussian, and lines at or above
their standard deviation make the content clusters. The clusters select the content region, the element that holds
most of them; of its lines all stay that no menu, advert, form or the like holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gives_back

#: Fixed values of HTML: elements that begin and end a line of text, those whose text is never shown or never an
#: article's, those that hold other blocks, and those without an end tag.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split())
HIDDEN = frozenset("applet area audio button canvas datalist embed iframe input label map math meter noembed noframes noscript object optgroup option output progress script select style svg template textarea title video".split())
FURNITURE = frozenset("aside dialog fieldset footer form menu nav search".split())
HOLDERS = frozenset("article body div main section td".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

#: Words of class and id attributes that name furniture.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies discussion disqus footer gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion recommended related replies reply respond share sharebar sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_UNSHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_HEAD = re.compile(r"h[1-6]")
_OPENING = re.compile(r"<[A-Za-z/!?]")


def named_furniture(attrs: dict[str, str | None]) -> bool:
    """Role, class, id or style say that an element is no part of an article."""
    if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or (attrs.get("role") or "").lower() in ROLES:
        return True
    if _UNSHOWN.search(attrs.get("style") or ""):
        return True
    words = _WORD.findall(f"{attrs.get('class') or ''} {attrs.get('id') or ''}")
    return any(w.lower() in NAMES for w in words)


class PageLines(HTMLParser):
    """The lines of a page in order: text, characters outside links, tags, the holder around it, furniture or not, heading or not."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.kind, self.barred, self.named = [-1], ["page"], [False], [False]  # by element; the page itself is element 0
        self.stack: list[tuple[str, int]] = [("page", 0)]
        self.open: dict[str, int] = {}
        self.lines: list[tuple[str, int, int, int, bool]] = []
        self.links = self.breaks = self.sections = 0  # sections: open articles and sections
        self._new(False)

    def _new(self, heading: bool) -> None:
        self.parts: list[str] = []
        self.plain, self.tags, self.heading = 0, 0, heading

    def border(self, heading: bool = False) -> None:
        """End the line."""
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.plain, self.tags, self.stack[-1][1], self.heading))
        self._new(heading)
        self.breaks = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.tags += 1
            self.breaks += 1
            self.parts.append(" ")
            if self.breaks == 2:  # two make a new block
                self.border()
            return
        hidden = tag in HIDDEN
        if tag in BLOCKS and not hidden:
            self.border(bool(_HEAD.fullmatch(tag)))
        self.tags += 1
        if tag in ("td", "th"):
            self.parts.append(" ")
        if tag == "a":
            self.links += 1
        if tag in VOID:
            return
        named = dict(attrs)
        article = tag in ("article", "main") or named.get("role") in ("article", "main")
        plain = hidden or tag in FURNITURE
        barred = plain or (tag not in ("html", "body") and named_furniture(named))
        if article and not barred:
            # What holds an article isn't furniture, whatever its class or id says.
            for name, at in reversed(self.stack):
                if self.kind[at] == "article" and not self.barred[at]:
                    break  # what is around it has been seen to
                if name not in FURNITURE and name not in HIDDEN:
                    self.barred[at] = False
        if tag == "header" and not self.sections:
            plain = barred = True
        if barred or tag in HOLDERS:
            self.parent.append(self.stack[-1][1])
            self.kind.append("article" if article else tag)
            self.barred.append(barred)
            self.named.append(barred and not plain)
            self.stack.append((tag, len(self.kind) - 1))
            self.sections += article or tag == "section"
            self.open[tag] = self.open.get(tag, 0) + 1
        elif tag in BLOCKS and tag not in ("p", "li", "dd", "dt", "tr", "html") and not _HEAD.fullmatch(tag):
            # Stands on the stack so that its end tag closes what was left open inside.
            self.stack.append((tag, self.stack[-1][1]))
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in BLOCKS:
            self.border()
        if self.open.get(tag):
            while True:
                name, at = self.stack.pop()
                self.open[name] -= 1
                self.sections -= at != self.stack[-1][1] and self.kind[at] in ("article", "section")
                if name == tag:
                    break
        self.tags += tag not in BLOCKS

    def handle_data(self, data: str) -> None:
        self.parts.append(data) if not self._hidden() else None
        if not data.isspace():
            self.breaks = 0
            self.plain += len(data) if not self.links and not self._hidden() else 0

    def _hidden(self) -> bool:
        return self.stack[-1][0] in HIDDEN


def smoothed(ratio: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing along the lines; at the page's ends the weights inside count alone."""
    reach = int(np.ceil(3 * sigma))
    weight = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    mid = slice(reach, reach + len(ratio))
    return np.convolve(ratio, weight)[mid] / np.convolve(np.ones(len(ratio)), weight)[mid]


def content_clusters(plain: np.ndarray, tags: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Whether each line is in a content cluster: its smoothed text-to-tag ratio reaches the ratios' standard deviation."""
    score = smoothed(plain / np.maximum(tags, 1), sigma)
    return (score >= score.std()) & (score > 0)


def _below(parent: list[int], marked: list[bool] | np.ndarray) -> np.ndarray:
    """By element: it or one around it is marked. Parents come before children."""
    out = np.array(marked, bool)
    for e in range(1, len(out)):
        out[e] |= out[parent[e]]
    return out


def main_text(html: str) -> str:
    """The article's lines, joined by line feeds; empty without any."""
    page = PageLines()
    page.feed(_cut_end(html))
    page.close()
    page.border()
    barred = _below(page.parent, page.barred)
    lines = [x for x in page.lines if not barred[x[3]]]
    if not lines:  # names that bar all there is say nothing
        barred = _below(page.parent, np.array(page.barred) & ~np.array(page.named))
        lines = [x for x in page.lines if not barred[x[3]]]
    if not lines:
        return ""
    plain, tags = (np.array([x[i] for x in lines], float) for i in (1, 2))
    cluster = content_clusters(plain, tags)
    # A line outside the clusters counts a little, so that a region of short lines can be told from an empty one.
    mass = np.zeros(len(page.kind))
    for w, x in zip((plain + 1) * np.where(cluster, 1, 0.01), lines, strict=True):
        mass[x[3]] += w
    for e in range(len(mass) - 1, 0, -1):
        mass[page.parent[e]] += mass[e]
    region, sure = _region(page, mass)
    inside = _below(page.parent, np.arange(len(mass)) == region)[[x[3] for x in lines]]
    at = np.flatnonzero(inside)
    if not sure and cluster[at].any():
        # No element says where the article begins and ends: the first and last cluster do, and headings before it.
        own = at[cluster[at]]
        low, high = own[0], own[-1]
        while low and inside[low - 1] and lines[low - 1][4]:
            low -= 1
        at = at[(at >= low) & (at <= high)]
    return "\n".join(lines[i][0] for i in at)


def _region(page: PageLines, mass: np.ndarray) -> tuple[int, bool]:
    """The element that holds the content clusters, and whether it is an article's."""
    parent = np.array(page.parent)
    heaviest = np.zeros(len(mass), np.int64)  # child of each element, 0 for none
    for e in range(1, len(mass)):
        if not heaviest[parent[e]] or mass[e] > mass[heaviest[parent[e]]]:
            heaviest[parent[e]] = e
    named = (np.array(page.kind) == "article") & (mass > 0)
    if named.any():
        around = np.append(False, _below(page.parent, named)[parent[1:]])  # an article holds it
        outer = np.flatnonzero(named & ~around)
        best = int(outer[np.argmax(mass[outer])])
        if len(outer) > 1 and mass[best] < 0.5 * mass[outer].sum():
            # Parts of one article: what holds nearly all of them.
            while best > 0 and mass[best] < 0.9 * mass[outer].sum():
                best = page.parent[best]
            return best, True
        # The innermost article with nearly all of it.
        at, least = best, 0.9 * mass[best]
        while heaviest[at] and mass[heaviest[at]] >= least:
            at = int(heaviest[at])
            best = at if named[at] else best
        return best, True
    at = 0
    while heaviest[at] and mass[at] and mass[heaviest[at]] >= 0.7 * mass[at]:
        at = int(heaviest[at])
    return at, False


def _cut_end(html: str) -> str:
    """The page without a comment or tag that its end has cut off."""
    start = html.find("<!--", max(html.rfind("-->"), 0))
    if start >= 0 and html.find("</script", start) < 0:
        html = html[:start]
    tag = _OPENING.search(html, html.rfind(">") + 1)
    return html[: tag.start()] if tag else html


@gives_back
def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 100):
            part = batch.slice(i, 100)
            texts = [main_text(h) if h else "" for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["row", "text", "n_chars"])


def extract_text(pages: DataFrame, html: str = "html", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all but the page itself, if not given), text and n_chars (code points) of each page.

    Null or empty pages, and pages without an article, give an empty text; repeated rows are told each for itself; an
    empty table gives an empty one. A page is parsed whole, whatever its length. Input columns named ``text`` or
    ``n_chars`` give way to the result's.
    """
    carry = [c for c in (pages.columns if carry is None else carry) if c not in (html, "text", "n_chars")]
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    rows = pages.select(F.struct(F.lit(0).alias("n"), *[quoted(c).alias(f"c{i}") for i, c in enumerate(carry)]).alias("row"), quoted(html).alias("html"))
    out = rows.mapInArrow(_extract, f"row {rows.schema['row'].dataType.simpleString()}, text string, n_chars long")
    return out.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(carry)], "text", "n_chars")
