"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page's events into lines, one for each block. A line has its
text and the tags met on the way; lines in menus, forms, notices and the like weigh
nothing. The ratios of text to tags are smoothed by a Gaussian and cut at their standard deviation; the
lines above are the content cluster. The region is the innermost container of all of it, and those around
as long as they add no block of links. All article and main elements belong to it wherever they are, and are
all of it if no block outside is in the cluster by its own ratio.
Every block of the region that is no boilerplate is kept, however short.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from functools import partial
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Spread of the smoothing in lines, and the share of a block's text in links that makes it one of links.
SIGMA, LINKED = 1.0, 0.5

# Elements of the HTML standard by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody tfoot thead "
    "tr ul".split()
)
BOILERPLATE = set(
    "head title script style noscript template nav footer aside form button select option textarea input menu dialog "
    "iframe object svg canvas audio video".split()
)
CONTAINERS = set("article main section div td body".split())
CLOSES_P = BLOCKS - {"body", "html", "tbody", "tfoot", "thead", "tr", "caption", "li", "dd", "dt"}
#: Words in a class, id or role that mark boilerplate anywhere, and outside of an article only.
MARKS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disclaimer disqus footer login menu modal nav navbar navigation newsletter pager "
    "pagination popup promo promoted promotion recommended related respond search share sharing sidebar signup skip "
    "social sponsor sponsored subscribe subscription toolbar widget contentinfo complementary".split()
)
OUTSIDE = set("header masthead topbar alert notice notices".split())
#: Words that say where or in what form something stands, and nothing of what it is.
FORM = set(
    "area articles bar block body bottom box btn button buttons card center col column container content entries entry "
    "extra feed field form group head heading icon icons inner input item items label left link links list main mobile "
    "modern module news outer page panel placement post posts primary region right row secondary section site slot "
    "small stories story strip text thread threads title to top unit view wrap wrapper zone".split()
)


def _marked(attributes: dict[str, str | None], inside: bool) -> bool:
    """A name marks if one of its words does and the others only tell its form: ``related-posts`` and not ``related-work``."""
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if "none" in re.findall(r"display\s*:\s*(\w+)", attributes.get("style") or ""):
        return True
    marks = MARKS if inside else MARKS | OUTSIDE
    for name in " ".join(attributes.get(x) or "" for x in ("class", "id", "role")).split():
        words = set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()))
        if words & marks and words <= marks | MARKS | OUTSIDE | FORM:
            return True
    return False


class Lines(HTMLParser):
    """Blocks of a page: text, tags, whether they are boilerplate, the innermost container, and whether they are links.

    Containers are numbered as they begin, so each has a greater number than its ``parents``. What an event asks of the open
    elements is counted as they open and close: each event takes the same time, however deep the page is nested.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, bool, int, bool]] = []
        self.open: list[tuple[str, bool, int]] = []  # name, boilerplate, number of the container or -1
        self.places: dict[str, list[int]] = defaultdict(list)  # of the open elements of each name
        self.walls: list[int] = []  # places of the open elements that are containers by name
        self.around: list[int] = [-1]  # numbers of the open containers
        self.kinds: list[str] = []
        self.parents: list[int] = []
        self.text: list[str] = []
        self.tags = self.linked = self.bad = 0

    def flush(self):
        text = " ".join("".join(self.text).split())
        if text:
            self.blocks.append((text, max(1, self.tags), self.bad > 0, self.around[-1], self.linked > LINKED * len(text)))
            self.tags = 0
        self.text, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P and self.places["p"]:
            self._close(self.places["p"][-1])
        elif tag in ("li", "dd", "dt", "option") and self.open and self.open[-1][0] == tag:
            self._close(len(self.open) - 1)
        if tag in BLOCKS:
            self.flush()
        elif tag in ("br", "td", "th"):
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        inside = bool(self.places["article"] or self.places["main"])
        bad = tag in BOILERPLATE or tag == "header" and not inside
        if not bad and attrs and tag not in ("html", "body") and not (self.places["pre"] or self.places["code"]):
            bad = _marked(dict(attrs), inside)
        number = -1
        if tag in CONTAINERS and not bad:
            number = len(self.kinds)
            self.kinds.append("main" if tag in ("article", "main") or dict(attrs).get("role") == "main" else tag)
            self.parents.append(self.around[-1])
        if bad and tag not in BLOCKS:  # its text is no part of the block around
            self.flush()
        self.places[tag].append(len(self.open))
        if tag in CONTAINERS:
            self.walls.append(len(self.open))
        if number >= 0:
            self.around.append(number)
        self.bad += bad
        self.open.append((tag, bad, number))

    def handle_endtag(self, tag):
        self.tags += 1
        if not self.places[tag]:
            return
        at = self.places[tag][-1]
        if tag not in BLOCKS | CONTAINERS and self.walls and self.walls[-1] > at:
            return  # a stray end tag closes nothing around the container
        self._close(at)

    def _close(self, at: int):
        if any(x[0] in BLOCKS or x[1] for x in self.open[at:]):
            self.flush()
        for tag, bad, number in reversed(self.open[at:]):
            self.places[tag].pop()
            if tag in CONTAINERS:
                self.walls.pop()
            if number >= 0:
                self.around.pop()
            self.bad -= bad
        del self.open[at:]

    def handle_data(self, data):
        self.text.append(data)
        if self.places["a"]:
            self.linked += len(" ".join(data.split()))


def _smoothed(ratios: np.ndarray) -> np.ndarray:
    reach = math.ceil(2 * SIGMA)
    kernel = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * SIGMA**2))
    padded = np.pad(ratios, reach)
    return np.convolve(padded, kernel / kernel.sum(), "valid")


def _totals(parents: list[int], places: list[int]) -> list[int]:
    """How many of the ``places`` lie in each container or deeper; the last figure is for the whole page."""
    totals = [0] * (len(parents) + 1)
    for place in places:
        totals[place] += 1
    for i in range(len(parents) - 1, -1, -1):
        totals[parents[i]] += totals[i]
    return totals


def _within(parents: list[int], chosen: set[int]) -> list[bool]:
    """Whether each container is one of the ``chosen`` or in one; the last is the page, which is not."""
    within = [False] * (len(parents) + 1)
    for i, parent in enumerate(parents):
        within[i] = i in chosen or within[parent]
    return within


def _region(page: Lines, content: list[bool], own: list[bool]) -> list[bool]:
    """Whether the blocks of each container are kept, and last those in none. ``own`` says which blocks of the content
    cluster are in it by their own ratio and not by their neighbours'."""
    blocks, parents = page.blocks, page.parents
    mains = {i for i, kind in enumerate(page.kinds) if kind == "main"}
    of_main = _within(parents, mains)
    if mains and all(of_main[b[3]] for b, chosen in zip(blocks, own) if chosen):
        return of_main
    held = _totals(parents, [b[3] for b, chosen in zip(blocks, content) if chosen])
    common = max((i for i in range(len(parents)) if held[i] == held[-1]), default=-1)
    links = _totals(parents, [b[3] for b in blocks if b[4] and not b[2]])
    while common >= 0:
        if links[parents[common]] > links[common]:
            return _within(parents, {common, *mains})
        common = parents[common]
    return [True] * (len(parents) + 1)


def main_text(html: str) -> str:
    """The blocks of the main text, one to a line."""
    page = Lines()
    page.feed(html)
    page.close()
    page.flush()
    blocks = page.blocks
    ratios = np.array([0.0 if b[2] else len(b[0]) / b[1] for b in blocks])
    if not ratios.any():
        return ""
    smooth = _smoothed(ratios)
    limit = min(smooth.std(), smooth.max())
    content = (smooth >= limit) & (ratios > 0)
    if not content.any():
        content = ratios > 0
    own = content & (ratios >= limit)
    region = _region(page, content.tolist(), (own if own.any() else content).tolist())
    return "\n".join(b[0] for b in blocks if not b[2] and region[b[3]])


def _extracted(names: list[str], batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            texts = [main_text(html or "") for html in rows["html"].to_pylist()]
            columns = [rows[name] for name in names]
            columns += [pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "text", "n_chars"])


def extracted(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns in ``keep`` of each row of ``pages``, and the ``text`` and ``n_chars`` of its main text.

    * A null or empty page, or one of boilerplate only, has an empty text.
    * Character references are decoded; white space in a block is one space; blocks are joined by ``\\n``.
    * A page of any length or depth takes time in proportion to its length; it is held in memory whole.
    * Rows are independent of each other; an empty table gives an empty result.
    * Columns that aren't kept are not looked at; those kept have any name but text and n_chars.
    """
    rows = pages.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)), F.col(html).cast("string").alias("html"))
    names = [f"c{i}" for i in range(len(keep))]
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{name} {kinds[name]}" for name in names) + ", text string, n_chars long"
    done = rows.mapInArrow(partial(_extracted, names), schema.removeprefix(", "))
    return done.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "text", "n_chars")
