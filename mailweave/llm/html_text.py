"""Main text of web pages: flat blocks, described by their neighbours, judged by a decision tree.

A page is cut into flat blocks of text at its block-level tags. A block is described by its
number of words and its link density (the share of its words inside links), by those of the
blocks before and after it, and by where it stands: inside an article, outside of one on a page
that has one, in a part for other things (menus, footers, forms, ...), in a part whose class or id
names such a thing, in a heading. A decision tree grown from the small labelled table below says
which blocks are main text; the chosen ones are joined by line breaks. Names are one number among
the others: the share of the names of the nearest named part that as a whole mean something else
than text ("cookie-banner", but not "has-sidebar"); the page itself and ``main`` have none.

Each page is read once, within its row and in time linear in its length; nothing is shuffled. The
tree is grown on the driver from the table, whatever the input.

Edge cases: null, empty and tag-only pages give the empty text. Comments, scripts, styles,
text areas and titles without an end go to the end of the page; of other parts that show no text
(``UNSEEN``) only the tag is left out then, and an empty ``<svg ... />`` is over at once. A tag that
does not end takes the rest of the page with it, as in browsers; a value whose quote does not end
stops at the next ``>``. Text in the head outside such parts starts the body, as in browsers.
Formulas are text. White space of any kind inside a block becomes one space. Repeated
pages are handled each; extra columns are kept, but an existing column ``text`` is replaced. An
empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.llm.common import table

# Kinds of tags.
TO_THE_END = {"script", "style", "textarea", "title"}  # of the page, if not ended
UNSEEN = TO_THE_END | set("noscript template svg iframe object select canvas audio video annotation annotation-xml".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr nobr "
    "math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle "
    "merror mpadded mphantom mmultiscripts mprescripts mtable mtr mtd".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = {"article", "main"}
PAGE = {"html", "body", "main"}
ASIDE = {"nav", "footer", "aside", "menu", "button", "dialog"}
HALF_ASIDE = {"form"}  # some pages stand in one as a whole
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Words in names of parts that are no text, and words that say nothing beside them.
READERS = set("comment comments commentlist replies reply respond responses discussion disqus".split())
OTHER = READERS | set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice alert "
    "gdpr popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer sidebar widget "
    "widgets related recommended share sharing social subscribe newsletter signup login search pagination pager toolbar skip".split()
)
PLAIN = set(
    "site page main top bottom left right global primary secondary box bar block area section container wrapper wrap inner "
    "outer list item items group content links link buttons icons form message text the my".split()
)
TEXT = {"post", "article", "entry", "story", "user"}  # beside a name of READERS
ROLE = re.compile(r"role\s*=\s*[\"']?(?:navigation|banner|contentinfo|complementary|search|form|dialog|alert)", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
CLASS_OR_ID = re.compile(r"(?:^|\s)(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
STOP = re.compile(r"[=>]")
GAP = re.compile(r"\s*")
UNQUOTED = re.compile(r"[^\s>]*")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in UNSEEN}

FEATURES = [
    "words", "links", "words_before", "links_before", "words_after", "links_after", "article", "aside", "named", "heading",
]

# Labelled blocks: the features in this order, and 1 for main text. Article is 1 inside of one, -1
# outside on a page that has one, 0 on a page without; aside is 0.5 in a form. ``/`` parts the
# values of a feature that share the label, ``*`` stands for all of ``GRID``.
GRID = {
    "words": "2/6/15/40/120", "links": "0/.3/1", "words_before": "0/5/40", "links_before": "0/1", "words_after": "0/5/40",
    "links_after": "0/1", "article": "-1/0/1", "aside": "0/.5/1", "named": "0/.5/1", "heading": "0/1",
}
LABELLED = """
*      *    *    * *    * -1 *    *    *  0
*      *    *    * *    *  1 .5/1 *    *  0
*      0/.3 *    * *    *  1 0    0    *  1
*      1    *    0 *    0  1 0    0    *  1
*      1    *    1 *    *  1 0    0    *  0
*      1    *    0 *    1  1 0    0    *  0
*      *    *    * *    *  1 0    .5/1 0  0
*      *    0    * 5/40 0  1 0    .5/1 1  1
*      *    5    1 5/40 0  1 0    .5/1 1  1
*      *    5/40 0 *    *  1 0    .5/1 1  0
*      *    *    * 0    *  1 0    .5/1 1  0
*      *    *    * *    *  0 1    *    *  0
*      *    *    * *    *  0 0/.5 .5/1 *  0
40/120 0/.3 *    * *    *  0 0/.5 0    0  1
15     0/.3 40   0 *    *  0 0/.5 0    0  1
15     0/.3 *    * 40   0  0 0/.5 0    0  1
15     0/.3 0/5  0 0/5  0  0 0    0    0  1
15     0/.3 0/5  0 0/5  0  0 .5   0    0  0
15     0/.3 0/5  1 0/5  *  0 0/.5 0    0  0
15     0/.3 0/5  * 0/5  1  0 0/.5 0    0  0
2/6    *    40   0 40   0  0 0/.5 0    0  1
6      0/.3 40   0 0/5  0  0 0    0    0  1
6      0/.3 40   0 0/5  *  0 .5   0    0  0
6      0/.3 0/5  0 5    0  0 0    0    0  0
6      0/.3 5    0 0    0  0 0    0    0  0
2      *    0/5  * *    *  0 0/.5 0    0  0
2      *    *    * 0/5  *  0 0/.5 0    0  0
6      *    *    1 *    *  0 0/.5 0    0  0
6      *    *    * *    1  0 0/.5 0    0  0
*      1    40   0 40   0  0 0/.5 0    0  1
*      1    *    1 *    *  0 0/.5 0    0  0
*      1    *    * *    1  0 0/.5 0    0  0
*      1    0/5  0 *    0  0 0/.5 0    0  0
*      *    *    * 40   0  0 0/.5 0    1  1
*      0/.3 *    0 5    0  0 0    0    1  1
*      *    *    * 5    0  0 .5   0    1  0
*      *    *    * 0    *  0 0/.5 0    1  0
*      *    *    * 5/40 1  0 0/.5 0    1  0
"""


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """The features and labels of the table, a row for each combination of values."""
    rows = []
    for line in LABELLED.strip().split("\n"):
        *values, label = line.split()
        each = [(GRID[name] if v == "*" else v).split("/") for name, v in zip(FEATURES, values)]
        rows += [[*map(float, row), float(label)] for row in product(*each)]
    table = np.array(rows)
    return table[:, :-1], table[:, -1]


def grow(x: np.ndarray, y: np.ndarray, depth: int = 14) -> tuple | float:
    """A decision tree by Gini impurity: ``(feature, threshold, below, above)`` or a leaf's share."""
    if depth == 0 or y.min() == y.max():
        return float(y.mean())
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            cost = sum(part.sum() * y[part].mean() * (1 - y[part].mean()) for part in (low, ~low))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, float(cut), low)
    if best is None:
        return float(y.mean())
    _, f, cut, low = best
    return f, cut, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def judge(tree: tuple | float, row: list[float]) -> bool:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree >= 0.5


class Tag(NamedTuple):
    start: int
    end: int
    name: str  # empty for comments and declarations
    closing: bool
    rest: str


class Scanner:
    """The tags of a page in order. Every character is looked at a bounded number of times."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.unended: set[str] = set()  # quotes that do not occur any more

    def next(self, at: int) -> Tag | None:
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return Tag(start, len(page) if end < 0 else end + 3, "", False, "")
            if page.startswith(("<!", "<?"), start):
                end = page.find(">", start)
                return Tag(start, len(page) if end < 0 else end + 1, "", False, "")
            closing = page.startswith("/", start + 1)
            name = NAME.match(page, start + 1 + closing)
            if name:
                end = self._end(name.end())
                return Tag(start, end, name[0].lower(), closing, page[name.end() : end].removesuffix(">"))
            at = start + 1  # a mere sign
        return None

    def _end(self, at: int) -> int:
        """Where a tag ends whose name ends at ``at``: the first ``>`` outside of quoted values."""
        page = self.page
        while stop := STOP.search(page, at):
            at = stop.end()
            if stop[0] == ">":
                return at
            at = GAP.match(page, at).end()
            quote = page[at : at + 1]
            if quote not in ("'", '"'):
                at = UNQUOTED.match(page, at).end()
                continue
            close = -1 if quote in self.unended else page.find(quote, at + 1)
            if close < 0:
                self.unended.add(quote)
                end = page.find(">", at)
                return len(page) if end < 0 else end + 1
            at = close + 1
        return len(page)


def named(rest: str, among: set[str] = OTHER) -> float:
    """The share of a tag's names that mean a part for other things than text, as a whole."""
    names = " ".join(a or b or c for a, b, c in CLASS_OR_ID.findall(rest)).split() if rest else []
    hits = 0
    for name in names:
        words = {w.lower() for w in WORD.findall(name)}
        hits += bool(words & READERS and words <= READERS | PLAIN | TEXT or words & among and words <= among | PLAIN)
    return hits / len(names) if names else 0.0


class Part(NamedTuple):
    """An open block-level tag and what holds inside of it."""

    tag: str
    article: bool
    aside: float
    named: float
    readers: bool
    heading: bool


NOWHERE = Part("", False, 0.0, 0.0, False, False)


def inside(parent: Part, tag: str, rest: str) -> Part:
    own = 0.0 if tag in PAGE else named(rest)
    readers = parent.readers or (own > 0 and named(rest, READERS) > 0)
    off = float(tag in ASIDE or (tag == "header" and not parent.article)) or 0.5 * (tag in HALF_ASIDE)
    if rest and tag not in PAGE and (ROLE.search(rest) or HIDDEN.search(rest)):
        off = 1.0
    if tag in ARTICLE and not parent.article:
        # What an article stands in says nothing of it, unless readers write there.
        return Part(tag, True, 0.0, max(own, float(parent.readers)), readers, False)
    return Part(
        tag, parent.article or tag in ARTICLE, max(parent.aside, off), max(parent.named, own), readers, tag in HEADING
    )


def blocks(page: str) -> list[tuple[str, list[float]]]:
    """Text of every block in page order with ``(words, links, article, aside, named, heading)``."""
    found: list[tuple[str, list[float]]] = []
    stack: list[Part] = []
    opened: Counter[str] = Counter()
    pieces: list[str] = []
    linked: list[str] = []
    in_link = False

    def close_block() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                n = len(text.split(" "))
                link_words = len(html.unescape("".join(linked)).split()) if linked else 0
                where = stack[-1] if stack else NOWHERE
                state = (where.article, where.aside, where.named, where.heading)
                found.append((text, [n, min(1.0, link_words / n), *map(float, state)]))
            pieces.clear()
            linked.clear()

    def leave(depth: int) -> None:
        for part in stack[depth:]:
            opened[part.tag] -= 1
        del stack[depth:]

    scanner, at = Scanner(page), 0
    endless: set[str] = set()  # tags without a further end
    while m := scanner.next(at):
        if m.start > at:
            piece = page[at : m.start]
            pieces.append(piece)
            if in_link:
                linked.append(piece)
        at, tag = m.end, m.name
        if not tag:
            continue
        if tag in UNSEEN and not m.closing:
            if tag == "svg" and m.rest.endswith("/"):
                continue
            end = None if tag in endless else END[tag].search(page, at)
            if end:
                at = end.end()
            elif tag in TO_THE_END:
                at = len(page)
            else:
                endless.add(tag)
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = not m.closing
                linked.append(" ")
            elif tag == "br":
                pieces.append(" ")
            continue
        close_block()
        in_link = False
        if m.closing:
            if opened[tag]:
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                leave(depth)
        elif tag not in VOID and tag != "head" and not m.rest.endswith("/"):
            if tag in ("p", "li", *HEADING) and stack and stack[-1].tag in ("p", *HEADING):
                leave(len(stack) - 1)  # those end by themselves
            stack.append(inside(stack[-1] if stack else NOWHERE, tag, m.rest))
            opened[tag] += 1
    if at < len(page):
        pieces.append(page[at:])
        if in_link:
            linked.append(page[at:])
    close_block()
    return found


def main_text(page: str, tree: tuple | float) -> str:
    found = blocks(page)
    near = [(0.0, 0.0), *[(b[1][0], b[1][1]) for b in found], (0.0, 0.0)]
    outside = -1.0 if any(b[1][2] for b in found) else 0.0
    chosen = []
    for k, (text, (n, links, article, *rest)) in enumerate(found):
        if judge(tree, [n, links, *near[k], *near[k + 2], article or outside, *rest]):
            chosen.append(text)
    return "\n".join(chosen)


def extract_text(pages: DataFrame, page: str = "html") -> DataFrame:
    """All columns of ``pages`` and ``text``."""
    tree = grow(*labelled())
    kept = [f for f in pages.schema.fields if f.name.lower() != "text" or f.name == page]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                texts = [main_text(h or "", tree) for h in batch.column(page).to_pylist()]
                columns = [*[batch.column(f.name) for f in kept], pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*[f.name for f in kept], "text"])

    return pages.mapInArrow(extract, T.StructType([*kept, T.StructField("text", T.StringType())]))


def op9_html_text(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars")
    )
