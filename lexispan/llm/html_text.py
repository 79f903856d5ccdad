"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of words and tags (Pasternack and Roth, 2009).
Words score positive where the kind of element they stand in holds
article text on labelled pages, tags score negative, and one linear scan
finds the contiguous region of the largest total. Pages that mark their
article up (``article`` or ``main``) are the labelled ones: a bounded
sample of them gives the weights. The region is widened to the element
that holds all of it, and elements that are no part of an article are
left out: by tag, role or an unambiguous class or id. Inside an article
or the region, names that may mean either leave the choice to the
weights of the words.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.llm.common import bounded_choice
from lexispan.llm.words import row_slices

#: Labelled pages that the weights are fitted on.
SAMPLE = 1500
#: Weights without labelled pages: of a word, of a word in furniture, of a tag.
WORD, ASIDE, TAG = 1.0, -1.0, -3.25
#: Bound of a learnt weight, either way.
MOST = 3.5
_FURNITURE = "furniture"

# Elements without article text, block elements, elements
# without an end tag, words of classes, ids and roles that may mark the
# furniture of a page, and whole names (less "-" and "_") that do.
FURNITURE = set("nav header footer aside form script style noscript template iframe svg button select "
                "textarea dialog menu object canvas video audio head title map annotation annotation-xml".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset "
             "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre "
             "section summary table tbody td tfoot th thead title tr ul br caption option".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
MARKS = set("ad ads advert adverts advertisement advertising adbox adsbygoogle banner sponsor sponsored promo "
            "promotion cookie cookies consent gdpr notice notices alert popup modal overlay sidebar sidebars aside "
            "widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer "
            "comment comments commentlist reply replies respond disqus discussion related recommended share "
            "sharing social newsletter subscribe subscription signup login search pagination pager toolbar "
            "skip complementary contentinfo tracking".split())
SURE = set("ad ads advert adverts advertisement advertisements advertising adbox adbanner adblock adcontainer adslot "
           "adunit adwrapper adsbygoogle googlead sponsoredcontent sponsoredlinks commentlist comments commentsarea "
           "commentssection commentsection commentform disqus disqusthread cookienotice cookiebanner cookiebar "
           "cookieconsent cookiepopup gdpr gdprbanner consentbanner popup menu menus topmenu mainmenu sidemenu "
           "navmenu navbar navigation sitenav mainnav breadcrumb breadcrumbs pagination pager sharebuttons "
           "sharebar socialshare sharelinks sociallinks relatedposts relatedarticles relatedlinks "
           "newslettersignup newsletterform skiplink".split())
# Whole names that mark a container of furniture, also in an article,
# unless it is a section, or is named by its id, and has a heading of its own.
NAMES = set("sidebar sidebars comment notice notices newsletter related promo promos promotion banner banners "
            "sponsor sponsored".split())
CONTAINERS = set("div aside section ul ol".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# Elements that end an open one of the same group when they begin.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_RAW = "script|style|textarea|title|noscript|iframe|template|svg"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<svg(?=[\s/>])[^>]*/>"
    # A closed tag ends here unless its end tag follows before another begins.
    rf"|<(?P<closed>{_RAW})(?=[\s/>])[^>]*/>(?!(?:(?!<(?P=closed)[\s/>]).)*?</(?P=closed)\s*>)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z", re.DOTALL | re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class _Element:
    tag: str
    parent: int
    depth: int
    furniture: bool
    sure: bool  # furniture by a whole class or id
    marked: bool  # by a word of a class or id
    in_article: bool
    by_id: bool  # sure or marked by the id alone
    contains: bool = False  # named as a container of furniture
    of_article: bool = False  # in an article element
    holds_article: bool = False
    heads: bool = False  # a heading is its child
    doubtful: bool = False  # marked, the words decide
    aside: bool = False  # in such an element of a page without a marked article


@dataclass
class _Page:
    """Elements in page order, and items: (element, text) for text and
    (element, None) for tags; ``breaks`` are items that end a block."""

    elements: list[_Element] = field(default_factory=list)
    items: list[tuple[int, str | None]] = field(default_factory=list)
    breaks: set[int] = field(default_factory=set)


def _marked(attrs: str) -> tuple[bool, bool, bool, bool, bool]:
    """(hidden or furniture by role, furniture by a whole class or id, by
    a word of one, by the id alone, named as a container of it)."""
    hidden = sure = named = by_class = contains = False
    for name, value in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            whole = any(w.lower().replace("-", "").replace("_", "") in SURE for w in value.split())
            contains |= any(w.lower() in NAMES for w in value.split())
            word = whole or any(w.lower() in MARKS for w in _NAME_WORDS.findall(value))
            sure, named, by_class = sure or whole, named or word, by_class or (word and name == "class")
        elif name == "role":
            hidden |= value.lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "form",
                                        "alert", "dialog", "menu", "menubar", "alertdialog")
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
    return hidden, sure, named, named and not by_class, contains


def _parse(source: str) -> _Page:
    page = _Page()
    page.elements.append(_Element("", -1, 0, False, False, False, False, False))
    open_, at = [0], 0

    def text(part: str) -> None:
        if part:
            page.items.append((open_[-1], html.unescape(part)))

    def mark(tag: str) -> None:
        if tag in BLOCKS:
            page.breaks.add(len(page.items))
        page.items.append((open_[-1], None))

    for token in _TOKEN.finditer(source):
        text(source[at:token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if token["end"]:
            place = next((i for i in range(len(open_) - 1, 0, -1) if page.elements[open_[i]].tag == tag), 0)
            mark(tag)
            if place:
                del open_[place:]
            continue
        for i in range(len(open_) - 1, 0, -1):
            inner = page.elements[open_[i]].tag
            if inner in ENDS.get(tag, ()) or (inner == "p" and tag in BLOCKS and tag != "br"):
                del open_[i:]
                break
            if inner in BLOCKS:
                break
        above = page.elements[open_[-1]]
        attrs = token["attrs"]
        hidden, sure, named, by_id, contains = _marked(attrs) if attrs else (False,) * 5
        in_article = tag == "header" and above.of_article
        furniture = above.furniture or hidden or (tag in FURNITURE and not in_article)
        free = tag in HEADINGS or tag in ("html", "body", "article", "main")
        page.elements.append(_Element(tag, open_[-1], above.depth + 1, furniture, sure and not free,
                                      named and not free, above.in_article or tag in ("article", "main"), by_id,
                                      contains and tag in CONTAINERS, above.of_article or tag == "article"))
        above.heads |= tag in HEADINGS
        number = len(page.elements) - 1
        if tag in ("article", "main", "h1") and not furniture:
            up = open_[-1]
            while up > 0 and not page.elements[up].holds_article:
                page.elements[up].holds_article = True
                up = page.elements[up].parent
        if tag not in VOID and not attrs.rstrip().endswith("/"):
            open_.append(number)
            mark(tag)
        else:
            mark(tag)
    text(source[at:])
    # A class that names furniture counts unless its element holds the
    # article (a page laid out "with-sidebar" has one). A section's id
    # may be made of its heading.
    has_article = any(e.in_article and not e.furniture for e in page.elements)
    for element in page.elements[1:]:
        above = page.elements[element.parent]
        element.furniture |= above.furniture
        element.aside = above.aside
        headed = element.tag == "section" and element.heads and element.by_id
        if element.holds_article or not element.marked or headed:
            continue
        own_heading = element.heads and (element.by_id or element.tag == "section")
        if element.sure or (element.contains and not own_heading) or (has_article and not element.in_article):
            element.furniture = True
        else:
            element.doubtful = True
            element.aside |= not has_article
    return page


def _leave_out(page: _Page, learnt: dict[str, float]) -> None:
    """Doubtful elements whose words score below zero are furniture."""
    if not any(e.doubtful for e in page.elements):
        return
    worth = [0.0] * len(page.elements)
    for number, text in page.items:
        if text is not None and not page.elements[number].furniture:
            worth[number] += learnt.get(_kind(page, number), WORD) * len(text.split())
    for number in range(len(worth) - 1, 0, -1):  # elements are numbered in page order
        worth[page.elements[number].parent] += worth[number]
    for number, element in enumerate(page.elements[1:], 1):
        element.furniture |= page.elements[element.parent].furniture or (element.doubtful and worth[number] < 0)


def _kind(page: _Page, number: int) -> str:
    """What a word stands in: its block element, and whether in a link."""
    link = ""
    while number > 0 and page.elements[number].tag not in BLOCKS:
        if page.elements[number].tag == "a":
            link = " link"
        number = page.elements[number].parent
    return f"{page.elements[number].tag}{link}"


def count_kinds(source: str) -> Counter:
    """((kind, inside the marked article), times) of a labelled page's
    words and tags. Furniture counts as outside, all of it as one kind,
    so that an advert in a ``div`` says nothing of other ``div``."""
    page, counts = _parse(source), Counter()
    for number, text in page.items:
        inside = page.elements[number].in_article and not page.elements[number].furniture
        if text is None:
            counts["<" + page.elements[number].tag, inside] += 1
        elif page.elements[number].furniture:
            counts[_FURNITURE, False] += len(text.split())
        elif words := len(text.split()):
            counts[_kind(page, number), inside] += words
    return counts


def weights(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log-odds of standing in an article, for each kind of word and tag;
    tags score below zero."""
    total = [sum(n for (k, i), n in counts.items() if i == side) + 1.0 for side in (False, True)]
    found = {}
    for kind in {k for k, _ in counts}:
        odds = math.log((counts.get((kind, True), 0) + 0.5) / total[1]) - math.log(
            (counts.get((kind, False), 0) + 0.5) / total[0])
        found[kind] = float(np.clip(odds, -MOST, -0.1 if kind[:1] == "<" else MOST))
    return found


def best_region(scores: list[float]) -> tuple[int, int]:
    """(first, end) of the contiguous part of the largest sum, the
    first such; (0, 0) where no score is positive."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, region = total, (start, i + 1)
    return region


def main_text(source: str, learnt: dict[str, float]) -> str:
    """The main text of one page: blocks joined by one line feed."""
    page = _parse(source)
    _leave_out(page, learnt)
    scores, kinds = [], {}
    for number, text in page.items:
        element = page.elements[number]
        if text is None:
            scores.append(learnt.get("<" + element.tag, TAG))
        elif element.furniture or element.aside:
            scores.append(learnt.get(_FURNITURE, ASIDE) * len(text.split()))
        else:
            if number not in kinds:
                kinds[number] = learnt.get(_kind(page, number), WORD)
            scores.append(kinds[number] * len(text.split()))
    first, end = best_region(scores)
    if first == end:
        return ""
    # Widen to the element that holds the region, and further as long as
    # the words that come in are no furniture and score no less than zero.
    # Elements are numbered in page order: an element's descendants follow
    # it up to its last one.
    elements = page.elements
    last = list(range(len(elements)))
    for number in range(len(elements) - 1, 0, -1):
        last[elements[number].parent] = max(last[elements[number].parent], last[number])
    held, worth = [], [0.0] * len(elements)
    for i, (number, text) in enumerate(page.items):
        if text is None or elements[number].furniture or not text.strip():
            continue
        if first <= i < end:
            held.append(number)
        worth[number] += scores[i]
    upto = [0.0, *accumulate(worth)]

    def below(number: int) -> float:
        return upto[last[number] + 1] - upto[number]
    holder, furthest = min(held, default=0), max(held, default=0)
    while last[holder] < furthest:
        holder = elements[holder].parent
    up = holder
    while up > 0 and elements[up].tag not in ("html", "body"):
        if below(up) < below(holder) - 1e-9:
            break
        holder, up = up, elements[up].parent
    whole = holder > 0 and elements[holder].tag not in ("html", "body")
    blocks, line = [], []
    for i, (number, text) in enumerate(page.items):
        if i in page.breaks:
            blocks.append("".join(line))
            line = []
        if text is None or elements[number].furniture:
            continue
        if (whole and holder <= number <= last[holder]) or (not whole and first <= i < end):
            line.append(text)
    blocks.append("".join(line))
    cleaned = (" ".join(block.split()) for block in blocks)
    return "\n".join(block for block in cleaned if block)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = Counter()
    for batch in batches:
        for source in batch.column("html"):
            counts.update(count_kinds(source.as_py()))
    rows = [(k, i, n) for (k, i), n in counts.items()]
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
        columns, (pa.string(), pa.bool_(), pa.int64()), strict=True)], names=["kind", "inside", "n"])


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Weights from a bounded sample of pages with marked-up articles."""
    labelled = pages.where(F.col(html_col).rlike("(?i)<(article|main)[ >]"))
    chosen = bounded_choice(labelled.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")),
                            sample, "id", "html").select("html")
    counted = chosen.mapInArrow(_count, "kind string, inside boolean, n long")
    # One row for each kind of element and side.
    rows = counted.groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect()
    return weights({(r["kind"], r["inside"]): r["n"] for r in rows})


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 sample: int = SAMPLE) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars.

    Null or empty html, and pages without article text, give an empty
    text. Repeated rows are each extracted; an empty table gives an
    empty result; other columns are not read.
    """
    learnt = fit(pages, id_col, html_col, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end in row_slices(batch.column("html")):
                own = batch.slice(at, end - at)
                texts = [main_text(source.as_py(), learnt) for source in own.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [own.column("page_id"), own.column("url"), pa.array(texts, pa.string()),
                     pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
