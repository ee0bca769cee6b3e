"""Main text of web pages by consensus host paths.

Every page scores its containers and votes for the generalised path (tags and
classes, digits blanked) of the best one. Spark adds the votes up by host; all
voted paths are joined with the paths on which each page has text, and the page is
extracted again with its best one. A page without any uses its own best container.

Work on a page grows with its size however deeply its tags are nested: paths are
running digests, and texts are added up from the innermost elements outwards.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import batches, ready, text_of
from clicktide.session import settle

# HTML elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
SKIPPED = frozenset(
    "script style textarea title noscript iframe xmp noembed noframes head nav header footer aside template svg math "
    "label button select option dialog menu object canvas audio video".split()
)
CONTAINERS = frozenset("article main section div td body center".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var wbr img".split()
)
# An opening tag of the left closes an open element of the right, up to the nearest container.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
CLOSE_P = frozenset(
    "p div article section main aside header footer nav form ul ol dl table h1 h2 h3 h4 h5 h6 pre blockquote hr address figure fieldset".split()
)
SCOPE = frozenset("article main section div td th body table ul ol dl html".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td".split())
# Words of class, id and role that mark what is not the article.
NOT_MAIN = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos promotion banner cookie cookies "
    "consent gdpr notice notices notification popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer "
    "header masthead topbar toolbar comment comments disqus reply replies respond share sharing social related recommended recommendations "
    "newsletter subscribe subscription signup login search widget widgets pagination pager disclaimer copyright skip outbrain taboola "
    "contentinfo complementary".split()
)
LIKELY_MAIN = frozenset("article content post entry story main body text page blog hentry".split())

MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</[^a-zA-Z>][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
DIGITS = re.compile(r"\d+")
WORDS = re.compile(r"[^a-z0-9]+")


@dataclass
class Element:
    tag: str
    step: str  # tag and generalised classes
    key: bytes  # MD5 of the path: all steps down to here, joined by ">"
    parent: int
    main: bool  # may be part of an article; nothing within boilerplate may
    likely: bool
    marked: bool = False  # boilerplate by a word of its class, id or role only
    texts: int = 0  # characters in its main text
    links: int = 0  # of them in links
    prose: int = 0  # of them in paragraphs and headings
    other: int = 0  # characters of boilerplate within


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    # (innermost element, text) in page order; None is a break between blocks.
    pieces: list[tuple[int, str | None]] = field(default_factory=list)

    def path(self, k: int) -> str:
        steps = []
        while k >= 0:
            steps.append(self.elements[k].step)
            k = self.elements[k].parent
        return ">".join(reversed(steps))


class OpenTags:
    """The stack of open elements, with the places of each tag on it."""

    def __init__(self) -> None:
        self.numbers: list[int] = []  # of the elements
        self.tags: list[str] = []
        self.digests: list = []  # running MD5 of each path
        self.places: dict[str, list[int]] = defaultdict(list)

    def push(self, number: int, tag: str, digest) -> None:
        self.places[tag].append(len(self.numbers))
        self.numbers.append(number)
        self.tags.append(tag)
        self.digests.append(digest)

    def close_from(self, place: int) -> None:
        while len(self.numbers) > place:
            self.places[self.tags.pop()].pop()
            self.numbers.pop()
            self.digests.pop()

    def innermost(self, tag: str) -> int:
        """Place of the last open one; 0, the root's, if there is none."""
        found = self.places.get(tag)
        return found[-1] if found else 0

    def close_all(self, tags: set[str]) -> None:
        """Close every open one of these tags, and what is within, up to the nearest container."""
        if not any(self.places.get(t) for t in tags):
            return
        upto = max(self.innermost(t) for t in SCOPE - tags)
        within = [self.places[t][k] for t in tags if (k := bisect_right(self.places[t], upto)) < len(self.places[t])]
        if within:
            self.close_from(min(within))


def attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(double or single or bare))
    return found


def _element(tag: str, source: str, parent: int, above) -> tuple[Element, object]:
    """An element and the running digest of its path; ``above`` is that of its parent."""
    attrs = attributes(source) if source.strip(" /\n\t") else {}
    classes = sorted({DIGITS.sub("#", c) for c in attrs.get("class", "").split()})
    names = {n: set(WORDS.split(n)) for n in " ".join(attrs.get(k, "") for k in ("class", "id", "role")).lower().split()}
    words = set().union(*names.values())
    hidden = "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", attrs.get("style", ""))
    frame = tag in ("html", "body", "main")
    main = frame or (tag not in SKIPPED and not hidden)
    # "post comments-open" and "content with-sidebar" name an article and its surroundings, "comment-body" names none.
    marks = {n for n, w in names.items() if w & NOT_MAIN}
    article = not marks & NOT_MAIN and any(w & LIKELY_MAIN for n, w in names.items() if n not in marks)
    step = ".".join([tag, *classes])
    digest = above.copy()
    digest.update(f">{step}".encode("utf-8", "replace"))
    # A form goes as boilerplate does, unless the page is wrapped in it.
    likely = tag in ("article", "main", "form") or bool(words & LIKELY_MAIN)
    marked = tag == "form" or (not frame and bool(marks) and not article)
    return Element(tag, step, digest.digest(), parent, main, likely, main and marked), digest


def _inherit(page: Page) -> None:
    """Boilerplate by a word goes, unless it looks like the article and holds most of the page's prose; all within goes with it."""
    inside: list[bool] = []  # a paragraph or heading
    for e in page.elements:  # parents come first
        e.main = e.main and (e.parent < 0 or page.elements[e.parent].main)
        inside.append(e.tag in PROSE or (e.parent >= 0 and inside[e.parent]))
    if any(e.marked and e.likely and e.main for e in page.elements):
        prose, total = [0] * len(page.elements), 0
        for inner, text in page.pieces:
            if text and page.elements[inner].main:
                total += len(text.strip())
                prose[inner] += len(text.strip()) * inside[inner]
        for k in range(len(prose) - 1, 0, -1):
            prose[page.elements[k].parent] += prose[k]
        for e, size in zip(page.elements, prose, strict=True):
            # A form must hold most of all text as well: one with the only paragraphs of a page may ask for a comment.
            e.marked = e.marked and not (e.likely and size * 5 > prose[0] * 4 and (e.tag != "form" or size * 2 > total))
    for e in page.elements:
        e.main = e.main and not e.marked and (e.parent < 0 or page.elements[e.parent].main)


def parse(source: str) -> Page:
    """Elements and texts of one page; unclosed and stray tags are mended as browsers do, roughly."""
    page, opened, at, end = Page(), OpenTags(), 0, len(source)
    root = hashlib.md5(b"html")
    page.elements.append(Element("html", "html", root.digest(), -1, True, False))
    opened.push(0, "html", root)
    while at <= end:
        tag_at = MARKUP.search(source, at)
        upto = tag_at.start() if tag_at else end
        if upto > at:
            page.pieces.append((opened.numbers[-1], source[at:upto]))
        if not tag_at:
            break
        at = tag_at.end() if tag_at.end() > tag_at.start() else end + 1
        closing, tag, attrs = tag_at.group(1, 2, 3) if tag_at.group(2) else tag_at.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            page.pieces.append((opened.numbers[-1], None))
        if closing:
            if place := opened.innermost(tag):
                opened.close_from(place)
            continue
        if tag == "html":
            continue
        if tag == "body":
            opened.close_from(1)
        shut = CLOSES.get(tag, set()) | ({"p"} if tag in CLOSE_P else set())
        if shut:
            opened.close_all(shut)
        element, digest = _element(tag, attrs, opened.numbers[-1], opened.digests[-1])
        page.elements.append(element)
        if tag in RAW:
            ended = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            at = ended.end() if ended else end + 1
        elif tag not in VOID and not (attrs.endswith("/") and tag in ("svg", "path", "circle", "rect", "use")):
            opened.push(len(page.elements) - 1, tag, digest)
    _inherit(page)
    return page


def _score(page: Page) -> None:
    """Add every text to the elements that it is main text of, and as boilerplate to those above."""
    elements = page.elements
    for inner, text in page.pieces:
        size = len(text.strip()) if text and html.unescape(text).strip() else 0
        if elements[inner].main:
            elements[inner].texts += size
        else:
            elements[inner].other += size
    # Parents come first, so from the last element on each one is complete when it is added to its parent.
    for e in reversed(elements):
        if e.tag == "a":
            e.links = e.texts
        if e.tag in PROSE:
            e.prose = e.texts
        if e.parent >= 0:
            above = elements[e.parent]
            above.texts += e.texts
            above.links += e.links
            above.prose += e.prose
            above.other += e.other


def vote(page: Page) -> tuple[int, float]:
    """The container that looks most like the article, and its score; -1 if there is no text.

    Prose counts, links and boilerplate within count against a container, and the
    innermost of equals wins.
    """
    _score(page)
    best, most = -1, 0.0
    for k, e in enumerate(page.elements):
        if (e.tag in CONTAINERS or k == 0) and e.main and e.texts:
            worth = (e.texts + e.prose - 2 * e.links - e.other) * (1.25 if e.likely else 1.0)
            worth = max(worth, 1e-6 * e.texts)
            if worth >= most:
                best, most = k, worth
    return best, most


def extract(page: Page, key: bytes) -> str:
    """Main text of all elements on the path with this digest, in page order."""
    chosen: list[bool] = []
    for e in page.elements:  # parents come first
        chosen.append(e.main and (e.key == key or (e.parent >= 0 and chosen[e.parent])))
    blocks: list[str] = []
    for inner, text in page.pieces:
        if text is None:
            blocks.append(" ")
        elif chosen[inner]:
            blocks.append(html.unescape(text))
    return " ".join("".join(blocks).split())


def _looks(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Vote of each page, and the digests of the paths of all its containers with text."""
    for part in parts:
        out: dict[str, list] = {"page": [], "host": [], "path": [], "score": [], "have": []}
        for number, host, source in zip(*(part.column(c).to_pylist() for c in ("page", "host", "html")), strict=True):
            page = parse(source)
            best, score = vote(page)
            if best < 0:
                continue
            have = {e.key for k, e in enumerate(page.elements) if (e.tag in CONTAINERS or k == 0) and e.main and e.texts}
            for column, value in zip(out, (number, host, page.path(best), score, sorted(have)), strict=True):
                out[column].append(value)
        yield out


def _texts(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for part in parts:
        out: dict[str, list] = {"page_id": part.column("page_id"), "url": part.column("url"), "text": [], "path": []}
        for source, used in zip(*(part.column(c).to_pylist() for c in ("html", "path")), strict=True):
            page = parse(source)
            found = extract(page, hashlib.md5(used.encode()).digest()) if used is not None else ""
            if not found:
                best = vote(page)[0]
                used = page.path(best) if best >= 0 else None
                found = extract(page, page.elements[best].key) if best >= 0 else ""
            out["text"].append(found)
            out["path"].append(used)
        yield out


LOOKS = pa.schema([("page", pa.binary()), ("host", pa.string()), ("path", pa.string()), ("score", pa.float64()), ("have", pa.list_(pa.binary()))])
TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("path", pa.string())])


def host_of(url: str = "url"):
    """Host in lower case without user, port and leading ``www.``; empty if there is none."""
    host = F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.regexp_replace(host, r"^www\.", "")


def _keyed(pages: DataFrame) -> DataFrame:
    rows = pages.select("page_id", "url", text_of("html").alias("html"), host_of().alias("host"))
    # Pages of one host with the same source have the same path.
    return rows.withColumn("page", F.unhex(F.md5(F.concat_ws(" ", "host", "html").cast("binary"))))


def _look(rows: DataFrame) -> DataFrame:
    looks = "page binary, host string, path string, score double, have array<binary>"
    return rows.select("page", "host", "html").mapInArrow(lambda parts: batches(_looks(parts), LOOKS), looks)


def _added(looks: DataFrame) -> DataFrame:
    # Whole numbers, so that the sum does not depend on the order of addition.
    return looks.groupBy("host", "path").agg(F.sum(F.ceil(F.col("score"))).alias("score"))


def voted_paths(pages: DataFrame) -> DataFrame:
    """Every container path that a page of a host chose: ``host, path, score``.

    A path's votes are the scores of the pages that chose it, added up with
    map-side combining, so that a host with most of the pages is no hot spot.
    """
    ready(pages.sparkSession)
    return _added(_look(_keyed(pages)))


def host_paths(pages: DataFrame) -> DataFrame:
    """The same as a list for each host, for looking at: ``host, paths``, best first; equal sums are ranked by path."""
    listed = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "path")))
    return voted_paths(pages).groupBy("host").agg(F.transform(listed, lambda x: x["path"]).alias("paths"))


def extract_pages(pages: DataFrame, paths: DataFrame | None = None) -> DataFrame:
    """Main text of every page: ``page_id, url, text, path``.

    One row per input row, repeated rows and NULL ids too. NULL, empty and
    text-free pages have the empty text and no path. Pages without a host share
    the empty host. ``paths`` (``host, path, score``) is voted on here unless given;
    no number of paths is too many, and equal scores are ranked by path.
    Columns other than ``page_id``, ``url`` and ``html`` are not looked at.
    """
    ready(pages.sparkSession)
    rows = _keyed(pages)
    # Votes and digests are a small part of the pages; kept, so that pages are parsed once for both.
    looks = settle(_look(rows), "page-paths")
    voted = _added(looks) if paths is None else paths
    have = looks.select("page", "host", F.explode("have").alias("key"))
    ranked = voted.select("host", F.unhex(F.md5(F.col("path").cast("binary"))).alias("key"), F.struct((-F.col("score")).alias("minus"), "path").alias("rank"))
    best = have.join(ranked, ["host", "key"]).groupBy("page").agg(F.min("rank")["path"].alias("path"))
    rows = rows.join(best, "page", "left").select(F.col("page_id").cast("long").alias("page_id"), "url", "html", "path")
    return rows.mapInArrow(lambda parts: batches(_texts(parts), TEXTS), "page_id long, url string, text string, path string")
