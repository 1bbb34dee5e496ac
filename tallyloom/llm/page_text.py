"""Main text of web pages as the maximum-scoring run of words and tags.

A page is read as a sequence of words and tags. Words score positive, tags
negative, and the contiguous run with the greatest sum, found by one scan, is the content; it is
widened to whole blocks. The weights are log-odds counted on labelled pages: pages
that mark their content with ``article`` or ``main`` label themselves, words and tags
inside against those outside. They hold for all pages, marked or not.

Elements that are no content by their kind (scripts, styles, menus, forms, page headers and footers, …) are left out
first. What a class, id or role says (adverts, notices, comments, …) is a hint: it is judged once the whole page is
read, and does not hold for an element around the page's only content, or with most of its words (see ``_stands``). A page that has no text
without its hinted elements is read with them. Elements end as HTML says, also where their end tags are omitted.

Character references are decoded; white space inside a block becomes one space; blocks are
joined by two line breaks. A null page is empty. Repeated rows each get their row. Extra
columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by what they do.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strong sub sup time tt u var wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset(
    "aside audio button canvas datalist dialog fieldset footer form head input label menu nav noscript object option "
    "select svg template video".split()
)
CONTENT = frozenset(("article", "main"))
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies copyright disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay "
    "pager pagination popup promo promotion related replies respond response responses share sharing sidebar signup social sponsor sponsored "
    "subscribe toolbar topbar widget".split()
)
_COMMENTS = frozenset("comment comments commentlist disqus replies respond response responses".split())
# Hints that say nothing inside of marked content: titles and call-outs.
_INSIDE = frozenset("header notice notices".split())
# Before these words, a hint says that something else has it ("has-sidebar").
_ABOUT = frozenset("has have no not with without".split())
# Hints that have a plain meaning before another word ("share-price"), and the words before which they keep theirs.
_PLAIN = frozenset("related share social notice promotion response responses sponsor comment".split())
_FURNITURE = frozenset(
    "and area article articles bar block body bottom box btn button buttons container content contents count counter form group icon icons inner "
    "item items left link links list meta media message module more networks news panel post posts reading right row section stories story "
    "tags text title tools top topics videos wrap wrapper".split()
)
_ROLES = re.compile(r"\b(?:navigation|banner|contentinfo|complementary|search|form|dialog|alert)\b", re.I)
_NEVER_HINTED = frozenset(("html", "body", "main"))

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)

# Elements whose end tags may be omitted: what a start tag ends, up to which elements around.
_ENDS = (
    {n: (frozenset(("li",)), frozenset("ul ol menu dir".split())) for n in ("li",)}
    | {n: (frozenset(("dt", "dd")), frozenset(("dl",))) for n in ("dt", "dd")}
    | {n: (frozenset(("td", "th")), frozenset(("table", "tr"))) for n in ("td", "th")}
    | {n: (frozenset("tr td th".split()), frozenset(("table",))) for n in ("tr", "tbody", "tfoot", "thead")}
    | {n: (frozenset(("option",)), frozenset(("select", "datalist"))) for n in ("option", "optgroup")}
)
_OMITTED = frozenset("p li dt dd td th tr option".split())
_ENDS_P = BLOCKS - frozenset("body caption dd dt head html legend li tbody td tfoot th thead title tr".split())
_AROUND_P = frozenset("article aside blockquote body button caption dd details div dl dt fieldset figure footer form header li main nav object ol section table td th ul".split())
_WALLS = frozenset("caption html object table td template th".split())
_TABLE = frozenset("caption table tbody td tfoot th thead tr".split())

LEAST, WORD_MOST, TAG_MOST = 0.1, 3.0, 4.0


@dataclass
class Token:
    """A run of text, or a tag."""

    tag: str
    text: str
    block: int
    context: str
    marked: bool

    @property
    def words(self) -> int:
        return 0 if self.tag else len(self.text.split())


@dataclass
class Region:
    """An element with a hint: its place among elements and what it holds."""

    around: int
    kind: str
    marked: int
    links: int
    context: str
    words: int = 0
    content: bool = False
    closed: bool = False


def _named_hint(value: str, known: frozenset[str], marked: bool) -> str:
    """The hint that a class or id holds, or nothing."""
    for name in value.lower().split():
        parts = re.split("[_-]+", name)
        for k, part in enumerate(parts):
            if part not in known or marked and part in _INSIDE or not _ABOUT.isdisjoint(parts[:k]):
                continue
            after = parts[k + 1] if k + 1 < len(parts) else ""
            if part in _PLAIN and after and not (after in _FURNITURE or after in _HINTS or after.isdigit()):
                continue
            return part
    return ""


def _hinted(name: str, attributes: str, marked: bool) -> str:
    """What says that the element is no content, or nothing."""
    if len(attributes) < 4 or name in _NEVER_HINTED:
        return ""
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "role":
            if _ROLES.search(value):
                return "role"
        elif key in ("class", "id"):
            found = _named_hint(value, _COMMENTS if name in CONTENT else _HINTS, marked)
            if found:
                return found
        elif key == "hidden" or key == "aria-hidden" and value.strip().lower() == "true" or key == "style" and _UNSEEN.search(value):
            return "hidden"
    return ""


class OpenElements:
    """The open elements of a page, with the places of each name, so that none is searched for from the top."""

    def __init__(self) -> None:
        self.opened: list[tuple[str, int]] = []
        self._places: dict[str, list[int]] = {}

    def open(self, name: str, region: int) -> None:
        self._places.setdefault(name, []).append(len(self.opened))
        self.opened.append((name, region))

    def close(self, first: int) -> list[tuple[str, int]]:
        """Remove the elements from a place on and return them, the innermost first."""
        gone = self.opened[first:][::-1]
        del self.opened[first:]
        for name, _ in gone:
            self._places[name].pop()
        return gone

    def _last(self, name: str) -> int:
        places = self._places.get(name)
        return places[-1] if places else -1

    def find(self, names: frozenset[str] | tuple[str, ...], walls: frozenset[str]) -> int:
        """Place of the outermost of ``names`` above the last open one of ``walls``, or -1."""
        if all(self._last(n) < 0 for n in names):
            return -1
        wall = max((self._last(w) for w in walls if w not in names), default=-1)
        found = -1
        for name in names:
            places = self._places.get(name, [])
            k = bisect_right(places, wall)
            if k < len(places) and (found < 0 or places[k] < found):
                found = places[k]
        return found

    def closed_by(self, name: str) -> int:
        """Place of the element that an end tag ends, or -1."""
        last = self._last(name)
        if last < 0:
            return -1
        walls = ("table",) if name in _TABLE else _WALLS
        return last if all(self._last(w) <= last for w in walls) else -1


def _stands(region: Region, total: int, elsewhere: bool) -> bool:
    """Whether a hint holds: not for what has the page's only marked content, nor for most of the words, unless these are comments
    or the page has its marked content elsewhere. An element that never ends has no hint, unless its end may be omitted.
    """
    if not region.closed:
        return False
    if region.content and not elsewhere:
        return False
    most = 2 * region.words > total and region.kind not in _COMMENTS
    return not (most and (region.marked > 0 or not elsewhere))


def read_page(page: str, hints: bool = True) -> list[Token]:
    """Runs of text and tags of a page in order, without what is left out."""
    out: list[Token] = []
    places: list[int] = []
    regions: list[Region] = []
    elements = OpenElements()
    last_ends: dict[str, int] = {}
    at, block, links, marked, region = 0, 0, 0, 0, -1
    around, elsewhere = "other", False
    skipping, depth = "", 0

    def close(first: int, by: str) -> None:
        """End the open elements from a place on; the end of the whole page does not tell where an element ends."""
        nonlocal region, marked, links, around
        for element, own in elements.close(first):
            if own >= 0:
                r = regions[own]
                r.closed = by not in ("body", "html") or element in _OMITTED
                region, marked, links, around = r.around, r.marked, r.links, r.context

    while True:
        m = _TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if end > at and not skipping:
            out.append(Token("", page[at:end], block, "link" if links else around, marked > 0))
            places.append(region)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        name, closing = m[2].lower(), bool(m[1])
        own_end = m[3].endswith("/>")
        if skipping:
            if name == skipping:
                depth += -1 if closing else (0 if own_end else 1)
                if depth <= 0:
                    skipping = ""
            elif not closing and name in RAW and not own_end:
                at = _raw_end(page, at, name)
            continue
        if not closing and name in RAW:
            if not own_end:
                at = _raw_end(page, at, name)
            continue
        if not closing:
            ended = elements.find(*_ENDS[name]) if name in _ENDS else -1
            if ended < 0 and name in _ENDS_P:
                ended = elements.find(("p",), _AROUND_P)
            if ended >= 0:
                close(ended, name)
        kind = name in LEFT_OUT or (name == "header" and not marked)
        if kind and not closing and name != "option":
            block += 1
            if name not in VOID and not own_end and _is_closed(page, at, name, last_ends):
                skipping, depth = name, 1
            continue
        hint = ""
        if not closing and (hints or name == "option"):
            hint = "option" if name == "option" else _hinted(name, m[3], marked > 0)
        ended = elements.closed_by(name) if closing else -1
        if hint:
            block += 1
            if name in VOID or own_end:
                continue
            regions.append(Region(region, hint, marked, links, around))
            region = len(regions) - 1
        if name in CONTENT and not closing and not hint:
            if region < 0:
                elsewhere = True
            for r in _up(regions, region):
                if r.content:
                    break
                r.content = True
        if name in CONTENT:
            marked = max(0, marked + (-1 if closing else 1))
        if name == "a":
            links = 0 if closing else 1
        if name in BLOCKS or name not in INLINE:
            block += 1
            links = 0
            around = "other" if closing else name
        out.append(Token(name, " " if name == "br" else "", block, "", marked > 0 and name not in CONTENT))
        places.append(region)
        if ended >= 0:
            inner = marked
            close(ended, name)
            if name in CONTENT:
                marked = min(marked, inner)
        elif not closing and name not in VOID and not own_end:
            elements.open(name, region if hint else -1)
    if not regions:
        return out
    # The end of the page ends what may end so.
    for name, own in elements.opened:
        if own >= 0 and name in _OMITTED:
            regions[own].closed = True
    total = 0
    for token, place in zip(out, places):
        words = token.words
        total += words
        if place >= 0:
            regions[place].words += words
    # Regions are listed from the outside in.
    for r in reversed(regions):
        if r.around >= 0:
            regions[r.around].words += r.words
    gone = [r.kind == "option" or _stands(r, total, elsewhere) for r in regions]
    for k, r in enumerate(regions):
        gone[k] = gone[k] or r.around >= 0 and gone[r.around]
    return [token for token, place in zip(out, places) if place < 0 or not gone[place]]


def _up(regions: list[Region], place: int) -> Iterator[Region]:
    while place >= 0:
        yield regions[place]
        place = regions[place].around


def _raw_end(page: str, at: int, name: str) -> int:
    m = re.compile(f"</{name}[^>]*>", re.I).search(page, at)
    return m.end() if m else len(page)


def _is_closed(page: str, at: int, name: str, last_ends: dict[str, int]) -> bool:
    """Whether the element ends at all; the end of the page does for what stands last on it. ``last_ends`` keeps the last end tags found."""
    if name == "footer":
        return True
    if name not in last_ends:
        last_ends[name] = max((m.start() for m in re.finditer(f"</{name}\\b", page, re.I)), default=-1)
    return last_ends[name] >= at


@dataclass(frozen=True)
class PageWeights:
    """Score of a word by its context, and of a tag by its name."""

    word: dict[str, float]
    tag: dict[str, float]

    def score(self, token: Token) -> float:
        if token.tag:
            return -self.tag.get(token.tag, 1.0)
        return token.words * self.word.get(token.context, 1.0)


def fit_page_weights(pages: DataFrame) -> PageWeights:
    """Count words and tags inside and outside of marked content on all pages that mark it.

    A task sends one row per kind of token; kinds are the names of elements known here, others count as one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, str, bool]] = Counter()
        known = BLOCKS | INLINE
        for batch in batches:
            for page in batch.column(0).to_pylist():
                tokens = read_page(page)
                if not any(t.marked for t in tokens):
                    continue
                for t in tokens:
                    kind, name = ("tag", t.tag) if t.tag else ("word", t.context)
                    n = 1 if t.tag else t.words
                    counts[kind, name if name in known or kind == "word" and name == "link" else "other", t.marked] += n
        rows = [dict(zip(("kind", "name", "inside", "n"), (*k, n))) for k, n in counts.items()]
        yield pa.RecordBatch.from_pylist(
            rows, schema=pa.schema([("kind", pa.string()), ("name", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())])
        )

    rows = (
        pages.select(F.coalesce(F.col("html"), F.lit("")).alias("html"))
        .mapInArrow(count, "kind STRING, name STRING, inside BOOLEAN, n BIGINT")
        .groupBy("kind", "name")
        .agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("i"), F.sum(F.when(~F.col("inside"), F.col("n")).otherwise(0)).alias("o"))
        .collect()
    )
    word, tag = {}, {}
    for r in rows:
        odds = float(np.log((r["i"] + 1) / (r["o"] + 1)))
        if r["kind"] == "word":
            word[r["name"]] = min(max(odds, LEAST), WORD_MOST)
        else:
            tag[r["name"]] = min(max(-odds, LEAST), TAG_MOST)
    return PageWeights(word, tag)


def best_run(scores: list[float]) -> tuple[int, int]:
    """``first, last`` (exclusive) of the run with the greatest sum; the first one of equals, empty if none is positive."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best:
            best, best_at = total, (start, k + 1)
    return best_at


def main_text(page: str, weights: PageWeights) -> str:
    """Blocks of the best run, joined by two line breaks."""
    for hints in (True, False):
        tokens = read_page(page, hints)
        first, last = best_run([weights.score(t) for t in tokens])
        if first < last:
            break
    else:
        return ""
    while first > 0 and tokens[first - 1].block == tokens[first].block:
        first -= 1
    while last < len(tokens) and tokens[last].block == tokens[last - 1].block:
        last += 1
    blocks: dict[int, list[str]] = {}
    for t in tokens[first:last]:
        blocks.setdefault(t.block, []).append(t.text)
    texts = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n\n".join(t for t in texts if t)


def extract_pages(pages: DataFrame, weights: PageWeights) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, shared.value) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"))
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(
        extract, f"page_id {fields['page_id']}, url {fields['url']}, text STRING, n_chars BIGINT"
    )
