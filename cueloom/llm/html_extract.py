"""HTML extraction: the contiguous region of a page with the largest sum of word and tag scores.

A page is a sequence of words and tags. A word scores by the elements it stands
in and by what they are called, a tag costs. All weights are learned from pages
that label themselves with an ``article`` or ``main`` element, from the words of
their menus, notices and footers as well as from those of the article; a short
list of names that mostly mark side matter is where learning starts from. A
linear scan finds the best region. What inside it stands in an element whose
name has a low weight (forms, notices, comments and the like) is left out.

A name is not believed for the article that has the most words, for a ``main``
and for what holds them; and if it leaves a page without running text, not for
an element that holds half of the page either.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueloom.llm.common import as_list, hash_sample, pieces_of

#: Pages that weights are learned from, at most about.
TRAINING_PAGES = 2000
#: Names of elements, classes and ids that get a weight of their own: those on the most training pages.
LEARNED_NAMES = 4096

# Element names of HTML.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NEVER_TEXT = frozenset(
    "head script style title template noscript svg math object iframe canvas video audio map textarea "
    "select option datalist noframes noembed xmp".split()
)
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
_LANDMARKS = ("article", "main")
_PLACES = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th pre blockquote figcaption caption div section a".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 a".split())
_PROSE = _PLACES - {"a", "li", "div", "section"}
_UNITS = frozenset("li dd dt td th blockquote figcaption caption".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr"}, "option": {"option"}}
_PARAGRAPH_ENDS = _BLOCKS - {"body", "html", "caption", "legend", "optgroup", "option", "summary", "tbody", "td", "tfoot", "th", "thead", "title", "tr"}

# Where learning starts from: elements, roles and parts of class names that mostly mark side matter, and parts that say nothing.
_SIDE_ELEMENTS = frozenset("nav footer aside form button dialog menu header".split())
_ALWAYS_SIDE = frozenset("nav footer aside button menu".split())
_SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_SIDE_PARTS = frozenset(
    "ad ads adsense adslot advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices notification popup modal overlay newsletter subscribe subscription signup login paywall comment "
    "comments commentlist disqus reply replies respond sidebar aside nav navbar navigation menu menubar breadcrumb "
    "breadcrumbs pagination pager footer footnav masthead topbar toolbar social share sharing related recommended "
    "recommendations trending popular skip hidden disclaimer alert widget".split()
)
_PLAIN_PARTS = frozenset(
    "area author bar block body bottom box col container content count date desktop first form group header holder image inner "
    "item items large last leaderboard left link links list main meta middle mobile outer page panel posts primary reader "
    "rectangle right row secondary section site slot small sr only text thread title top unit wrap wrapper".split()
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PARTS = re.compile(r"[_\W]+")

#: Names of this weight and below mark what is left out. A listed part before one unknown word reaches -0.5.
SIDE = -0.6
#: Words that a name of the list, or none, counts as having been seen with.
_PRIOR_WORDS = 200

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")


@lru_cache(8192)
def names_of(element: str, attributes: str) -> tuple[bool, tuple[tuple[str, ...], ...]]:
    """Whether an element is never shown, and what it is called: groups of names, one each for element, role, class and id."""
    groups = [(f"<{element}",)] if element in _SIDE_ELEMENTS else []
    unseen = element in _NEVER_TEXT
    if attributes.strip():
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), unescape("".join(values)).strip().lower()
            unseen |= key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and bool(_HIDDEN.search(value)))
            if key == "role" and value:
                groups.append((f"role={value}",))
            elif key in ("class", "id") and value:
                groups.append(tuple(sorted(set(value.split()))))
    return unseen, tuple(groups)


@lru_cache(8192)
def prior_of(name: str) -> float:
    """Weight of a name before anything is learned: -1 if its last telling part is listed, else the share that is, negative.

    The last part of a name says what it names: ``post-comments`` are comments, ``menu-planning-guide`` is no menu.
    """
    if name[0] == "<":
        return -float(name[1:] in _SIDE_ELEMENTS)
    if name.startswith("role="):
        return -float(name[5:] in _SIDE_ROLES)
    parts = [p for p in _PARTS.split(name) if p and not p.isdigit()]
    telling = [p in _SIDE_PARTS for p in parts if p in _SIDE_PARTS or p not in _PLAIN_PARTS]
    if not telling:
        return 0.0
    return -1.0 if telling[-1] else -sum(telling) / len(telling)


@dataclass(slots=True)
class Element:
    """An opened element: its parent's number, and what of its ancestors counts for its words."""

    parent: int
    name: str
    names: tuple[tuple[str, ...], ...]
    unseen: bool
    place: str
    outer: str
    article: int
    main: int
    words: int = 0
    #: Words in it and all it holds, unseen ones apart.
    held: int = 0


@dataclass(slots=True)
class Segment:
    """Text between two tags: the element it stands in, its block, and the tags before it."""

    text: str
    words: int
    element: int
    block: int
    tags: tuple[str, ...]


def scan(html: str) -> tuple[list[Element], list[Segment]]:
    """Read a page once, in time linear in its length and nesting.

    Unclosed and misnested elements are taken as browsers mostly do. The first
    element stands for the page.
    """
    elements = [Element(-1, "", (), False, "body", "body", -1, -1)]
    out: list[Segment] = []
    stack = [0]
    block = at = 0
    tags: list[str] = []
    open_now: dict[str, int] = {}

    def pop() -> None:
        open_now[elements[stack.pop()].name] -= 1

    def text(raw: str) -> None:
        nonlocal tags
        if raw:
            element = elements[stack[-1]]
            words = 0 if element.unseen else len(raw.split())
            out.append(Segment(raw, words, stack[-1], block, tuple(tags)))
            element.words += words
            tags = []

    while at < len(html):
        found = _TOKEN.search(html, at)
        if not found:
            text(html[at:])
            break
        text(html[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        name, closing, attributes = found[2].lower(), bool(found[1]), found[3]
        tags.append(name)
        if name in _BLOCKS:
            block += 1
        if closing:
            if open_now.get(name):
                while elements[stack[-1]].name != name:
                    pop()
                pop()
            continue
        if name in _VOID:
            if name == "br":
                text(" ")
            continue
        if name in _RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if name in _PARAGRAPH_ENDS and open_now.get("p"):
            while elements[stack[-1]].name != "p":
                pop()
            pop()
        if name in _CLOSED_BY and elements[stack[-1]].name in _CLOSED_BY[name]:
            pop()
        if attributes.endswith("/") and name not in _BLOCKS:
            continue
        parent, number = elements[stack[-1]], len(elements)
        unseen, names = (names_of if len(attributes) < 1000 else names_of.__wrapped__)(name, attributes)
        unseen = parent.unseen or unseen
        article = number if name == "article" and not unseen else parent.article
        main = number if name == "main" and not unseen else parent.main
        if name in ("blockquote", "pre"):  # a quote is part of what quotes it, whatever it is called
            names = ()
        if name == "header" and (article >= 0 or main >= 0):  # the article's own, not the page's
            names = names[1:]
        place, outer = parent.place, parent.outer
        if parent.place in _UNITS:
            outer = parent.place
        if name in _PLACES and not (name == "a" and place in _PROSE):  # a link in a paragraph is part of it
            place = name
        elements.append(Element(stack[-1], name, names, unseen, place, outer, article, main))
        stack.append(number)
        open_now[name] = open_now.get(name, 0) + 1
    for e in elements:
        e.held = e.words
    for e in reversed(elements):
        if e.parent >= 0:
            elements[e.parent].held += e.held
    return elements, out


@dataclass
class RegionWeights:
    """Score of a word by the kind of page, landmark and place; weight of names; cost of tags by the kind of page."""

    words: dict[tuple[bool, bool, str], float] = field(default_factory=dict)
    names: dict[str, float] = field(default_factory=dict)
    tags: dict[tuple[bool, str], float] = field(default_factory=dict)
    tag: dict[bool, float] = field(default_factory=dict)

    def word(self, marked: bool, landmark: bool, place: str, outer: str) -> float:
        known = self.words.get((marked, landmark, f"{place}<{outer}"))
        if known is not None:
            return known
        default = 1.0 if landmark else -1.0 if marked else -0.3 if place == "a" else 1.0
        inner = self.words.get((marked, landmark, place), default)
        return (inner + self.words.get((marked, landmark, f"<{outer}"), inner)) / 2

    def cost(self, marked: bool, tags: tuple[str, ...]) -> float:
        """Tags cost by the share of them that stands outside of articles; a tag never seen, half."""
        return self.tag.get(marked, 0.1) * sum(self.tags.get((marked, t), 0.5) for t in tags)

    def name(self, groups: tuple[tuple[str, ...], ...]) -> float:
        """The lowest weight of all names, not above 0. A name of articles beside it makes it the mean of the two's group."""
        low = 0.0
        for group in groups:
            own = [self.names[n] if n in self.names else prior_of(n) for n in group]
            low = min(low, min(own) if max(own) < -SIDE else sum(own) / len(own))
        return low


@dataclass
class Page:
    """A scanned page with the weight of names over each segment and whether it stands in a landmark."""

    elements: list[Element]
    found: list[Segment]
    low: list[float]
    landmark: list[bool]
    trusted: set[int]


def _lows(elements: list[Element], weights: RegionWeights, trusted: set[int]) -> list[float]:
    low: list[float] = []
    for i, e in enumerate(elements):
        above = low[e.parent] if e.parent >= 0 else 0.0
        low.append(-2.0 if e.unseen else above if i in trusted or not e.names else min(above, weights.name(e.names)))
    return low


def _ancestors(elements: list[Element], of: set[int]) -> set[int]:
    """``of`` and all elements that hold one of them."""
    out: set[int] = set()
    for i in of:
        while i >= 0 and i not in out:
            out.add(i)
            i = elements[i].parent
    return out


def read_page(html: str, weights: RegionWeights, trust_large: bool = False) -> Page:
    """Scan a page and tell its landmarks: articles, unless a ``main`` has over twice the words of them all.

    No name counts for the article with the most words (those that no name marks come first), for a ``main``
    with as many, and for what holds them (one that a name marks must have as many
    words as the paragraphs outside of articles); with ``trust_large`` for no element with half of the page's words, but for menus, footers and the like.
    """
    elements, found = scan(html)
    trusted = {i for i, e in enumerate(elements) if trust_large and 2 * e.held >= elements[0].held and e.name not in _ALWAYS_SIDE}
    low = _lows(elements, weights, trusted)
    chosen = set()
    for kind in _LANDMARKS:
        of_kind = [i for i, e in enumerate(elements) if e.name == kind and not e.unseen and e.held]
        if of_kind:
            most = max(of_kind, key=lambda i: (low[i] > SIDE, elements[i].held, -i))
            outside = (e.words for i, e in enumerate(elements) if low[i] > SIDE and e.article < 0 and e.place in _PROSE - _HEADINGS)
            if low[most] > SIDE or elements[most].held >= sum(outside):
                chosen.add(most)
    trusted |= _ancestors(elements, chosen)
    low = _lows(elements, weights, trusted)
    in_article = [e.article >= 0 and low[i] > SIDE for i, e in enumerate(elements)]
    in_main = [e.main >= 0 and low[i] > SIDE for i, e in enumerate(elements)]
    count = lambda inside: sum(e.words for e, yes in zip(elements, inside, strict=True) if yes)
    landmark = in_article if 2 * count(in_article) >= count(in_main) else in_main
    return Page(elements, found, low, landmark, trusted)


def segment_scores(page: Page, weights: RegionWeights, marked: bool | None = None) -> list[tuple[float, float]]:
    """``(cost of the tags before, score of the words)`` of each segment; ``marked=False`` hides the landmarks.

    A segment that its names mark as side matter counts for nothing: it is left out, and does not part what is around it.
    """
    if marked is None:
        marked = any(page.landmark[s.element] and s.words for s in page.found)
    out = []
    for s in page.found:
        e, low = page.elements[s.element], page.low[s.element]
        if low <= SIDE:
            out.append((0.0, 0.0))
        else:
            weight = weights.word(marked, marked and page.landmark[s.element], e.place, e.outer)
            out.append((weights.cost(marked, s.tags), s.words * (weight + 1.5 * low if weight > 0 else weight)))
    return out


def best_region(scores: list[tuple[float, float]]) -> tuple[int, int]:
    """First and last segment (exclusive) of the region with the largest score: one scan.

    A region's score is its words' less the costs of tags between its segments. Of
    equal scores the earliest; an empty region if nothing scores above zero.
    """
    best = (0.0, 0, 0)
    total, start = 0.0, 0
    for i, (cost, score) in enumerate(scores):
        total -= cost
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best[0]:
            best = (total, start, i + 1)
    return best[1], best[2]


def _region(page: Page, weights: RegionWeights) -> list[Segment]:
    """Segments of the best region, whole blocks at both ends, without side matter."""
    found = page.found
    first, last = best_region(segment_scores(page, weights))
    if first < last:
        while first and found[first - 1].block == found[first].block:
            first -= 1
        while last < len(found) and found[last].block == found[last - 1].block:
            last += 1
    return [s for s in found[first:last] if page.low[s.element] > SIDE]


def main_text(html: str | None, weights: RegionWeights) -> str:
    """The best region's text: references decoded, white space one space, blocks joined by a line feed.

    A region of headings and links alone is no article: then names are not
    believed of elements that hold half of the page, and if that does not help,
    what was learned of places is left aside too.
    """
    untaught = RegionWeights(names=weights.names)
    chosen: list[Segment] = []
    for tried, large in ((weights, False), (weights, True), (untaught, True)):
        page = read_page(html or "", tried, large)
        region = _region(page, tried)
        if any(s.words and page.elements[s.element].place not in _HEADINGS for s in region):
            chosen = region
            break
        chosen = chosen or region
    blocks: list[list[str]] = []
    block = None
    for s in chosen:
        if s.block != block:
            blocks.append([])
            block = s.block
        blocks[-1].append(unescape(s.text))
    texts = (" ".join("".join(parts).split()) for parts in blocks)
    return "\n".join(t for t in texts if t)


_GRID = (0.1, 0.3, 1.0)


def _observed(page: Page) -> Iterator[tuple[str, str, bool, bool, int]]:
    """What a self-labelling page teaches: ``(kind, key, marked, inside, count)``, of words in side matter too.

    Words inside of a landmark speak for a listed name only where its element
    holds half of them: a landmark says nothing of what smaller parts it has.
    """
    inside_words = sum(s.words for s in page.found if page.landmark[s.element])
    for s in page.found:
        e, inside = page.elements[s.element], page.landmark[s.element]
        for t in s.tags:
            yield "tag", t, True, inside, 1
            yield "tag", t, False, inside, 1
        if s.words and (inside or not (e.article >= 0 or e.main >= 0)):
            for place in (e.place, f"<{e.outer}", f"{e.place}<{e.outer}"):
                yield "word", f"{int(inside)}{place}", True, inside, s.words
                yield "word", f"0{place}", False, inside, s.words
    for i, e in enumerate(page.elements):
        if e.held and not e.unseen and i not in page.trusted:
            in_landmark = e.article >= 0 or e.main >= 0
            large = 2 * e.held >= inside_words > 0
            for name in {n for group in e.names for n in group}:
                if not in_landmark or large or prior_of(name) > SIDE:
                    yield "name", name, True, in_landmark, e.held


def _agreement(page: Page, weights: RegionWeights, marked: bool) -> tuple[int, int, int]:
    """Words found and right, found, and right, of a page whose landmarks are shown or not."""
    first, last = best_region(segment_scores(page, weights, marked))
    kept = [s for s in page.found[first:last] if page.low[s.element] > SIDE]
    both = sum(s.words for s in kept if page.landmark[s.element])
    return both, sum(s.words for s in kept), sum(s.words for s in page.found if page.landmark[s.element])


def _labelled(pages: DataFrame) -> DataFrame:
    marks = [F.lower("html").contains(f"<{name}") for name in _LANDMARKS]
    return pages.where(marks[0] | marks[1])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


_COUNTS = pa.schema(
    [("kind", pa.string()), ("key", pa.string()), ("marked", pa.bool_()), ("inside", pa.bool_()), ("n", pa.int64()), ("pages", pa.int64())]
)
_GRADES = pa.schema([("marked", pa.bool_()), ("cost", pa.float64()), ("both", pa.int64()), ("found", pa.int64()), ("right", pa.int64())])


def _counted(chosen: DataFrame) -> DataFrame:
    """``kind, key, inside, outside, pages`` of the training pages: one row a place, tag or name."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            counts: dict[tuple, list[int]] = {}
            for html in as_list(batch, "html"):
                of_page: dict[tuple, int] = {}
                for *key, n in _observed(read_page(html, RegionWeights())):
                    of_page[tuple(key)] = of_page.get(tuple(key), 0) + n
                for key, n in of_page.items():
                    total = counts.setdefault(key, [0, 0])
                    total[0] += n
                    total[1] += 1
            yield _batch([(*k, *n) for k, n in counts.items()], _COUNTS)

    rows = chosen.mapInArrow(count, "kind string, key string, marked boolean, inside boolean, n long, pages long")
    amount = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0).cast("long"))
    return rows.groupBy("kind", "key", "marked").agg(
        amount(F.col("inside")).alias("inside"), amount(~F.col("inside")).alias("outside"), F.sum("pages").alias("pages")
    )


def train_region_weights(pages: DataFrame, rows: int = TRAINING_PAGES, names: int = LEARNED_NAMES) -> RegionWeights:
    """Learn from at most about ``rows`` pages (page_id, html) that have an article or main element.

    A word's weight is the share of words of its place that were inside, from -1
    to 1; a name's weight is the same over the words of its elements, moved from
    where the list puts it, for the ``names`` names on the most pages (two at
    least). A tag costs by the share of it that stands outside. Weights for pages
    without landmarks come from the same pages with the landmarks hidden. The cost
    is the one of a small grid that finds most of the labelled regions (F1 over
    words; of equal ones the lowest with landmarks, and without them the highest,
    as it parts regions best). Only counts by place, tag and these names reach the driver. Without labelled pages words
    inside a landmark, or on pages without any all words, score 1.
    """
    chosen = hash_sample(_labelled(pages.where("html is not null").select("page_id", "html")), rows, "page_id", "html")
    counted = _counted(chosen).persist()
    try:
        known = counted.where("kind = 'name' and pages >= 2").orderBy(F.desc("pages"), "key").limit(names).collect()
        # As many rows as HTML has places and tags; of invented tags those that two pages share.
        fixed = counted.where("kind = 'word'").collect()
        fixed += counted.where("kind = 'tag' and pages >= 2").orderBy(F.desc("pages"), "key", "marked").limit(names).collect()
    finally:
        counted.unpersist()
    weights = RegionWeights()
    for r in known:
        seen = r["inside"] + r["outside"]
        weights.names[r["key"]] = (_PRIOR_WORDS * prior_of(r["key"]) + r["inside"] - r["outside"]) / (_PRIOR_WORDS + seen)
    for r in fixed:
        if r["kind"] == "word":
            weight = (r["inside"] - r["outside"]) / (r["inside"] + r["outside"] + 1)
            weights.words[(r["marked"], r["key"][0] == "1", r["key"][1:])] = weight
        else:
            weights.tags[(r["marked"], r["key"])] = (r["outside"] + 1) / (r["inside"] + r["outside"] + 2)

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {(m, c): [0, 0, 0] for m in (True, False) for c in _GRID}
        for batch in pieces_of(batches):
            for html in as_list(batch, "html"):
                page = read_page(html, weights)
                for (marked, cost), total in sums.items():
                    tried = RegionWeights(weights.words, weights.names, weights.tags, {marked: cost})
                    for i, n in enumerate(_agreement(page, tried, marked)):
                        total[i] += n
        yield _batch([(m, c, *n) for (m, c), n in sums.items()], _GRADES)

    graded = chosen.mapInArrow(grade, "marked boolean, cost double, both long, found long, right long")
    sums = graded.groupBy("marked", "cost").agg(*[F.sum(c).alias(c) for c in ("both", "found", "right")]).collect()
    for marked in (True, False):
        tried = [(r["cost"], round(2 * r["both"] / (r["found"] + r["right"]), 4)) for r in sums if r["marked"] == marked and r["right"]]
        if tried:
            best = max(f for _, f in tried)
            weights.tag[marked] = (min if marked else max)(c for c, f in tried if f == best)
    return weights


def extract_text(pages: DataFrame, weights: RegionWeights) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages`` (page_id, url, html), from its whole html.

    Null and empty html give an empty text, as do pages without a word that scores.
    Repeated rows give equal results. Other columns are ignored.
    """
    narrow = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            texts = [main_text(html, weights) for html in as_list(batch, "html")]
            columns = [pa.array(as_list(batch, "page_id"), pa.int64()), pa.array(as_list(batch, "url"), pa.string())]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return narrow.mapInArrow(run, "page_id long, url string, text string, n_chars long")
