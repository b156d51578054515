"""HTML extraction by consensus host paths.

Every page's containers are scored by the text of their blocks, links aside.  The
best container is widened to the whole article around it (see ``widened``).  The
generalised path of that (tags with classes, digits and ids removed) gets the page's
vote, votes are counted per host in Spark, and every page is extracted again from the
containers on its host's winning path; a page without such a container uses its own
best one, widened.

Votes are added up within each task before the shuffle.  The html itself is
shuffled only for hosts with few pages (see ``skewed``): the large hosts, of which there
are few, get their winning path by broadcast.

Blocks end where block elements begin or end.  Character references are decoded,
white space in a block becomes one space, and blocks are joined by a newline.

An element is beside the main text by its tag, role, or the name that its class or id
gives it, unless it holds what must be the main text (see ``blocks``).

A page is parsed once a pass, in time linear in its length: what an element holds is the
difference of two running counts, and containers are nodes of a tree of generalised paths.

Defined cases: a quote opens a value only after ``=``, and one that never closes is part of the value; elements
nested deeper than ``DEPTH`` are siblings at that depth, as browsers have it; a null or empty html gives an empty text; a null url, or one
without ``://``, counts for the empty host; of paths with equal votes the first in
alphabetical order wins; rows that repeat an id are extracted one by one; other
columns are not read; tags cut off at the end of a page are dropped.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genospark.llm import textarrays as T
from genospark.llm.skewed import join_groups
from genospark.session import stored

_VALUE = r"""\s*+=\s*+(?>"[^"]*"|'[^']*'|[^\s>]*+)"""
_TAG = re.compile(rf"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
                  rf"""|<(/?)([a-zA-Z][^\s/>]*)((?>[\s/]+|=?[^\s/>=]++(?:{_VALUE})?|=)*+)(>?)""", re.S)
_ATTR = re.compile(r"""(=?[^\s/>=]++)(?:\s*+=\s*+(?>"([^"]*)"|'([^']*)'|([^\s>]*+)))?""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in
            ("script", "style", "title", "textarea", "noscript", "iframe", "template", "svg")}

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
#: Elements whose text is never main text.
ASIDE_TAGS = frozenset("nav header footer aside form button select dialog menu object video audio canvas".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
#: Names in a class or id of what is not main text.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement adbox sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar aside footer header masthead topbar toolbar comment comments reply replies "
    "discussion disqus notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe "
    "signup login form search share sharing social related recommended widget pagination pager skip copyright".split())
#: A name with one of these words says what goes along with an element, not what it is.
_WITH = frozenset("with without no not non has have hide hides hidden show shows is are".split())
#: Last words that do not change what a name means.
_PART = frozenset("area bar block box container content inner outer wrap wrapper list item items section group slot "
                  "unit links widget widgets left right top bottom body text".split())
#: An open element of the first set is ended by an opening tag of the second.
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
              "th": {"td", "th", "tr"}, "option": {"option"}}
#: Elements whose text, right inside a container, is a part of the container's own text.
_FLOW = frozenset("h1 h2 h3 h4 h5 h6 p ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre "
                  "figure figcaption section hgroup details summary".split())
#: Other parts of a container call for it if they have this part of the text found so far.
LARGE_PART = 0.25
#: A form with more than this part of a page's text is the page's own (the whole page is sent with it).
PAGE_FORM = 0.75
#: Containers further inside than this are siblings at this depth.
DEPTH = 512
_SCOPE = frozenset("article section main div td th table ul ol dl blockquote body aside nav header footer form".split())


class Block:
    """Text of one block, the node of the container around it, and its linked characters."""

    __slots__ = ("text", "node", "linked")

    def __init__(self, text: str, node: int, linked: int):
        self.text, self.node, self.linked = text, node, linked


class Paths:
    """The generalised paths of a page's containers as a tree; node 0 is the page."""

    def __init__(self):
        self.names, self.parents, self.depths = [""], [-1], [0]
        self._nodes: dict[tuple[int, str], int] = {}

    def child(self, node: int, name: str) -> int:
        if self.depths[node] >= DEPTH:
            return node
        found = self._nodes.get((node, name))
        if found is None:
            found = self._nodes[node, name] = len(self.names)
            self.names.append(name)
            self.parents.append(node)
            self.depths.append(self.depths[node] + 1)
        return found

    def around(self, node: int) -> list[int]:
        """The node and those around it, outermost first."""
        out = []
        while node >= 0:
            out.append(node)
            node = self.parents[node]
        return out[::-1]

    def text(self, node: int) -> str:
        return ">".join(self.names[n] for n in self.around(node))

    def tag(self, node: int) -> str:
        return self.names[node].partition(".")[0]

    def find(self, path: str) -> int | None:
        node: int | None = 0
        for name in path.split(">")[1:]:
            node = self._nodes.get((node, name))
            if node is None:
                break
        return node


def _names_aside(token: str) -> bool:
    """Does the class or id name something beside the main text?  The last word of a name
    says what it is; what follows ``--`` is a variant of it."""
    words = [w for w in re.split(r"[^a-z]+", token.partition("--")[0] or token) if w]
    if not _WITH.isdisjoint(words):
        return False
    while len(words) > 1 and words[-1] in _PART:
        words.pop()
    return bool(words) and words[-1] in ASIDE_WORDS


#: What makes an element one beside the main text: its tag or role, only its name, or that it is a form.
_BY_TAG, _BY_NAME, _BY_FORM = 1, 2, 3


@lru_cache(4096)
def _kind(tag: str, attributes: str) -> tuple[str, int]:
    """Generalised name of an element, and what makes it one beside the main text (0: nothing)."""
    aside, name = _BY_FORM if tag == "form" else _BY_TAG if tag in ASIDE_TAGS else 0, tag
    if attributes:
        for key, *value in _ATTR.findall(attributes):
            key, value = key.lower(), "".join(value).lower()
            if key == "role":
                aside = _BY_TAG if value in ASIDE_ROLES else aside
            elif key in ("class", "id") and not aside and tag != "main" and any(map(_names_aside, value.split())):
                aside = _BY_NAME
            if key == "class" and value:
                name = ".".join([tag, *sorted(set(re.sub(r"[\d>]+", "", value).split()))])
    return name, aside


class Aside:
    """What an element beside the main text holds: characters outside of links, ``article`` or ``main``
    elements that are not marked themselves, and main headings."""

    __slots__ = ("kind", "parent", "weight", "articles", "headings")

    def __init__(self, kind: int = 0, parent: int = -1, weight: int = 0, articles: int = 0, headings: int = 0):
        self.kind, self.parent = kind, parent
        self.weight, self.articles, self.headings = weight, articles, headings


def blocks(page: str) -> tuple[list[Block], Paths]:
    """The blocks of a page outside of elements beside the main text, in order, and the page's paths.

    No element is beside the main text if it holds all ``article`` and ``main`` elements of
    the page, or a main heading and most of the text; nor is a form with nearly all of the text.  If no text is
    left, the largest of those by name alone, or forms, are not beside it either.
    """
    raw, paths, whole, asides = _parse(page)
    spared = {n for n, a in enumerate(asides)
              if (a.articles and a.articles == whole.articles) or (a.headings and 2 * a.weight > whole.weight)
              or (a.kind == _BY_FORM and a.weight > PAGE_FORM * whole.weight)}
    found = _visible(raw, asides, spared)
    if all(b.linked == len(b.text) for b in found):
        named = {n: a.weight for n, a in enumerate(asides) if a.kind in (_BY_NAME, _BY_FORM)}
        most = max(named.values(), default=0)
        large = {n for n, weight in named.items() if 2 * weight > most}
        if large:
            found = _visible(raw, asides, spared | large)
    return found, paths


def _visible(raw: list, asides: list[Aside], spared: set[int]) -> list[Block]:
    """The blocks with what is in no element beside the main text, those ``spared`` aside."""
    hidden: list[bool] = []
    for n, a in enumerate(asides):
        hidden.append(n not in spared or (a.parent >= 0 and hidden[a.parent]))
    out = []
    for node, words in raw:
        words = [w for w in words if w[0] < 0 or not hidden[w[0]]]
        text = " ".join("".join(html.unescape(t) if "&" in t else t for _, t, _ in words).split())
        if text:
            out.append(Block(text, node, min(sum(len(t) for _, t, link in words if link), len(text))))
    return out


class _Open:
    """The open elements: (tag, container node, aside around its content, whether that aside is its own)."""

    def __init__(self):
        self.stack: list[tuple[str, int, int, bool]] = [("", 0, -1, False)]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = [0]
        self.scopes: list[int] = [0]

    def push(self, tag: str, node: int, aside: int, own: bool) -> None:
        at = len(self.stack)
        self.stack.append((tag, node, aside, own))
        self.places[tag].append(at)
        if tag not in INLINE:
            self.blocks.append(at)
        if tag in _SCOPE:
            self.scopes.append(at)

    def last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else 0

    def ended_by(self, tag: str) -> int:
        """The innermost open element that an opening tag ends (0: none)."""
        at = max(self.last("p"), *(self.last(t) for t, by in _CLOSED_BY.items() if tag in by), 0)
        return at if at >= self.scopes[-1] else 0

    def cut(self, at: int) -> list[int]:
        """Close the elements from ``at`` on; the asides that end."""
        ended = []
        while len(self.stack) > at:
            tag, _, aside, own = self.stack.pop()
            self.places[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()
            if tag in _SCOPE:
                self.scopes.pop()
            if own:
                ended.append(aside)
        return ended


def _parse(page: str) -> tuple[list, Paths, Aside, list[Aside]]:
    """The blocks as (container node, [(aside around, text, in a link)]), the paths, what the whole page holds,
    and what each element beside the main text does."""
    raw: list[tuple[int, list]] = []
    paths, opened = Paths(), _Open()
    whole, asides = Aside(), []
    stack = opened.stack
    words: list[tuple[int, str, bool]] = []
    link = False
    at = 0

    def flush() -> None:
        nonlocal words
        if words:
            raw.append((stack[-1][1], words))
            words = []

    def put(text: str) -> None:
        if text:
            if not link:
                whole.weight += len(text.strip())
            words.append((stack[-1][2], text, link))

    def close(place: int) -> None:
        for n in opened.cut(place):  # until here the aside has the counts of what came before it
            a = asides[n]
            a.weight, a.articles, a.headings = (
                whole.weight - a.weight, whole.articles - a.articles, whole.headings - a.headings)

    n = len(page)
    while at < n:
        m = _TAG.search(page, at)
        if not m:
            put(page[at:])
            break
        put(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag or not m[4]:
            continue  # a comment, a declaration, or a tag that the page's end cuts off
        if tag in _RAW_END and not m[1]:
            end = _RAW_END[tag].search(page, at)
            at = n if not end else page.find(">", end.end()) + 1 or n
            continue
        if tag in ("html", "head", "body"):
            flush()
            continue
        if tag == "a":
            link = not m[1]
        if tag in ("br", "hr", "img", "input"):
            put(" ")
        if tag in VOID:
            continue
        if m[1]:
            place = opened.last(tag)
            if place and not (tag in INLINE and opened.blocks[-1] > place):
                if tag not in INLINE:
                    flush()
                close(place)
            continue
        if tag in INLINE and not m[3]:
            opened.push(tag, stack[-1][1], stack[-1][2], False)
            continue
        if tag not in INLINE:
            flush()
            link = False
            place = opened.ended_by(tag)
            if place:
                close(place)
        name, kind = _kind(tag, m[3])
        _, node, around, _ = stack[-1]
        if kind:
            if tag in INLINE:
                put(" ")
            asides.append(Aside(kind, around, whole.weight, whole.articles, whole.headings))
            around = len(asides) - 1
        elif tag in ("article", "main"):
            whole.articles += 1
        elif tag == "h1":
            whole.headings += 1
        opened.push(tag, node if tag in INLINE else paths.child(node, name), around, bool(kind))
    flush()
    close(1)
    return raw, paths, whole, asides


def best_node(found: list[Block], paths: Paths) -> int | None:
    """The container with the best score: a block counts in full for the
    container around it, half for the next, and so on outwards."""
    weights: dict[int, int] = defaultdict(int)
    for b in found:
        weights[b.node] += len(b.text) - b.linked
    score: dict[int, float] = defaultdict(float)
    for node, weight in weights.items():
        around = paths.around(node)
        for k, outer in enumerate(reversed(around[:-1] or around)):
            score[outer] += weight / (k + 1)
    if not score:
        return None
    best = max(score.values())
    return max((n for n, value in score.items() if value == best), key=paths.text)


def widened(found: list[Block], paths: Paths, node: int | None) -> int | None:
    """The whole article around the container ``node``.

    That is the outermost ``article`` around it.  Without one, it is the outermost
    container, ``main`` at most, up to which each adds text that is not mostly links
    and not of another article: blocks of its own or sections, or large other parts.
    """
    if node is None:
        return None
    around = paths.around(node)
    at = len(around) - 1
    tags = [paths.tag(n) for n in around]
    if "article" in tags:
        return around[tags.index("article")]
    last = tags.index("main") if "main" in tags else 0
    # by node: its innermost container of those around, and whether beyond it are only parts of its text, an article
    place = {n: (k, True, False) for k, n in enumerate(around)}

    def placed(n: int) -> tuple[int, bool, bool]:
        up = []
        while n not in place:
            up.append(n)
            n = paths.parents[n]
        for n in reversed(up):
            k, flow, article = place[paths.parents[n]]
            place[n] = (k, flow and paths.tag(n) in _FLOW, article or paths.tag(n) == "article")
        return place[up[0] if up else n]

    joins: dict[int, list[tuple[Block, bool, bool]]] = defaultdict(list)
    for b in found:
        k, flow, article = placed(b.node)
        joins[k].append((b, flow, article))
    had = sum(len(b.text) - b.linked for b, _, _ in joins[at])
    weight = linked = 0
    own = articles = False
    for k in range(at - 1, last - 1, -1):
        own = own and tags[k + 1] in _FLOW
        for b, flow, article in joins[k]:
            weight, linked = weight + len(b.text) - b.linked, linked + b.linked
            own = own or (flow and 2 * b.linked < len(b.text))
            articles = articles or article
        if linked > weight or articles:
            break
        if own or (weight + linked and weight >= LARGE_PART * had):
            at, had = k, had + weight
            weight = linked = 0
            own = False
    return around[at]


def voted(found: list[Block], paths: Paths) -> str | None:
    """The path that a page votes for."""
    node = widened(found, paths, best_node(found, paths))
    return None if node is None else paths.text(node)


def _inside(found: list[Block], paths: Paths, node: int | None) -> list[str]:
    if node is None:
        return []
    within = {node: True, -1: False}
    for n in range(len(paths.names)):  # a container comes before those in it
        within.setdefault(n, within[paths.parents[n]])
    return [b.text for b in found if within[b.node]]


def extract(page: str | None, path: str | None) -> str:
    """The text of the containers on ``path``, else of the page's best one."""
    found, paths = blocks(page or "")
    chosen = _inside(found, paths, None if path is None else paths.find(path))
    if not chosen:
        chosen = _inside(found, paths, widened(found, paths, best_node(found, paths)))
    return "\n".join(chosen)


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    votes: Counter = Counter()
    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            votes[host, voted(*blocks(page.as_py() or ""))] += 1
        if len(votes) > 100_000:
            yield _votes(votes)
            votes.clear()
    yield _votes(votes)


def _votes(votes: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in votes], pa.string()), pa.array([k[1] for k in votes], pa.string()),
         pa.array(list(votes.values()), pa.int64())], names=["host", "path", "votes"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(page.as_py(), path) for page, path in
                 zip(batch.column(2), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["id", "url", "text", "n_chars"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes, pages): the winning path of each host of (host, html) rows."""
    votes = pages.mapInArrow(_vote, "host string, path string, votes long").groupBy("host", "path").agg(
        F.sum("votes").alias("votes"))
    return stored(votes.groupBy("host").agg(
        F.min_by("path", F.struct(F.col("path").isNull(), -F.col("votes"), "path")).alias("path"),
        F.max("votes").alias("votes"), F.sum("votes").alias("pages")), "host-paths")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page: its id, url, ``text`` and ``n_chars``."""
    T.bounded_batches(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract(url_col, r"://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"), host.alias("host"))
    winners = host_paths(rows.select("host", "html"))
    total = winners.agg(F.sum("pages")).first()[0] or 0
    both = join_groups(rows, winners.drop("votes"), "host", "pages", total).select("id", "url", "html", "path")
    return (both.mapInArrow(_extract, "id long, url string, text string, n_chars long")
            .withColumnsRenamed({"id": id_col, "url": url_col}))
