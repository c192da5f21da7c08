"""Main text of web pages by tag-path ratios.

Every piece of text has a root-to-leaf tag path. Per path, text length and punctuation are summed over its text
nodes and divided by their number; both ratios are smoothed over neighbouring paths in page order, fused by
multiplication and with a prior that is 0 inside menus, footers, adverts and the like, and cut off at a share of
their standard deviation. The prior goes by tags and names, so it is lifted from an element that turns out to hold the
article: the only article, main or h1 elements, or most of the text. The paths above it point out the content; the deepest container of all of them, never one
inside an article or main element, is the article, and every block in it comes out except what the prior rules out. A
title (h1) before or after an article or main element without one comes out too.
"""

import re
from bisect import bisect_right
from collections import Counter
from html import unescape
from itertools import groupby
from statistics import pstdev
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Share of the standard deviation that a path must reach.
CUT = 0.2
# Weights of a path and its neighbours in page order.
_SMOOTH = (0.25, 0.5, 0.25)
_PUNCTUATION = re.compile(r"[.,;:!?]")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>"
    r"|</?[a-zA-Z][^>]*\Z"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL,
)
# Whole attributes, so that neither a longer name nor a value is taken for one of those looked for.
_ATTRIBUTE = re.compile(r"([^\s\"'=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is no text of the page.
_RAW = frozenset("script style noscript template iframe svg textarea select object canvas audio video head title".split())
_NO_MARKUP = frozenset("script style textarea title".split())
_SIDE = frozenset("nav footer aside form button menu dialog fieldset label".split())
_MAIN = frozenset(("article", "main"))
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
_UNNAMED = _INLINE | _HEADINGS | frozenset(("html", "body", *_MAIN))
# Blocks of an article, never its container.
_LEAVES = _INLINE | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd tr th td thead tbody table blockquote pre figure figcaption hgroup".split())
_SIDE_NAME = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|header|masthead|footer|sidebar|aside|cookies?|consent|gdpr|notice|banner|alert"
    r"|ads?|advert\w*|sponsor\w*|promo\w*|share|sharing|social|related|recommend\w*|comments?|disqus|repl(?:y|ies)"
    r"|newsletter|subscri\w+|signup|login|popup|modal|overlay|breadcrumbs?|pagination|pager|widget|skip|search)(?:$|[\s_-])",
    re.I,
)
# Words that say what an element has beside it or is for, not what it is: 'with-sidebar', 'no-comments', 'entry-header'.
_BESIDE = re.compile(
    r"(?:^|(?<=[\s_-]))(?:(?:with|without|has|have|no|not|non|hide|show|is)[_-]\S*|(?:entry|post|article|story|content|title)[_-]header(?=$|[\s_-]))",
    re.I,
)
_SIDE_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
# How sure the prior is of an element: not at all of what often wraps a page; of names; of tags and roles; of what is not shown.
_WRAPPER, _NAMED, _TAGGED, _UNSEEN = range(4)
_WRAPPERS = frozenset(("form", "fieldset", "header"))
# Shares of the text: an element with more holds most of it; with less left besides, it may also hold the article of a page whose h1 is outside.
MOST, REST = 0.5, 0.1
# Opening one of these ends an open one of the others.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
         "th": ("td", "th"), "option": ("option",)}


class _Side(NamedTuple):
    """An element that the prior rules out: where it begins, how sure, and whether in an article or main element."""

    start: int
    sure: int
    inside: bool


def _side(tag: str, attributes: str, inside_main: bool) -> int | None:
    """How sure the prior rules an element out; None if it does not."""
    found = [_WRAPPER if tag in _WRAPPERS else _TAGGED] if tag in _SIDE or tag == "header" and not inside_main else []
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDDEN.search(value):
            found.append(_UNSEEN)
        if name == "role" and value.lower() in _SIDE_ROLE:
            found.append(_WRAPPER if value.lower() in _WRAPPERS else _TAGGED)
        # Headings and pieces of a line are named for what they say or link to.
        if name in ("class", "id") and tag not in _UNNAMED and _SIDE_NAME.search(_BESIDE.sub("", value)):
            found.append(_NAMED)
    return max(found, default=None)


class _Path:
    """A root-to-leaf tag path, one object for each; `main` is its first article or main element, itself included."""

    __slots__ = ("children", "main", "parent", "tag", "titled")

    def __init__(self, parent: "_Path | None" = None, tag: str = ""):
        self.parent, self.tag, self.children = parent, tag, {}
        self.main = (parent and parent.main) or (self if tag in _MAIN else None)
        self.titled = tag == "h1" or bool(parent and parent.titled)

    def below(self, tag: str, known: list["_Path"]) -> "_Path":
        if tag not in self.children:
            self.children[tag] = _Path(self, tag)
            known.append(self.children[tag])
        return self.children[tag]


class _Open:
    """The open elements, with the places of each tag, so that none needs a look at all of them."""

    def __init__(self):
        self.known = [_Path()]
        self.stack: list[tuple[_Path, tuple[_Side, ...]]] = [(self.known[0], ())]
        self.places: dict[str, list[int]] = {}

    @property
    def path(self) -> _Path:
        return self.stack[-1][0]

    @property
    def sides(self) -> tuple[_Side, ...]:
        return self.stack[-1][1]

    def last(self, tags) -> int:
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=-1)

    def first_after(self, tags, border: int) -> int | None:
        found = []
        for tag in tags:
            places = self.places.get(tag, ())
            if places and places[-1] > border:
                found.append(places[bisect_right(places, border)])
        return min(found, default=None)

    def push(self, tag: str, sides: tuple[_Side, ...]) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((self.path.below(tag, self.known), sides))

    def cut(self, place: int) -> None:
        while len(self.stack) > place:
            self.places[self.stack.pop()[0].tag].pop()


def _nodes(html: str) -> tuple[list[tuple[int, _Path, tuple[_Side, ...], str]], list[_Path]]:
    """(block, path, sides, text) of the text nodes in page order, where a line break is a node with a blank; all paths,
    parents first."""
    opened = _Open()
    found, block, at = [], 0, 0
    while match := _TOKEN.match(html, at):
        at = match.end()
        if text := match["text"]:
            found.append((block, opened.path, opened.sides, unescape(text)))
            continue
        tag = match["tag"] or match["tag2"]
        if not tag:
            continue
        tag, closing = tag.lower(), match["close"] or match["close2"]
        if tag not in _INLINE:
            block += 1
        if closing:
            if (place := opened.last((tag,))) > 0:
                opened.cut(place)
            continue
        if tag == "br":
            found.append((block, opened.path, opened.sides, " "))
        if tag in _VOID:
            continue
        if tag in _RAW:
            # Up to its end; what has markup inside may hold the same tag again, which changes nothing.
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            if not end and tag == "head":
                end = re.compile(r"(?=<body\b)", re.I).search(html, at)
            if not end and tag == "head":
                continue  # neither ends it; what may stand in it has no text of the page
            if not match[0].endswith("/>") or tag in _NO_MARKUP:
                at = end.end() if end else len(html)
            continue
        if tag not in _INLINE:
            # Not beyond the list or table that the new one belongs to.
            border = opened.last(("ul", "ol", "dl", "table"))
            if (first := opened.first_after((*_ENDS.get(tag, ()), "p"), border)) is not None:
                opened.cut(first)
        if not match[0].endswith("/>"):
            sides, inside = opened.sides, opened.path.main is not None
            if (sure := _side(tag, match["rest"] or match["rest2"] or "", inside)) is not None:
                sides += (_Side(match.start(), sure, inside),)
            opened.push(tag, sides)
    return found, opened.known


def _inside(path: _Path) -> bool:
    return path.main is not None


def _lifted(nodes) -> set[_Side]:
    """The ruled-out elements that hold the article after all."""
    texts = [(path, sides, len(text.strip())) for _, path, sides, text in nodes if text.strip()]
    texts = [node for node in texts if not any(side.sure == _UNSEEN for side in node[1])]
    lifted: set[_Side] = set()
    kept = lambda sides: lifted.issuperset(sides)
    total = sum(chars for *_, chars in texts)

    # An article or main element, where the page has no other; the one with most text and those with only wrappers above.
    titled = any(path.titled and kept(sides) for path, sides, _ in texts)
    if not any(_inside(path) and kept(sides) for path, sides, _ in texts):
        above: Counter = Counter()
        for path, sides, chars in texts:
            if _inside(path):
                above[tuple(side for side in sides if not side.inside)] += chars
        if above and (not titled or above.most_common(1)[0][1] > MOST * total):
            lifted.update(above.most_common(1)[0][0])
            if not titled:
                lifted.update(*[sides for sides in above if all(side.sure == _WRAPPER or side in lifted for side in sides)])
    has_main = any(_inside(path) and kept(sides) for path, sides, _ in texts)

    # A title, where there is no other; where there is an article, only one in it.
    titles = [sides for path, sides, _ in texts if path.titled and (_inside(path) or not has_main)]
    if not any(kept(sides) for sides in titles):
        lifted.update(*[sides for sides in titles if all(side.sure <= _NAMED for side in sides if side not in lifted)])
    if has_main:
        return lifted

    # Most of the text that may be the article.
    own = [(path, sides, chars) for path, sides, chars in texts if all(side.sure <= _NAMED or side in lifted for side in sides)]
    total = sum(chars for *_, chars in own)
    rest = sum(chars for path, sides, chars in own if kept(sides) and not path.titled)
    titled = any(path.titled and kept(sides) for path, sides, _ in own)
    holds: Counter = Counter()
    for _, sides, chars in own:
        for side in sides:
            holds[side] += chars
    for side, chars in holds.items():
        if chars > MOST * total and (side.sure == _WRAPPER or not titled or rest < REST * total):
            lifted.add(side)
    return lifted


def _smoothed(values: list[float]) -> list[float]:
    padded = [values[0], *values, values[-1]]
    return [sum(w * v for w, v in zip(_SMOOTH, padded[i : i + 3], strict=True)) for i in range(len(values))]


def _container(nodes, known: list[_Path]) -> _Path:
    """The path of the element that holds the content: all selected paths, and an article or main element whole."""
    sums: dict[_Path, list[float]] = {}
    for _, path, side, text in nodes:
        text = text.strip()
        if text and not side:
            own = sums.setdefault(path, [0, 0, 0])
            own[0] += len(text)
            own[1] += len(_PUNCTUATION.findall(text))
            own[2] += 1
    if not sums:
        return known[0]
    lengths, marks = [], []
    # Not across the border of an article, or what is next to it would be taken for a part of it.
    for _, run in groupby(sums, key=_inside):
        own = [sums[path] for path in run]
        lengths += _smoothed([chars / count for chars, _, count in own])
        marks += _smoothed([1 + points / count for _, points, count in own])
    scores = [a * b * (2 if _inside(path) else 1) for path, a, b in zip(sums, lengths, marks, strict=True)]
    cut = min(CUT * pstdev(scores), max(scores))
    # The deepest path above all selected ones has them all below it.
    below = {path: score >= cut for path, score in zip(sums, scores, strict=True)}
    every = sum(below.values())
    common = known[0]
    for path in reversed(known):
        count = below.get(path, 0)
        if count == every:
            common = path
            break
        below[path.parent] = below.get(path.parent, 0) + count
    if common.main:
        return common.main
    while common.tag in _LEAVES:
        common = common.parent
    return common


def main_text(html: str | None) -> str:
    """The blocks of the article, joined by empty lines; empty without any."""
    nodes, known = _nodes(html or "")
    if any(sides for _, _, sides, _ in nodes):
        lifted = _lifted(nodes)
        nodes = [(block, path, not lifted.issuperset(sides), text) for block, path, sides, text in nodes]
    container = _container(nodes, known)
    inner = {container}
    for path in known:  # parents come first
        if path.parent in inner:
            inner.add(path)
    held = inner.__contains__
    titled = not _inside(container) or any(path.titled and held(path) and text.strip() for _, path, side, text in nodes if not side)
    blocks = []
    for _, parts in groupby(nodes, key=lambda node: node[0]):
        kept = [text for _, path, side, text in parts if not side and (held(path) or not titled and path.titled)]
        if text := " ".join("".join(kept).split()):
            blocks.append(text)
    return "\n\n".join(blocks)


def extracted(pages: DataFrame) -> DataFrame:
    """`page_id, url, text, n_chars` of every page row, from its whole html.

    NULL or empty html gives an empty text. NULL ids or urls and repeated rows stay as they are; markup that is cut
    off at the end is dropped, unclosed elements end with the one around them.
    """

    @F.arrow_udf("string")
    def text(html: pa.Array) -> pa.Array:
        return pa.array([main_text(page.as_py()) for page in html], pa.string())

    rows = pages.select("page_id", "url", text("html").alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
