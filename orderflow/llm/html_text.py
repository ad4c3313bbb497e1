"""Main text of web pages by tree scoring.

The open elements of a page are followed tag by tag. Every paragraph earns
points for its length and commas and passes them to the elements above it:
all to its parent, half to the next, then a third and so on, ``REACH`` levels
up; ``article`` and ``main`` get all points of what they hold. A container's points are
discounted by the share of its text that is in links. The best container is
the article, together with its siblings that score well or have few links;
on pages without article or main also the siblings of what it lies in, if
they hold a paragraph. Menus,
headers, adverts and the like are left out by element and by the words of
their class, id or role. A class or id that says only that (``cookie-notice``)
takes its element out, unless that wraps most of the page; one that says more
(``social-impact``, ``has-sidebar``) only if most of the text is links. Inside a
line of text (``<span class="ad">``) a class or id decides only if the line has
no other text.

Elements are listed in the order of their start tags, so sums over what an
element holds are one pass backwards and marks of what holds it one pass
forwards: the time does not grow with the depth of the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import ids_and_bytes, slices

SLICE_BYTES = 1 << 22
CHARS_PER_POINT = 100
MAX_LENGTH_POINTS = 3.0
SIBLING_SHARE = 0.2
SIBLING_LEAST = 10.0
SIBLING_CHARS = 80
WRAPPER_SHARE = 0.5
MOSTLY_LINKS = 0.5
#: Levels that points are passed up, with a share of 1 / level.
REACH = 64

# Fixed values of the HTML vocabulary.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
DROPPED = frozenset("head nav footer aside form script style textarea title noscript template iframe xmp button select svg canvas object audio video dialog menu".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPH = frozenset("p pre li h1 h2 h3 h4 h5 h6 blockquote td th dd dt figcaption summary address".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
WHOLE = frozenset(("article", "main"))
CLOSES_P = BLOCK - {"body", "html"}
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related recommended respond share sharing sidebar skip social sponsor sponsored subscribe toolbar".split()
)
# Words of place and shape beside which a boilerplate word still says it all.
FRAME_WORDS = frozenset(
    "area article articles bar block blog body bottom box button buttons center col column container content count desktop entry fixed form global group heading icon icons inner item items left link links list main mobile outer overlay page panel post posts primary right row secondary section signup site slot stories story sticky sub text thread title top unit wrap wrapper".split()
)
# What readers write: it may well be longer than the article.
DISCUSSION_WORDS = frozenset("comment comments disqus respond".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_UNMARKED, _HINTED, _MARKED, _DISCUSSION = range(4)


@dataclass(slots=True, eq=False)
class Element:
    tag: str
    parent: Element | None
    dropped: bool
    mark: int = _UNMARKED
    depth: int = 0
    #: The nearest block element, itself included.
    box: Element | None = None
    #: Of all that it holds: blocks, their points, the longest, ``article`` and ``main``.
    blocks: int = 0
    held_points: float = 0.0
    longest: int = 0
    wholes: int = 0
    points: float = 0.0
    chars: int = 0
    link_chars: int = 0
    gone: bool = False

    def score(self) -> float:
        return self.points * (1 - self.link_chars / self.chars) if self.chars else 0.0


@dataclass(slots=True)
class Block:
    text: str
    above: Element
    link_chars: int

    def points(self) -> float:
        return 1 + self.text.count(",") + self.text.count("，") + min(len(self.text) / CHARS_PER_POINT, MAX_LENGTH_POINTS)


def _attributes(text: str) -> dict[str, str]:
    """Values by lower-case name; of a repeated name the first counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), "".join(values))
    return found


def _token_mark(token: str) -> int:
    said = [w.lower() for w in _WORDS.findall(token)]
    if BOILERPLATE_WORDS.isdisjoint(said):
        return _UNMARKED
    if any(len(w) > 1 and not w.isdigit() and w not in BOILERPLATE_WORDS and w not in FRAME_WORDS for w in said):
        return _HINTED
    return _MARKED if DISCUSSION_WORDS.isdisjoint(said) else _DISCUSSION


def _hidden_and_mark(tag: str, text: str) -> tuple[bool, int]:
    """Whether the attributes take the element out whatever it holds, and what
    its class and id say. The id of a heading is made from its words."""
    if not text or text.isspace():
        return False, _UNMARKED
    has = _attributes(text)
    if "hidden" in has or has.get("aria-hidden", "").lower() == "true" or has.get("role", "").lower() in BOILERPLATE_ROLES:
        return True, _UNMARKED
    if tag in ("html", "body", "article", "main"):
        return False, _UNMARKED
    tokens = has.get("class", "").split() + (has.get("id", "").split() if tag not in HEADING else [])
    return False, max(map(_token_mark, tokens), default=_UNMARKED)


def _sum_up(found: list[Block], elements: list[Element]) -> None:
    """Leave on every element the sums of what it holds."""
    for e in elements:
        e.blocks = e.chars = e.link_chars = e.longest = e.wholes = 0
        e.held_points = 0.0
    for b in found:
        e = b.above
        e.blocks += 1
        e.held_points += b.points()
        e.chars += len(b.text)
        e.link_chars += b.link_chars
        e.longest = max(e.longest, len(b.text))
    for e in reversed(elements):
        e.wholes += e.tag in WHOLE and e.blocks > 0
        up = e.parent
        if up is not None and e.blocks:
            up.blocks += e.blocks
            up.held_points += e.held_points
            up.chars += e.chars
            up.link_chars += e.link_chars
            up.longest = max(up.longest, e.longest)
            up.wholes += e.wholes


def _without_marked(found: list[Block], elements: list[Element]) -> list[Block]:
    """The blocks outside of elements whose mark decides. A hint decides if
    most of the text is links. Any other mark does, unless the element wraps
    the page: most of all paragraph points, few links, a text of some length,
    and every article or main that has text. Discussions stay only if there is
    nothing else."""
    _sum_up(found, elements)
    root = elements[0]
    for e in elements:
        if e.mark == _HINTED:
            e.gone = e.link_chars > MOSTLY_LINKS * e.chars
        elif e.mark:
            most = e.blocks == root.blocks if e.mark == _DISCUSSION else e.held_points > WRAPPER_SHARE * root.held_points
            e.gone = not (most and e.link_chars < 0.25 * e.chars and e.longest > SIBLING_CHARS and e.wholes == root.wholes)
        e.gone = e.gone or e.parent is not None and e.parent.gone
    return [b for b in found if not b.above.gone]


def _score(found: list[Block], elements: list[Element]) -> None:
    """Leave the blocks' points and text lengths on the elements above them."""
    _sum_up(found, elements)
    for b in found:
        above = b.above.parent if b.above.tag in PARAGRAPH and b.above.parent is not None else b.above
        points = b.points()
        for level in range(1, REACH + 1):
            if above.tag not in WHOLE:
                above.points += points / level
            if (above := above.parent) is None:
                break
    for e in elements:
        if e.tag in WHOLE:
            e.points = e.held_points


class _Page:
    """The page's elements and text blocks in order, without boilerplate."""

    def __init__(self, page: str) -> None:
        self.root = Element("html", None, False)
        self.root.box = self.root
        self.elements, self.blocks = [self.root], []
        self._open = [self.root]
        self._at: dict[str, list[int]] = {}  # places of the open elements by tag
        self._links = self._noted = 0  # open links, open inline elements with a mark
        self._held: list[str] = []
        self._held_links = self._held_noted = 0
        self._read(page)
        if any(e.mark for e in self.elements):
            self.blocks = _without_marked(self.blocks, self.elements)
        _score(self.blocks, self.elements)

    def _flush(self) -> None:
        if not self._held:
            return
        raw = "".join(self._held)
        text = " ".join(html.unescape(raw).split())
        in_links, noted = self._held_links, self._held_noted
        self._held.clear()
        self._held_links = self._held_noted = 0
        # A text that lies in marked elements alone is marked.
        if text and noted < len(raw) - raw.count(" ") - raw.count("\n") - raw.count("\t") - raw.count("\r"):
            self.blocks.append(Block(text, self._open[-1].box, min(in_links, len(text))))

    def _hold(self, text: str) -> None:
        self._held.append(text)
        if self._links:
            self._held_links += len(text)
        if self._noted:
            self._held_noted += len(text)

    def _inside(self, tags: frozenset[str] | set[str]) -> int:
        """Place of the nearest open element of those names; 0 without one."""
        return max((self._at[t][-1] for t in tags if self._at.get(t)), default=0)

    def _close(self, names: set[str] | frozenset[str], stop: set[str] | frozenset[str]) -> None:
        """End the nearest open element of those names, unless ``stop`` is nearer."""
        place = self._inside(names)
        if not place or place < self._inside(stop):
            return
        while len(self._open) > place:
            ended = self._open.pop()
            self._at[ended.tag].pop()
            self._links -= ended.tag == "a"
            self._noted -= ended.mark > _HINTED and ended.box is not ended

    def _read(self, page: str) -> None:
        at = 0
        for m in iter(lambda: _TAG.search(page, at), None):
            top = self._open[-1]
            if m.start() > at and not top.dropped:
                self._hold(page[at : m.start()])
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            tag, ending = name.lower(), m[1] or m[4]
            if tag == "br" or tag == "hr":
                if not top.dropped:
                    self._held.append(" ")
            if tag in BLOCK and not top.dropped:
                self._flush()
            if ending:
                if tag not in VOID:
                    self._close({tag}, {"article", "main", "body"} if tag not in BLOCK else frozenset())
                continue
            attributes = m[3] if m[2] else m[6]
            if tag in VOID:
                continue
            if tag in CLOSES_P:
                self._close({"p"}, {"article", "main", "section", "div", "td", "th", "li", "blockquote", "body", "table"})
            if tag in SAME_ENDS:
                self._close(SAME_ENDS[tag], SCOPE[tag])
            top = self._open[-1]
            dropped, mark = top.dropped or tag in DROPPED or tag == "header" and not self._inside(WHOLE), _UNMARKED
            if not dropped:
                dropped, mark = _hidden_and_mark(tag, attributes)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
                continue
            if tag in ("html", "body"):
                continue
            element = Element(tag, top, dropped, mark, top.depth + 1)
            element.box = element if tag in BLOCK else top.box
            if tag not in BLOCK:
                self._noted += mark > _HINTED
            self._at.setdefault(tag, []).append(len(self._open))
            self._open.append(element)
            self._links += tag == "a"
            if not dropped:
                self.elements.append(element)
        if at < len(page) and not self._open[-1].dropped:
            self._hold(page[at:])
        self._flush()
        for e in self.elements:
            if e.box is not e:
                e.mark = _UNMARKED


def main_text(page: str | None) -> str:
    """The article's blocks, joined by line breaks; empty if there are none."""
    tree = _Page(page) if page else None
    if tree is None or not tree.blocks:
        return ""
    found, elements = tree.blocks, tree.elements
    scored = [e for e in elements if e.blocks and e.points > 0]
    most = max(e.score() for e in scored)
    # Equal but for rounding: the outermost, of these the first.
    best = min((e for e in scored if e.score() >= most * (1 - 1e-9)), key=lambda e: e.depth)
    limit = max(SIBLING_LEAST, SIBLING_SHARE * most)
    # What the best container lies in, up to the article or main.
    around: set[Element] = set()
    e = best
    while e.parent is not None and (e is best or e.tag not in WHOLE):
        e = e.parent
        around.add(e)
        if best.tag in WHOLE:
            break
    # By element: what it lies in that is the best container, beside it, or
    # beside or one of those around it.
    side: dict[Element, Element | None] = {}
    for e in elements:
        own = e is best or e in around or e.parent in around
        side[e] = e if own else side[e.parent] if e.parent is not None else None
    held: dict[Element, bool] = {}
    for b in found:
        if (e := side[b.above]) is not None:
            held[e] = held.get(e, False) or _is_paragraph(b)
    kept = []
    for b in found:
        e = side[b.above]
        if e is best or e is not None and _good_sibling(e, b, held[e], e.parent is best.parent, e in around, limit):
            kept.append(b.text)
    return "\n".join(kept)


def _is_paragraph(b: Block) -> bool:
    return b.link_chars < 0.25 * len(b.text) and (len(b.text) > SIBLING_CHARS or b.text.endswith("."))


def _good_sibling(e: Element, block: Block, paragraphs: bool, beside: bool, around: bool, limit: float) -> bool:
    """Whether a block outside the best container stays. ``e`` is the sibling
    that holds it, maybe with ``paragraphs``, beside the best container or
    farther out; or, for text of its own, an element around the best."""
    if around:
        return block.above.tag in HEADING or _is_paragraph(block)
    if e.score() >= limit or e.tag in HEADING:
        return True
    if e.link_chars < 0.25 * e.chars:
        if e.tag in PARAGRAPH:
            return e.chars > SIBLING_CHARS or block.text.endswith(".")
        if beside or paragraphs:
            return True
    return _is_paragraph(block)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "data", SLICE_BYTES):
        texts = [main_text(d.decode("utf-8", "replace")) if d else "" for d in batch.column("data").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64))],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars`` (code points). Null or
    empty pages, and those with nothing but boilerplate, have an empty text.
    Ids may be null or repeat; broken markup is read as far as it goes; of
    equally good containers the outermost that comes first is taken."""
    id_type = pages.schema[id_col].dataType.simpleString()
    rows = ids_and_bytes(pages, id_col, html_col, F.col(f"`{url_col}`").cast("string").alias("url"))
    return rows.mapInArrow(_texts, f"page_id {id_type}, url string, text string, n_chars bigint")
