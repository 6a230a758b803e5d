"""Main text of web pages by tag-path ratios.

1. The page is read into text nodes, each with its path of tags from the root.
2. Per path, the lengths and punctuation marks of its nodes are added up. Their
   ratios to the number of nodes are large for prose and small for menus.
3. Along the page both ratios are smoothed with a Gaussian window and fused into
   one score; paths whose score reaches a share of the spread of the scores are
   content. Paths through elements that are no content by tag, role or name, and
   paths that are mostly links, are not. A name sets no element aside that wraps
   most of the prose, nor does one after a word such as "has" or "no". Nor does a
   form, or an element that is never closed, if it wraps most of the prose, or one
   with the article, the main element or the first heading in it.
4. The content block is the deepest container that holds all the text of content
   paths, or the article or main element around it. Its text is the result,
   block by block in page order, without the elements that are no content by tag,
   role or name. So a short line of an article is kept with it. Before the first
   and after the last block of content, blocks that are mostly links go too,
   unless the element that holds nearly all of the content holds them.

Character references are decoded, white space in a block becomes one space, and
blocks are joined by a line break. Pages are independent rows: nothing shuffles.

Nulls: a null or empty page, or one without content, has an empty text. Rows
with a null or repeated id are extracted each. An empty table gives an empty one;
further columns are not read. Pages of any length and depth take time and memory
in proportion; a page is held by one task. Of equally good containers the deepest
counts, and of those the first.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, longs, map_batches

SPREADS = 0.3     # share of the scores' standard deviation that makes a path content
WINDOW = 2        # nodes on each side that smooth a ratio
LIKE_TEXT = 0.5   # share of the content's mean ratios that makes a box on the page one of it
NEARLY_ALL = 0.8  # share of the content text in the element that keeps its lists of links

# HTML elements by what they do.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW = frozenset("script style textarea title noscript iframe xmp template".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p "
    "pre section summary table tbody td tfoot th thead tr ul".split()
)
# Blocks that are parts of a text and no containers of one.
_PARTS = frozenset(
    "address blockquote caption dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr li ol option p pre "
    "summary table tbody tfoot thead tr ul".split()
)
_ENDS_P = _BLOCK - {"body", "caption", "html", "option", "tbody", "td", "tfoot", "th", "thead", "tr"}
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_ASIDE_TAGS = frozenset(
    "head nav aside footer form menu button select dialog svg canvas audio video object "
    "datalist map".split()
)
# What may stand in a head; anything else, and any text, ends one that is left open.
_HEAD_TAGS = frozenset("base head link meta noscript script style template title".split())
_PAGE = frozenset(["", "html", "body"])
_ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar "
    "form toolbar".split()
)
_ASIDE_NAMES = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored promo promos "
    "promotion banner sidebar sidebars aside menu menus nav navbar navigation breadcrumb "
    "breadcrumbs footer footnav masthead topbar toolbar comment comments commentlist disqus reply "
    "replies respond cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay newsletter subscribe subscription signup login register share sharing social related "
    "recommended recommendations widget widgets pagination pager skip search".split()
)
# Names of what readers add, which can be longer than the text itself.
_READERS_NAMES = frozenset(
    "comment comments commentlist disqus reply replies respond".split()
)
# The name after such a word says what the element holds or lacks, not what it is.
_MODIFIERS = frozenset("has have with without no not non hide hides".split())
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")
_TAG_NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_STOP = re.compile(r"[>=]")
_QUOTE = re.compile(r"\s*+([\"'])")
_ATTRIBUTE = re.compile(
    r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?"
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class _Element:
    __slots__ = ("tag", "parent", "path", "aside", "named", "link", "own", "closed", "holds")

    def __init__(self, tag: str, parent: _Element | None, path: int, aside: bool, named: str = ""):
        self.tag, self.parent, self.path = tag, parent, path
        self.closed = self.holds = False  # by an end tag; an article, main element or h1
        self.aside = aside or bool(parent and parent.aside)
        self.named = "" if self.aside else named
        self.link = tag == "a" or bool(parent and parent.link)
        self.own = 0


class _Tags:
    """Finds where tags end, in time linear in the page however long their values are.

    A quoted value ends at its quote; a quote that never closes opens nothing.
    """

    def __init__(self, page: str):
        self.page = page
        self.dead: set[int] = set()  # stops from which no tag comes to an end
        self.near = (0, -1)          # between these no stop lies but the last

    def end(self, at: int) -> int:
        """The place of the ``>`` of a tag whose name ends at a place, or -1."""
        passed = []
        while True:
            if not self.near[0] <= at <= self.near[1]:
                stop = _STOP.search(self.page, at)
                self.near = (at, stop.start() if stop else len(self.page))
            at = self.near[1]
            if at == len(self.page) or at in self.dead:
                self.dead.update(passed)
                return -1
            if self.page[at] == ">":
                return at
            passed.append(at)
            quote = _QUOTE.match(self.page, at + 1)
            closing = self.page.find(quote.group(1), quote.end()) if quote else -1
            at = closing + 1 if closing >= 0 else at + 1


def _aside_name(value: str) -> str:
    """The first name in a class or id that can set an element aside."""
    for name in value.split():
        words = [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", name)]
        for before, word in zip(["", *words], words):
            if word in _ASIDE_NAMES and before not in _MODIFIERS:
                return word
    return ""


def _names(attributes: str) -> tuple[str, bool, str]:
    """The class for the path, whether the attributes set aside, and a name that can do so."""
    shown, aside, named = "", False, ""
    for match in _ATTRIBUTE.finditer(attributes):
        key = match.group(1).lower()
        value = next((g for g in match.groups()[1:] if g is not None), "")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            aside = True
        elif key == "style":
            aside = aside or bool(_HIDDEN.search(value))
        elif key == "role":
            aside = aside or value.strip().lower() in _ASIDE_ROLES
        elif key in ("class", "id"):
            named = named or _aside_name(value)
            if key == "class":
                shown = value
    return shown, aside, named


def _set_aside(named: list[_Element], nodes: list[tuple[_Element, int, str]]) -> None:
    """Set elements aside by name, but no wrapper, which holds most prose of what is around it.

    The prose is compared with that of the article or main element around, or of
    the page. What readers add may be longer than the text: it is a wrapper only
    with the main element, a first heading or nearly all prose in it, and outside
    an article. An article or main element elsewhere leaves no named wrapper.
    """
    prose: dict[int, int] = {}
    headed, every = set(), {}
    for element, _, text in nodes:
        size = 0 if element.aside or element.link else len(text.strip())
        up = element
        while up and size:
            prose[id(up)] = prose.get(id(up), 0) + size
            every[id(up)] = up
            if up.tag in ("main", "h1"):
                over = up
                while over and id(over) not in headed:
                    headed.add(id(over))
                    over = over.parent
            up = up.parent
    texts = [e for e in every.values() if e.tag in ("article", "main")]
    aside = set()
    for element in named:
        own, scope = prose.get(id(element), 0), element.parent
        while scope.parent and scope.tag not in ("article", "main"):
            scope = scope.parent
        share = own / max(prose.get(id(scope), 0), 1)
        wrapper = share > 0.5
        if element.named == element.tag and element.closed and element.tag != "form":
            wrapper = wrapper and element.holds
        elif element.named in _READERS_NAMES:
            wrapper = wrapper and not scope.parent and (id(element) in headed or share >= 0.95)
        if wrapper and not scope.parent:
            wrapper = not texts or any(_inside(e, element) for e in texts)
        if not wrapper:
            aside.add(id(element))
    if aside:
        _inherit(nodes, aside)


def _inherit(nodes: list[tuple[_Element, int, str]], aside: set[int]) -> None:
    known: set[int] = set()
    for element, _, _ in nodes:
        line = []
        while element and id(element) not in known:
            line.append(element)
            element = element.parent
        for node in reversed(line):
            node.aside = node.aside or id(node) in aside or bool(node.parent and node.parent.aside)
            known.add(id(node))


def _nodes(page: str) -> list[tuple[_Element, int, str]]:
    """(element, number of the block, text) of every text node that is no raw text."""
    root = _Element("", None, 0, False)
    at, block, nodes, named_ones = root, 0, [], []
    place, end, tags = 0, len(page), _Tags(page)
    paths: dict[tuple[int, str], int] = {}  # the number of a path, by its parent's and a name
    head: _Element | None = None

    def leave_head() -> None:
        nonlocal at, head
        at, head = head.parent, None

    def text(upto: int) -> None:
        if upto > place:
            piece = unescape(page[place:upto])
            if piece:
                if head and piece.strip():
                    leave_head()
                nodes.append((at, block, piece))

    def close(names: set, stops: set) -> None:
        """Leave the outermost open element of these names that no stop encloses first."""
        nonlocal at
        node, leave = at, None
        while node.parent and node.tag not in stops:
            if node.tag in names:
                leave = node
            node = node.parent
        if leave:
            at = leave.parent

    search = 0
    while True:
        start = page.find("<", search)
        if start < 0:
            text(end)
            break
        if page.startswith("<!--", start):
            text(start)
            close_at = page.find("-->", start + 4)
            place = search = end if close_at < 0 else close_at + 3
            continue
        if page.startswith(("<!", "<?"), start):
            text(start)
            close_at = page.find(">", start)
            place = search = end if close_at < 0 else close_at + 1
            continue
        match = _TAG_NAME.match(page, start)
        tag_end = tags.end(match.end()) if match else -1
        if tag_end < 0:
            search = start + 1
            continue
        text(start)
        place = search = tag_end + 1
        tag = match.group(2).lower()
        if match.group(1):
            node = at
            while node.parent and node.tag != tag:
                node = node.parent
            if node.parent:
                at, node.closed = node.parent, True
                head = head if head and _inside(at, head) else None
            block += tag in _BLOCK
            continue
        if head and tag not in _HEAD_TAGS:
            leave_head()
        if tag in _VOID:
            if tag == "br":
                nodes.append((at, block, " "))
            block += tag == "hr"
            continue
        if tag in _RAW:
            finish = re.compile(f"</{re.escape(tag)}", re.IGNORECASE).search(page, place)
            stop = page.find(">", finish.end()) if finish else -1
            place = search = end if stop < 0 else stop + 1
            continue
        if tag in _ENDS_P:
            close({"p"}, {"table", "button", "article", "section", "div", "li", "td", "th", "main"})
        if tag in _CLOSES:
            close(*_CLOSES[tag])
        attributes = page[match.end():tag_end]
        shown, aside, named = _names(attributes) if attributes.strip() else ("", False, "")
        if tag == "head":
            aside = True
        elif tag in _ASIDE_TAGS:
            named = tag
        elif tag == "header":
            node = at
            while node.parent and node.tag not in ("article", "main"):
                node = node.parent
            aside = aside or not node.parent
        elif tag in ("html", "body", "main", "article"):
            aside, named = False, ""  # their names describe the site or the layout
        step = (at.path, f"{tag}.{shown}" if shown else tag)
        at = _Element(tag, at, paths.setdefault(step, len(paths) + 1), aside, named)
        if tag == "head":
            head = at
        elif tag in ("article", "main", "h1"):
            up = at
            while up and not up.holds:
                up.holds, up = True, up.parent
        if at.named:
            named_ones.append(at)
        block += tag in _BLOCK
    # Tags that set aside do so, but where an element may wrap the text.
    sure = {
        id(e) for e in named_ones
        if e.named == e.tag and e.closed and e.tag != "form" and not e.holds
    }
    if sure:
        _inherit(nodes, sure)
    if len(named_ones) > len(sure):
        _set_aside([e for e in named_ones if id(e) not in sure], nodes)
    return nodes


def _smooth(values: np.ndarray) -> np.ndarray:
    offsets = np.arange(-WINDOW, WINDOW + 1)
    weights = np.exp(-offsets ** 2 / 2.0)
    padded = np.pad(values, WINDOW, mode="edge")
    return np.convolve(padded, weights / weights.sum(), mode="valid")


def content_paths(nodes: list[tuple[_Element, int, str]]) -> tuple[set[int], set[int]]:
    """The paths whose smoothed, fused ratios reach the threshold, and those like their text.

    The latter are told by the ratios of a path alone, which neighbours do not raise.
    """
    kept = [(e, t.strip()) for e, _, t in nodes if not e.aside and t.strip()]
    totals: dict[int, list[int]] = {}
    for element, text in kept:
        total = totals.setdefault(element.path, [0, 0, 0, 0])
        total[0] += 1
        total[1] += len(text)
        total[2] += len(_PUNCTUATION.findall(text))
        total[3] += len(text) * element.link
    if not kept:
        return set(), set()
    lengths = np.array([totals[e.path][1] / totals[e.path][0] for e, _ in kept])
    marks = np.array([totals[e.path][2] / totals[e.path][0] for e, _ in kept])
    fused = _smooth(lengths) * (1 + _smooth(marks))
    scores: dict[int, float] = {}
    for (element, _), value in zip(kept, fused.tolist(), strict=True):
        scores[element.path] = max(scores.get(element.path, 0.0), value)
    least = SPREADS * float(fused.std())
    content = {
        path for path, value in scores.items()
        if value >= least and 2 * totals[path][3] <= totals[path][1]
    }
    alone = {p: size / n * (1 + found / n) for p, (n, size, found, _) in totals.items()}
    weight = sum(totals[p][1] for p in content)
    mean = sum(alone[p] * totals[p][1] for p in content) / max(weight, 1)
    return content, {p for p in content if alone[p] >= LIKE_TEXT * mean}


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    nodes = _nodes(page)
    paths, alike = content_paths(nodes)
    content = [(e, len(t.strip())) for e, _, t in nodes if not e.aside and e.path in paths]
    total = sum(size for _, size in content)
    if not total:
        return ""
    for element, size in content:
        node = element
        while node:
            node.own += size
            node = node.parent
    dense, deepest = None, -1
    for element, _ in content:
        node = element
        while node.own < NEARLY_ALL * total:
            node = node.parent
        # Elements with more than half of the text lie on one line from the root.
        if (depth := _depth(node)) > deepest:
            dense, deepest = node, depth
    top = dense
    while top.own < total:
        top = top.parent
    direct = {id(_block_of(e)) for e, _ in content}
    dense, top = _container(dense, direct), _around(_container(top, direct))
    shown: dict[int, list[tuple[_Element, str]]] = {}
    for element, block, text in nodes:
        if not element.aside and _inside(element, top):
            shown.setdefault(block, []).append((element, text))
    whole = top.tag not in _PAGE

    def is_text(parts: list[tuple[_Element, str]]) -> bool:
        """Whether a block is one of the text; on the page itself a box has to be like it."""
        if not any(e.path in paths and t.strip() for e, t in parts):
            return False
        box = _block_of(parts[0][0])
        return whole or box.tag in _PARTS or any(e.path in alike for e, _ in parts)

    held = [is_text(parts) for parts in shown.values()]
    if not any(held):
        held = [any(e.path in paths and t.strip() for e, t in parts) for parts in shown.values()]
    first, last = held.index(True), len(held) - 1 - held[::-1].index(True)
    lines = []
    for place, parts in enumerate(shown.values()):
        # Menus and notices without a name lie around the text, never between its parts.
        if first <= place <= last or (
            _inside(parts[0][0], dense) and (whole or dense is not top)
        ) or not _mostly_links(parts) and (whole or _block_of(parts[0][0]).tag in _PARTS):
            lines.append(" ".join("".join(t for _, t in parts).split()))
    return "\n".join(line for line in lines if line)


def _inside(node: _Element | None, top: _Element) -> bool:
    while node and node is not top:
        node = node.parent
    return node is not None


def _mostly_links(parts: list[tuple[_Element, str]]) -> bool:
    sizes = [(len(t.strip()), e.link) for e, t in parts]
    return 2 * sum(n for n, link in sizes if link) > sum(n for n, _ in sizes)


def _block_of(node: _Element) -> _Element:
    while node.parent and node.tag not in _BLOCK:
        node = node.parent
    return node


def _container(node: _Element, direct: set[int]) -> _Element:
    """The nearest container: neighbours of a paragraph, list, table or cell of text belong to it.

    A cell that holds blocks, none of ``direct`` text, is one of a layout.
    """
    while node.parent and (node.tag not in _BLOCK or node.tag in _PARTS or id(node) in direct
                           and node.tag in ("td", "th")):
        node = node.parent
    return node


def _around(node: _Element) -> _Element:
    """The article around an element, else the main element, else itself."""
    main, up = None, node
    while up:
        if up.tag == "article":
            return up
        main = main or (up if up.tag == "main" else None)
        up = up.parent
    return main or node


def _depth(node: _Element) -> int:
    depth = 0
    while node.parent:
        node, depth = node.parent, depth + 1
    return depth


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""

    def rows():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            return batch_of(
                page_id=batch.column(0), url=batch.column(1), text=pa.array(texts, pa.string()),
                n_chars=longs([len(t) for t in texts]),
            )

        return apply

    source = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    return map_batches(source, rows, "page_id long, url string, text string, n_chars long")
