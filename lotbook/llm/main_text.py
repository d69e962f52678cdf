"""Main text of web pages by minimum-cut labelling of their blocks.

A page is split into blocks of text at block-level tags. A linear classifier over markup and text statistics gives each
block a cost for either label, which become its capacities to the two terminals. Neighbouring blocks are joined by
edges, stronger the closer they are in the element tree, and so are blocks under one parent that are a few blocks
apart. The minimum cut between the terminals labels all blocks at once: a doubtful block goes with its surroundings.
Blocks whose own costs outweigh all their edges are settled first, which leaves the cut as it is; maximum flow (Dinic)
settles the others.

Character references are decoded, white space inside a block becomes one space, kept blocks are joined in page order by
a line feed. Script, style, template and similar elements, comments and everything in the head are no text.

Defined cases: null, empty and tag-only pages give an empty text; broken markup is read as far as it can be: unclosed
elements end with the page, stray end tags are skipped, a lone ``<`` is text; repeated rows get equal texts; an empty
table gives an empty result; input columns named like a result give way. Reading a page takes time in proportion to its
length whatever its markup; only the flow, which sees the doubtful blocks alone, may take more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotbook.llm.text_arrays import numbered

_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_MARK = re.compile("[>\"']")
#: A tag whose quotes match up and hold neither < nor >: all others take the longer way, with the same outcome for these.
_PLAIN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)>")
#: Elements whose content is no text of the page.
SKIPPED = frozenset(
    "script style noscript template svg math iframe object textarea title select canvas audio video".split())
_ENDS = {tag: re.compile(rf"</{tag}\s*+>", re.I) for tag in SKIPPED}
_ATTRIBUTE = re.compile(
    r"(?<![\w:-])(class|id|role|hidden|aria-hidden|style)(?![\w:-])\s*+(?:=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img br input nobr".split())
_SELF_NESTING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                 "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_LIMITS = frozenset("ul ol dl table tbody thead article section div body main aside nav footer header form".split())
#: Elements and roles around a block that speak against it, and for it.
_OUTER = frozenset("nav footer aside button dialog menu fieldset".split())
_MAIN = frozenset("article main".split())
_OUTER_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Names in a class or an id that speak against a block, as a whole or as its first or last part. Names of the first
#: list hold for everything beneath; those of the second give way to an article beneath if the page has no other one.
_APART_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense sponsor sponsored promo promos promotion promotions "
    "cookie cookies consent gdpr notice notices notification notifications popup popups modal overlay newsletter "
    "subscribe subscription comment comments commentlist respond reply replies disqus discussion related recommend "
    "recommended recommendations outbrain taboola".split())
_AROUND_NAMES = frozenset(
    "nav navbar navigation menu submenu header masthead topbar footer foot sidebar side aside banner banners alert "
    "alerts signup login share sharing social breadcrumb breadcrumbs widget widgets toolbar pagination pager copyright "
    "legal search tag tags skip".split())
#: Parts that may stand behind such a name, and beginnings of names that only tell how a page is laid out.
_CONTAINERS = frozenset(
    "area articles author banner bar block body bottom box boxes buttons cloud container content count date dialog "
    "first footer form group head header heading holder icons inner item items label left link links list main media "
    "menu message meta modal nav news notice outer overlay panel popup posts primary reading reply right second "
    "secondary section signup slot stories text thread title top trail unit widget wrap wrapper".split())
_LAYOUTS = frozenset("has no with without is not".split())
_MAIN_NAMES = frozenset(
    "article articlebody content maincontent post postbody entry story storybody main text".split())
_PARTS = re.compile(r"[^a-z]+")
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Weights of the classifier's features, in nats for "content".
WEIGHTS = {"bias": -0.6, "outer": -6.0, "main": 3.5, "hidden": -6.0, "links": -4.0, "length": 2.5, "sentences": 1.5,
           "heading": 0.8, "paragraph": 0.8, "item": -0.3, "first_heading": 0.5}
NEIGHBOUR = 1.2  # capacity between neighbours under one parent; divided by one more than their distance in the tree
SIBLING = 0.4  # capacity between blocks under one parent two or three blocks apart


@dataclass(slots=True)
class Element:
    """``apart``: outside the main text, with all beneath. ``around``: outside unless an article lies beneath.

    ``named`` is an element that is around by itself, ``article`` one that is an article by its tag or role.
    """

    tag: str
    parent: Element | None
    depth: int
    apart: bool
    around: bool
    main: bool
    hidden: bool
    named: bool = False
    article: bool = False
    scope: dict[str, Element] = field(default_factory=dict)  # nearest elements of list and table parts, by tag
    inline: dict[str, int] = field(default_factory=dict)  # open inline elements since the nearest block, by tag

    @property
    def outer(self) -> bool:
        return self.apart or self.around


@dataclass(slots=True)
class Block:
    element: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def tokens(html: str, skipped: frozenset[str] = SKIPPED) -> Iterator[tuple[int, int, bool, str, str, int]]:
    """Markup in page order: start, end, whether it closes, the tag, its attributes, and where the tag itself ends.

    Comments, declarations and the like have no tag. An element of the ``skipped`` ones is a single item with all that
    is in it, to the page's end if it stays open. A ``>`` inside a quoted value ends no tag, unless the quotes do not
    match up, when the first ``>`` does. Each place is looked at a bounded number of times, whatever the markup.
    """
    at, n = 0, len(html)
    last = {"'": html.rfind("'"), '"': html.rfind('"')}
    broken: set[int] = set()  # opening quotes from which the quotes do not match up
    while (start := html.find("<", at)) >= 0:
        plain = _PLAIN.match(html, start)
        if plain is not None:
            slash, tag, attributes = plain.groups()
            tag, at = tag.lower(), plain.end()
            inner = at
            if not slash and tag in skipped and not (tag in ("svg", "math") and attributes.endswith("/")):
                end = _ENDS[tag].search(html, at)
                at = end.end() if end else n
            yield start, at, bool(slash), tag, attributes, inner
            continue
        if html.startswith("<!--", start):
            stop = html.find("-->", start + 4)
            at = n if stop < 0 else stop + 3
            yield start, at, False, "", "", at
            continue
        name = _NAME.match(html, start + 1)
        if name is None and not html.startswith(("!", "?", "/"), start + 1):
            at = start + 1
            continue
        first = html.find(">", start)
        if first < 0:
            comment = html.find("<!--", start)
            if comment >= 0:
                yield comment, n, False, "", "", n
            return
        if name is None:
            at = first + 1
            yield start, at, False, "", "", at
            continue
        stop, seen, place = first, [], name.end()
        while (mark := _MARK.search(html, place)) is not None:
            quote, opening = mark[0], mark.start()
            if quote == ">":
                stop = opening
                break
            seen.append(opening)
            if opening == last[quote] or opening in broken:
                broken.update(seen)
                break
            place = html.find(quote, opening + 1) + 1
        else:
            broken.update(seen)
        at, tag = stop + 1, name[2].lower()
        inner = at
        if not name[1] and tag in skipped and not (tag in ("svg", "math") and html.endswith("/", start, stop)):
            end = _ENDS[tag].search(html, at)
            at = end.end() if end else n
        yield start, at, bool(name[1]), tag, html[name.end() : stop], inner


def _speaks(parts: list[str], names: frozenset[str]) -> bool:
    """Whether a name ends with one of the names, or begins with one and goes on with parts of a layout only."""
    return parts[-1] in names or parts[0] in names and all(p in _CONTAINERS for p in parts[1:])


def _open(tag: str, attributes: str, parent: Element) -> Element:
    apart, article, hidden, main = tag in _OUTER, tag in _MAIN, False, False
    named = tag == "form" or tag == "header" and not parent.main
    names: list[list[str]] = []
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                names += [[p for p in _PARTS.split(token) if p] for token in value.split()]
            elif key == "role":
                apart |= bool(_OUTER_ROLES & set(value.split()))
                article |= value in ("main", "article")
            elif key == "hidden" or key == "aria-hidden" and value == "true":
                hidden = True
            elif key == "style" and re.search(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden", value):
                hidden = True
    names = [p for p in names if p and p[0] not in _LAYOUTS]
    if names and tag not in ("html", "body"):
        main = any(_MAIN_NAMES & set(p) and not _speaks(p, _APART_NAMES | _AROUND_NAMES) for p in names)
        apart |= tag not in _MAIN and any(_speaks(p, _APART_NAMES) for p in names)
        named |= not (article or main) and any(_speaks(p, _AROUND_NAMES) for p in names)
    main = article or main and not apart or parent.main
    around = named or parent.around
    apart |= parent.apart
    scope = {} if tag in _LIMITS else parent.scope
    if tag in _SELF_NESTING:
        scope = {**scope}
    made = Element(tag, parent, parent.depth + 1, apart, around, main, hidden or parent.hidden, named, article, scope,
                   parent.inline if tag in _INLINE else {})
    if tag in _SELF_NESTING:
        scope[tag] = made
    return made


def _released(found: list[Block]) -> None:
    """If no block lies in an article, articles beneath elements that are only named like page furniture come free.

    Elements of comments, adverts and the like keep their articles outside.
    """
    if any(b.element.main and not b.element.outer for b in found):
        return
    done: dict[int, bool] = {}  # whether an element seen lies in an article
    for block in found:
        chain, node = [], block.element
        while node is not None and id(node) not in done:
            chain.append(node)
            node = node.parent
        inside = node is not None and done[id(node)]
        for node in reversed(chain):
            if inside:
                node.around = node.named or node.parent.around
            elif node.article and not node.apart:
                node.around, inside = node.named, True
            done[id(node)] = inside


def blocks(html: str) -> list[Block]:
    """The page's blocks that hold text, in page order."""
    root = Element("", None, 0, False, False, False, False)
    top, links, done = root, 0, 0
    found: list[Block] = []
    current = Block(root)
    skipped_head = False
    opened: dict[str, int] = {}  # open block elements by tag

    def flush() -> None:
        nonlocal current
        if current.parts:
            current.text = " ".join("".join(current.parts).split())
            if current.text:
                found.append(current)
            current = Block(top)

    def add(text: str) -> None:
        nonlocal current
        if text and not skipped_head:
            decoded = unescape(text) if "&" in text else text
            if not current.parts:
                if decoded.isspace():
                    return
                current.element = top
            current.parts.append(decoded)
            if links:
                current.linked += len(decoded)

    def leave(node: Element) -> None:
        """Closes ``node`` and all that is open in it."""
        nonlocal top
        while True:
            last, counts = top, top.inline if top.tag in _INLINE else opened
            counts[last.tag] -= 1
            top = top.parent
            if last is node:
                return

    for start, stop, closing, tag, attributes, inner in tokens(html):
        if done < start:
            add(html[done:start])
        done = stop
        if not tag or not closing and inner < stop:
            continue
        if tag == "head":
            skipped_head = not closing
            continue
        if tag == "body" and not closing:
            skipped_head = False
        if tag == "br":
            add(" ")
            continue
        inline = tag in _INLINE
        if not inline:
            flush()
        if closing:
            if tag == "a":
                links = max(0, links - 1)
            # An inline end tag never closes a block.
            if (top.inline if inline else opened).get(tag, 0):
                node = top
                while node.tag != tag:
                    node = node.parent
                leave(node)
        elif tag not in _VOID:
            if not inline:
                links = 0
                while top is not root and top.tag in _INLINE:
                    leave(top)
                if tag not in _SELF_NESTING and top.tag == "p":
                    leave(top)
                closes = [top.scope[t] for t in _SELF_NESTING.get(tag, ()) if t in top.scope]
                if closes:
                    leave(max(closes, key=lambda e: e.depth))
            if not attributes.rstrip().endswith("/"):
                top = _open(tag, attributes, top)
                counts = top.inline if inline else opened
                counts[tag] = counts.get(tag, 0) + 1
                links += tag == "a"
        if not inline:
            current.element = top
    add(html[done:])
    flush()
    _released(found)
    return found


def _holder(element: Element) -> Element:
    while element.tag in _INLINE and element.parent is not None:
        element = element.parent
    return element


def evidence(block: Block, first_heading: bool) -> float:
    """The classifier: log odds that a block is content."""
    element, text, w = block.element, block.text, WEIGHTS
    holder = _holder(element)
    n = len(text)
    total = w["bias"]
    total += w["outer"] * element.outer + w["main"] * (element.main and not element.outer) + w["hidden"] * element.hidden
    if not (element.main and not element.outer):
        total += w["links"] * min(1.0, block.linked / max(n, 1))
    else:
        total += 0.5 * w["links"] * (block.linked >= 0.9 * n and holder.tag == "li")
    total += w["length"] * min(1.0, n / 200)
    total += w["sentences"] * min(1.0, sum(text.count(mark) for mark in ".!?。！？") / 3)
    total += w["heading"] * (holder.tag in _HEADING) + w["paragraph"] * (holder.tag in ("p", "blockquote", "pre"))
    total += w["item"] * (holder.tag in ("li", "td", "th")) + w["first_heading"] * first_heading
    return total


def _distance(a: Element, b: Element) -> int:
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def edges(found: Sequence[Block]) -> list[tuple[int, int, float]]:
    """Neighbours, and blocks of one parent that are two or three blocks apart."""
    holders = [_holder(b.element) for b in found]
    parents = [h.parent or h for h in holders]
    out = []
    for i in range(1, len(found)):
        if found[i].element.outer == found[i - 1].element.outer:
            out.append((i - 1, i, NEIGHBOUR * 2 / (1 + _distance(parents[i - 1], parents[i])) / 2))
        else:
            out.append((i - 1, i, NEIGHBOUR / (3 + _distance(parents[i - 1], parents[i]))))
        out.extend((j, i, SIBLING) for j in range(max(0, i - 3), i - 1) if parents[j] is parents[i])
    return out


def minimum_cut(unary: Sequence[float], links: Sequence[tuple[int, int, float]]) -> list[bool]:
    """The labelling with the least sum of lost evidence and cut edges; a tie goes against content."""
    n = len(unary)
    weight, near = list(unary), [dict() for _ in range(n)]
    for a, b, c in links:
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    label: list[bool | None] = [None] * n
    queue = list(range(n))
    while queue:
        i = queue.pop()
        if label[i] is None and abs(weight[i]) > sum(near[i].values()):
            label[i] = weight[i] > 0
            for j, c in near[i].items():
                weight[j] += c if label[i] else -c
                del near[j][i]
                queue.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        place = {i: k for k, i in enumerate(rest)}
        open_links = [(place[a], place[b], c) for a in rest for b, c in near[a].items() if a < b]
        for i, content in zip(rest, _source_side([weight[i] for i in rest], open_links), strict=True):
            label[i] = content
    return [bool(x) for x in label]


def _source_side(unary: Sequence[float], links: Sequence[tuple[int, int, float]]) -> list[bool]:
    """Dinic's maximum flow from evidence for content to evidence against it; True on the source's side of the cut."""
    n = len(unary)
    source, sink = n, n + 1
    arcs: list[list[int]] = [[] for _ in range(n + 2)]
    head: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, forth: float, back: float) -> None:
        arcs[a].append(len(head))
        head.append(b)
        room.append(forth)
        arcs[b].append(len(head))
        head.append(a)
        room.append(back)

    for i, u in enumerate(unary):
        if u > 0:
            join(source, i, u, 0.0)
        elif u < 0:
            join(i, sink, -u, 0.0)
    for a, b, c in links:
        join(a, b, c, c)
    tiny = 1e-12
    while True:
        level = [-1] * (n + 2)
        level[source], queue = 0, [source]
        for a in queue:
            for arc in arcs[a]:
                if room[arc] > tiny and level[head[arc]] < 0:
                    level[head[arc]] = level[a] + 1
                    queue.append(head[arc])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        following = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                amount = min(room[arc] for arc in path)
                for arc in path:
                    room[arc] -= amount
                    room[arc ^ 1] += amount
                cut = next(k for k, arc in enumerate(path) if room[arc] <= tiny)
                at = head[path[cut] ^ 1]
                del path[cut:]
            elif following[at] < len(arcs[at]):
                arc = arcs[at][following[at]]
                if room[arc] > tiny and level[head[arc]] == level[at] + 1:
                    path.append(arc)
                    at = head[arc]
                else:
                    following[at] += 1
            elif path:
                level[at] = -1
                at = head[path.pop() ^ 1]
            else:
                break


def extract(html: str | None) -> str:
    """The main text of one page."""
    found = blocks(html or "")
    if not found:
        return ""
    first = next((i for i, b in enumerate(found) if _holder(b.element).tag == "h1"), -1)
    content = minimum_cut([evidence(b, i == first) for i, b in enumerate(found)], edges(found))
    return "\n".join(b.text for b, kept in zip(found, content, strict=True) if kept)


def main_text(pages: DataFrame, html_col: str = "html", *, text_col: str = "text", length_col: str = "n_chars",
              keep: Sequence[str] | None = None) -> DataFrame:
    """Adds the main text and its code points to the ``keep`` columns (all but the html unless named)."""
    new = {text_col.lower(), length_col.lower()}
    keep = [c for c in (pages.columns if keep is None else keep)
            if c.lower() not in new and (keep is not None or c.lower() != html_col.lower())]
    schema = T.StructType([*[pages.schema[c] for c in keep], T.StructField(text_col, T.StringType()),
                           T.StructField(length_col, T.LongType())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [extract(page.as_py()) for page in part.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=schema.names)

    return pages.select(*numbered(keep), F.col(html_col).cast("string").alias("html")).mapInArrow(run, schema)
