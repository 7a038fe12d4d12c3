"""Main text of web pages through wrappers inferred from the pages of the same host.

A page is cut into tags and texts by the states of the public HTML tokenizer and folded into a tree of containers
and text slots. Wrappers are union-free regular expressions over such streams, kept as trees too: neighbours whose
labels repeat, one by one or several in turn, are a repeated group, what some pages lack is optional, and texts are
slots. Aligning a page's stream with a wrapper resolves each mismatch in one of these ways; aligning two wrappers
does the same, so each task aligns the pages it reads and the results are aligned further, host by host, a bounded
number at a time. Nesting may be of any depth: steps that follow it keep their own stack.

Each wrapper then decides which of its slots hold the article: slots below an article or main container,
or, on hosts without one, below the container that holds most text which is no link and not equal on all pages.
Slots below containers whose tag, class, id or role names menus, headers, footers, sidebars, notices, adverts, forms
or comments do not; but a name of that kind counts for nothing on a container without which no article would be left,
and some names count for nothing on a section of the article whose text differs from page to page and is no list of links.
A first-level heading before an article that has none belongs to it. What is marked as hidden is left out.
A page's text is what its own stream has in these slots.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import math
import re
from collections.abc import Callable, Generator, Iterator
from functools import lru_cache, wraps

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LARGE_KEYS, dealt, materialize, repeated, small_batches

#: Wrappers of one host aligned by one task at a time.
FAN_IN = 32
#: Hosts that a task holds before it passes their wrappers on.
HELD_HOSTS = 2_000

#: Lists of more neighbours than this are searched for repeated groups by whole rows of comparisons; the result is the same.
LONG_LIST = 64
#: Pages of one host that a task of the join with rules reads, about.
HOST_PAGES = 200_000

# Elements of the public HTML standard by role.
CONTAINERS = frozenset(
    "article aside body center details dialog div dl fieldset figure footer form header hgroup main menu nav "
    "ol section table tbody td tfoot th thead tr ul".split()
)
LEAVES = frozenset("address blockquote br caption dd dt figcaption h1 h2 h3 h4 h5 h6 hr li p pre summary".split())
#: Elements whose content is text up to their end tag, or to the end of the page, and no part of the article.
RAW = frozenset("script style title textarea noframes noembed xmp".split())
#: Elements within a line that are no part of the article, with all their content.
DROPPED = frozenset("audio button canvas datalist iframe label legend noscript object select svg template video".split())
BOILERPLATE_TAGS = frozenset("aside dialog fieldset footer form header menu nav".split())
MAIN_TAGS = frozenset(("article", "main"))
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement adverts adsense alert alerts banner banners breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright "
    "disclaimer discussion disqus footer foot form gdpr header login masthead menu menubar meta modal nav navbar navigation newsletter "
    "notice notices pagination paywall popup promo promotion recommended related replies reply respond search share sharing sidebar "
    "signup skip skyscraper social sponsor sponsored subscribe subscription tags toolbar widget widgets".split()
)
MAIN_WORDS = frozenset("article articlebody content entry main post postbody story".split())
#: A name with one of these words tells the state or the layout of a container, not its role.
STATE_WORDS = frozenset("has have is no not with without show hide layout".split())
#: Names that a section of an article may have for its subject; other evidence decides there.
SUBJECT_WORDS = frozenset("copyright disclaimer discussion form login reply search share sharing subscription tags widget widgets".split())
#: Elements within a line with one of these names are adverts.
ADVERT_WORDS = frozenset("ad ads advert advertisement adverts adsense sponsored".split())
#: Stands in a label for an element that is not shown.
HIDDEN = "!hidden"
#: A header of these is the headline of an article.
HEADLINE_WORDS = frozenset("article entry post story".split())

# An attribute: a name, and after an equals sign a value in quotes, or one that ends at white space or at the tag's end.
_ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*=\s*(?:"[^"]*"|'[^']*'|(?=>)|[^\s"'>][^\s>]*))?"""
_TOKEN = re.compile(
    rf"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[\s/]++|{_ATTRIBUTE})*+)>"""
    r"""|<[!?/][^>]*>|<[a-zA-Z!?/][^<>]*\Z""",
    re.DOTALL,
)
_NAMED = re.compile(r"""(?:^|[\s/"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_QUOTED = re.compile(r""""[^"]*"|'[^']*'""")
_UNSEEN = re.compile(r"""(?:^|[\s/])hidden(?=[\s/=]|$)""", re.IGNORECASE)
_STYLED = re.compile(r"""(?:^|[\s/"'])style\s*=\s*(?:"[^"]*?display\s*:\s*none|'[^']*?display\s*:\s*none|display:none)""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


def _end_of(name: str) -> re.Pattern[str]:
    return re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE)


_ENDS = {name: _end_of(name) for name in RAW | DROPPED}


def deep(steps: Callable[..., Generator]) -> Callable:
    """Run a function that yields the arguments of its calls of itself and is sent their results, at any depth."""

    @wraps(steps)
    def run(*args):
        stack, value = [steps(*args)], None
        while stack:
            try:
                call = stack[-1].send(value)
                stack.append(steps(*call))
                value = None
            except StopIteration as done:
                stack.pop()
                value = done.value
        return value

    return run


class Node:
    """A container, or a slot for texts if it has no ``children`` list."""

    __slots__ = ("chars", "children", "constant", "label", "links", "optional", "pages", "repeated", "texts")

    def __init__(self, label: str, slot: bool = False):
        self.label, self.children = label, None if slot else []
        self.repeated = self.optional = False
        self.pages, self.chars, self.links = 1, 0, 0
        self.constant: str | None = None
        self.texts: list[str] = []


def _label(name: str, rest: str) -> str:
    """Tag name and the names in its class, id and role, digits left out, each as its words joined by dashes."""
    names: set[str] = set()
    if "=" in rest:
        for m in _NAMED.finditer(rest):
            for token in (m[2] or m[3] or m[4] or "").split():
                # a name in another letter case or with a dash counts as its parts
                words = _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
                if words:
                    names.add("-".join(words))
    if rest and (_UNSEEN.search(_QUOTED.sub("''", rest)) or "=" in rest and _STYLED.search(rest)):
        names.add(HIDDEN)
    return " ".join([name, *sorted(names)])


def _is_advert(label: str) -> bool:
    """Whether an element within a line is left out with what it holds."""
    return HIDDEN in label or any(set(name.split("-")) <= ADVERT_WORDS for name in label.split(" ")[1:])


def page_tree(page: str) -> Node:
    """Containers and slots of one page; blocks of text in page order, neighbours with equal labels in one slot."""
    root = Node("page")
    stack, leaf = [root], "#"
    #: How many open containers have each tag name, so that a stray end tag costs nothing.
    opened: dict[str, int] = {}
    parts: list[str] = []
    links = inside_link = 0
    unclosed: set[str] = set()
    #: Open elements ``span`` and ``ins`` since one that is left out.
    skipped = 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                into = stack[-1].children
                if into and into[-1].children is None and into[-1].label == leaf:
                    node = into[-1]
                    node.repeated = True
                else:
                    node = Node(leaf, slot=True)
                    into.append(node)
                node.texts.append(text)
                node.chars += len(text)
                node.links += min(links, len(text))
            parts.clear()
        links = 0

    def text(piece: str) -> None:
        nonlocal links
        if skipped:
            return
        piece = entities.unescape(piece) if "&" in piece else piece
        parts.append(piece)
        if inside_link:
            links += len(piece)

    at = 0
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name, ends = name.lower(), bool(m["end"])
        if name in _ENDS:
            if ends or name in unclosed or name == "svg" and m["rest"].endswith("/"):
                continue
            close = _ENDS[name].search(page, at)
            if close:
                at = close.end()
            elif name in RAW:
                at = len(page)
            else:
                unclosed.add(name)
        elif name == "a":
            inside_link = 0 if ends else 1
        elif name in ("ins", "span"):
            if skipped:
                skipped += -1 if ends else 1
            elif not ends and m["rest"] and _is_advert(_label(name, m["rest"])):
                skipped = 1
        elif name in LEAVES:
            flush()
            skipped = 0
            leaf = "#" if ends or name in ("br", "hr") else _label(name, m["rest"]).replace(name, "#h1" if name == "h1" else "#", 1)
        elif name in CONTAINERS:
            flush()
            skipped = 0
            leaf = "#"
            inside_link = 0
            if not ends:
                node = Node(_label(name, m["rest"]))
                stack[-1].children.append(node)
                stack.append(node)
                opened[name] = opened.get(name, 0) + 1
            elif opened.get(name):
                while True:
                    last = stack.pop().label.split(" ", 1)[0]
                    opened[last] -= 1
                    if last == name:
                        break
    if at < len(page):
        text(page[at:])
    flush()
    return root


def _kind(node: Node) -> tuple[str, bool]:
    return node.label, node.children is None


def _common(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of two lists.

    A row of differences is one large integer, which carries all its cells forward at once; every so many rows are kept,
    and the rows between are worked out again on the way back.
    """
    where: dict = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1

    def forward(row: int, x) -> int:
        same = row & where.get(x, 0)
        return ((row + same) | (row - same)) & full

    every = max(1, math.isqrt(len(a)))
    kept, row = [full], full
    for i, x in enumerate(a, 1):
        row = forward(row, x)
        if i % every == 0:
            kept.append(row)
    out: list[tuple[int, int]] = []
    i, j = len(a), len(b)
    for block in range(len(kept) - 1, -1, -1):
        first = block * every
        rows = [kept[block]]
        for x in a[first:i]:
            rows.append(forward(rows[-1], x))
        while i > first and j:
            if rows[i - first] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
                if rows[i - first] >> (j - 1) & 1:
                    j -= 1
                    out.append((i, j))
    return out[::-1]


def _aligned(a: list[Node], b: list[Node]) -> list[tuple[Node | None, Node | None]]:
    """The longest common alignment of two lists by label and kind."""
    x, y = [_kind(n) for n in a], [_kind(n) for n in b]
    lo = 0
    while lo < len(x) and lo < len(y) and x[lo] == y[lo]:
        lo += 1
    hi = 0
    while hi < len(x) - lo and hi < len(y) - lo and x[-1 - hi] == y[-1 - hi]:
        hi += 1
    middle = _common(x[lo : len(x) - hi], y[lo : len(y) - hi])
    ends = [(len(x) - hi + k, len(y) - hi + k) for k in range(hi)]
    out: list[tuple[Node | None, Node | None]] = []
    i = j = 0
    for p, q in [*((k, k) for k in range(lo)), *((lo + p, lo + q) for p, q in middle), *ends, (len(a), len(b))]:
        out += [(n, None) for n in a[i:p]]
        out += [(None, n) for n in b[j:q]]
        if p < len(a):
            out.append((a[p], b[q]))
        i, j = p + 1, q + 1
    return out


def _group(members: list[Node]) -> Node:
    """Several neighbours as one group."""
    out = Node("(" + " | ".join(n.label for n in members) + ")")
    out.children, out.pages = list(members), max(n.pages for n in members)
    out.chars, out.links = sum(n.chars for n in members), sum(n.links for n in members)
    return out


def _periods(kinds: list) -> Callable[[int], int]:
    """The least number of labels, two or more and not all equal, that stand twice in a row from a place on; 0 for none."""
    n = len(kinds)
    if n <= LONG_LIST:

        def least(i: int) -> int:
            for k in range(2, (n - i) // 2 + 1):
                if kinds[i] == kinds[i + k] and kinds[i : i + k] == kinds[i + k : i + 2 * k] and len(set(kinds[i : i + k])) > 1:
                    return k
            return 0

        return least
    numbers: dict = {}
    row = np.array([numbers.setdefault(x, len(numbers)) for x in kinds])
    # how many labels from a place on are equal to it
    ends = np.flatnonzero(np.append(row[1:] != row[:-1], True))
    equal = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n) + 1
    found = np.zeros(n, dtype=np.int64)
    for k in range(2, n // 2 + 1):
        same = row[:-k] == row[k:]
        if np.count_nonzero(same) < k:
            continue
        # places from which the next k comparisons all hold
        stops = np.flatnonzero(np.append(~same, True))
        run = stops[np.searchsorted(stops, np.arange(len(same)))] - np.arange(len(same))
        places = np.flatnonzero((run >= k) & (found[: len(same)] == 0) & (equal[: len(same)] < k))
        found[places] = k
    return lambda i: int(found[i])


def _runs(kinds: list, known: dict) -> list[tuple[int, int]]:
    """(first, length) of the items of a list of labels: single ones, and groups that repeat or are ``known``."""
    out, i = [], 0
    period = _periods(kinds)
    while i < len(kinds):
        group = next((k for k in known.get(kinds[i], ()) if tuple(kinds[i : i + len(k)]) == k), None)
        if group is None:
            k = period(i)
            group = tuple(kinds[i : i + k]) if k else None
        if group is None:
            out.append((i, 1))
            i += 1
        while group is not None and tuple(kinds[i : i + len(group)]) == group:
            out.append((i, len(group)))
            i += len(group)
    return out


def _known(nodes: list[Node]) -> dict:
    """The groups among ``nodes`` by the label of their first member, longer ones first."""
    out: dict = {}
    for n in nodes:
        if n.children is not None and n.label.startswith("("):
            kinds = tuple(map(_kind, n.children))
            out.setdefault(kinds[0], []).append(kinds)
    return {k: sorted(set(v), key=lambda g: (-len(g), g)) for k, v in out.items()}


def _grouped(nodes: list[Node], known: dict) -> list[Node]:
    """``nodes`` with neighbours that repeat in turn, or that are ``known`` to, put together in groups."""
    if len(nodes) < 2:
        return nodes
    return [nodes[i] if n == 1 else _group(nodes[i : i + n]) for i, n in _runs([_kind(x) for x in nodes], known)]


@deep
def align(a: Node, b: Node, same_page: bool = False) -> Generator:
    """The wrapper of both."""
    out = Node(a.label, slot=a.children is None)
    out.repeated, out.optional = a.repeated or b.repeated, a.optional or b.optional
    out.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    out.chars, out.links = a.chars + b.chars, a.links + b.links
    if a.children is None:
        out.constant = a.constant if a.constant == b.constant else None
        return out
    if a.label.startswith("("):
        for x, y in zip(a.children, b.children, strict=True):
            out.children.append((yield x, y, same_page))
        return out
    children: list[Node] = []
    for x, y in _aligned(_grouped(a.children, _known(b.children)), _grouped(b.children, _known(a.children))):
        node = (yield x, y, same_page) if x and y else x or y
        node.optional = node.optional or not (x and y)
        children.append(node)
    out.children = yield from _folded(children)
    return out


def _folded(nodes: list[Node]) -> Generator:
    """Neighbours with equal labels as one repeated group, and neighbours that repeat in turn."""
    out: list[Node] = []
    for node in _grouped(nodes, _known(nodes)):
        if out and _kind(out[-1]) == _kind(node):
            out[-1] = yield out[-1], node, True
            out[-1].repeated = True
        else:
            out.append(node)
    return out


def _of_slots(node: Node) -> Node:
    out = Node(node.label, slot=node.children is None)
    out.repeated, out.chars, out.links = node.repeated, node.chars, node.links
    if node.children is None:
        out.constant = hashlib.blake2b("\n".join(node.texts).encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()
    return out


def _bottom_up(root: Node) -> Iterator[Node]:
    """All nodes, children before their parents."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += node.children or ()
    return reversed(order)


def _fold(nodes: list[Node]) -> list[Node]:
    out: list[Node] = []
    for node in _grouped(nodes, {}):
        if out and _kind(out[-1]) == _kind(node):
            out[-1] = align(out[-1], node, True)
            out[-1].repeated = True
        else:
            out.append(node)
    return out


def wrapper_of(tree: Node) -> Node:
    """The wrapper of a single page: its stream without the texts."""
    made: dict[int, Node] = {}
    for node in _bottom_up(tree):
        out = made[id(node)] = _of_slots(node)
        if node.children is not None:
            out.children = _fold([made.pop(id(c)) for c in node.children])
    return made[id(tree)]


def _written(root: Node, fields: Callable[[Node], list]) -> str:
    """A tree as one list: for each node, parents first, its number of children (-1 for a slot) and its fields."""
    rows, stack = [], [root]
    while stack:
        node = stack.pop()
        rows.append([-1 if node.children is None else len(node.children), *fields(node)])
        stack += reversed(node.children or ())
    return json.dumps(rows, ensure_ascii=False, separators=(",", ":"))


def _read(text: str, fill: Callable[[Node, list], None]) -> Node:
    root = Node("")
    waiting: list[tuple[Node, int]] = [(root, 1)]
    for n, label, *fields in json.loads(text):
        node = Node(label, slot=n < 0)
        fill(node, fields)
        parent, rest = waiting.pop()
        parent.children.append(node)
        if rest > 1:
            waiting.append((parent, rest - 1))
        if n > 0:
            waiting.append((node, n))
    return root.children[0]


def dump(node: Node) -> str:
    return _written(node, lambda x: [x.label, x.repeated + 2 * x.optional, x.pages, x.chars, x.links, x.constant])


def load(text: str) -> Node:
    def fill(node: Node, fields: list) -> None:
        flags, node.pages, node.chars, node.links, node.constant = fields
        node.repeated, node.optional = bool(flags & 1), bool(flags & 2)

    return _read(text, fill)


def _names(label: str) -> list[set[str]]:
    return [set(name.split("-")) for name in label.split(" ")[1:]]


@lru_cache(maxsize=65_536)
def _is_boilerplate(label: str, in_main: bool, by_name: bool) -> bool:
    """Whether the container's role is no part of an article: by its tag, and with ``by_name`` by its names."""
    if label.startswith("("):
        return False
    tag, names = label.split(" ", 1)[0], _names(label)
    if HIDDEN in label:
        return True
    if tag in ("nav", "menu") or tag in BOILERPLATE_TAGS and by_name and not (in_main and tag == "header"):
        return True
    if not by_name or tag in ("main", "body", "page"):
        return False
    # a name such as post or content says more than one of several words such as category-ad
    main = any(len(words) == 1 and words <= MAIN_WORDS for words in names) or tag == "article"
    for words in names:
        headline = "header" in words and (bool(words & HEADLINE_WORDS) or in_main and len(words) == 1)
        if words & BOILERPLATE_WORDS and not words & STATE_WORDS and not headline and (len(words) == 1 or not main):
            return True
    return False


@lru_cache(maxsize=65_536)
def _is_main(label: str) -> bool:
    if label.startswith("("):
        return False
    tag = label.split(" ", 1)[0]
    named = any(words & MAIN_WORDS and (not words & BOILERPLATE_WORDS or words & STATE_WORDS) for words in _names(label))
    return tag in MAIN_TAGS or tag != "body" and named


@lru_cache(maxsize=65_536)
def _may_be_subject(label: str) -> bool:
    """Whether the names of a section that are those of boilerplate may also be its subject."""
    found = [words for words in _names(label) if words & BOILERPLATE_WORDS]
    return label.startswith("section ") and all(words & BOILERPLATE_WORDS <= SUBJECT_WORDS or "related" in words and len(words) > 1 for words in found)


def _is_subject(node: Node, pages: int) -> bool:
    """Whether a section of an article tells its subject by its name: it occurs once, is no list, and texts differ from page to page."""
    if not _may_be_subject(node.label) or HIDDEN in node.label or node.repeated or pages < 2:
        return False
    inner = list(_bottom_up(node))
    slots = [x for x in inner if x.children is None]
    told = 2 * sum(x.links for x in slots) < sum(x.chars for x in slots) and any(x.constant is None for x in slots)
    return told and not any(x is not node and x.children is not None and (x.repeated or x.label.startswith("(")) for x in inner)


def _roles(wrapper: Node, by_name: bool) -> tuple[list[Node], list[Node]]:
    """The slots in main containers, and the others that are in no boilerplate."""
    named: list[Node] = []
    other: list[Node] = []
    stack = [(wrapper, False)]
    while stack:
        node, in_main = stack.pop()
        for child in node.children:
            if _is_boilerplate(child.label, in_main, by_name) and not (in_main and child.children is not None and _is_subject(child, wrapper.pages)):
                continue
            if child.children is None:
                (named if in_main else other).append(child)
            else:
                stack.append((child, in_main or _is_main(child.label)))
    return named, other


def main_slots(wrapper: Node) -> set[int]:
    """The slots (by identity) of a wrapper that hold the article."""
    named, other = _roles(wrapper, True)
    if named:
        if not any(s.label.startswith("#h1") for s in named):
            named += [s for s in other if s.label.startswith("#h1") and s.constant is None and wrapper.pages > 1 and 2 * s.links < max(1, s.chars)]
        return set(map(id, named))
    loose, rest = _roles(wrapper, False)
    if loose:
        return set(map(id, loose))
    for slots in (other, rest):
        usable = {id(s) for s in slots if 2 * s.links < max(1, s.chars) and not (wrapper.pages > 1 and s.constant is not None)}
        usable = usable or {id(s) for s in slots if 2 * s.links < max(1, s.chars)}
        if usable:
            break
    weight: dict[int, int] = {}
    for node in _bottom_up(wrapper):
        inner = sum(weight[id(c)] for c in node.children) if node.children is not None else node.chars if id(node) in usable else 0
        weight[id(node)] = inner
    best, total = wrapper, weight[id(wrapper)]
    while total:
        inner = [c for c in best.children if c.children is not None and 10 * weight[id(c)] >= 7 * total]
        if not inner:
            break
        best = inner[0]
    return {id(n) for n in _bottom_up(best) if n.children is None} & usable


def rule_of(wrapper: Node) -> str:
    """What extraction needs of a wrapper: labels, and which slots hold the article."""
    main = main_slots(wrapper)
    return _written(wrapper, lambda x: [x.label, id(x) in main])


@lru_cache(maxsize=1024)
def _rule(text: str) -> Node:
    def fill(node: Node, fields: list) -> None:
        node.optional = fields[0]

    return _read(text, fill)


def extract(page: str, rule: str | None) -> str:
    """The texts of a page in the slots that its host's rule names, joined by line ends.

    A page that has none of these slots, unlike the others of its host, is read by a wrapper of its own.
    """
    tree = page_tree(page)
    out = _texts(tree, rule) if rule is not None else []
    return "\n".join(out or _texts(tree, rule_of(wrapper_of(tree))))


def _texts(tree: Node, rule: str) -> list[str]:
    """The texts of the slots that ``rule`` names, in page order."""
    out: list[str] = []
    stack: list[tuple[Node, Node]] = [(tree, _rule(rule))]
    while stack:
        node, by = stack.pop()
        if node.children is None:
            if by.optional:
                out.extend(node.texts)
            continue
        grouped = _grouped(node.children, _known(by.children))
        # repeated groups of the rule take any number of neighbours with their label
        own: list[Node] = []
        for child in grouped:
            if not own or _kind(own[-1]) != _kind(child):
                own.append(child)
        matched = {id(x): y for x, y in _aligned(own, by.children) if x and y}
        heads, slot, inner = set(map(id, own)), None, []
        for child in grouped:
            slot = matched.get(id(child)) if id(child) in heads else slot
            if slot is not None:
                inner.append((child, slot))
        stack += reversed(inner)
    return out


def _host() -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def wrappers(pages: DataFrame) -> DataFrame:
    """host, rule and number of pages for every host of ``pages`` (url, html), from all its pages."""
    spark = pages.sparkSession
    small_batches(spark)
    schema = "host string, wrapper string"

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Node] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(map(dump, held.values()))], ["host", "wrapper"])

        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                own = wrapper_of(page_tree(page))
                held[host] = align(held[host], own) if host in held else own
            if len(held) > HELD_HOSTS:
                yield out()
                held.clear()
        if held:
            yield out()

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for text in sorted(rows["wrapper"]):
            whole = load(text) if whole is None else align(whole, load(text))
        return pd.DataFrame({"host": [key[0]], "wrapper": [dump(whole)]})

    def rule(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = [load(x) for x in batch.column("wrapper").to_pylist()]
            rules, counts = pa.array(map(rule_of, trees), pa.string()), pa.array([t.pages for t in trees], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("host"), rules, counts], ["host", "rule", "pages"])

    found = pages.filter("html is not null").select(_host().alias("host"), "html").mapInArrow(infer, schema)
    while True:
        found = materialize(found, "wrappers")
        most = found.groupBy("host").count().agg(F.max("count")).head()[0] or 1
        if most == 1:
            break
        salt = F.pmod(F.xxhash64("wrapper", F.monotonically_increasing_id()), F.lit(max(1, -(-most // FAN_IN))))
        found = found.withColumn("salt", salt).groupBy("host", "salt").applyInPandas(merge, schema)
    return materialize(found.mapInArrow(rule, "host string, rule string, pages long"), "rules")


def extract_pages(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` and the main text of every row of ``pages`` (page_id, url, html, ...), with n_chars.

    Null and empty html give an empty text. Pages without a host in their url (null urls included) share
    one wrapper. Repeated rows give repeated results. An empty table gives no rows. Other columns are ignored.
    """
    rules = wrappers(pages)
    fields = [pages.schema[k] for k in keep]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("_html").to_pylist(), batch.column("_rule").to_pylist(), strict=True)
            texts = [extract(page, rule) if page else "" for page, rule in pairs]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [*keep, "text", "n_chars"],
            )

    keyed = pages.select(*keep, _host().alias("_host"), F.coalesce("html", F.lit("")).alias("_html"))
    rules = rules.select(F.col("host").alias("_host"), F.col("rule").alias("_rule"), "pages")
    # pages of a large host are read in many places; at most LARGE_KEYS hosts
    least = max(HOST_PAGES, (rules.agg(F.sum("pages")).head()[0] or 0) // LARGE_KEYS)
    large = rules.filter(F.col("pages") > least).select("_host", F.ceil(F.col("pages") / HOST_PAGES).cast("int").alias("blocks"))
    large = F.broadcast(materialize(large, "large-hosts"))
    joined = dealt(keyed, large, "_host", "_html").join(repeated(rules, large, "_host"), ["_host", "block"], "left")
    return joined.select(*keep, "_html", "_rule").mapInArrow(read, schema)
