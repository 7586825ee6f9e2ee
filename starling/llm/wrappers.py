"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

*Token streams.*  A page is a stream of tags (with their class and id) and texts.  Runs of
a repeated block become one repeated group, ``( <li> <a> # </a> </li> )+``, innermost
first, and every text a slot ``#``: the page's *shape*.  Pages of one host share few shapes.

*Inference.*  The distinct shapes of a host (with counts and the amount of text in each
slot, summed over its pages, so a hot host is a few rows) are aligned one after the other
with the wrapper so far.  Tokens that agree are kept; a block found once on one side and
repeated on the other becomes the repeated group; what is on one side only becomes an
optional group.  The result is a union-free regular expression, and for every shape the
wrapper's slot behind each of its texts.

*Template and content.*  At every slot the aligned pages' texts are compared, whole blocks at a
time: for each slot the set of block texts that all of its pages have there is kept (an
intersection, so it is summed up by task, by shape and by alignment in any order).  A block that
is the same on all pages of its slot, seen on at least ``TEMPLATE_PAGES`` pages that differ
otherwise, is part of the template and not of the text, whatever element it is in; what differs
fills the slot.  It stays inside an article or main element (there the page says itself what its
text is), and where such blocks hold half of a host's text or more: those pages are copies of
one another and do not tell template from content.

*Main slots.*  A slot inside a navigation, header, footer, aside, form, script or style
element, or one whose class or id names a menu, advert, notice, sidebar, comments and the
like, is page furniture; so is a repeated group that holds links and hardly any other text.
They are chosen for each shape, so pages of several templates do not decide for one another:
of the shape's other slots the main ones lie in its own article or main element if it has
one, else in the innermost element that holds most of the remaining text and is not one of
several alike.  The host is
evidence only: which repeated slots hold links is told from all its pages, and at each step
inwards the text is summed over the shapes that have all the elements the shape has there
(so a page whose article is short for once is cut like its siblings).  A shape with text
outside furniture always has a main slot.  Pages without a host are each judged by their
own shape.

*Extraction.*  Every page of a shape gives the texts of its main slots, in page order:
character references decoded, white space inside a block one space, blocks joined by \\n.

Cost: one pass makes the shapes, one extracts; between them only shapes are shuffled.  The
table of main slots is broadcast up to ``BROADCAST_SHAPES`` rows, beyond that joined.

An element nested deeper than ``DEEPEST`` is held for a sibling of the one that deep, so paths
stay short on pages whose elements are never closed; what is inside furniture there remains so.

Defined cases: null and empty html give the empty text; a page without any tag is one
block; pages cut off in the middle are read as far as they go; a null or odd url has the
empty host, whose shapes have a wrapper each; repeated rows keep one output row each; a host with a single
page is its own wrapper.
"""

from __future__ import annotations

import html as html_lib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from difflib import SequenceMatcher
from functools import lru_cache
from hashlib import blake2b, md5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, ship_package

LONGEST_BLOCK = 24
MOST_TEXT = 0.6
BROADCAST_SHAPES = 50_000
#: Most template blocks (16 bytes each) in the broadcast table.
BROADCAST_BLOCKS = 500_000
#: On how many different pages a block must be the same to be of the template.
TEMPLATE_PAGES = 8
#: At this share of a host's text, equal blocks are no template: the pages are copies.
MOST_TEMPLATE = 0.5
DEEPEST = 64
#: Most shapes of one host that are aligned in one task (pages of a host share few).
MOST_SHAPES = 2_000

# Elements by what they are.
RAW = ("script", "style", "noscript", "template", "textarea", "title")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby s samp "
                    "small span strike strong sub sup time tt u var wbr").split())
FURNITURE = frozenset(("nav header footer aside form script style noscript template textarea title head button select option "
                       "iframe menu dialog svg object").split())
NAMES = frozenset(("ad ads advert adverts advertisement advertising sponsor sponsored promo promoted banner menu nav navbar "
                   "navigation breadcrumb breadcrumbs header masthead footer sidebar side aside widget cookie cookies consent "
                   "notice notices notification alert popup modal overlay newsletter subscribe subscription signup login social "
                   "share sharing related recommended recommendations comment comments disqus reply replies toolbar pagination "
                   "pager copyright legal disclaimer search form hidden skip").split())
CLOSES_P = frozenset(("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                      "header hr main menu nav ol p pre section table ul").split())
SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                "th": ("td", "th"), "option": ("option",)}
LISTS = ("ul", "ol", "dl", "table", "select")
MAIN = ("article", "main")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)"
                    r"((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_MARKS = re.compile(r"""(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass(slots=True)
class Item:
    """One place of a shape or wrapper: a tag, a text slot or a group."""
    label: str                      # "<tag.class>", "</tag>", "#", "(" for groups
    body: list[Item] = field(default_factory=list)
    texts: list[int] = field(default_factory=list)   # of a slot: the page's texts, or the wrapper's slot number
    many: bool = False
    optional: bool = False
    path: tuple[str, ...] = ()
    name: str = ""                  # key of a group, once asked for

    def key(self) -> str:
        if self.label != "(":
            return self.label
        if not self.name:
            self.name = "(" + " ".join(x.key() for x in self.body) + ")+"
        return self.name


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("open" | "close" | "text", tag or text, marks) in page order; raw elements lose their content."""
    at = 0
    for_raw = None
    n = len(page)
    while at < n:
        if for_raw:
            end = re.compile(rf"</{for_raw}(?![A-Za-z0-9])", re.I).search(page, at)
            at = end.start() if end else n
            for_raw = None
            continue
        m = _TOKEN.search(page, at)
        if not m:
            yield "text", page[at:], ""
            return
        if m.start() > at:
            yield "text", page[at:m.start()], ""
        at = max(m.end(), at + 1)
        tag = m.group(2)
        if not tag:
            continue
        tag = tag.lower()
        if m.group(1):
            yield "close", tag, ""
            continue
        marks = " ".join(sorted({w.lower() for a in _MARKS.finditer(m.group(3) or "")
                                 for w in _NAME.findall(a.group(2) or a.group(3) or a.group(4) or "") if not w.isdigit()}))
        yield "open", tag, marks
        if tag in RAW and not (m.group(3) or "").rstrip().endswith("/"):
            for_raw = tag


def _below(path: tuple[str, ...], label: str, known: dict[tuple[str, ...], tuple[str, ...]]) -> tuple[str, ...]:
    """The path of an element with that label in the one with that path; equal paths are one object."""
    if len(path) >= DEEPEST:
        if _tag(path[-1]) in FURNITURE or _has_name(path[-1]):
            return path
        path = path[:-1]
    path = (*path, label)
    return known.setdefault(path, path)


class _Open:
    """The open elements of a page: their tags and the path down to each."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.paths: list[tuple[str, ...]] = [()]
        self.counts: dict[str, int] = {}
        self.known: dict[tuple[str, ...], tuple[str, ...]] = {}

    def push(self, tag: str, label: str) -> None:
        self.names.append(tag)
        self.paths.append(_below(self.paths[-1], label, self.known))
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def has(self, tag: str) -> bool:
        return self.counts.get(tag, 0) > 0

    def cut(self, keep: int) -> None:
        for tag in self.names[keep:]:
            self.counts[tag] -= 1
        del self.names[keep:], self.paths[keep + 1:]

    def close(self, tag: str) -> None:
        """The innermost element of that tag ends, with all inside it."""
        if self.has(tag):
            k = len(self.names) - 1
            while self.names[k] != tag:
                k -= 1
            self.cut(k)

    def close_alike(self, tags: tuple[str, ...]) -> None:
        """The outermost of those elements in the innermost list or table ends."""
        if any(self.has(t) for t in tags):
            spot = None
            for k in range(len(self.names) - 1, -1, -1):
                if self.names[k] in LISTS:
                    break
                if self.names[k] in tags:
                    spot = k
            if spot is not None:
                self.cut(spot)


def stream(page: str) -> tuple[list[Item], list[tuple[str, int, bool]]]:
    """The items of a page and its texts (text, block number, inside a link)."""
    items: list[Item] = []
    texts: list[tuple[str, int, bool]] = []
    opened = _Open()
    block = 0
    for kind, value, marks in tokens(page):
        if kind == "text":
            if value.strip():
                items.append(Item("#", texts=[len(texts)], path=opened.paths[-1]))
                texts.append((value, block, opened.has("a")))
            elif value and texts and texts[-1][1] == block:
                texts[-1] = (texts[-1][0] + " ", block, texts[-1][2])  # white space between inline elements
            continue
        if value not in INLINE:
            block += 1
        if kind == "open":
            label = f"<{value}.{marks}>" if marks else f"<{value}>"
            if value in CLOSES_P:
                opened.close("p")
            if value in SELF_CLOSING:
                opened.close_alike(SELF_CLOSING[value])
            items.append(Item(label, path=opened.paths[-1]))
            if value not in VOID:
                opened.push(value, label)
            elif value == "br" and texts and texts[-1][1] == block:
                texts[-1] = (texts[-1][0] + " ", block, texts[-1][2])
        else:
            opened.close(value)
            items.append(Item(f"</{value}>", path=opened.paths[-1]))
    return items, texts


def block_hashes(texts: list[tuple[str, int, bool]]) -> list[int]:
    """For each text the hash of its whole block, white space aside."""
    whole: dict[int, list[str]] = {}
    for raw, block, _ in texts:
        whole.setdefault(block, []).append(raw)
    made = {block: int.from_bytes(blake2b(" ".join("".join(parts).split()).encode("utf-8", "surrogatepass"), digest_size=8).digest(),
                                  "big", signed=True) for block, parts in whole.items()}
    return [made[block] for _, block, _ in texts]


def _merge_texts(into: Item, other: Item) -> None:
    into.texts += other.texts
    for a, b in zip(into.body, other.body):
        _merge_texts(a, b)


def fold(items: list[Item]) -> list[Item]:
    """Runs of a repeated block become groups, shorter blocks first, until nothing repeats."""
    keys = [x.key() for x in items]
    size = 1
    while size <= min(LONGEST_BLOCK, len(items) // 2):
        twice = [k for k in range(len(keys) - size) if keys[k] == keys[k + size]]
        if len(twice) < size:
            size += 1
            continue
        runs = _runs(twice, size, items)
        if not runs:
            size += 1
            continue
        out: list[Item] = []
        done = 0
        for at, n in runs:
            out += items[done:at]
            head = items[at:at + size]
            for k in range(at + size, at + n * size, size):
                for a, b in zip(head, items[k:k + size]):
                    _merge_texts(a, b)
            out.append(head[0] if size == 1 and head[0].label == "(" else Item("(", body=head, many=True, path=head[0].path))
            done = at + n * size
        items = _join_groups(out + items[done:])
        keys = [x.key() for x in items]
        size = 1
    return items


def _runs(twice: list[int], size: int, items: list[Item]) -> list[tuple[int, int]]:
    """(place, times) of the blocks of ``size`` that repeat and hold a text; ``twice``: places equal to the one a block on."""
    runs = []
    k, free = 0, 0
    while k < len(twice):
        at = twice[k]
        end = k
        while end + 1 < len(twice) and twice[end + 1] == twice[end] + 1:
            end += 1
        equal = twice[end] + 1 - at  # so many places in a row equal the one a block on
        if at >= free and equal >= size and any(x.label in ("#", "(") for x in items[at:at + size]):
            n = equal // size + 1
            runs.append((at, n))
            free = at + n * size
        k = end + 1
    return runs


def _join_groups(items: list[Item]) -> list[Item]:
    """A single block beside a group of the same block belongs to the group."""
    out: list[Item] = []
    for x in items:
        out.append(x)
        while True:
            last = out[-1]
            if last.label == "(" and last.many:  # a block right before the group
                n = len(last.body)
                before = out[-1 - n:-1]
                if len(before) == n and [b.key() for b in before] == [b.key() for b in last.body]:
                    for a, b in zip(last.body, before):
                        _merge_texts(a, b)
                    del out[-1 - n:-1]
                    continue
            group = next((k for k in range(len(out) - 2, max(-1, len(out) - 2 - LONGEST_BLOCK), -1)
                          if out[k].label == "(" and out[k].many and len(out[k].body) == len(out) - 1 - k), None)
            if group is not None and [b.key() for b in out[group].body] == [b.key() for b in out[group + 1:]]:
                for a, b in zip(out[group].body, out[group + 1:]):
                    _merge_texts(a, b)
                del out[group + 1:]
                continue
            break
    return out


def slots(items: list[Item]) -> Iterator[Item]:
    for x in items:
        if x.label == "#":
            yield x
        yield from slots(x.body)


def to_json(items: list[Item]) -> list:
    """A shape without its page's texts: what pages share.  Paths are numbers of rows (parent's number, label)."""
    numbers: dict[tuple[str, ...], int] = {(): 0}
    rows: list[tuple[int, str]] = []

    def number(path: tuple[str, ...]) -> int:
        if path not in numbers:
            rows.append((number(path[:-1]), path[-1]))
            numbers[path] = len(rows)
        return numbers[path]

    def plain(some: list[Item]) -> list:
        return [[x.label, number(x.path), plain(x.body)] for x in some]

    body = plain(items)
    return [rows, body]


def from_json(data: list) -> list[Item]:
    paths: list[tuple[str, ...]] = [()]
    for parent, label in data[0]:
        paths.append((*paths[parent], label))

    def made(some: list) -> list[Item]:
        return [Item(label, body=made(body), many=label == "(", path=paths[at]) for label, at, body in some]

    return made(data[1])


def shape_of(page: str) -> tuple[list[Item], list[tuple[str, int, bool]]]:
    items, texts = stream(page)
    return fold(items), texts


@dataclass(slots=True)
class ShapeSlots:
    """The slots of one shape: where they are, the wrapper's slot for each, and how much text its pages have in them."""
    paths: list[tuple[str, ...]]
    in_group: list[bool]
    numbers: list[int]
    chars: list[float]
    link_chars: list[float]
    pages: int = 1
    groups: list[int] = field(default_factory=list)             # how deep the element around its outermost group is, or -1
    blocks: list[dict[int, int]] = field(default_factory=list)  # the block texts all its pages have in a slot, by hash: characters


@dataclass(slots=True)
class Shape:
    """A shape of a host, summed over its pages."""
    id: str
    data: str
    pages: int
    chars: list[float]
    link_chars: list[float]
    blocks: list[dict[int, int]]    # by slot: the block texts of all its pages, by hash, and their characters
    seen: list[int]                 # some ``TEMPLATE_PAGES`` of the different pages, by the hash of their texts


class Wrapper:
    """A union-free regular expression and, for each slot, where it is and how much text it has."""

    def __init__(self) -> None:
        self.items: list[Item] = []
        self.paths: list[tuple[str, ...]] = []
        self.chars: list[float] = []
        self.link_chars: list[float] = []
        self.in_group: list[bool] = []
        self.blocks: list[set[int] | None] = []   # what all pages have there; None before the first
        self.seen: list[set[int]] = []

    def _new(self, x: Item, inside: bool, optional: bool) -> Item:
        """A copy of a shape's item for the wrapper; its slots get numbers."""
        y = Item(x.label, many=x.many, optional=optional, path=x.path)
        if x.label == "#":
            y.texts = [len(self.paths)]
            self.paths.append(x.path)
            self.chars.append(0.0)
            self.link_chars.append(0.0)
            self.in_group.append(inside)
            self.blocks.append(None)
            self.seen.append(set())
        y.body = [self._new(b, True, False) for b in x.body]
        return y

    def _number(self, mine: Item, theirs: Item, at: dict[int, int]) -> None:
        if mine.label == "#":
            at[id(theirs)] = mine.texts[0]
        for a, b in zip(mine.body, theirs.body):
            self._number(a, b, at)

    def _align(self, mine: list[Item], theirs: list[Item], at: dict[int, int], inside: bool) -> list[Item]:
        out: list[Item] = []
        a, b = [x.key() for x in mine], [x.key() for x in theirs]
        for what, i, j, k, n in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
            if what == "equal":
                for x, y in zip(mine[i:j], theirs[k:n]):
                    self._number(x, y, at)
                    out.append(x)
                continue
            out += self._mismatch(mine[i:j], theirs[k:n], at, inside)
        return out

    def _mismatch(self, mine: list[Item], theirs: list[Item], at: dict[int, int], inside: bool) -> list[Item]:
        """One mismatch: a repetition (once here, repeated there), groups alike, or options."""
        for one, other, flipped in ((mine, theirs, False), (theirs, mine, True)):
            if len(one) == 1 and one[0].label == "(":
                body = [x.key() for x in one[0].body]
                if [x.key() for x in other] == body:
                    group = one[0] if not flipped else Item("(", body=list(mine), many=True, path=mine[0].path)
                    pairs = zip(group.body, other if not flipped else one[0].body)
                    for x, y in pairs:
                        self._number(x, y, at)
                    group.many = True
                    return [group]
        if len(mine) == len(theirs) == 1 and mine[0].label == theirs[0].label == "(":
            mine[0].body = self._align(mine[0].body, theirs[0].body, at, True)
            mine[0].name = ""
            return mine
        out = list(mine)
        for x in mine:
            x.optional = True
        for y in theirs:
            x = self._new(y, inside, True)
            self._number(x, y, at)
            out.append(x)
        return out

    def add(self, shape: list[Item], sums: Shape) -> list[int]:
        """Align a shape with the wrapper; the wrapper's slot for each of the shape's slots."""
        at: dict[int, int] = {}
        if not self.items:
            self.items = [self._new(x, False, False) for x in shape]
            for x, y in zip(self.items, shape):
                self._number(x, y, at)
        else:
            self.items = self._align(self.items, shape, at, False)
        numbers = [at[id(s)] for s in slots(shape)]
        here: dict[int, set[int]] = {}
        for k, c, l, blocks in zip(numbers, sums.chars, sums.link_chars, sums.blocks):
            self.chars[k] += c
            self.link_chars[k] += l
            here.setdefault(k, set()).update(blocks)
        for k, blocks in here.items():
            had = self.blocks[k]
            self.blocks[k] = blocks if had is None else had & blocks
            self.seen[k] = set(sorted(self.seen[k] | set(sums.seen))[:TEMPLATE_PAGES])
        return numbers

    def template(self, shapes: list[ShapeSlots]) -> list[list[set[int]]]:
        """For each shape and slot, the block texts that are part of the template."""
        found = []
        all_chars, equal_chars = 0.0, 0.0
        for s in shapes:
            own: list[set[int]] = []
            for k, w in enumerate(s.numbers):
                equal: set[int] = set()
                if not any(_tag(p) in MAIN or _tag(p) in FURNITURE for p in s.paths[k]):
                    if len(self.seen[w]) >= TEMPLATE_PAGES:
                        equal = {h for h in s.blocks[k] if h in self.blocks[w]}
                    all_chars += s.chars[k]
                    equal_chars += s.pages * sum(s.blocks[k][h] for h in equal)
                own.append(equal)
            found.append(own)
        if equal_chars >= MOST_TEMPLATE * all_chars:
            return [[set() for _ in own] for own in found]
        return found

    def main_slots(self, shapes: list[ShapeSlots]) -> list[list[bool]]:
        """For each of the host's shapes, which of its slots are main."""
        # An element that holds the title or the main element is no furniture, whatever its class says
        # (``page with-sidebar``).
        titled = {path[:i + 1] for path in {p for s in shapes for p in s.paths}
                  for i in range(max((k for k, p in enumerate(path) if _tag(p) in ("h1", "main")), default=0))}
        kept = [self._plain(s, titled) for s in shapes]
        # The text below each element of a shape, summed over the shapes with the same elements there.
        below: dict[tuple[str, ...], dict[frozenset, dict[tuple[str, ...], float]]] = {}
        children = []
        for s, rest in zip(shapes, kept):
            own: dict[tuple[str, ...], dict[tuple[str, ...], float]] = {}
            for k in rest:
                path = s.paths[k]
                for i in range(len(path)):
                    at = own.setdefault(path[:i], {})
                    at[path[:i + 1]] = at.get(path[:i + 1], 0.0) + s.chars[k]
                # Text right in an element counts for the element as a whole.
                at = own.setdefault(path, {})
                at[()] = at.get((), 0.0) + s.chars[k]
            children.append(own)
            for here, at in own.items():
                sums = below.setdefault(here, {}).setdefault(frozenset(at), {})
                for p, c in at.items():
                    sums[p] = sums.get(p, 0.0) + c
        known: dict[tuple, tuple[tuple[str, ...] | None, float]] = {}
        return [self._main(s, rest, own, below, known) for s, rest, own in zip(shapes, kept, children)]

    def _plain(self, s: ShapeSlots, titled: set[tuple[str, ...]]) -> list[int]:
        """The slots of a shape that are neither furniture nor, if there are others, groups of links."""
        plain, rest = [], []
        for k, path in enumerate(s.paths):
            if any(_tag(p) in FURNITURE or (_has_name(p) and path[:i + 1] not in titled) for i, p in enumerate(path)):
                continue
            plain.append(k)
            # The wrapper's slot speaks for this one only if it lies in the same element.
            w = s.numbers[k]
            same = self.paths[w] == path
            chars, link_chars = (self.chars[w], self.link_chars[w]) if same else (s.chars[k], s.link_chars[k])
            links = (s.in_group[k] or (same and self.in_group[w])) and link_chars > 0.6 * max(chars, 1.0)
            if not links or any(_tag(p) in MAIN for p in path):
                rest.append(k)
        return rest or plain

    @staticmethod
    def _main(s: ShapeSlots, rest: list[int], own: dict, below: dict, known: dict) -> list[bool]:
        for name in MAIN:
            inner = {k for k in rest if any(_tag(p) == name for p in s.paths[k])}
            if inner:
                return [k in inner for k in range(len(s.paths))]
        here: tuple[str, ...] = ()
        share = 1.0
        while True:  # the innermost element holding most of the text
            mine = frozenset(own.get(here, ()))
            if (here, mine) not in known:
                sums = {p: sum(at[p] for has, at in below.get(here, {}).items() if mine <= has) for p in mine}
                best = max((p for p in sums if p), key=lambda p: (sums[p], p), default=None)
                known[here, mine] = best, sums[best] / max(sum(sums.values()), 1.0) if best else 0.0
            best, part = known[here, mine]
            share *= part
            if (best is None or share < MOST_TEXT or _tag(best[-1]) in ("p", "li", "td") or _tag(best[-1]) in INLINE
                    # One of several alike is a part of the text, not its container.
                    or any(0 <= s.groups[k] < len(best) and s.paths[k][:len(best)] == best for k in rest)):
                return [k in rest and s.paths[k][:len(here)] == here for k in range(len(s.paths))]
            here = best


@lru_cache(maxsize=1 << 16)
def _tag(label: str) -> str:
    return re.match(r"<([^.>]*)", label).group(1)


@lru_cache(maxsize=1 << 16)
def _has_name(label: str) -> bool:
    """Does the class or id of an element name page furniture?"""
    tag = _tag(label)
    names = label[1 + len(tag):-1].strip(".").split()
    return tag not in ("html", "body", "article", "main") and any(n in NAMES for n in names)


def infer(shapes: list[Shape]) -> dict[str, tuple[list[int], list[set[int]]]]:
    """{shape id: which of its slots are main, and the template's blocks in each} for the shapes of one host."""
    w = Wrapper()
    found = {}
    for one in sorted(shapes, key=lambda s: (-s.pages, s.id)):
        shape = from_json(json.loads(one.data))
        groups = [len(x.path) if x.label == "(" else -1 for x in shape for _ in slots([x])]
        found[one.id] = ShapeSlots([x.path for x in slots(shape)], [g >= 0 for g in groups], w.add(shape, one), one.chars,
                                   one.link_chars, one.pages, groups, one.blocks)
    template = w.template(list(found.values()))
    # The template's text is no text of the page: it does not count when the main element is looked for.
    for s, own in zip(found.values(), template):
        s.chars = [max(c - s.pages * sum(blocks[h] for h in equal), 0.0) for c, blocks, equal in zip(s.chars, s.blocks, own)]
    return {i: ([int(m) for m in main], own) for i, main, own in zip(found, w.main_slots(list(found.values())), template)}


def main_texts(items: list[Item], texts: list[tuple[str, int, bool]], main: list[int], template: set[tuple[int, int]]) -> set[int]:
    """The numbers of the page's texts that lie in main slots and not in a block of the template (slot, hash)."""
    chosen = {k: n for n, (s, m) in enumerate(zip(slots(items), main)) if m for k in s.texts}
    if not template:
        return set(chosen)
    hashes = block_hashes(texts)
    content = {texts[k][1] for k, n in chosen.items() if (n, hashes[k]) not in template}
    return {k for k in chosen if texts[k][1] in content}


def blocks_text(texts: list[tuple[str, int, bool]], chosen: set[int]) -> str:
    """The chosen texts in page order, one line for each block."""
    lines: list[str] = []
    last = None
    for k, (raw, block, _) in enumerate(texts):
        if k in chosen:
            if block == last:
                lines[-1] += raw
            else:
                lines.append(raw)
            last = block
    clean = (" ".join(html_lib.unescape(x).split()) for x in lines)
    return "\n".join(x for x in clean if x)


def host_of(url):
    """Host of a url, lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


_SHAPE_SCHEMA = ("host string, shape string, data string, pages bigint, chars array<double>, links array<double>, "
                 "seen array<bigint>, blocks array<struct<k: int, h: bigint, n: bigint>>")


_BLOCK = pa.struct([("k", pa.int32()), ("h", pa.int64())])
_SHAPE_ARROW = pa.schema([
    ("host", pa.string()), ("shape", pa.string()), ("data", pa.string()), ("pages", pa.int64()), ("chars", pa.list_(pa.float64())),
    ("links", pa.list_(pa.float64())), ("seen", pa.list_(pa.int64())), ("blocks", pa.list_(pa.struct([*_BLOCK, ("n", pa.int64())])))])


def read_page(page: str) -> tuple[list[Item], list[tuple[str, int, bool]], str, str]:
    """The items, the texts, the shape and its id of a page."""
    items, texts = shape_of(page)
    data = json.dumps(to_json(items), separators=(",", ":"))
    return items, texts, data, md5(data.encode("utf-8", "surrogatepass")).hexdigest()


def sum_up(found: dict[tuple[str, str], Shape], host: str, page: str) -> None:
    """Add a page to its host's shape."""
    items, texts, data, name = read_page(page)
    hashes = block_hashes(texts)
    own = list(slots(items))
    blocks: list[dict[int, int]] = []
    for s in own:
        here: dict[int, int] = {}
        for k in s.texts:
            here[hashes[k]] = here.get(hashes[k], 0) + len(texts[k][0])
        blocks.append(here)
    row = found.get((host, name))
    if row is None:
        row = found[host, name] = Shape(name, data, 0, [0.0] * len(own), [0.0] * len(own), blocks, [])
    else:
        row.blocks = [{h: min(n, new[h]) for h, n in had.items() if h in new} for had, new in zip(row.blocks, blocks)]
    row.pages += 1
    for k, s in enumerate(own):
        row.chars[k] += sum(len(texts[t][0]) for t in s.texts)
        row.link_chars[k] += sum(len(texts[t][0]) for t in s.texts if texts[t][2])
    page_hash = int.from_bytes(blake2b(repr(hashes).encode(), digest_size=8).digest(), "big", signed=True)
    if page_hash not in row.seen:
        row.seen = sorted([*row.seen, page_hash])[:TEMPLATE_PAGES]


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) to one row per host and shape of this task, texts summed by slot."""
    found: dict[tuple[str, str], Shape] = {}
    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sum_up(found, host, page or "")
    rows = [{"host": h, "shape": s.id, "data": s.data, "pages": s.pages, "chars": s.chars, "links": s.link_chars, "seen": s.seen,
             "blocks": [{"k": k, "h": x, "n": n} for k, at in enumerate(s.blocks) for x, n in at.items()]}
            for (h, _), s in found.items()]
    yield pa.RecordBatch.from_pylist(rows, schema=_SHAPE_ARROW)


_MAIN_SCHEMA = "host string, shape string, main array<int>, template array<struct<k: int, h: bigint>>"
_MAIN_ARROW = pa.schema([("host", pa.string()), ("shape", pa.string()), ("main", pa.list_(pa.int32())), ("template", pa.list_(_BLOCK))])


def main_slots(pages: DataFrame) -> DataFrame:
    """(host, shape, main, template) for every distinct shape of every host.

    main: a flag for each slot; template: the blocks (slot, hash) that are part of the host's template.
    """
    ship_package(pages.sparkSession)
    shaped = pages.select(host_of(F.col("url")).alias("host"), F.col("html")).mapInArrow(_shapes, _SHAPE_SCHEMA)
    at = F.posexplode(F.arrays_zip("chars", "links")).alias("k", "v")
    # Sum the tasks' rows of a shape: slot by slot, then gathered again in slot order.
    shaped = materialize(shaped, "page-shapes")
    heads = shaped.groupBy("host", "shape").agg(
        F.min("data").alias("data"), F.sum("pages").alias("pages"), F.count(F.lit(1)).alias("tasks"))
    seen = (shaped.select("host", "shape", F.explode("seen").alias("p")).distinct().groupBy("host", "shape")
            .agg(F.sort_array(F.collect_list("p")).alias("seen")).withColumn("seen", F.slice("seen", 1, TEMPLATE_PAGES)))
    # A block is on all pages of a shape if it is in the rows of all tasks that met the shape.
    blocks = (shaped.select("host", "shape", F.explode("blocks").alias("b"))
              .groupBy("host", "shape", F.col("b.k").alias("k"), F.col("b.h").alias("h"))
              .agg(F.count(F.lit(1)).alias("times"), F.min("b.n").alias("n"))
              .join(heads.select("host", "shape", "tasks"), ["host", "shape"]).filter(F.col("times") == F.col("tasks"))
              .groupBy("host", "shape").agg(F.collect_list(F.struct("k", "h", "n")).alias("blocks")))
    sums = (shaped.select("host", "shape", at).groupBy("host", "shape", "k")
            .agg(F.sum("v.chars").alias("c"), F.sum("v.links").alias("l")).groupBy("host", "shape")
            .agg(F.sort_array(F.collect_list(F.struct("k", "c", "l"))).alias("s"))
            .select("host", "shape", F.col("s.c").alias("chars"), F.col("s.l").alias("links")))

    none = F.array().cast("array<double>")
    one = (heads.drop("tasks").join(sums, ["host", "shape"], "left").join(seen, ["host", "shape"], "left")
           .join(blocks, ["host", "shape"], "left")
           .withColumns({"chars": F.coalesce("chars", none), "links": F.coalesce("links", none),
                         "blocks": F.coalesce("blocks", F.array().cast("array<struct<k: int, h: bigint, n: bigint>>"))}))

    def wrap(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shapes = []
        for r in table.to_pylist():
            own: list[dict[int, int]] = [{} for _ in r["chars"]]
            for x in r["blocks"]:
                own[x["k"]][x["h"]] = x["n"]
            shapes.append(Shape(r["shape"], r["data"], r["pages"], r["chars"], r["links"], own, r["seen"]))
        host = key[0].as_py()
        if host:
            found = infer(shapes)
        else:  # pages without a host have nothing in common, not even a template
            found = {k: v for s in shapes for k, v in infer([replace(s, seen=[])]).items()}
        return pa.Table.from_pylist(
            [{"host": host, "shape": s, "main": main, "template": [{"k": k, "h": h} for k, own in enumerate(equal) for h in sorted(own)]}
             for s, (main, equal) in found.items()], schema=_MAIN_ARROW)

    # A host with more shapes than one task should align is cut into parts, each with its own wrapper.
    many = one.groupBy(F.col("host").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.col("n") / MOST_SHAPES).cast("int")
    dealt = one.join(many, F.col("host") == F.col("h")).withColumn("part", F.pmod(F.xxhash64("shape"), parts)).drop("h", "n")
    return dealt.groupBy("host", "part").applyInArrow(wrap, _MAIN_SCHEMA)


def _template_set(template: list[dict]) -> set[tuple[int, int]]:
    return {(x["k"], x["h"]) for x in template}


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    spark = pages.sparkSession
    chosen = materialize(main_slots(pages), "page-main-slots")
    host = host_of(F.col("url"))
    base = pages.select("page_id", "url", host.alias("host"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    schema = T.StructType([base.schema["page_id"], base.schema["url"], T.StructField("text", T.StringType())])
    size = chosen.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("template")), F.lit(0)).alias("blocks")).first()
    if size["rows"] <= BROADCAST_SHAPES and size["blocks"] <= BROADCAST_BLOCKS:
        table = spark.sparkContext.broadcast({(r["host"], r["shape"]): (r["main"], _template_set(r["template"])) for r in chosen.collect()})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for h, page in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                    items, texts, _, name = read_page(page)
                    main, template = table.value[(h, name)]
                    out.append(blocks_text(texts, main_texts(items, texts, main, template)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])

        return base.mapInArrow(run, schema)

    def shape_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [read_page(p)[3] for p in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.string())], [*batch.schema.names, "shape"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, main, template in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
                items, texts = shape_of(page)
                out.append(blocks_text(texts, main_texts(items, texts, main, _template_set(template))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])

    keyed = base.mapInArrow(shape_ids, T.StructType([*base.schema.fields, T.StructField("shape", T.StringType())]))
    return keyed.join(chosen, ["host", "shape"]).select("page_id", "url", "html", "main", "template").mapInArrow(cut, schema)


def pages_digest(pages: DataFrame) -> DataFrame:
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
