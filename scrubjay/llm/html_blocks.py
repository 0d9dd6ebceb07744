"""A page as a sequence of leaf blocks: text between block-level tags, with its path of open tags.

Markup is read tolerantly: unknown or unbalanced end tags are ignored, ``p``, ``li`` and the like close an open one of
their kind, and raw text (scripts, styles, titles and so on) is skipped up to its end tag or the page's end. Drawings,
choices and templates are skipped if they have an end tag of their own; self-closed ones are empty, and unclosed ones,
like drawings that hold blocks of HTML, are read as any element. So are formulas, objects and ``noscript``. A ``<`` that
begins no whole tag is text. An element within ``DEPTH`` open ones is taken for the sibling of the innermost, as browsers
do, so untidy markup nests no deeper; its text is kept.

Reading takes time and memory in proportion to the page: tags are found in one forward pass that remembers where a
search has failed, open elements are looked up by kind, and blocks share the nodes of their paths.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

#: Fixed values of HTML: raw text, elements that are skipped if closed, formulas, elements within a line, elements
#: without content.
RAW = frozenset("script style title textarea iframe".split())
CLOSED = frozenset("template select svg".split())
MATH = frozenset("math maction annotation annotation-xml menclose merror mfrac mi mmultiscripts mn mo mover mpadded "
                 "mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder "
                 "munderover semantics".split())
#: Elements whose own name does not tell what they hold, and which are not named on a path.
UNNAMED = CLOSED | MATH | {"noscript", "object"}
INLINE = MATH | frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: An opening tag that closes an open one of these kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol "
                    "p pre section table ul".split())
_SCOPE = frozenset("ul ol dl table div section article aside nav main body".split())

#: Fixed value: how many elements may be open at once.
DEPTH = 512
_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")
_EVENT = re.compile(r"[>\"']")


class Path:
    """The open elements around a block, innermost last; a node holds one element's names and the node above."""

    __slots__ = ("above", "names", "size", "last", "level")

    def __init__(self, above: Path | None, names: tuple[str, ...]):
        self.above, self.names = above, names
        self.size = len(names) + (above.size if above else 0)
        self.last = names[-1] if names else above.last if above else None
        self.level = above.level + 1 if above else 0

    def nodes(self) -> list[Path]:
        """From the outermost to this one."""
        out, node = [], self
        while node:
            out.append(node)
            node = node.above
        return out[::-1]


class Leaf(NamedTuple):
    """A block's text, the node of its path (tags, and words of their class, id and role), and its linked characters."""

    text: str
    node: Path
    linked: int

    @property
    def path(self) -> tuple[str, ...]:
        return tuple(n for node in self.node.nodes() for n in node.names)


def leaf(text: str, names: tuple[str, ...], linked: int) -> Leaf:
    """A block whose path is given by its names."""
    return Leaf(text, Path(None, names), linked)


class Tag(NamedTuple):
    """Where a tag starts and ends, whether it is an end tag, its name (none for comments and the like), its attributes."""

    start: int
    end: int
    closes: bool
    name: str
    rest: str

    @property
    def empty(self) -> bool:
        return self.rest.rstrip().endswith("/")


class Tags:
    """The tags of a page, asked for from front to back."""

    def __init__(self, page: str):
        self.page = page
        self.none_after: dict[str, int] = {}  # a sign does not occur from here on
        self.dead: set[int] = set()  # quotes from which no tag's end is reached
        self.event_from, self.event_at = 0, -1  # no quote or end sign lies between the two

    def find(self, sign: str, at: int) -> int:
        if at >= self.none_after.get(sign, len(self.page) + 1):
            return -1
        found = self.page.find(sign, at)
        if found < 0:
            self.none_after[sign] = at
        return found

    def event(self, at: int) -> int:
        """The next quote or end sign; -1 if there is none."""
        if not self.event_from <= at <= self.event_at:
            found = _EVENT.search(self.page, at)
            self.event_from, self.event_at = at, found.start() if found else len(self.page)
        return self.event_at if self.event_at < len(self.page) else -1

    def end_of_tag(self, at: int) -> int:
        """The place after the end sign of the tag whose attributes start at ``at``; -1 if it has none."""
        quotes = []
        while (spot := self.event(at)) >= 0:
            if self.page[spot] == ">":
                return spot + 1
            if spot in self.dead:
                break
            quotes.append(spot)
            closing = self.find(self.page[spot], spot + 1)
            if closing < 0:
                break
            at = closing + 1
        self.dead.update(quotes)
        return -1

    def next(self, at: int) -> Tag | None:
        while (start := self.find("<", at)) >= 0:
            end, name = -1, _OPEN.match(self.page, start)
            if name:
                end = self.end_of_tag(name.end())
                if end >= 0:
                    return Tag(start, end, bool(name[1]), name[2].lower(), self.page[name.end():end - 1])
            elif self.page.startswith("<!--", start):
                found = self.find("-->", start + 4)
                return Tag(start, found + 3 if found >= 0 else len(self.page), False, "", "")
            elif self.page.startswith(("<!", "<?"), start):
                if self.page.startswith("<![CDATA[", start):
                    found = self.find("]]>", start + 9)
                    end = found + 3 if found >= 0 else -1
                if end < 0:
                    end = self.find(">", start + 2) + 1 or -1
                if end >= 0:
                    return Tag(start, end, False, "", "")
            at = start + 1
        return None


def _raw_end(page: str, name: str, at: int) -> int:
    end = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
    return page.find(">", end.end()) + 1 or len(page) if end else len(page)


def skips(page: str) -> dict[int, int]:
    """Where each drawing, choice or template that is skipped starts, and where it ends."""
    out: dict[int, int] = {}
    held: dict[str, list[int]] = {name: [] for name in CLOSED}
    tags, depth, at, block = Tags(page), 0, 0, -1
    while tag := tags.next(at):
        at, name = tag.end, tag.name
        if name in _ENDS_P and not tag.closes:
            block = tag.start
        if name in ("svg", "math") and not (not tag.closes and tag.empty):
            depth = max(0, depth + (-1 if tag.closes else 1))
        if name in CLOSED and tag.closes and held[name]:
            start = held[name].pop()
            if name != "svg" or block < start:
                out[start] = at
        elif name in CLOSED and not tag.closes and not tag.empty:
            held[name].append(tag.start)
        elif name in RAW and not tag.closes and not (depth and tag.empty):
            at = _raw_end(page, name, at)
    return out


class _Open:
    """The open elements, and where those of each kind stand."""

    def __init__(self) -> None:
        self.items: list[tuple[str, Path]] = []
        self.places: dict[str, list[int]] = {}
        self.root = Path(None, ())

    def top(self) -> Path:
        return self.items[-1][1] if self.items else self.root

    def innermost(self, kinds) -> int:
        return max((self.places[k][-1] for k in kinds if self.places.get(k)), default=-1)

    def cut(self, place: int) -> None:
        """Closes the element at ``place`` and all within it."""
        while len(self.items) > place:
            self.places[self.items.pop()[0]].pop()

    def push(self, kind: str, names: tuple[str, ...]) -> None:
        if len(self.items) >= DEPTH:
            self.cut(DEPTH - 1)
        self.places.setdefault(kind, []).append(len(self.items))
        above = self.top()
        self.items.append((kind, Path(above, names) if names else above))


def leaves(page: str | None) -> list[Leaf]:
    """The non-empty blocks of a page in order; null and empty pages have none."""
    out: list[Leaf] = []
    if not page:
        return out
    open_, tags = _Open(), Tags(page)
    parts: list[str] = []
    linked, place, at = 0, 0, 0
    started: Path | None = None
    skipped: dict[int, int] | None = None

    def flush() -> None:
        nonlocal linked, started
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Leaf(text, started or open_.root, linked))
        parts.clear()
        linked, started = 0, None

    def say(raw: str) -> None:
        nonlocal linked, started
        if raw:
            if started is None and not raw.isspace():
                started = open_.top()
            parts.append(raw)
            if open_.places.get("a"):
                linked += len(raw)

    while tag := tags.next(at):
        say(page[place:tag.start])
        place = at = tag.end
        name = tag.name
        if not name:
            continue
        if name not in INLINE:
            flush()
        if tag.closes:
            if open_.places.get(name):
                open_.cut(open_.places[name][-1])
            continue
        if name in RAW and not (tag.empty and open_.innermost(("svg", "math")) >= 0):
            place = at = _raw_end(page, name, at)
            continue
        if name in CLOSED:
            skipped = skips(page) if skipped is None else skipped
            if tag.start in skipped:
                place = at = skipped[tag.start]
                continue
        ends = CLOSES.get(name, ()) or (("p",) if name in _ENDS_P else ())
        last = open_.innermost(ends)
        if last >= 0 and last > open_.innermost(_SCOPE):
            open_.cut(last)
        if name not in VOID and not tag.empty:
            words = tuple(f".{w}" for value in _NAMES.findall(tag.rest) for w in _WORD.findall(value.lower()))
            open_.push(name, words if name in UNNAMED else (name, *words))
    say(page[place:])
    flush()
    return out
