"""Leaf blocks of a web page: the stretches of text between block-level tags, with their ancestors."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

# HTML's elements by their part in the layout.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "script style noscript template head title iframe object svg canvas select option datalist "
    "textarea button audio video map".split()
)
IN_HEAD = frozenset("title meta link base style script noscript template basefont bgsound noframes".split())
RAW = frozenset(("script", "style", "textarea", "title", "iframe", "noscript"))
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr main menu nav ol p pre section table ul".split()
)
ITEMS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
         "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table"))}

# Elements that leave no mark between the words beside them: a word goes on around them.
INSIDE_WORDS = frozenset(
    "area base embed img input link meta param script source style svg template track wbr noscript".split()
)
_PLAIN_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:\s++[\w:@.-]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'<>=`]++))?+)*+)\s*+(/?)>"
)
_OPEN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_GAP = re.compile(r"[\s/]*+")
_ATTR_NAME = re.compile(r"[^\s/>][^\s/>=]*+")
_EQUALS = re.compile(r"\s*+=\s*+")
_VALUE = re.compile(r"[^\s>]*+")
_COMMENT_END = re.compile(r"--!?>")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_ATTR = re.compile(r"([\w:@.-]++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'<>=`]++))?+")
_NO_RULE = re.compile(r"/\*.*?(?:\*/|\Z)|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|\([^)]*(?:\)|\Z)", re.S)  # comments, strings, arguments


class Place:
    """An open element and its ancestors: a node that all blocks below it share."""

    __slots__ = ("parent", "tag", "names", "new", "near", "kept")

    def __init__(self, parent: Place | None, tag: str, names: tuple[str, ...]) -> None:
        self.parent, self.tag, self.names = parent, tag, names
        self.new: tuple[str, ...] = ()  # features that no ancestor has, set by whoever reads them
        self.near = ""
        self.kept = None

    def up(self) -> Iterator[Place]:
        """This place and its ancestors, innermost first."""
        at: Place | None = self
        while at is not None:
            yield at
            at = at.parent


class Block(NamedTuple):
    text: str
    place: Place | None  # the innermost open element
    linked: int  # characters inside links

    @property
    def tags(self) -> tuple[str, ...]:
        """Ancestors, outermost first."""
        return tuple(x.tag for x in self.place.up())[::-1] if self.place else ()


def _tag_at(page: str, at: int) -> tuple[int, str, str, list[tuple[str, str]]] | None:
    """The tag that begins at a `<`: where it ends, `/` of an end tag, name, attributes.

    A quote opens a value only where the value begins. None: no tag, the `<` is text. A tag
    without an end runs to the end of the page.
    """
    m = _PLAIN_TAG.match(page, at)
    if m:
        return m.end(), m[1], m[2], [(k, v[1:-1] if v[:1] in "\"'" else v) for k, v in _ATTR.findall(m[3])] if m[3] else []
    m = _OPEN_TAG.match(page, at)
    if not m:
        return None
    found, pos, size = [], m.end(), len(page)
    while True:
        pos = _GAP.match(page, pos).end()
        if pos >= size:
            return size, m[1], "", []
        if page[pos] == ">":
            return pos + 1, m[1], m[2], found
        name = _ATTR_NAME.match(page, pos)
        pos, value = name.end(), ""
        equals = _EQUALS.match(page, pos)
        if equals:
            pos = equals.end()
            quote = page[pos : pos + 1]
            if quote in ("'", '"'):
                end = page.find(quote, pos + 1)
                if end < 0:
                    return size, m[1], "", []
                value, pos = page[pos + 1 : end], end + 1
            else:
                end = _VALUE.match(page, pos).end()
                value, pos = page[pos:end], end
        found.append((name[0], value))


def _mark_end(page: str, at: int) -> int:
    """Where a comment or declaration that begins at `at` ends."""
    if page.startswith("<!--", at):
        if page.startswith(("<!-->", "<!--->"), at):
            return page.index(">", at) + 1
        end = _COMMENT_END.search(page, at + 4)
        return end.end() if end else len(page)
    end = page.find(">", at)
    return end + 1 if end >= 0 else len(page)


def _named(attrs: dict[str, str]) -> tuple[str, ...]:
    found = (attrs[k] for k in ("class", "id", "role") if k in attrs)
    return tuple(w.lower() for value in found for w in _PART.findall(value))


def _styled(style: str) -> dict[str, str]:
    """The display and visibility of a style value; the last rule counts, important ones before others."""
    found: dict[str, tuple[bool, str]] = {}
    for rule in _NO_RULE.sub(" ", style).lower().split(";"):
        name, _, value = rule.partition(":")
        name, (value, *mark) = name.strip(), value.split("!")
        if name in ("display", "visibility") and value.strip() and bool(mark) >= found.get(name, (False,))[0]:
            found[name] = bool(mark), value.strip()
    return {name: value for name, (_, value) in found.items()}


def _hiding(attrs: dict[str, str]) -> tuple[bool, bool | None]:
    """Whether the attributes hide all of the element, and the visibility they set for it (None: none).
    aria-hidden hides nothing from who reads the page."""
    style = _styled(html.unescape(attrs["style"])) if "style" in attrs else {}
    gone = html.unescape(attrs.get("hidden", "false")).strip().lower() != "false" or style.get("display") == "none"
    return gone, {"hidden": False, "collapse": False, "visible": True}.get(style.get("visibility", ""))


class _Open:
    """The open elements of a page, with what the innermost one of each kind needs in one step."""

    def __init__(self) -> None:
        self.places: list[Place] = []
        self.at: dict[str, list[int]] = {}  # of each tag, where it is open
        self.blocks: list[int] = []  # where elements that are not inline are open
        self.hides: list[bool] = []
        self.shows: list[bool] = []  # visibility passes to children, which may set it anew
        self.hidden = self.links = 0

    def top(self) -> Place | None:
        return self.places[-1] if self.places else None

    def last(self, tag: str) -> int:
        return self.at[tag][-1] if self.at.get(tag) else -1

    def push(self, tag: str, attrs: dict[str, str]) -> None:
        gone, shown = _hiding(attrs) if attrs else (False, None)
        self.at.setdefault(tag, []).append(len(self.places))
        if tag not in INLINE:
            self.blocks.append(len(self.places))
        self.places.append(Place(self.top(), tag, _named(attrs) if attrs else ()))
        self.hides.append(tag in HIDDEN or gone)
        self.shows.append(shown if shown is not None else not self.shows or self.shows[-1])
        self.hidden += self.hides[-1]
        self.links += tag == "a"

    def pop_to(self, depth: int) -> None:
        while len(self.places) > depth:
            tag = self.places.pop().tag
            self.at[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()
            self.hidden -= self.hides.pop()
            self.shows.pop()
            self.links -= tag == "a"

    def close(self, tag: str, stops: tuple[str, ...] = ()) -> None:
        """Close the innermost such element, unless one of `stops` is open inside it."""
        depth = self.last(tag)
        if depth >= 0 and depth > max((self.last(s) for s in stops), default=-1):
            self.pop_to(depth)

    def close_inline(self, tag: str) -> None:
        depth = self.last(tag)
        if depth >= 0 and depth > (self.blocks[-1] if self.blocks else -1):
            self.pop_to(depth)


def blocks(page: str | None) -> list[Block]:
    """The page's visible text in page order; white space runs are one space, empty blocks go.
    One pass with one forward pointer: linear in the page, however deep or broken it is."""
    if not page:
        return []
    out: list[Block] = []
    open_ = _Open()
    linked = 0
    held: list[str] = []

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append(Block(text, open_.top(), linked))
            held.clear()
        linked = 0

    at, size = 0, len(page)
    begun = 0  # of the text since the last tag
    while True:
        stop = page.find("<", at)
        tag_found = None
        if 0 <= stop < size - 1 and page[stop + 1] in "!?":
            end = _mark_end(page, stop)
        elif stop >= 0:
            tag_found = _tag_at(page, stop)
            if tag_found is None:
                if page.startswith("</", stop) and stop + 2 < size:
                    end = _mark_end(page, stop)  # an end tag without a name is a comment
                else:
                    at = stop + 1  # a mere `<` is text
                    continue
            else:
                end = tag_found[0]
        else:
            stop = end = size
        if stop > begun:
            raw = page[begun:stop]
            if open_.places and open_.places[-1].tag == "head" and raw.strip():
                open_.pop_to(len(open_.places) - 1)  # </head> may be left out: words or a tag of the body end it
            if not open_.hidden and (not open_.shows or open_.shows[-1]):
                text = html.unescape(raw) if "&" in raw else raw
                held.append(text)
                if open_.links:
                    linked += len(text)
        if stop >= size:
            break
        at = begun = end
        if tag_found is None:
            continue
        _, is_end, tag, attrs = tag_found
        tag = tag.lower()
        if not tag:
            continue
        inline = tag in INLINE or tag in INSIDE_WORDS
        if is_end:
            if open_.last(tag) >= 0:
                if not inline and not open_.hidden:
                    flush()
                if tag in INLINE:
                    open_.close_inline(tag)
                else:
                    open_.close(tag)
            elif tag in ("p", "br"):
                flush()
            continue
        if open_.places and open_.places[-1].tag == "head":
            if tag in ("head", "html"):
                continue
            if tag not in IN_HEAD:
                open_.pop_to(len(open_.places) - 1)
        if not inline:
            if not open_.hidden:
                flush()
            if tag in CLOSES_P:
                open_.close("p", ("table", "td", "th", "button", "object"))
            if tag in ITEMS:
                kin, stops = ITEMS[tag]
                for other in kin.split():
                    open_.close(other, stops)
        if tag in VOID:
            continue
        if tag in RAW:
            over = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            close = page.find(">", over.end() - 1) if over else -1
            at = begun = close + 1 if close >= 0 else size
            continue
        if page[end - 2 : end] == "/>" and tag not in CLOSES_P and tag not in INLINE:
            continue
        values: dict[str, str] = {}
        for name, value in attrs:
            values.setdefault(name.lower(), value)
        open_.push(tag, values)
    flush()
    return out
