"""One walk over a page's markup that finds the parts of a listing. Runs on Arrow batches in Spark's Python workers.

Elements are found by class paths: each class belongs to an ancestor of the next one. A part ends where its element ends,
whatever lies behind it. Markup is read as browsers do where that matters here: tags and attribute names in any case and whole
(`data-class` is no class), values in double, single or no quotes, the first of equal attributes, every character reference,
list items and paragraphs that are never closed, no markup inside comments, scripts and styles.

Pages of a site repeat the same tags, so a tag is read once and remembered by its text. They repeat whole sequences of tags
too, whatever their texts and their attributes are; the walk looks at nothing else, so what it finds is remembered by these.

Many pages are cut at once (`take`): their angle brackets are found in the bytes of an Arrow batch, and only the texts that are
asked for become Python objects. Pages with more than plain tags and texts are walked one by one.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from itertools import accumulate, chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

_REST = r"(?:[^'\">]|\"[^\"]*\"|'[^']*')*+>"
# A comment, a script or style with all it holds, or a tag.
_TAG = re.compile(
    rf"(<!--.*?-->|<script(?=[\s/>]){_REST}.*?(?=</script|\Z)|<style(?=[\s/>]){_REST}.*?(?=</style|\Z)|</?[a-zA-Z][^\s/>]*{_REST})", re.S | re.I
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# In attributes a reference without semicolon is none if a letter, a digit or = follows.
_REFERENCE = re.compile(r"&(?:#\d+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*(?:;|(?![=A-Za-z0-9;])))")
# A tag without its last > that begins and ends where _TAG would have it, whatever follows.
_PLAIN = re.compile(r"</?[a-zA-Z][^\s/>\"'<]*(?:(?=[\s/])(?:[^'\"<>]|\"[^\"<]*\"|'[^'<]*')*+)?")
_MENDED = 8  # signs of > in texts and quotes that a page's tags are mended for
_REMEMBERED, _SHORT = 5_000, 120  # tags and texts that are remembered, and their longest text
_PLANNED = 1_000_000  # tags of the plans that are remembered
_SPELLED = 4_000_000  # letters of the tags of pages that are remembered
_ITEMS, _ITEM = 20_000, 300  # items of profiles that are remembered, and the most bytes of one
_CUT = 4 << 20  # bytes of pages that are cut at once; one page may be longer
# Tags as HTML defines them.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_COMMENT, _CLOSE, _OPEN = range(3)
_RAW_TEXT = frozenset([(_OPEN, "script"), (_OPEN, "style")])
_NOT_PLAIN = -1


class Form(NamedTuple):
    """Class paths of a kind of page, outermost first."""

    title: tuple[str, ...]
    crumbs: tuple[str, ...]
    prices: tuple[tuple[str, ...], ...]
    new_price: tuple[str, ...]
    item_list: tuple[str, ...]
    item_name: str
    card: str


class _Part:
    """An element whose text is taken until it ends: the texts from `start` up to `end`, and for an item those of its name."""

    __slots__ = ("depth", "end", "name", "rule", "start")

    def __init__(self, rule: str, depth: int, start: int):
        self.rule, self.depth, self.start, self.end, self.name = rule, depth, start, start, None


def attribute_text(value: str) -> str:
    """The value of an attribute with its character references decoded."""
    return _REFERENCE.sub(lambda m: unescape(m[0]), value) if "&" in value else value


def attribute(tag: str, name: str) -> str:
    """The value of an attribute of a tag's text, '' if it has none."""
    for m in _ATTRIBUTE.finditer(tag, _NAME.match(tag).end()):
        if m[1].lower() == name:
            return attribute_text(next((g for g in m.groups()[1:] if g is not None), ""))
    return ""


Tag = tuple[int, str, tuple[str, ...]]


class Tags:
    """Tags by their text as numbers; a number stands for a kind, a name and the classes that a form asks for. And the plans of
    pages by the numbers of their tags."""

    def __init__(self, form: Form):
        rules = {"title": form.title, "crumbs": form.crumbs, "new_price": form.new_price}
        rules |= {f"price {k}": path for k, path in enumerate(form.prices)}
        self.form = form
        self.ends: dict[str, list[tuple[str, tuple[str, ...]]]] = {}
        for rule, path in rules.items():
            if path:
                self.ends.setdefault(path[-1], []).append((rule, path[:-1]))
        self.wanted = {c for path in [*rules.values(), form.item_list] for c in path} | {form.item_name, form.card}
        self.known, self.whole = _Known(self, False), _Known(self, True)
        self.numbers: dict[Tag, int] = {}
        self.tags: list[Tag] = []
        self.plans: dict[tuple[int, ...], Plan] = {}
        self.planned = 0  # tags of all plans
        self.pages: dict[tuple[str, tuple[int, ...]], Plan] = {}  # by the tags' texts
        self.spelled = 0  # letters of all of these
        self.cuts: dict[bytes, Plan | None] = {}  # by the tags' bytes; None: walked one by one
        self.cut = 0  # bytes of all of these

    def read(self, text: str) -> Tag:
        if text.startswith("<!--"):
            return _COMMENT, "", ()
        name = _NAME.match(text)[1].lower()
        if text[1] == "/":
            return _CLOSE, name, ()
        classes = dict.fromkeys(attribute(text, "class").split()) if "class" in text.lower() else {}
        return _OPEN, name, tuple(c for c in classes if c in self.wanted)

    def number(self, text: str) -> int:
        tag = self.read(text)
        found = self.numbers.get(tag)
        if found is None:
            found = self.numbers[tag] = len(self.tags)
            self.tags.append(tag)
        return found

    def split(self, html: str) -> tuple[list[str], Plan]:
        """The texts of a page with the tags between them, and its plan. Tags are cut at the angle brackets of the page; a few >
        in texts or quotes are mended, and what else stands there leaves the page to `_TAG`. (Tags of the first kind lack their
        >.) A page whose tags are those of one before, letter by letter, takes its plan unread."""
        pieces = html.replace("<", "><").split(">")  # text, tag, text, ..., text
        tags, known, k = html.count("<"), self.known, 1
        quoted, more = (), len(pieces) - 1 - 2 * tags
        if 0 < more <= _MENDED:
            while more and k < len(pieces):
                if pieces[k].startswith("<"):
                    k += 2
                    continue
                if k > 1 and known[pieces[k - 2]] == _NOT_PLAIN:  # a > in quotes
                    pieces[k - 2 : k] = [f"{pieces[k - 2]}>{pieces[k - 1]}"]
                    k -= 2
                    quoted += (k,)
                else:  # a > in the text before
                    pieces[k - 1 : k + 1] = [f"{pieces[k - 1]}>{pieces[k]}"]
                more -= 1
        if not more:
            between = pieces[1::2]
            key = ">".join(between), quoted  # the places of the signs in quotes tell where a tag ends
            found = self.pages.get(key)
            if found is not None:
                return pieces, found
            numbers = tuple(map(known.__getitem__, between))
            if _NOT_PLAIN not in numbers:
                found = self.plan(numbers)
                if len(key[0]) <= _SPELLED // 100:
                    if self.spelled + len(key[0]) > _SPELLED:
                        self.pages.clear()
                        self.spelled = 0
                    self.pages[key] = found
                    self.spelled += len(key[0])
                return pieces, found
        pieces = _TAG.split(html)
        return pieces, self.plan(tuple(map(self.whole.__getitem__, pieces[1::2])))

    def plan(self, numbers: tuple[int, ...]) -> Plan:
        found = self.plans.get(numbers)
        if found is None:
            found = Plan([self.tags[n] for n in numbers], self)
            if len(numbers) <= _PLANNED // 100:
                if self.planned + len(numbers) > _PLANNED:
                    self.plans.clear()
                    self.planned = 0
                self.plans[numbers] = found
                self.planned += len(numbers)
        return found

    def of_bytes(self, tags: bytes) -> Plan | None:
        """The plan of a page by the bytes of its tags, each from its < to its >. None if one of them is not plain."""
        if tags in self.cuts:
            return self.cuts[tags]
        numbers = tuple(self.known[f"<{t[:-1]}"] for t in tags.decode().split("<")[1:])
        found = None if _NOT_PLAIN in numbers else self.plan(numbers)
        if len(tags) <= _SPELLED // 100:
            if self.cut + len(tags) > _SPELLED:
                self.cuts.clear()
                self.cut = 0
            self.cuts[tags] = found
            self.cut += len(tags)
        return found

    def forget(self) -> None:
        """Between two pages: starts anew if there are too many kinds of tags."""
        if len(self.tags) > _REMEMBERED:
            self.known.clear()
            self.whole.clear()
            self.numbers.clear()
            self.tags.clear()
            self.plans.clear()
            self.pages.clear()
            self.cuts.clear()
            self.planned = self.spelled = self.cut = 0


class _Known(dict):
    """Numbers of tags by their whole text, or by their text without the last > (`_NOT_PLAIN` if only the page tells where it
    ends)."""

    def __init__(self, tags: Tags, whole: bool):
        super().__init__()
        self.tags, self.whole = tags, whole

    def __missing__(self, text: str) -> int:
        if self.whole:
            found = self.tags.number(text)
        else:
            found = self.tags.number(f"{text}>") if _PLAIN.fullmatch(text) else _NOT_PLAIN
            if found != _NOT_PLAIN and self.tags.tags[found][:2] in _RAW_TEXT:
                found = _NOT_PLAIN
        if len(text) <= _SHORT:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[text] = found
        return found


class Plan:
    """What a walk over the tags of a page finds, as places of texts: `first` by rule, the profile's items as those of their
    name (its only one, if there is one, and all) and of the whole, and the places of the tags of cards' links. Texts play no part in it, so pages of equal tags share it."""

    def __init__(self, tags: list[Tag], of: Tags):
        self.first: dict[str, slice | None] = {}
        self.items: list[tuple[int | None, slice, slice]] = []
        self.links: list[int] = []
        self._form, self._ends = of.form, of.ends
        self._section: int | None = None  # depth of the first profile section, 0 when it has ended
        self._stack: list[str] = []  # names of the open elements
        self._classes: list[tuple[str, ...]] = []  # and those of their classes that are asked for
        self._above: dict[str, int] = {}  # how many open elements have a class
        self._parts: list[_Part] = []
        self._at = 0  # texts up to here
        self._walk(tags)
        self.title = self.first.get("title") or self.first.get("last crumb")
        self.price = next((p for k in range(len(of.form.prices)) if (p := self.first.get(f"price {k}")) is not None), None)
        self.new_price = self.first.get("new_price")
        # Texts of the items as places of the page, and their names' within them.
        self.spans = [(whole, named.start - whole.start, named.stop - whole.start) for _, named, whole in self.items]
        # Places in items are counted from the first text that any of them holds.
        first = min((p.start for _, named, whole in self.items for p in (named, whole)), default=0)
        self.items_texts = slice(first, max((p.stop for _, named, whole in self.items for p in (named, whole)), default=first))
        back = lambda p: slice(p.start - first, p.stop - first)
        self.items = [(a if a is None else a - first, back(named), back(whole)) for a, named, whole in self.items]

    def _end(self, depth: int) -> None:
        """Closes all elements deeper than `depth`."""
        stack, classes, parts = self._stack, self._classes, self._parts
        while len(stack) > depth:
            stack.pop()
            for c in classes.pop():
                self._above[c] -= 1
        while parts and parts[-1].depth > depth:
            self._finish(parts.pop(), parts)
        if self._section and depth < self._section:
            self._section = 0

    def _close(self, tag: str, bounds: frozenset[str]) -> None:
        stack = self._stack
        for k in range(len(stack) - 1, -1, -1):
            if stack[k] == tag:
                self._end(k)
                return
            if stack[k] in bounds:
                return

    def _walk(self, tags: list[Tag]) -> None:
        stack, card, none = self._stack, self._form.card, frozenset()
        for place, (kind, tag, classes) in enumerate(tags):
            self._at = place + 1
            if kind == _OPEN:
                if tag == "li":
                    self._close("li", _LISTS)
                elif tag in _ENDS_P:
                    self._close("p", _BLOCKS)
                depth = len(stack) + (tag not in _VOID)
                if classes or tag == "li" or tag == "a":
                    self._open(tag, classes, depth)
                    if tag == "a" and self._above.get(card):
                        self.links.append(place)
                if depth > len(stack):
                    stack.append(tag)
                    self._classes.append(classes)
                    for c in classes:
                        self._above[c] = self._above.get(c, 0) + 1
            elif kind == _CLOSE:
                if stack and stack[-1] == tag:
                    self._end(len(stack) - 1)
                else:
                    self._close(tag, none)
        self._at = len(tags) + 1
        self._end(0)

    def _open(self, tag: str, classes: tuple[str, ...], depth: int) -> None:
        form, parts, above = self._form, self._parts, self._above
        for c in classes:
            for rule, ancestors in self._ends.get(c, ()):
                if rule not in self.first and all(above.get(a) for a in ancestors):
                    self.first[rule] = None
                    parts.append(_Part(rule, depth, self._at))
            if c == form.item_list[0] and self._section is None:
                self._section = depth
            if c == form.item_name and any(p.rule == "item" and p.name is None for p in parts):
                parts.append(_Part("name", depth, self._at))
        if tag == "li" and self._section and above.get(form.item_list[-1]):
            parts.append(_Part("item", depth, self._at))
        if tag == "a" and any(p.rule == "crumbs" for p in parts):
            parts.append(_Part("crumb", depth, self._at))

    def _finish(self, part: _Part, parts: list[_Part]) -> None:
        texts = slice(part.start, self._at)
        if part.rule == "crumb":
            self.first["last crumb"] = texts
        elif part.rule == "name":
            for p in parts:
                if p.rule == "item" and p.name is None:
                    p.name = texts
        elif part.rule == "item":
            if part.name is not None:
                named = part.name
                self.items.append((named.start if named.stop == named.start + 1 else None, named, texts))
        else:
            self.first[part.rule] = texts


class Page:
    """A page's texts and what its plan finds among them."""

    __slots__ = ("_pieces", "_plan")

    def __init__(self, html: str, tags: Tags):
        tags.forget()
        self._pieces, self._plan = tags.split(html)

    def _texts(self, part: slice) -> list[str]:
        """Some of the texts, decoded."""
        return [_decoded(t) if "&" in t else t for t in self._pieces[2 * part.start : 2 * part.stop : 2]]

    def _text(self, part: slice | None) -> str | None:
        """Every text node trimmed on its own, joined without a separator."""
        return None if part is None else "".join([t.strip() for t in self._texts(part)]).strip()

    def title(self) -> str | None:
        part = self._plan.title
        return None if part is None else "".join(self._texts(part))

    def price(self) -> str | None:
        return self._text(self._plan.price)

    def new_price(self) -> str | None:
        return self._text(self._plan.new_price)

    def links(self) -> list[str]:
        found = [attribute(self._pieces[2 * k + 1], "href") for k in self._plan.links]
        return [href for href in found if href]

    def profile(self, all_blanks: bool) -> dict[str, str]:
        """Key -> value; a later duplicate key wins, empty keys and values are left out."""
        out, items = {}, self._plan.items
        if not items:
            return out
        keys = _KEYS[all_blanks]
        trimmed = [t.strip() for t in self._texts(self._plan.items_texts)]
        for alone, named, part in items:
            name = trimmed[alone] if alone is not None else "".join(trimmed[named]).strip()
            key = keys[name]
            if key:
                value = _value(name, trimmed[part])
                if value:
                    if key in out:
                        del out[key]
                    out[key] = value
        return out


def _value(name: str, trimmed: list[str]) -> str:
    """An item's value: its texts without its name."""
    text = "".join(trimmed)
    return (text.replace(name, "") if name else text).strip()


class _Keys(dict):
    """Keys of a profile by the names on the page."""

    def __init__(self, all_blanks: bool):
        super().__init__()
        self.all_blanks = all_blanks

    def __missing__(self, name: str) -> str:
        key = name.replace("\xa0", "").replace("：", "").replace(" ", "")
        key = "".join(key.split()) if self.all_blanks else key
        if len(name) <= _SHORT:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[name] = key
        return key


@lru_cache(maxsize=_REMEMBERED)
def _short_decoded(text: str) -> str:
    return unescape(text)


def _decoded(text: str) -> str:
    return _short_decoded(text) if len(text) <= _SHORT else unescape(text)


_LISTS = frozenset(("ul", "ol", "menu"))
_BLOCKS = frozenset("div ul ol dl table section article aside header footer nav main form h1 h2 h3 h4 h5 h6 blockquote pre hr".split())


_ENDS_P = _BLOCKS | {"p"}
_TAGS: dict[Form, Tags] = {}
_KEYS = {all_blanks: _Keys(all_blanks) for all_blanks in (False, True)}


def walk(html: str | None, form: Form) -> Page:
    tags = _TAGS.get(form)
    if tags is None:
        tags = _TAGS[form] = Tags(form)
    return Page(html or "", tags)


class _Items(dict):
    """Key and value of an item by its bytes; ('', '') for those that are left out. Its name is that of the texts `first` up to
    `end`."""

    def __init__(self, first: int, end: int, all_blanks: bool):
        super().__init__()
        self.named, self.keys_of = slice(first, end), _KEYS[all_blanks]

    def __missing__(self, raw: bytes) -> tuple[str, str]:
        trimmed = [t.strip() for t in _texts_of(raw)]
        name = "".join(trimmed[self.named]).strip()
        key = self.keys_of[name]
        value = _value(name, trimmed) if key else ""
        found = (key, value) if value else ("", "")
        if len(raw) <= _ITEM:
            if len(self) >= _ITEMS:
                self.clear()
            self[raw] = found
        return found


def _texts_of(raw: bytes) -> list[str]:
    """The texts of a stretch of a page with plain tags alone, decoded."""
    text = raw.decode()
    pieces = [text]
    if "<" in text:
        pieces = text.replace("<", "><").split(">")
        if len(pieces) != 2 * text.count("<") + 1:  # a > in texts or quotes
            pieces = _TAG.split(text)
        pieces = pieces[::2]
    return [_decoded(t) for t in pieces] if "&" in text else pieces


# As _PLAIN, with the last >. What it finds is checked by the tags' texts.
_PLAIN_BYTES = re.compile(_PLAIN.pattern.encode() + b">")
_LT, _GT = b"<>"
_ONES = np.uint64(0x0101010101010101)


class _Cut:
    """Some pages of a batch, cut at the angle brackets of their bytes: the places of their texts, and the bytes of each page's
    tags."""

    def __init__(self, data: bytes, bounds: np.ndarray):
        self.data, self.bounds = data, bounds
        letters = np.frombuffer(data, np.uint8)
        signs = np.flatnonzero((letters == _LT) | (letters == _GT))
        opens = letters[signs] == _LT
        at = np.flatnonzero(opens)
        starts = signs[at]
        ends = np.append(signs, len(data))[at + 1]  # the next sign: of a plain tag mostly its >
        first = np.searchsorted(starts, bounds)  # of each page's tags
        page = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
        plain = np.ones(len(bounds) - 1, bool)
        plain[page[np.append(opens, True)[at + 1] | (ends >= bounds[page + 1])]] = False  # another < or the page's end
        # Signs of > behind another one: where such a tag ends is read from its text.
        more = np.searchsorted(at, np.flatnonzero(~opens[1:] & ~opens[:-1]) + 1) - 1
        more = more[more >= 0]
        more = more[plain[page[more]]]
        found = map(_PLAIN_BYTES.match, repeat(data), starts[more].tolist(), bounds[page[more] + 1].tolist())
        ends[more] = [-1 if tag is None else tag.end() - 1 for tag in found]
        plain[page[more[ends[more] < 0]]] = False
        good = plain[page]
        # Letters inside tags lie behind an odd number of edges: counted in words of eight first.
        edges = np.zeros((len(data) // 8 + 1) * 8, np.uint8)
        edges[starts[good]] = 1
        edges[ends[good] + 1] ^= 1
        words = edges.view("<u8") * _ONES
        counts = words >> np.uint64(56)
        before = np.cumsum(counts) - counts & np.uint64(1)
        inside = (words + before * _ONES & _ONES).view(bool)[: len(data)]
        self.tags = letters[inside].tobytes()
        self.plain = plain.tolist()
        self.spelled = np.append(0, np.cumsum(np.where(good, ends + 1 - starts, 0)))[first].tolist()
        self.texts = first + np.arange(len(bounds))  # the place of each page's first text
        self.begin = np.insert(ends + 1, first[:-1], bounds[:-1])
        self.end = np.insert(starts, first[1:], bounds[1:])

    def plans(self, tags: Tags) -> list[Plan | None]:
        spelled, out = self.spelled, []
        for k, plain in enumerate(self.plain):
            tags.forget()
            out.append(tags.of_bytes(self.tags[spelled[k] : spelled[k + 1]]) if plain else None)
        return out

    def stretches(self, pages: np.ndarray, parts: list[slice]) -> Iterator[list[bytes]]:
        """For each part its first up to its last text, with the tags between them, of pages with one plan."""
        texts, data = self.texts[pages], self.data
        begin = self.begin[np.array([[p.start] for p in parts]) + texts].tolist()
        end = self.end[np.array([[p.stop - 1] for p in parts]) + texts].tolist()
        for a, b in zip(begin, end, strict=True):
            yield [data[i:j] for i, j in zip(a, b, strict=True)]


def _title_of(raw: bytes) -> str:
    return "".join(_texts_of(raw))


def _price_of(raw: bytes) -> str:
    return "".join([t.strip() for t in _texts_of(raw)]).strip()


_TAKEN = {"title": _title_of, "price": _price_of, "new_price": _price_of}
_ITEMS_OF: dict[tuple[int, int, bool], _Items] = {}


def _profiles_of(cut: _Cut, pages: np.ndarray, plan: Plan, all_blanks: bool) -> list[dict[str, str]]:
    if not plan.spans:
        return [{} for _ in pages]
    columns = []
    for (_, first, end), raws in zip(plan.spans, cut.stretches(pages, [whole for whole, _, _ in plan.spans]), strict=True):
        known = _ITEMS_OF.get((first, end, all_blanks))
        if known is None:
            known = _ITEMS_OF[first, end, all_blanks] = _Items(first, end, all_blanks)
        columns.append(map(known.__getitem__, raws))
    found = []
    for items in zip(*columns, strict=True):
        out = dict(items)
        if len(out) < len(items) or "" in out:  # the order is that of the last of equal keys
            out = {}
            for key, value in items:
                if key:
                    if key in out:
                        del out[key]
                    out[key] = value
        found.append(out)
    return found


def take(pages: pa.Array, form: Form, parts: tuple[str, ...], all_blanks: bool = False) -> list[list]:
    """These parts of each page: for each part its values in the order of the pages. The same as a walk over each of them."""
    tags = _TAGS.get(form)
    if tags is None:
        tags = _TAGS[form] = Tags(form)
    pages = pages.cast(pa.large_binary())
    if pages.null_count:
        pages = pages.fill_null(b"")
    out: list[list] = [[None] * len(pages) for _ in parts]
    if not len(pages):
        return out
    bounds = np.frombuffer(pages.buffers()[1], np.int64)[pages.offset : pages.offset + len(pages) + 1]
    row = 0
    while row < len(pages):
        until = max(int(np.searchsorted(bounds, bounds[row] + _CUT, "right")) - 1, row + 1)
        until = min(until, len(pages))
        low, high = int(bounds[row]), int(bounds[until])
        data = pages.buffers()[2].slice(low, high - low).to_pybytes() if high > low else b""
        _take_some(_Cut(data, bounds[row : until + 1] - low), row, tags, parts, all_blanks, out)
        row = until
    return out


def _take_some(cut: _Cut, row: int, tags: Tags, parts: tuple[str, ...], all_blanks: bool, out: list[list]) -> None:
    plans = cut.plans(tags)
    by_plan: dict[int, list[int]] = {}
    for k, plan in enumerate(plans):
        by_plan.setdefault(id(plan), []).append(k)
    for members in by_plan.values():
        plan = plans[members[0]]
        if plan is None:
            for k in members:
                page = Page(cut.data[cut.bounds[k] : cut.bounds[k + 1]].decode(), tags)
                for part, values in zip(parts, out, strict=True):
                    values[row + k] = page.profile(all_blanks) if part == "profile" else getattr(page, part)()
            continue
        at = np.array(members)
        for part, values in zip(parts, out, strict=True):
            if part == "profile":
                found = _profiles_of(cut, at, plan, all_blanks)
            else:
                place = getattr(plan, part)
                if place is None:
                    continue
                found = map(_TAKEN[part], *cut.stretches(at, [place]))
            for k, value in zip(members, found, strict=True):
                values[row + k] = value


def maps(found: list[dict[str, str]]) -> pa.Array:
    """Profiles as one array of maps."""
    ends = pa.array([0, *accumulate(map(len, found))], pa.int32())
    keys, values = ([*chain.from_iterable(side)] for side in (found, map(dict.values, found)))
    kind = pa.map_(pa.string(), pa.string())
    return pa.MapArray.from_arrays(ends, pa.array(keys, pa.string()), pa.array(values, pa.string())).cast(kind)
