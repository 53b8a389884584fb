"""Main-text extraction with inferred wrappers.

Pages of one host share a template. A *wrapper* is a union-free expression for
it: a tree of elements whose children are required, optional (``?``) or
repeated (``+``), with text slots (different text on different pages) and fixed
text. It is inferred by aligning the element streams of the host's pages one
after the other: equal elements are merged, a mismatch becomes an optional
element, neighbouring equal elements become a repeated group, differing text a
slot. Merging is associative enough to be done in parts: every task folds its
pages into one wrapper per host, and the parts are merged in two rounds, the
first over 64 salts, so a host with a third of all pages is no single task.

Elements whose keys differ only in some class or id names are merged under the
names they share.

The wrapper says where the main text is, by structure alone, whatever the lengths:
in its ``article`` and ``main`` elements with text slots, but for those that yield
to others, namely elements named as teasers and, outside of any other such element,
those of which a page has several in a row. Where all yield and the template has
paragraphs with slots outside of them, or where there is no such element, it is in the
innermost element that holds all paragraphs with slots outside menus, forms and
the like. Pages are then read whole: blocks below every such element, without
elements that are not part of an article. A page without a host is read by a
wrapper of its own.

Nothing here recurses over elements, so a page may nest them to any depth, and a
page is read in one forward scan.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import ascii_lower, cut

#: Elements whose content is not markup: to their end tag, or to the end of the page.
_RAW = "script|style|iframe|textarea|title"
#: Elements whose content is never shown: to their end tag; without one, the tag alone.
_HIDDEN = "noscript|template|svg|math|object|select"
_RAW_TAGS, _HIDDEN_TAGS = frozenset(_RAW.split("|")), frozenset(_HIDDEN.split("|"))
_END_TAG = {t: re.compile(rf"</{t}\s*>", re.IGNORECASE) for t in _RAW_TAGS | _HIDDEN_TAGS}
_START = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-z][a-z0-9:-]*))", re.IGNORECASE)
_INSIDE = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
_SIMPLE = re.compile(r"[^<>]*>")
#: Characters in which a tag's quoted attributes are looked for once a page has shown
#: a tag whose quotes run off its end.
_BROKEN = 4096
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An opening tag ends the open elements on the right, if no element of
#: _SCOPE lies between.
ENDS = {t: ("p",) for t in BLOCK} | {
    "li": ("p", "li"), "dt": ("p", "dt", "dd"), "dd": ("p", "dt", "dd"), "tr": ("p", "td", "th", "tr"),
    "td": ("p", "td", "th"), "th": ("p", "td", "th"), "body": ("head",),
}
_SCOPE = frozenset("article aside body div section main table ul ol dl nav header footer blockquote form".split())
#: Elements that are no part of an article, by tag and by a whole name of class, id or role:
#: one of these words, or several joined, also with one of NEUTRAL (not 'has-sidebar').
NOT_TEXT = frozenset("nav footer aside form button menu head dialog figure-actions".split())
NOT_TEXT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices "
    "popup modal sidebar aside menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments respond "
    "reply replies discussion share sharing social related recommended newsletter subscribe signup login widget toolbar pagination".split()
)
NEUTRAL = frozenset("area areas list box block wrap wrapper container section left right top bottom site links buttons bar inner items posts primary secondary".split())
MAIN = ("article", "main")
#: Children that a wrapper's element keeps in order; the rarest beyond are merged
#: by key, and by tag if still too many, so that their text stays counted.
WIDTH = 256
#: Elements of which a template has one, or a few with varying names.
_ONE = frozenset(("html", "body", *MAIN))
#: Names of elements that only point to a text.
TEASER_WORDS = frozenset("teaser teasers card cards preview previews excerpt excerpts".split())
#: Elements that hold a paragraph's text.
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption".split())


def _attributes(raw: str) -> str:
    """Class, id and role words in order, digits as 0: the key of an element."""
    if "=" not in raw:
        return ""
    found = [(a.lower(), b or c or d) for a, b, c, d in ATTRIBUTE.findall(raw)]
    plain = [(a, re.sub(r"[0-9]+", "0", re.sub(r"[\[\]>]", "_", v)).lower().split()) for a, v in sorted(found)]
    return "".join(f"[{a}={' '.join(sorted(names))}]" for a, names in plain)


def _tags(page: str) -> Iterator[tuple[int, int, str, str | None, str]]:
    """(start, end, '/' for an end tag, tag, attributes) of all markup in page order;
    the tag is None for comments, declarations and elements that are not shown, whose
    stretch reaches to their end. One forward scan: what is known to be absent behind
    a place is not looked for again."""
    at, size, broken = 0, len(page), False
    gone: set[str] = set()  # end tags that do not come any more
    while m := _START.search(page, at):
        start, after = m.span()
        at = after
        if m[1] or m[2] or m[3]:
            mark = "-->" if m[1] else "]]>" if m[2] else ">"
            found = page.find(mark, after)
            at = size if found < 0 else found + len(mark)
            yield start, at, "", None, ""
            continue
        tag = m[5].lower()
        inside = _INSIDE.match(page, after, min(size, after + _BROKEN) if broken else size)
        if not inside:
            if not broken and page.find(">", after) < 0:
                return  # no tag ends any more: the rest is text
            broken = True
            inside = _SIMPLE.match(page, after)
        unshown = not m[4] and page[after : after + 1] in ("/", ">", " ", "\t", "\n", "\r", "\f") and tag in _END_TAG
        if unshown and not (tag in ("svg", "math") and inside and inside[0].endswith("/>")):
            gt = page.find(">", after)
            if gt < 0:
                continue
            end = None if tag in gone else _END_TAG[tag].search(page, gt + 1)
            if end:
                at = end.end()
            else:
                gone.add(tag)
                at = size if tag in _RAW_TAGS else gt + 1
            yield start, at, "", None, ""
            continue
        if inside:
            at = inside.end()
            yield start, at, m[4], None if unshown else tag, page[after : at - 1]


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """('open', tag, key), ('close', tag, '') and ('text', text, '') in page order;
    elements are balanced, text is decoded."""
    stack: list[str] = []
    held: Counter[str] = Counter()  # open elements by tag
    at = 0

    def close() -> tuple[str, str, str]:
        last = stack.pop()
        held[last] -= 1
        return "close", last, ""

    for start, end, slash, tag, raw in _tags(page):
        if start > at:
            yield "text", entities.unescape(page[at:start]), ""
        at = end
        if not tag:
            continue
        if slash:
            while held[tag]:
                last = close()
                yield last
                if last[1] == tag:
                    break
            continue
        for ended in ENDS.get(tag, ()):
            for k in range(len(stack) - 1, -1, -1) if held[ended] else ():
                if stack[k] == ended:
                    while len(stack) > k:
                        yield close()
                    break
                if stack[k] in _SCOPE:
                    break
        yield "open", tag, tag + _attributes(raw)
        if tag in VOID:
            yield "close", tag, ""
        else:
            stack.append(tag)
            held[tag] += 1
    if at < len(page):
        yield "text", entities.unescape(page[at:]), ""
    while stack:
        yield close()


# A wrapper node is [key, quantifier, pages, children, elements]; a text node is
# ["#", fixed text or None, pages, characters].
TEXT = "#"


@lru_cache(maxsize=1 << 16)
def _parts(key: str) -> tuple[str, frozenset[tuple[str, str]]]:
    """A key's tag and its (attribute, name) pairs."""
    tag = key.partition("[")[0]
    return tag, frozenset((a, n) for a, v in re.findall(r"\[(class|id|role)=([^\]]*)\]", key) for n in v.split())


@lru_cache(maxsize=1 << 16)
def _shared(a: str, b: str) -> str:
    """The key of the names that two keys of one tag share."""
    if a == b:
        return a
    both = _parts(a)[1] & _parts(b)[1]
    names = {k: " ".join(sorted(n for x, n in both if x == k)) for k in ("class", "id", "role")}
    return _parts(a)[0] + "".join(f"[{k}={v}]" for k, v in names.items() if v)


@lru_cache(maxsize=1 << 16)
def _likeness(a: str, b: str) -> int:
    """1000 for equal keys, 1 for keys that may differ in varying names only, else 0."""
    if a == b:
        return 1000
    (tag, x), (other, y) = _parts(a), _parts(b)
    return int(tag == other and (tag in _ONE or not x.isdisjoint(y)))


class _Both:
    """Two child lists, or pairs of such, still to be aligned."""

    __slots__ = ("left", "right", "one_page")

    def __init__(self, left, right, one_page: bool):
        self.left, self.right, self.one_page = left, right, one_page

    def aligned(self) -> list:
        todo, out = [(self, False)], []
        while todo:
            item, ready = todo.pop()
            if ready:
                right, left = out.pop(), out.pop()
                out.append(_align_level(left, right, item.one_page))
            elif isinstance(item, _Both):
                todo += [(item, True), (item.right, False), (item.left, False)]
            else:
                out.append(item)
        return out[0]


def _settled(children: list) -> list:
    """The children with all that is still to be aligned below them aligned."""
    todo = [children]
    while todo:
        for x in todo.pop():
            if x[0] != TEXT and isinstance(x[3], _Both):
                x[3] = x[3].aligned()
                todo.append(x[3])
    return children


def _merge_node(a: list, b: list, one_page: bool = False) -> list:
    """Two nodes as one; those of one page leave its texts, taken together, fixed."""
    pages = max(a[2], b[2]) if one_page else a[2] + b[2]
    if a[0] == TEXT:
        fixed = a[1] if a[1] == b[1] else None
        if one_page and a[1] is not None and b[1] is not None:
            fixed = f"+{zlib.crc32(f'{a[1]}{TEXT}{b[1]}'.encode('utf-8', 'replace'))}"
        return [TEXT, fixed, pages, a[3] + b[3]]
    quantifier = "+" if "+" in (a[1], b[1]) else "?" if "?" in (a[1], b[1]) else "1"
    return [_shared(a[0], b[0]), quantifier, pages, _Both(a[3], b[3], one_page), a[4] + b[4]]


def align(a: list, b: list, one_page: bool = False) -> list:
    """Merge two child lists: the pairs of their heaviest common subsequence, equal
    keys before like ones, are merged, the others become optional."""
    return _settled(_align_level(a, b, one_page))


def _align_level(a: list, b: list, one_page: bool) -> list:
    if [x[0] for x in a] == [x[0] for x in b]:
        return [_merge_node(x, y, one_page) for x, y in zip(a, b, strict=True)]
    n, m = len(a), len(b)
    like = [[_likeness(x[0], y[0]) for y in b] for x in a]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below, own = best[i], best[i + 1], like[i]
        for j in range(m - 1, -1, -1):
            row[j] = max(below[j], row[j + 1], below[j + 1] + own[j])

    def optional(x: list) -> list:
        return x if x[0] == TEXT or x[1] == "+" else [x[0], "?", *x[2:]]

    out, i, j = [], 0, 0
    while i < n and j < m:
        if like[i][j] and best[i][j] == best[i + 1][j + 1] + like[i][j]:
            out.append(_merge_node(a[i], b[j], one_page))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out.append(optional(a[i]))
            i += 1
        else:
            out.append(optional(b[j]))
            j += 1
    return fold(out + [optional(x) for x in a[i:]] + [optional(x) for x in b[j:]])


def _repeated(a: list, b: list) -> list:
    """Two children of one element as one repeated child."""
    merged = _merge_node(a, b, True)
    if a[0] != TEXT:
        merged[1] = "+"
    return merged


def fold(children: list) -> list:
    """Neighbouring equal elements as one repeated element, neighbouring texts as
    one slot, groups of two or three elements that repeat as one round of them;
    WIDTH children in order, the rest merged."""
    out: list = []
    for x in children:
        if out and out[-1][0] == x[0]:
            out[-1] = _repeated(out[-1], x)
            continue
        out.append(x)
        for size in (2, 3):
            if len(out) >= 2 * size and [y[0] for y in out[-size:]] == [y[0] for y in out[-2 * size : -size]]:
                late = out[-size:]
                del out[-size:]
                for k in range(-size, 0):
                    out[k] = _repeated(out[k], late[k])
                break
    for group in (lambda x: x[0], lambda x: _parts(x[0])[0]):
        if len(out) > WIDTH:
            often = set(sorted(range(len(out)), key=lambda k: -out[k][2])[: WIDTH // 2])
            rest: dict[str, list] = {}
            for k, x in enumerate(out):
                if k not in often:
                    rest[group(x)] = _repeated(rest[group(x)], x) if group(x) in rest else x
            out = [out[k] for k in sorted(often)] + list(rest.values())
    return out


def page_wrapper(page: str) -> list:
    """The child list of a page's root: its wrapper before any alignment."""
    stack: list[list] = [["", "1", 1, [], 1]]
    for kind, value, key in events(page):
        if kind == "open":
            stack.append([key, "1", 1, [], 1])
        elif kind == "close":
            done = stack.pop()
            done[3] = _settled(fold(done[3]))
            stack[-1][3].append(done)
        elif text := " ".join(value.split()):
            stack[-1][3].append([TEXT, text if len(text) <= 200 else f"{len(text)}:{zlib.crc32(text.encode('utf-8', 'replace'))}", 1, len(text)])
    return _settled(fold(stack[0][3]))


def dumps(children: list) -> str:
    """A wrapper as text: its nodes from the root on, each with the number of its
    children."""
    flat, todo = [], list(reversed(children))
    while todo:
        x = todo.pop()
        if x[0] == TEXT:
            flat.append(x)
        else:
            flat.append([x[0], x[1], x[2], len(x[3]), x[4]])
            todo.extend(reversed(x[3]))
    return json.dumps([len(children), flat])


def loads(text: str) -> list:
    n, flat = json.loads(text)
    root: list = []
    open_ = [(root, n)]
    for x in flat:
        while len(open_[-1][0]) == open_[-1][1]:
            open_.pop()
        open_[-1][0].append(x)
        if x[0] != TEXT:
            count, x[3] = x[3], []
            open_.append((x[3], count))
    return root


def _is_skip_name(name: str) -> bool:
    words = re.findall(r"[a-z]+", name)
    return not NOT_TEXT_WORDS.isdisjoint(words) and all(w in NOT_TEXT_WORDS or w in NEUTRAL for w in words)


@lru_cache(maxsize=1 << 16)
def skipped(key: str) -> bool:
    """Is an element with this key no part of an article?"""
    tag = key.partition("[")[0]
    if tag in NOT_TEXT:
        return True
    names = (n for a in re.findall(r"\[(?:class|id|role)=([^\]]*)\]", key) for n in a.split())
    return tag not in ("html", "body") and any(map(_is_skip_name, names))


def _site_header(key: str, outer: str) -> bool:
    """Is a header that of the page, not of something on it?"""
    return key.partition("[")[0] == "header" and outer.partition("[")[0] in ("", "html", "body")


def _named(key: str) -> bool:
    return _parts(key)[0] in MAIN or "[role=article]" in key or "[role=main]" in key


@lru_cache(maxsize=1 << 16)
def _teaser(key: str) -> bool:
    return any(not TEASER_WORDS.isdisjoint(re.findall(r"[a-z]+", n)) for _, n in _parts(key)[1])


class _Shown:
    """An element of a wrapper outside all that is skipped."""

    def __init__(self, node: list, outer: "_Shown | None"):
        self.node, self.outer = node, outer
        self.key: str = node[0]
        self.named = _named(self.key)
        #: The next named element around it.
        self.within = None if outer is None else outer if outer.named else outer.within
        self.repeated = node[1] == "+" or bool(outer and not outer.named and outer.repeated)
        self.paragraph = _parts(self.key)[0] in PARAGRAPH or bool(outer and outer.paragraph)
        self.slots = self.free = self.strict = 0  # below it: all; outside named elements; of these in paragraphs

    def path(self) -> str:
        keys, x = [], self
        while x is not None:
            keys.append(x.key)
            x = x.outer
        return ">".join(reversed(keys))


def _shown(wrapper: list) -> list[_Shown]:
    """The shown elements in page order, with the text slots below each: text that
    differs between pages, or that only one of many pages has; of a single page all."""
    pages = max((x[2] for x in wrapper), default=0)
    out: list[_Shown] = []
    todo = [(x, None) for x in reversed(wrapper)]
    while todo:
        x, outer = todo.pop()
        if x[0] == TEXT:
            if outer is not None and x[3] and (pages < 2 or x[1] is None or x[2] < 2):
                outer.slots += 1
        elif not skipped(x[0]) and not _site_header(x[0], outer.key if outer else ""):
            out.append(_Shown(x, outer))
            todo += [(y, out[-1]) for y in reversed(x[3])]
    for x in out:
        x.free = 0 if x.named or x.within else x.slots
        x.strict = x.free if x.paragraph else 0
    for x in reversed(out):
        if x.outer is not None:
            x.outer.slots += x.slots
            x.outer.free += x.free
            x.outer.strict += x.strict
    return out


def main_path(wrapper: list) -> str:
    """Where the main text is: the keys from the root to an element joined by '>',
    a line for each place; a place after '-' is known to hold none. Empty if the
    wrapper has no text slot."""
    shown = _shown(wrapper)
    found = [x for x in shown if x.named and x.slots]
    outermost = [x for x in shown if x.outer is None]

    def strong() -> set[int]:
        """Those that do not yield: an element whose slots all lie in yielding ones
        inside it says no more than those."""
        own = {id(x): x.slots for x in found}
        out: set[int] = set()
        for x in reversed(found):  # the inner ones first
            weak = _teaser(x.key) or (x.repeated and x.within is None)
            if not weak and own[id(x)] > 0:
                out.add(id(x))
            elif x.within is not None and id(x.within) in own and (_teaser(x.key) or x.repeated):
                own[id(x.within)] -= x.slots
        return out

    best = strong()
    if best:
        # Inside a strong element only teasers yield.
        keep = [x for x in found if id(x) in best or (x.within is not None and id(x.within) in best and not _teaser(x.key))]
    elif found and not any(x.strict for x in outermost):
        keep = found
    else:
        keep = []
    if keep:
        yes = {id(x) for x in keep}
        return "\n".join(dict.fromkeys("-" * (id(x) not in yes) + x.path() for x in found))
    # The innermost element with all paragraphs, or else all slots, outside of those.
    count = (lambda x: x.strict) if any(x.strict for x in outermost) else (lambda x: x.free)
    whole = sum(map(count, outermost))
    place = None
    for x in shown:
        if whole and count(x) == whole and x.outer is place and not (place and _parts(x.key)[0] in PARAGRAPH):
            place = x
    return place.path() if place else ""


@lru_cache(maxsize=4096)
def _places(path: str) -> tuple[tuple[tuple, bool], ...]:
    """(tag and names of each element from the root, is it main text) of each place."""
    lines = path.split("\n") if path else ()
    return tuple((tuple(map(_parts, x.removeprefix("-").split(">"))), not x.startswith("-")) for x in lines)


def _place(keys: list[str], places: tuple) -> bool | None:
    """Is an element with these keys from the root main text, by the place that
    names it best? None where no place is its."""
    fits = [
        (sum(len(names) for _, names in place), yes)
        for place, yes in places
        if len(place) == len(keys)
        and all(tag == t and names <= n for (tag, names), (t, n) in zip(reversed(place), map(_parts, reversed(keys)), strict=True))
    ]
    return max(fits)[1] if fits else None


class _Element:
    """An element that may hold a page's main text."""

    def __init__(self, at: int, key: str, place: bool | None, outer: "_Element | None", parent: int):
        self.at, self.end, self.key, self.place, self.outer, self.parent = at, -1, key, place, outer, parent
        self.text = self.own = False  # does it hold text; also outside the others inside it


def _elements(seen: list, path: str, by_name: bool) -> list[_Element]:
    """The elements of a page that are named as main text or stand at a place of
    ``path``. Without ``by_name`` only tags say what is skipped."""
    places, keys, out = _places(path), [], []
    depths = {(len(p), p[-1][0]) for p, _ in places}
    open_: list[tuple[int, _Element]] = []
    starts: list[int] = []
    dropped = -1
    for at, (kind, value, key) in enumerate(seen):
        if kind == "text":
            if open_ and dropped < 0 and value.strip():
                open_[-1][1].own = True
        elif kind == "open":
            keys.append(key)
            starts.append(at)
            if dropped < 0 and (_skips(key, by_name) or _site_header(key, keys[-2] if len(keys) > 1 else "")):
                dropped = len(keys)
            if dropped < 0:
                place = _place(keys, places) if (len(keys), value) in depths else None
                if place is not None or _named(key):
                    out.append(_Element(at, key, place, open_[-1][1] if open_ else None, starts[-2] if len(starts) > 1 else -1))
                    open_.append((len(keys), out[-1]))
        else:
            if open_ and open_[-1][0] == len(keys):
                open_.pop()[1].end = at
            if len(keys) == dropped:
                dropped = -1
            keys.pop()
            starts.pop()
    for x in reversed(out):
        x.text = x.text or x.own
        if x.outer is not None:
            x.outer.text = x.outer.text or x.text
    return out


def _skips(key: str, by_name: bool) -> bool:
    return skipped(key) if by_name else key.partition("[")[0] in NOT_TEXT


def _chosen(found: list[_Element]) -> tuple[set[int], set[int]]:
    """Event numbers of the elements to read and of those to leave out inside them:
    read are those at the wrapper's places, and others unless they yield (teasers,
    several of one key in a row); of nested ones the outer one, if it holds text that
    the inner ones do not."""
    alike = Counter((x.parent, x.key) for x in found)

    def yields(x: _Element) -> bool:
        return x.place is None and (_teaser(x.key) or (x.outer is None and alike[x.parent, x.key] > 1))

    own = [x for x in found if x.place or (x.place is None and not yields(x))]
    if not any(x.text for x in own):
        own = found
    mine = set(map(id, own))
    out = {x.at for x in found if id(x) not in mine}
    # Text of its own, or of elements inside it that are not read by themselves.
    holds = {id(x): x.own for x in found}
    picked: list[_Element] = []
    for x in own:
        if picked and x.at < picked[-1].end:
            continue
        if not any(y.at > x.at and y.end <= x.end and y.text for y in own) or holds[id(x)]:
            picked.append(x)
    return {x.at for x in picked}, out


def main_text(page: str, path: str) -> str:
    """Blocks of the main text of one page, joined by two line ends: of every
    element at the places of ``path``, else of the articles or main elements, else of
    the whole body."""
    seen = list(events(page))

    def inside(chosen: set[int], left_out: set[int] = frozenset(), by_name: bool = True) -> str:
        keys: list[str] = [""]
        depth = 0
        blocks: list[str] = []
        now: list[str] = []
        start, dropped = -1, -1  # depths at which main text and a skipped element began

        def end_block() -> None:
            if text := " ".join("".join(now).split()):
                blocks.append(text)
            now.clear()

        for at, (kind, value, key) in enumerate(seen):
            if kind == "text":
                if start >= 0 and dropped < 0:
                    now.append(value)
                continue
            if value in BLOCK:
                end_block()
            elif value == "br":
                now.append(" ")
            if kind == "open":
                depth += 1
                if dropped < 0 and (at in left_out or _skips(key, by_name) or _site_header(key, keys[-1])):
                    dropped = depth
                keys.append(key)
                if start < 0 and dropped < 0 and at in chosen:
                    start = depth
            else:
                if depth == start:
                    end_block()
                    start = -1
                if depth == dropped:
                    dropped = -1
                depth -= 1
                keys.pop()
        end_block()
        return "\n\n".join(blocks)

    if found := _elements(seen, path, True):
        return inside(*_chosen(found))
    body = next((at for at, (kind, value, _) in enumerate(seen) if kind == "open" and value == "body"), None)
    if body is not None:
        # Where names leave nothing, an article inside an element of such a name is the text.
        found = _elements(seen, path, False)
        return inside({body}) or (inside(*_chosen(found), False) if found else "")
    # No body: everything that is shown.
    return main_text("<body>" + page, "")


def _fold_hosts(batches: Iterator[pd.DataFrame], wrapper_of, most: int = 1000) -> Iterator[pd.DataFrame]:
    """One wrapper per host over all batches; handed on when ``most`` hosts are open."""
    known: dict[str, list] = {}

    def out() -> pd.DataFrame:
        return pd.DataFrame({"host": list(known), "wrapper": [dumps(w) for w in known.values()]}, dtype="object")

    for batch in batches:
        for host, value in zip(batch.iloc[:, 0], batch.iloc[:, 1], strict=True):
            new = wrapper_of(value)
            known[host] = align(known[host], new) if host in known else new
            if len(known) >= most:
                yield out()
                known.clear()
    yield out()


def hosts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, host, html) of the pages; null html is empty, a null url or
    one without ``://`` has the empty host."""
    at = F.instr(F.col(url_col), "://")
    rest = F.coalesce(F.when(at > 0, F.substr(F.col(url_col), at + 3)), F.lit(""))
    return pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)).alias("host"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )


def infer_wrappers(rows: DataFrame, salts: int = 64) -> DataFrame:
    """(host, path): where each host's pages hold their main text, inferred from
    all pages of ``rows`` (see ``hosts``); pages without a host share nothing."""
    kind = "host string, wrapper string"
    parts = rows.where("html <> '' and host <> ''").select("host", "html").mapInPandas(lambda b: _fold_hosts(b, page_wrapper), kind)

    def merged(df: pd.DataFrame) -> pd.DataFrame:
        return pd.concat(_fold_hosts(iter([df[["host", "wrapper"]]]), loads))

    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(salts)))
    once = salted.groupBy("host", "salt").applyInPandas(merged, kind)

    def placed(df: pd.DataFrame) -> pd.DataFrame:
        whole = merged(df)
        return pd.DataFrame({"host": whole["host"], "path": [main_path(loads(w)) for w in whole["wrapper"]]})

    return cut(once.groupBy("host").applyInPandas(placed, "host string, path string"), "wrappers")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text (empty if none), n_chars.

    Null and empty html give an empty text. Rows that repeat stay; other columns
    are passed over. The join with the paths of the hosts is left to the planner.
    """
    rows = hosts(pages, id_col, url_col, html_col)
    placed = infer_wrappers(rows)

    def run(page: pd.Series, host: pd.Series, path: pd.Series) -> pd.Series:
        def one(html: str, host: str, path: str | None) -> str:
            return main_text(html, (path or "") if host else main_path(page_wrapper(html)))

        return pd.Series([one(*x) for x in zip(page, host, path, strict=True)], dtype="object")

    text = F.pandas_udf(run, "string")
    read = rows.join(placed, "host", "left").select("page_id", "url", text(F.col("html"), F.col("host"), F.col("path")).alias("text"))
    return read.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
