"""Main text of web pages by wrappers: union-free regular expressions over page tokens.

Pages of one host come from a few templates. A page's tokens are its tags and texts. Runs of
equal groups are folded into repeated groups, and the distinct folded shapes of all pages are
aligned: tokens that only one side has become an optional group, single groups meet repeated
ones. A wrapper is a regular expression without unions that accepts the shapes it was made
of; shapes that look different, or that no wrapper accepts, get further wrappers, until every
page of the host is accepted.

Each page is then read by its wrapper: every text is captured by a place of the expression.
A text that a place has on all pages that reach it is a constant, all others fill a slot; the
count is over all pages, and pages whose longest main texts are equal count as one. The main
text is what the slots and repeated groups of the region capture: of the article where the
wrapper has one, else of its main element, else of the element with most slot text. Slots that
are marked as menus, headers, footers, side columns, notices, adverts, forms or reader
comments are left out. A constant inside the article or main element is dropped only if it
stands in a div of its own; constants in paragraphs, headings, lists and tables always stay.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.frames import saved, table, unused, with_columns

#: Shapes of a host that one task aligns, about; rounds and tasks grow until all are accepted.
SHAPES = 400
#: Share of common symbols from which two shapes are taken for one template.
ALIKE = 0.5
#: Elements of a shape from which long runs of siblings are written as one group, and so many siblings
#: are a long run; elements of a wrapper from which the same is done with all that it is made of.
LONG_SHAPE, LONG_RUN, LONG_WRAPPER = 200, 24, 600
#: Elements aligned with each other in one go.
ALIGNED = 400
#: Hosts whose wrappers are broadcast at once; more of them are joined by a shuffle.
BROADCAST_ROWS = 20_000
#: Places and text counted in a task before they are passed on.
HELD_PLACES = 20_000
#: Longest group of tokens that is tried as the body of a repeated group.
LONGEST_GROUP = 24
#: Different pages that must agree before an equal text counts as the template's own.
TEMPLATE_PAGES = 4

# Fixed values of HTML: elements without an end, with raw contents, and inside a line.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|iframe|noembed|noframes|xmp"
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
             "span strike strong sub sup time tt u var wbr".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
NOT_MAIN = set("nav header footer aside form script style noscript template button select option dialog menu svg math object canvas "
               "audio video head fieldset".split())
MARKED = set("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promotion promoted menu nav "
             "navbar navigation breadcrumb breadcrumbs header masthead topbar footer sidebar aside widget widgets related recommended "
             "share sharing social cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay "
             "newsletter subscribe subscription signup login search form copyright pagination pager toolbar complementary contentinfo "
             "dialog".split())
#: Whole class names that tell adverts, notices, sidebars and comments inside the article too.
STRICT = set("ad ads advert adverts advertisement sponsored notice cookie-notice sidebar comment comments reader-comments".split())
COMMENTS = set("comment comments reply replies respond response responses disqus discussion".split())
WHOLE = {"html", "body", "main", "article"}
#: Elements whose texts are content even where they recur.
_CONTENT = re.compile(r"/(?:p|h[1-6]|li|blockquote|td|th|dt|dd|caption|figcaption|pre)(?:/|$)")

_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)"
                    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S | re.I)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_DIGITS = re.compile(r"\d+")
_WHITE = re.compile(r"\s+")


def tokens_of(page: str) -> list[tuple[str, str, str]]:
    """(kind, name, detail): open tags with their marks, close tags, and decoded texts."""
    out, at = [], 0
    for found in _TOKEN.finditer(page):
        if found.start() > at:
            out.append(("text", "#", html.unescape(page[at:found.start()])))
        at = found.end()
        if name := found[3]:
            if found[2]:
                out.append(("close", name.lower(), ""))
            else:
                marks = " ".join(a or b or c for _, a, b, c in _ATTRIBUTE.findall(found[4])) if "=" in found[4] else ""
                out.append(("open", name.lower(), marks))
    if at < len(page):
        out.append(("text", "#", html.unescape(page[at:])))
    return out


def standing(name: str, marks: str, inside: bool) -> str:
    """What an element's kind and marks say of it: "kind" (no main text), "word" (probably none) or "".

    Inside the article only the kind and whole class names decide; a word in a name says there that
    an equal text on all pages is the template's.
    """
    if name in NOT_MAIN:
        return "kind"
    words = {w.lower() for w in _WORD.findall(marks)} if marks else set()
    if name in WHOLE:
        return "kind" if name == "article" and words & COMMENTS else ""
    if inside and not STRICT.isdisjoint(marks.lower().split()):
        return "kind"
    return "word" if words & (MARKED | COMMENTS) else ""


def symbol(kind: str, name: str, detail: str) -> str:
    """The symbol of a tag; numbers in its marks are those of the page, not of the template."""
    if kind == "close":
        return f"</{name}>"
    return f"<{name} {_DIGITS.sub('0', detail)}>" if detail else f"<{name}>"


def symbols_of(page: str) -> list[str]:
    """The symbols of a page alone."""
    return [symbol(*t) if t[0] != "text" else "#" for t in tokens_of(page) if t[0] != "text" or (t[2] and not t[2].isspace())]


class Page:
    """A page read once: its symbols, and its texts with their path, block, standing and symbol."""

    def __init__(self, page: str):
        self.symbols: list[str] = []
        texts: list[tuple[str, str, int, bool, int, tuple[int, ...]]] = []
        # Name, out by kind, path, and the elements around it that a word marks.
        stack: list[tuple[str, bool, str, tuple[int, ...]]] = [("", False, "", ())]
        block = marked = 0
        for kind, name, detail in tokens_of(page):
            _, out, path, marks = stack[-1]
            if kind == "text":
                at = -1
                if detail and not detail.isspace():
                    at = len(self.symbols)
                    self.symbols.append("#")
                texts.append((detail, path, block, out, at, marks))
                continue
            if name not in INLINE:
                block += 1
            self.symbols.append(symbol(kind, name, detail))
            if kind == "open":
                if name == "br":
                    texts.append((" ", path, block, out, -1, marks))
                if name in VOID:
                    continue
                while stack[-1][0] in CLOSED_BY.get(name, ()):
                    stack.pop()
                if name not in INLINE and any(s[0] == "p" for s in stack[-4:]):
                    self._pop(stack, "p")
                _, out, path, marks = stack[-1]
                inside = _inside(path)
                says = standing(name, detail, inside)
                if says == "word" and not inside:
                    marked += 1
                    marks = (*marks, marked)
                # Inside the article a marked element shows in the path.
                path = f"{path}/{name}~" if says == "word" and inside else f"{path}/{name}"
                stack.append((name, out or says == "kind", path, marks))
            elif any(s[0] == name for s in stack[1:]):
                self._pop(stack, name)
        # What holds most of a page's text is not beside the main text, whatever its name says.
        mass: Counter = Counter()
        for text, _, _, out, _, marks in texts:
            if not out:
                for mark in ("all", *marks):
                    mass[mark] += len(text.strip())
        beside = {m for m in range(1, marked + 1) if 2 * mass[m] <= mass["all"]}
        self.texts = [(text, path, block, out or not beside.isdisjoint(marks), at) for text, path, block, out, at, marks in texts]

    @staticmethod
    def _pop(stack: list, name: str) -> None:
        while stack[-1][0] != name:
            if len(stack) == 1:
                return
            stack.pop()
        stack.pop()

    def region(self) -> str | None:
        """The element of the main text, of this page alone."""
        return region_of([(path, len(text.strip())) for text, path, _, out, _ in self.texts if not out])

    def longest(self) -> str:
        """The longest text of the page's region, by which pages with the same main text are told."""
        region = self.region()
        return max((text.strip() for text, path, _, out, _ in self.texts if not out and within(path, region)), key=lambda t: (len(t), t), default="")

    def main_text(self, region: str | None, places: list[int] | None, constants: set[tuple[int, object]], key=lambda text: text) -> str:
        """The texts that places other than constants capture inside the region, a line a block."""
        blocks: dict[int, list[str]] = {}
        for text, path, block, out, at in self.texts:
            if not out and within(path, region) and (at < 0 or not constants or places is None or (places[at], key(text.strip())) not in constants):
                blocks.setdefault(block, []).append(text)
        lines = (_WHITE.sub(" ", "".join(parts)).strip() for parts in blocks.values())
        return "\n".join(line for line in lines if line)


def within(path: str, region: str | None) -> bool:
    return region is None or (region in path.split("/") if "/" not in region else path == region or path.startswith(region + "/"))


def region_of(texts: list[tuple[str, int]]) -> str | None:
    """Of (path, length): article, main, or the deepest element with most of the text."""
    mass: Counter = Counter()
    for path, size in texts:
        end = len(path)
        while end > 0:
            mass[path[:end]] += size
            end = path.rfind("/", 0, end)
    for name in ("article", "main"):
        if any(size and name in path.split("/") for path, size in mass.items()):
            return name
    inside = {p: n for p, n in mass.items() if p.rsplit("/", 1)[-1] not in INLINE | {"p", "li", "h1", "h2", "h3", "h4", "td", "tr", "ul", "ol"}}
    most = max(inside.values(), default=0)
    return max((p for p, n in inside.items() if n >= 0.6 * most), key=lambda p: (p.count("/"), p), default=None)


def _inside(path: str) -> bool:
    """Whether an element at this path is in an article or main element."""
    return "/article" in path and "article" in path.split("/") or "/main" in path and "main" in path.split("/")


def droppable(path: str) -> bool:
    """Whether a constant at this path may be the template's own: inside the article only under a marked element."""
    return "~" in path if _inside(path) else not _CONTENT.search(path)


def fold(symbols: list) -> list:
    """Runs of equal groups become ("+", body); groups of groups are folded in turn."""
    for _ in range(3):
        out, i, changed = [], 0, False
        while i < len(symbols):
            for size in range(1, min(LONGEST_GROUP, (len(symbols) - i) // 2) + 1):
                if symbols[i] == symbols[i + size] and symbols[i:i + size] == symbols[i + size:i + 2 * size] and (size > 1 or symbols[i][0] == "+"):
                    body, end = symbols[i:i + size], i + 2 * size
                    while symbols[end:end + size] == body:
                        end += size
                    out.append(body[0] if size == 1 else ("+", tuple(body)))
                    i, changed = end, True
                    break
            else:
                out.append(symbols[i])
                i += 1
        symbols = out
        if not changed:
            break
    return symbols


def met(symbols: list, groups: set) -> list:
    """Single groups that the other side repeats become the repeated group."""
    for group in sorted(groups, key=lambda g: -len(g[1])):
        body, out, i = list(group[1]), [], 0
        while i < len(symbols):
            if symbols[i] == body[0] and symbols[i:i + len(body)] == body:
                if not out or out[-1] != group:
                    out.append(group)
                i += len(body)
            elif symbols[i] == group and out and out[-1] == group:
                i += 1
            else:
                out.append(symbols[i])
                i += 1
        symbols = out
    return symbols


def shape_of(symbols: list[str]) -> list:
    """The folded symbols of a page; of a long page long runs of siblings are one group."""
    folded = fold(symbols)
    return folded if len(folded) <= LONG_SHAPE else loosened(folded)


def loosened(elements: list, run: int = LONG_RUN) -> list:
    """Runs of more than ``run`` siblings become ("*", members): a repeated group whose members are
    all optional, so that it accepts the different members in any number and order."""
    frames: list[tuple[str | None, list]] = [(None, [])]

    def name(element: str) -> str:
        return element.strip("</>").split(" ", 1)[0]

    def up() -> None:  # an element without an end: its children are its siblings
        opened, children = frames.pop()
        frames[-1][1].extend([(opened,), *children])

    for element in elements:
        if isinstance(element, str) and element.startswith("</"):
            if any(f[0] is not None and name(f[0]) == name(element) for f in frames):
                while name(frames[-1][0]) != name(element):
                    up()
                opened, children = frames.pop()
                frames[-1][1].append((opened, *_written(children, run), element))
            else:
                frames[-1][1].append((element,))
        elif isinstance(element, str) and element.startswith("<") and name(element) not in VOID:
            frames.append((element, []))
        else:
            frames[-1][1].append((element,))
    while len(frames) > 1:
        up()
    return list(_written(frames[0][1], run))


def _written(children: list[tuple], run: int) -> tuple:
    if len(children) <= run:
        return tuple(e for child in children for e in child)
    members: set[tuple] = set()
    for child in children:
        members |= set(child[0][1]) if child[0][0] == "*" else {child}
    return (("*", tuple(sorted(members, key=str))),)


class Wrapper:
    """``elements`` are (symbol or repeated group, 0 or the number of its optional group)."""

    def __init__(self, elements: list[tuple]):
        self.elements = elements

    def aligned(self, symbols: list[str]) -> Wrapper:
        """The wrapper that also accepts a page with these symbols."""
        page = fold(symbols)
        groups = {e for e, _ in self.elements if e[0] == "+"} | {e for e in page if e[0] == "+"}
        page = met(page, groups)
        own: list[tuple] = []
        for element, group in self.elements:
            own.append((element, group))
        flat = met([e for e, _ in own], groups)
        if flat != [e for e, _ in own]:
            kinds = dict(own)
            own = [(e, kinds.get(e, 0)) for e in flat]
        fresh = max((g for _, g in own), default=0)
        out: list[tuple] = []
        for low in range(0, max(len(own), len(page)), ALIGNED):
            mine, other = own[low:low + ALIGNED], page[low:low + ALIGNED]
            for kind, a, b, c, d in SequenceMatcher(None, [_face(e) for e, _ in mine], list(map(_face, other)), autojunk=False).get_opcodes():
                if kind == "equal":
                    out += [(_joined(e, x), g) for (e, g), x in zip(mine[a:b], other[c:d], strict=True)]
                    continue
                for part in (mine[a:b], [(e, 0) for e in other[c:d]]):
                    fresh += 1
                    out += [(e, g or fresh) for e, g in part]
        return Wrapper(out)

    def loosened(self) -> Wrapper:
        """A shorter wrapper that accepts all that this one accepts, if its long runs are of siblings."""
        return Wrapper([(e, 0) for e in loosened([e for e, _ in self.elements], 2)])

    def pattern(self, codes: dict[str, str]) -> str:
        """The regular expression over one character a symbol."""

        def one(element) -> str:
            if element[0] == "+":
                return "(?:" + "".join(map(one, element[1])) + ")++"
            if element[0] == "*":
                return "(?:" + "".join("(?:" + "".join(map(one, m)) + ")?" for m in element[1]) + ")*"
            return re.escape(codes.setdefault(element, chr(0xE000 + len(codes))))

        out, open_ = "", 0
        for element, group in [*self.elements, ("", 0)]:
            if group != open_:
                out += ")?" if open_ else ""
                out += "(?:" if group else ""
                open_ = group
            out += one(element) if element else ""
        return out


def _face(element):
    """What an element shows in an alignment: groups of optional members are alike."""
    return "*" if element[0] == "*" else element


def _joined(mine, other):
    """A group with the optional members of both."""
    return ("*", tuple(sorted({*mine[1], *other[1]}, key=str))) if mine[0] == "*" else mine


class Places:
    """A wrapper as an automaton whose states are its symbols' places (Glushkov's)."""

    def __init__(self, elements: list[tuple]):
        self.symbols: list[str] = []
        self.follow: list[list[int]] = []
        parts, i = [], 0
        while i < len(elements):
            j = i + 1
            while elements[i][1] and j < len(elements) and elements[j][1] == elements[i][1]:
                j += 1
            first, last, empty = self._sequence([self._one(e) for e, _ in elements[i:j]])
            parts.append((first, last, empty or elements[i][1] != 0))
            i = j
        first, last, self.empty = self._sequence(parts)
        self.last = set(last)
        self.next = [self._by_symbol(f) for f in [*self.follow, first]]

    def _by_symbol(self, places: list[int]) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {}
        for p in dict.fromkeys(places):
            out.setdefault(self.symbols[p], []).append(p)
        return out

    def _one(self, element) -> tuple[list[int], list[int], bool]:
        if element[0] == "+":
            first, last, empty = self._sequence([self._one(e) for e in element[1]])
            for p in last:
                self.follow[p] += first
            return first, last, empty
        if element[0] == "*":
            parts = [self._sequence([self._one(e) for e in member]) for member in element[1]]
            first, last = [p for f, _, _ in parts for p in f], [p for _, l, _ in parts for p in l]
            for p in last:
                self.follow[p] += first
            return first, last, True
        self.symbols.append(element)
        self.follow.append([])
        return [len(self.symbols) - 1], [len(self.symbols) - 1], False

    def _sequence(self, parts: list) -> tuple[list[int], list[int], bool]:
        first, last, empty = [], [], True
        for f, l, e in parts:
            for p in last:
                self.follow[p] += f
            first = first + f if empty else first
            last = l + last if e else l
            empty = empty and e
        return first, last, empty

    def read(self, symbols: list[str]) -> list[int] | None:
        """The place that takes each symbol, or None if the wrapper does not accept them."""
        if not symbols:
            return [] if self.empty else None
        steps: list[dict[int, int]] = []
        now: dict[int, int] = {-1: -1}
        for s in symbols:
            then: dict[int, int] = {}
            for p in now:
                for q in self.next[p].get(s, ()):
                    then.setdefault(q, p)
            if not then:
                return None
            steps.append(then)
            now = then
        at = next((p for p in now if p in self.last), None)
        if at is None:
            return None
        out = []
        for step in reversed(steps):
            out.append(at)
            at = step[at]
        return out[::-1]


class Tally:
    """What each place of a wrapper captures: path, slot text, constants, and different main texts.

    Two tallies of the same place are one by adding lengths, intersecting the texts found on
    all pages, and uniting the main texts (only whether there are ``TEMPLATE_PAGES`` matters).
    """

    def __init__(self, key=lambda text: text):
        self.key, self.places = key, {}

    def add(self, wrapper: int, page: Page, places: list[int]) -> None:
        main, found = self.key(page.longest()), {}
        for text, path, _, out, at in page.texts:
            if at >= 0:
                text = text.strip()
                held = found.setdefault(places[at], [path, 0, set()])
                held[1] += 0 if out else len(text)
                held[2].add(self.key(text))
        for place, (path, size, texts) in found.items():
            held = self.places.setdefault((wrapper, place), [path, 0, texts, set()])
            held[0] = max(held[0], path)
            held[1] += size
            held[2] = held[2] & texts
            if len(held[3]) < TEMPLATE_PAGES:
                held[3].add(main)


def settled(tallied: list[tuple]) -> tuple[str | None, set[tuple[int, object]]]:
    """Region and constants of a wrapper from its places (place, path, size, texts, number of main texts)."""
    constants = {(place, text) for place, path, _, texts, n in tallied if n >= TEMPLATE_PAGES and droppable(path) for text in texts}
    fixed = {place for place, _ in constants}
    slots = [(path, size) for place, path, size, _, _ in tallied if place not in fixed]
    return region_of(slots), constants


def spelled(shape: list) -> list[str]:
    """Symbols of a page with this folded shape: every repeated group three times."""
    return [s for e in shape for s in (spelled(e[1]) * 3 if e[0] == "+" else [s for m in e[1] for s in spelled(m)] * 2 if e[0] == "*" else [e])]


def tuples(element):
    if isinstance(element, str):
        return element
    return (element[0], tuple(map(tuples, element[1])) if element[0] == "+" else tuple(tuple(map(tuples, m)) for m in element[1]))


def wrapped(shapes: list[list]) -> list[list[tuple]]:
    """Elements of wrappers that accept all of these folded shapes: one for those that look alike."""
    out, left = [], [(shape, set(spelled(shape)), spelled(shape)) for shape in shapes]
    while left:
        first, look, _ = left[0]
        made = Wrapper([(e, 0) for e in first])
        places = Places(made.elements)
        for shape, symbols, page in left[1:]:
            if len(look & symbols) < ALIKE * len(look | symbols) or places.read(page) is not None:
                continue
            wider = made.aligned(shape)
            if len(wider.elements) > LONG_WRAPPER:
                wider = wider.loosened()
            if (then := Places(wider.elements)).read(page) is not None:
                made, places = wider, then
        rejected = [x for x in left[1:] if places.read(x[2]) is None]
        if places.read(left[0][2]) is None:  # a repeated group met otherwise: the shape alone
            out.append([(e, 0) for e in first])
        out.append(made.elements)
        left = rejected
    return out


def infer(pages: list[str]) -> dict:
    """One wrapper of these pages, with its region and the template's own texts."""
    read = [Page(p) for p in dict.fromkeys(pages)]
    wrapper = Wrapper([(e, 0) for e in shape_of(read[0].symbols)])
    for page in read[1:]:
        wrapper = wrapper.aligned(shape_of(page.symbols))
    codes: dict[str, str] = {}
    pattern = wrapper.pattern(codes)
    reader, tally = Places(wrapper.elements), Tally()
    for page in read:
        if (places := reader.read(page.symbols)) is not None:
            tally.add(0, page, places)
    paths = {place: held[0] for (_, place), held in tally.places.items()}
    region, constants = settled([(place, path, size, texts, len(mains)) for (_, place), (path, size, texts, mains) in tally.places.items()])
    return {"pattern": pattern, "codes": codes, "template": sorted((paths[p], t) for p, t in constants), "region": region}


def text_key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


class Extractor:
    """A host's wrappers, ready to be applied, with what is settled about each: region and constants."""

    def __init__(self, wrappers: list[str], known: str | None = None):
        self.places = [Places([(tuples(e), g) for e, g in json.loads(w)]) for w in wrappers]
        self.settled = {w: (region, set(map(tuple, constants))) for w, region, constants in json.loads(known or "[]")}
        self.known: dict[tuple, tuple] = {}

    def read(self, page: Page) -> tuple[int, list[int] | None]:
        """The first wrapper that accepts the page, and the places that take its symbols."""
        known = tuple(page.symbols)
        if known not in self.known:
            if len(self.known) > 50:
                self.known.clear()
            found = ((w, places) for w, reader in enumerate(self.places) if (places := reader.read(page.symbols)) is not None)
            self.known[known] = next(found, (-1, None))
        return self.known[known]

    def extract(self, text: str) -> tuple[str, bool]:
        """The main text, and whether a wrapper accepts the page; else the page's own region counts."""
        page = Page(text)
        wrapper, places = self.read(page)
        region, constants = self.settled.get(wrapper, (None, set()))
        if places is None or not any(within(path, region) for _, path, _, out, _ in page.texts if not out):
            region = page.region()  # optional in the wrapper, or no wrapper
        return page.main_text(region, places, constants, text_key), places is not None


def _extractors():
    """Extractors by their wrappers, the newest few hundred of them kept."""
    made: dict[str, Extractor] = {}

    def get(wrappers: list[str] | None, host: str | None, known: str | None = None) -> Extractor:
        key = host or ""
        if key not in made:
            if len(made) > 500:
                made.clear()
            made[key] = Extractor(wrappers or [], known)
        return made[key]

    return get


def shapes_of(pages: DataFrame) -> DataFrame:
    """The distinct (host, shape) of pages (host, html), with the number of pages."""

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        folded: dict[tuple, str] = {}

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([h for h, _ in found], pa.string()), pa.array([s for _, s in found], pa.string()),
                                               pa.array(list(found.values()), pa.int64())], ["host", "shape", "n"])

        size = 0
        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                symbols = tuple(symbols_of(page))
                if symbols not in folded:
                    if len(folded) > 1000:
                        folded.clear()
                    folded[symbols] = json.dumps(shape_of(list(symbols)))
                key = (host, folded[symbols])
                size += 0 if key in found else len(key[1])
                found[key] += 1
                if size > 16 << 20:
                    yield rows()
                    found, size = Counter(), 0
        yield rows()

    return pages.mapInArrow(shapes, "host string, shape string, n long").groupBy("host", "shape").agg(F.sum("n").alias("n"))


def wrappers_of(pages: DataFrame) -> DataFrame:
    """(host, wrappers) for the hosts of pages (host, html): one of the wrappers accepts each page."""
    left, made, hold = saved(shapes_of(pages), "shapes"), None, 1
    while not left.isEmpty():
        # Of a host with many shapes some are taken at first; what their wrappers accept needs no others.
        sizes = left.groupBy("host").agg(F.ceil(F.count("*") / (SHAPES * hold)).alias("shares"), F.ceil(F.count("*") / SHAPES).alias("groups"))
        dealt = left.join(sizes, "host").withColumn("dealt", F.xxhash64("shape", F.lit(hold)))
        dealt = dealt.withColumn("taken", F.pmod("dealt", "shares") == 0)
        group = F.pmod(F.xxhash64("dealt"), F.least("groups", F.lit(hold))).alias("group")

        def make(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["n", "shape"], ascending=[False, True])
            found = wrapped([[tuples(e) for e in json.loads(s)] for s in rows["shape"]])
            return pd.DataFrame({"host": [rows["host"].iloc[0]] * len(found), "wrapper": [json.dumps(w) for w in found]})

        new = saved(dealt.where("taken").select("host", "shape", "n", group).groupBy("host", "group").applyInPandas(make, "host string, wrapper string")
                    .distinct(), "wrappers")
        made = new if made is None else made.unionByName(new)
        rest = dealt.where("NOT taken").select("host", "shape", "n")
        lists = new.groupBy("host").agg(F.sort_array(F.collect_list("wrapper")).alias("wrappers"))

        def rejected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            get = _extractors()
            for batch in batches:
                keep = []
                for host, shape, wrappers in zip(*(batch.column(c).to_pylist() for c in ("host", "shape", "wrappers")), strict=True):
                    symbols = spelled([tuples(e) for e in json.loads(shape)])
                    keep.append(all(p.read(symbols) is None for p in get(wrappers, host).places))
                yield batch.filter(pa.array(keep, pa.bool_())).select(["host", "shape", "n"])

        left = saved(rest.join(lists, "host", "left").mapInArrow(rejected, "host string, shape string, n long"), "shapes")
        hold *= 8
    if made is None:
        return pages.sparkSession.createDataFrame([], "host string, wrappers array<string>")
    return made.groupBy("host").agg(F.sort_array(F.collect_set("wrapper")).alias("wrappers"))


_TALLIED = "host string, wrapper int, place int, path string, size long, texts array<long>, mains array<long>"


def tallied(pages: DataFrame) -> DataFrame:
    """(host, known) over all pages (host, html, wrappers): region and constants of each wrapper."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, tallies, held = _extractors(), {}, 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"host": host, "wrapper": w, "place": p, "path": path, "size": size, "texts": list(texts), "mains": list(mains)}
                 for host, tally in tallies.items() for (w, p), (path, size, texts, mains) in tally.places.items()], schema)

        schema = pa.schema([("host", pa.string()), ("wrapper", pa.int32()), ("place", pa.int32()), ("path", pa.string()), ("size", pa.int64()),
                            ("texts", pa.list_(pa.int64())), ("mains", pa.list_(pa.int64()))])
        for batch in batches:
            for host, text, wrappers in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "wrappers")), strict=True):
                page = Page(text)
                wrapper, places = get(wrappers, host).read(page)
                if places is not None:
                    tally = tallies.setdefault(host, Tally(text_key))
                    before = len(tally.places)
                    tally.add(wrapper, page, places)
                    held += len(tally.places) - before
                    if held > HELD_PLACES:
                        yield rows()
                        tallies, held = {}, 0
        yield rows()

    parts = pages.mapInArrow(count, _TALLIED)
    lists = F.collect_list("texts")
    one = parts.groupBy("host", "wrapper", "place").agg(
        F.max("path").alias("path"), F.sum("size").alias("size"), lists.alias("lists"),
        F.size(F.array_distinct(F.flatten(F.collect_list("mains")))).alias("mains"))
    texts = F.aggregate("lists", F.element_at("lists", 1), lambda a, b: F.array_intersect(a, b))
    # Texts are needed only where enough different pages agree.
    one = one.withColumn("texts", F.when(F.col("mains") >= TEMPLATE_PAGES, texts)).drop("lists")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = []
            for tally in batch.column("tallied").to_pylist():
                rows: dict[int, list[tuple]] = {}
                for r in tally:
                    rows.setdefault(r["wrapper"], []).append((r["place"], r["path"], r["size"], r["texts"] or [], r["mains"]))
                made = ((w, *settled(places)) for w, places in sorted(rows.items()))
                known.append(json.dumps([(w, region, sorted(constants)) for w, region, constants in made]))
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(known, pa.string())], ["host", "known"])

    rows = F.collect_list(F.struct("wrapper", "place", "path", "size", "texts", "mains"))
    return one.groupBy("host").agg(rows.alias("tallied")).mapInArrow(settle, "host string, known string")


EXTRACTED = [T.StructField("text", T.StringType(), False), T.StructField("matched", T.BooleanType(), False)]


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Adds text (the main text) and matched (a wrapper of the host accepts the page) to every row.

    Needs ``page_id``, ``url`` and ``html``. A null or empty html has the empty text. Pages
    without a url, or with one that names no host, share the empty host. Repeated rows get
    the same text; other columns stay, ``text`` and ``matched`` are replaced. An empty table
    gives no rows.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    keyed = pages.where("html IS NOT NULL").select(host.alias("host"), "html")
    wrappers = saved(wrappers_of(keyed), "wrappers")
    few = wrappers.count() <= BROADCAST_ROWS
    near = lambda df: F.broadcast(df) if few else df
    counts = tallied(keyed.join(near(wrappers), "host"))
    names = unused(pages, "host", "wrappers", "known")
    made = saved(wrappers.join(counts, "host", "left"), "tallied").toDF(*names)
    joined = pages.join(near(made), host == F.col(names[0]), "left")

    def make():
        get = _extractors()

        def extract(batch: pa.RecordBatch) -> list[pa.Array]:
            texts, matched = [], []
            hosts, wrappers, settled_ = (batch.column(c) for c in names)
            known: dict[str | None, Extractor] = {}
            for i, (page, name) in enumerate(zip(batch.column("html").to_pylist(), hosts.to_pylist(), strict=True)):
                if name not in known:
                    known[name] = get(wrappers[i].as_py(), name, settled_[i].as_py())
                text, ok = known[name].extract(page or "")
                texts.append(text)
                matched.append(ok and page is not None)
            return [pa.array(texts, pa.string()), pa.array(matched)]

        return extract

    return with_columns(joined, "html", EXTRACTED, make, drop=tuple(names))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extract_main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "matched")
