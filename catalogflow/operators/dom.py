"""Captured HTML: the page reader, selectors as one automaton, and a lean table of elements.

``mapInArrow`` stages read each page once, with the automaton's state on every open element: which chains a node answers to is
known as it opens. ``operators/boxes.py`` collects fields of item boxes that way, one row per page, with no shuffle. Where elements themselves are
wanted, ``page_table`` gives one row per page: its text once, and for each element its place in that text (start, length) and its
interval of ids. ``nodes_of`` spreads it into rows; a node's text is cut from the page's text only where it is used.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

DOCUMENT = "#document"

# HTML element classes (public HTML standard).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in ("script", "style", "title", "textarea")}
HIDDEN = frozenset(("script", "style", "noscript", "template"))
BLOCK = frozenset(
    "address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul title".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CLOSES_P = BLOCK - {"tbody", "td", "tfoot", "th", "thead", "tr", "option", "title"}
CELL = frozenset(("table", "td", "th", "caption"))
# start tag -> (open elements it ends, elements it never looks past)
IMPLIED_END = {
    "li": ({"li"}, CELL | {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, CELL | {"dl"}),
    "dd": ({"dt", "dd"}, CELL | {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, CELL | {"select", "datalist"}),
    "a": ({"a"}, CELL | {"button", "object"}),
    "body": ({"head"}, frozenset()),
}
NAME = re.compile(r"[A-Za-z]")
NAME_END = re.compile(r"[\s/>]")
SPECIAL = re.compile(r"[>\"']")
ATTR = re.compile(r"([^\s=/>\"'][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
# Text up to the next tag and that tag, if it is a plain one: whole, with no "<" inside. What this does not match is left to ``Tags``. As it never looks past
# the second "<", a failed try costs no more than the stretch between two of them.
PLAIN = re.compile(r"([^<]*+)<(?:/([A-Za-z][^\s/<>]*+)[^<>]*+>|([A-Za-z][^\s/<>]*+)((?:[^<>\"']++|\"[^<\"]*+\"|'[^<']*+')*+)>)")
NO_BARRIER: frozenset[str] = frozenset()
# Browsers nest elements no deeper than this (public: the usual limit of HTML parsers); what is opened below becomes a sibling.
DEEPEST = 512
# Characters of pages that one Arrow batch answers for before it is passed on: what a worker holds of them as objects is many times as large.
BATCH_CHARS = 500_000
P_BARRIER = CELL | {"button"}
P_ONLY = frozenset(("p",))
WIDE = frozenset(("html", "head", "body", DOCUMENT))
SHOWN = frozenset(("body", "main", "article", DOCUMENT))


class Tags:
    """Tags of a page in order, each character looked at a bounded number of times, however broken the page.

    A ``<`` opens a tag only if the tag also ends, which an open quote or a missing ``>`` prevents. What a failed try has
    learned is kept: the next delimiter of each kind, and the quotes from which no tag end can be reached.
    """

    def __init__(self, html: str):
        self.html, self.size = html, len(html)
        self.ahead: dict[object, tuple[int, int]] = {}
        self.dead: set[int] = set()

    def _next(self, what, start: int) -> int:
        """Place of the next match at or after ``start``, the page's size if there is none; starts may only rise per kind."""
        known = self.ahead.get(what)
        if known and known[0] <= start <= known[1]:
            return known[1]
        if isinstance(what, str):
            place = self.html.find(what, start)
        else:
            match = what.search(self.html, start)
            place = match.start() if match else -1
        place = self.size if place < 0 else place
        self.ahead[what] = (start, place)
        return place

    def _tag_end(self, start: int) -> int | None:
        """Place of the ``>`` that ends a start tag, looked for from behind its name: quoted parts are passed over."""
        passed = []
        while True:
            place = self._next(SPECIAL, start)
            if place < self.size and self.html[place] == ">":
                return place
            if place == self.size or place in self.dead:
                break
            passed.append(place)
            close = self._next(self.html[place], place + 1)
            if close == self.size:
                break
            start = close + 1
        self.dead.update(passed)
        return None

    def following(self, pos: int) -> tuple[int, int, str | None, str | None, str]:
        """(start, end, name of an end tag, name of a start tag, its attributes) of the next tag or comment at or after ``pos``."""
        html, size = self.html, self.size
        while True:
            start = self._next("<", pos)
            if start + 1 >= size:
                return size, size, None, None, ""
            pos = start + 1
            sign = html[pos]
            if html.startswith("!--", pos):
                end = html.find("-->", start + 4)
                return start, size if end < 0 else end + 3, None, None, ""
            if sign in "!?":
                end = self._next(">", pos)
                if end < size:
                    return start, end + 1, None, None, ""
                continue
            name = pos + (sign == "/")
            if not NAME.match(html, name) or self._next(">", pos) == size:
                continue
            stop = self._next(NAME_END, name)
            if sign == "/":
                end = self._next(">", stop)
                if end < size:
                    return start, end + 1, html[name:stop], None, ""
                continue
            end = self._tag_end(stop)
            if end is not None:
                return start, end + 1, None, html[name:stop], html[stop:end]


class Attributes(dict):
    """Attributes and classes by the text of a tag; short texts are kept, as they come back on every page. Callers do not change them."""

    KEPT, LONGEST = 20_000, 200

    def __missing__(self, raw: str) -> tuple[dict[str, str], Sequence[str]]:
        attrs: dict[str, str] = {}
        for name, double, single, bare in ATTR.findall(raw):
            value = double or single or bare
            attrs.setdefault(name.lower(), unescape(value) if "&" in value else value)
        found = attrs, attrs["class"].split() if "class" in attrs else ()
        if len(raw) <= self.LONGEST:
            if len(self) >= self.KEPT:
                self.clear()
            self[raw] = found
        return found


_ATTRIBUTES = Attributes()
NOTHING: tuple[dict[str, str], Sequence[str]] = {}, ()


# --- selectors ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Token:
    """One element of a selector."""

    tag: str | None = None
    id: str | None = None
    id_start: str | None = None
    classes: tuple[str, ...] = ()
    part: str | None = None
    #: (attribute, "given" | "has" | "is" | "holds" | "starts", value); all but "given" want a value that is not empty
    attrs: tuple[tuple[str, str, str | None], ...] = ()
    #: a direct child of the element before it in the chain
    child: bool = False

    def fits_class(self, tag: str, classes: Sequence[str]) -> bool:
        return ((self.tag is None or self.tag == tag) and all(c in classes for c in self.classes)
                and (self.part is None or any(self.part in c for c in classes)))

    @property
    def plain(self) -> bool:
        return self.id is None and self.id_start is None and not self.attrs

    def fits_values(self, attrs: Mapping[str, str]) -> bool:
        own = attrs.get("id") or ""
        if self.id is not None and own != self.id or self.id_start is not None and not own.startswith(self.id_start):
            return False
        for name, how, value in self.attrs:
            found = attrs.get(name)
            if how == "given" and found is not None:
                continue
            if not found or how == "is" and found != value or how == "holds" and value not in found or how == "starts" and not found.startswith(value):
                return False
        return True


@dataclass(frozen=True)
class Chain:
    """Descendant chain that ends at the node itself."""

    tokens: tuple[Token, ...]


def token(
    tag: str | None = None, *, id: str | None = None, id_start: str | None = None, cls: str | tuple[str, ...] = (),
    part: str | None = None, attr: tuple[str, str] | tuple[str, str, str] | str | None = None, child: bool = False,
) -> Token:
    """Element by tag, id, classes, a part of a class name, or an attribute: its name (not empty), (name, value) or (name, how, value)."""
    test = () if attr is None else ((attr, "has", None),) if isinstance(attr, str) else ((attr[0], "is", attr[1]),) if len(attr) == 2 else (attr,)
    return Token(tag, id, id_start, (cls,) if isinstance(cls, str) else tuple(cls), part, test, child)


def chain(*tokens: Token) -> Chain:
    return Chain(tokens)


class Automaton:
    """All chains as one table of states, filled as pages need it.

    A state says which beginnings of chains the open elements have matched. An element's tag and classes (kept by their text) and, for
    the few tokens that ask for them, its other attributes give the tokens it fits; state and tokens give the next state and the chains that end there.
    """

    KEPT = 20_000

    def __init__(self, chains: Sequence[Chain]):
        tokens = list(dict.fromkeys(t for c in chains for t in c.tokens))
        self.tokens = tokens
        self.valued = [(1 << i, t) for i, t in enumerate(tokens) if not t.plain]
        self.asks = sum(bit for bit, _ in self.valued)
        # tokens that no element without attributes fits
        self.wants = sum(bit for bit, t in self.valued if not t.fits_values({}))
        self.steps: list[tuple[int, int, int, int]] = []
        self.lasting, bit = 0, 0
        known: dict[tuple[Token, ...], int] = {}
        for number, c in enumerate(chains):
            before = 0
            for k, t in enumerate(c.tokens):
                if k + 1 == len(c.tokens):
                    self.steps.append((1 << tokens.index(t), before, 0, 1 << number))
                    break
                # beginnings that chains share are one bit; one that only a direct child may go on from does not last
                child = c.tokens[k + 1].child
                key = (*c.tokens[:k + 1], child)
                if key not in known:
                    known[key] = 1 << bit
                    self.lasting |= 0 if child else 1 << bit
                    self.steps.append((1 << tokens.index(t), before, 1 << bit, 0))
                    bit += 1
                before = known[key]
        self.fits: dict[tuple[str, str | None], int] = {}
        self.table: dict[tuple[int, int], tuple[int, int]] = {}

    def step(self, state: int, tag: str, attrs: Mapping[str, str], classes: Sequence[str]) -> tuple[int, int]:
        """(state of the element, chains that end at it) from the state of its parent."""
        key = (tag, attrs.get("class") if attrs else None)
        fits = self.fits.get(key)
        if fits is None:
            if len(self.fits) > self.KEPT:
                self.fits.clear()
            fits = self.fits[key] = sum(1 << i for i, t in enumerate(self.tokens) if t.fits_class(tag, classes))
        if not attrs:
            fits &= ~self.wants
        if fits & self.asks:
            for bit, t in self.valued:
                if fits & bit and not t.fits_values(attrs):
                    fits ^= bit
        if not fits:
            return state & self.lasting, 0
        found = self.table.get((state, fits))
        if found is None:
            if len(self.table) > self.KEPT:
                self.table.clear()
            following, ends = state & self.lasting, 0
            for own, before, now, end in self.steps:
                if fits & own and (not before or state & before):
                    following |= now
                    ends |= end
            found = self.table[state, fits] = following, ends
        return found


# --- the reader --------------------------------------------------------------------------


class Element:
    """An open element; ``text`` and ``shown`` are where the page's pieces stood as it opened."""

    __slots__ = ("id", "parent", "sib", "tag", "attrs", "classes", "text", "shown", "own", "children", "state", "extra")

    def __init__(self, id, parent, sib, tag, attrs, classes, text, shown):
        self.id, self.parent, self.sib, self.tag, self.attrs, self.classes = id, parent, sib, tag, attrs, classes
        self.text, self.shown, self.own, self.children, self.state, self.extra = text, shown, [], 0, 0, None


class Walk:
    """One page, element by element: subclasses say what happens as elements open and close. Only open elements are held here."""

    def __init__(self, html: str, deepest: int = DEEPEST):
        self.pieces: list[str] = []
        self.visible: list[str] = []
        self.next_id = 1
        self.read(html, deepest)

    def opened(self, node: Element, parent: Element | None) -> None:
        pass

    def closed(self, node: Element, parent: Element | None) -> None:
        pass

    def read(self, html: str, deepest: int) -> None:
        root = Element(0, None, 0, DOCUMENT, {}, (), 0, 0)
        stack, pieces, visible = [root], self.pieces, self.visible
        pos, size, hidden = 0, len(html), 0
        scan, last_end, plain = Tags(html).following, html.rfind(">") + 1, PLAIN.match
        # open p elements: most pages ask at every block whether one has to end
        paragraphs = 0
        self.opened(root, None)

        def add_text(text: str) -> None:
            pieces.append(text)
            stack[-1].own.append(text)
            if not hidden:
                visible.append(text)

        def close() -> None:
            nonlocal hidden, paragraphs
            node = stack.pop()
            tag = node.tag
            if tag in BLOCK:
                visible.append("\n")
                if tag == "p":
                    paragraphs -= 1
            elif tag in HIDDEN:
                hidden -= 1
            self.closed(node, stack[-1] if stack else None)

        def end_implied(closing: Iterable[str], barrier: Iterable[str]) -> None:
            for depth in range(len(stack) - 1, 0, -1):
                tag = stack[depth].tag
                if tag in closing:
                    while len(stack) > depth:
                        close()
                    return
                if tag in barrier:
                    return

        while pos < size:
            match = plain(html, pos)
            if match:
                text, ended, started, raw_attrs = match.groups()
                pos = match.end()
            else:
                start, end, ended, started, raw_attrs = scan(pos)
                text, pos = html[pos:start], end
            if text:
                add_text(unescape(text) if "&" in text else text)
            if ended:
                tag = ended.lower()
                if stack[-1].tag == tag:
                    close()
                else:
                    end_implied((tag,), NO_BARRIER if tag in IMPLIED_END or tag in CELL else CELL)
                continue
            if not started:
                continue
            tag = started.lower()
            attrs, classes = _ATTRIBUTES[raw_attrs] if raw_attrs else NOTHING
            if tag in CLOSES_P:
                if paragraphs:
                    end_implied(P_ONLY, P_BARRIER)
                if tag in HEADINGS and stack[-1].tag in HEADINGS:
                    close()
            if tag in IMPLIED_END:
                end_implied(*IMPLIED_END[tag])
            while len(stack) >= deepest:
                close()
            parent = stack[-1]
            parent.children += 1
            node = Element(self.next_id, parent.id, parent.children, tag, attrs, classes, len(pieces), len(visible))
            self.next_id += 1
            if tag in BLOCK or tag == "br":
                visible.append("\n")
                if tag == "p":
                    paragraphs += 1
            elif tag in HIDDEN:
                hidden += 1
            self.opened(node, parent)
            stack.append(node)
            if tag in VOID:
                close()
            elif tag in RAW:
                close_tag = RAW[tag].search(html, pos, max(pos, last_end))
                text = html[pos:close_tag.start() if close_tag else size]
                if text:
                    add_text(unescape(text) if tag in ("title", "textarea") else text)
                pos = close_tag.end() if close_tag else size
                close()
        while stack:
            close()


# --- the table of elements ---------------------------------------------------------------

_KINDS = {"int": (T.IntegerType(), pa.int32()), "string": (T.StringType(), pa.string()), "strings": (T.ArrayType(T.StringType()), pa.list_(pa.string())),
          "map": (T.MapType(T.StringType(), T.StringType()), pa.map_(pa.string(), pa.string()))}
_NODE = {"node_id": "int", "end_id": "int", "parent_id": "int", "sib_pos": "int", "tag": "string", "id": "string", "classes": "strings", "attrs": "map",
         "marks": "strings", "own_text": "string", "text_start": "int", "text_size": "int", "shown_start": "int", "shown_size": "int"}
NODE = T.StructType([T.StructField(name, _KINDS[kind][0]) for name, kind in _NODE.items()])
NODE_TYPES = [_KINDS[kind][1] for kind in _NODE.values()]


class Listing(Walk):
    """Rows of a page, ``NODE``'s values each; starts and sizes count pieces until the page has ended."""

    def __init__(self, html: str, tags: frozenset[str] | None = None, automaton: Automaton | None = None, names: Sequence[str] = (), deepest: int = DEEPEST):
        self.tags, self.automaton, self.names, self.rows = tags, automaton, names, []
        super().__init__(html, deepest)

    def opened(self, node: Element, parent: Element | None) -> None:
        if self.automaton is not None:
            node.state, ends = self.automaton.step(parent.state if parent else 0, node.tag, node.attrs, node.classes)
            if ends:
                node.extra = sorted({name for i, name in enumerate(self.names) if ends >> i & 1})

    def closed(self, node: Element, parent: Element | None) -> None:
        tag = node.tag
        if self.tags is not None and tag not in self.tags:
            return
        text = (None, None) if tag in WIDE else (node.text, len(self.pieces))
        shown = (node.shown, len(self.visible)) if tag in SHOWN or node.attrs.get("role") == "main" else (None, None)
        self.rows.append((node.id, self.next_id - 1, node.parent, node.sib, tag, node.attrs.get("id"), node.classes, list(node.attrs.items()), node.extra or (),
                          "".join(node.own), *text, *shown))


def parse_page(html: str, tags: frozenset[str] | None = None, deepest: int = DEEPEST) -> list[dict]:
    """The elements of one page in the order they end, with ``text`` and ``visible_text`` written out."""
    page = Listing(html, tags, deepest=deepest)
    rows = [dict(zip(NODE.names, r)) for r in page.rows]
    for r in rows:
        for name, pieces in (("text", page.pieces), ("shown", page.visible)):
            start, end = r.pop(f"{name}_start"), r.pop(f"{name}_size")
            r["text" if name == "text" else "visible_text"] = None if start is None else "".join(pieces[start:end])
    return rows


def _placed(pieces: list[str], starts: tuple, ends: tuple) -> tuple[bytes, list, list]:
    """The pieces as one UTF-8 text, and the byte places and sizes for places counted in pieces."""
    parts = [p.encode() for p in pieces]
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]) if parts else np.zeros(1, np.int64)
    at = at.tolist()
    return b"".join(parts), [None if s is None else at[s] for s in starts], [None if s is None else at[e] - at[s] for s, e in zip(starts, ends)]


def batched(batch: pa.RecordBatch, carried: int, build, finish) -> Iterator[pa.RecordBatch]:
    """``build(html)`` of each page of a batch, passed on by ``finish(carried columns, results)`` so that a batch answers for a bounded amount of text."""
    results, lo, held = [], 0, 0
    for i, html in enumerate(batch.column(carried)):
        html = html.as_py() or ""
        results.append(build(html))
        held += len(html)
        if held >= BATCH_CHARS or i + 1 == batch.num_rows:
            yield finish([batch.column(c).slice(lo, i + 1 - lo) for c in range(carried)], results)
            results, lo, held = [], i + 1, 0


def page_table(
    pages: DataFrame, carry: tuple[str, ...] = (), tags: Iterable[str] | None = None, marks: Mapping[str, Sequence[Chain]] | None = None,
    page_id: str = "page_id", html: str = "html", deepest: int = DEEPEST,
) -> DataFrame:
    """One row per page: ``carry``, its text and visible text (UTF-8 bytes, each once) and its elements, ``NODE``'s fields each.

    The output is of the order of the page, however deep its elements nest. ``marks`` names sets of chains: an element's ``marks`` are the names of which it
    answers to a chain. ``tags`` limits the elements. Elements nest ``deepest`` deep; what is opened below becomes a sibling.
    """
    ship_package(pages.sparkSession)
    keep = None if tags is None else frozenset(tags)
    named = [(name, c) for name, chains in (marks or {}).items() for c in chains]
    names = [name for name, _ in named]
    columns = [page_id, *carry]
    source = pages.select(*columns, html)
    schema = T.StructType([*[source.schema[c] for c in columns], T.StructField("page_text", T.BinaryType()), T.StructField("page_shown", T.BinaryType()),
                           T.StructField("nodes", T.ArrayType(NODE))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton([c for _, c in named]) if named else None

        def build(text: str):
            page = Listing(text, keep, automaton, names, deepest)
            columns = [list(c) for c in zip(*page.rows)] or [[] for _ in NODE.fields]
            whole, columns[10], columns[11] = _placed(page.pieces, columns[10], columns[11])
            shown, columns[12], columns[13] = _placed(page.visible, columns[12], columns[13])
            return whole, shown, pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, NODE_TYPES)], NODE.names)

        def finish(carried, results):
            sizes = np.concatenate([[0], np.cumsum([len(r[2]) for r in results])]).astype(np.int32)
            nodes = pa.ListArray.from_arrays(pa.array(sizes), pa.concat_arrays([r[2] for r in results]))
            return pa.RecordBatch.from_arrays([*carried, pa.array([r[0] for r in results], pa.binary()), pa.array([r[1] for r in results], pa.binary()), nodes], schema.names)

        for batch in batches:
            yield from batched(batch, len(columns), build, finish)

    return source.mapInArrow(read, schema)


def nodes_of(table: DataFrame) -> DataFrame:
    """One row per element of a page table, with the texts cut from the page's; what is not used is not cut.

    ``node_id`` counts elements in document order (0 is the ``#document``) and ``end_id`` is the last one inside; ``text`` is the text content (NULL for
    html, head, body and document), ``visible_text`` the text without scripts and with line breaks between blocks, of the page and main parts.
    """
    def cut(text: str, name: str) -> Column:
        return F.col(text).substr(F.col(f"_n.{name}_start") + 1, F.col(f"_n.{name}_size")).cast("string")

    carried = [c for c in table.columns if c not in ("page_text", "page_shown", "nodes")]
    spread = table.select(*carried, "page_text", "page_shown", F.explode("nodes").alias("_n"))
    return spread.select(
        *carried, *[F.col(f"_n.{c}").alias(c) for c in NODE.names[:10]], cut("page_text", "text").alias("text"), cut("page_shown", "shown").alias("visible_text"))


def html_nodes(pages: DataFrame, carry: tuple[str, ...] = (), tags: Iterable[str] | None = None, marks: Mapping[str, Sequence[Chain]] | None = None, **settings) -> DataFrame:
    """One row per element of each page; to keep elements for several readers, store a ``page_table`` and spread that."""
    return nodes_of(page_table(pages, carry, tags, marks, **settings))


def marked(name: str) -> Column:
    """True for elements that answer to a chain of this name."""
    return F.array_contains("marks", name)


def _blocks(low: Column, high: Column) -> Column:
    """The ids from ``low`` to ``high`` as the fewest blocks (level, number): a block of level l is ids with the same ``id >> l``."""
    def level(n: Column) -> Column:
        width = F.call_function("shiftleft", F.lit(1).cast("long"), n.cast("int"))
        start, stop = F.floor((low + width - 1) / width).cast("long"), F.floor((high + 1) / width).cast("long")
        first, last = (start < stop) & (start % 2 == 1), (start < stop) & (stop % 2 == 1)
        return F.filter(F.array(F.when(first, F.struct(n.alias("level"), start.alias("block"))), F.when(last, F.struct(n.alias("level"), (stop - 1).alias("block")))),
                        lambda b: b.isNotNull())

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(31)), level))


def contained(boxes: DataFrame, nodes: DataFrame, key: str = "page_id") -> DataFrame:
    """General containment: each node with each row of ``boxes`` (key, box_id, end_id) whose interval of ids holds it.

    Intervals are cut into blocks of ids with a common beginning; a node lies in one block of each level. An equality join on (key, level, block)
    gives each pair once, so no box meets a node outside it and the rows moved grow with the logarithm of the page.
    """
    spread = boxes.withColumn("_b", F.explode(_blocks(F.col("box_id").cast("long"), F.col("end_id").cast("long"))))
    spread = spread.select(*[c for c in boxes.columns if c != "end_id"], F.col("_b.level").alias("_level"), F.col("_b.block").alias("_block"))
    levels = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda n: F.struct(n.alias("level"), F.floor(F.col("node_id") / F.call_function("shiftleft", F.lit(1).cast("long"), n.cast("int"))).cast("long").alias("block")))
    # levels above the largest in use hold no box
    top = spread.groupBy(key).agg(F.max("_level").alias("_top"))
    inner = nodes.join(top, key).withColumn("_b", F.explode(F.slice(levels, F.lit(1), F.col("_top") + 1)))
    inner = inner.select(*nodes.columns, F.col("_b.level").alias("_level"), F.col("_b.block").alias("_block"))
    return inner.join(spread, [key, "_level", "_block"]).drop("_level", "_block")
