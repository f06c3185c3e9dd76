"""Fields of item boxes, collected while the page is read: one row per page, one entry per box, nothing shuffled.

A ``Box`` says which elements are boxes and which of the elements inside are wanted (``Find``). All chains of all boxes form one
automaton (see ``dom``). Chains are matched against the whole page, as a query on an element does; what they find belongs to every open box around it. What the
texts mean is left to expressions on the box rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .dom import DEEPEST, Automaton, Chain, Element, Walk, batched, chain, token

_STRING, _INT = T.StringType(), T.IntegerType()
_MAP = T.MapType(_STRING, _STRING)
VALUES = {
    "text": (_STRING, pa.string()), "line": (_STRING, pa.string()), "shown": (_STRING, pa.string()), "attrs": (_MAP, pa.map_(pa.string(), pa.string())),
    "node": (T.StructType([T.StructField("text", _STRING), T.StructField("attrs", _MAP)]), pa.struct([("text", pa.string()), ("attrs", pa.map_(pa.string(), pa.string()))])),
}
BESIDE = {"id": (_INT, pa.int32()), "end": (_INT, pa.int32()), "tag": (_STRING, pa.string()), "text": (_STRING, pa.string())}
DOCUMENT = chain(token("#document"))
# The blanks of ``functions.text.BLANK``; Java's $ also stands before a last U+0085, which is none of them.
_BLANKS = "\t-\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
_UNTIDY = re.compile("[^ -~\u00a1-\u167f\u3001-\ufefe\uff00-\U0010ffff]|  ")
_RUNS, _ENDS = re.compile(f"[{_BLANKS}]{{2,}}"), re.compile(f"\\A[{_BLANKS}]+|[{_BLANKS}]+(?=\u0085?\\Z)")
_HARD = str.maketrans("\u00a0\t\r\n", "    ")


def tidy_line(text: str) -> str:
    """``functions.text.compact_spaces`` of a text that the reader holds."""
    if _UNTIDY.search(text) is None:
        return text.strip(" ")
    return _ENDS.sub("", _RUNS.sub(" ", text.translate(_HARD)))


@dataclass(frozen=True)
class Find:
    """Elements of a box that answer to a choice: a chain, or any of a tuple of chains.

    ``every``: all of them as (choice, id, v), by the first choice each answers to, then in document order. Otherwise the first of each choice, an
    array of values as long as ``choices``, null where there is none. ``itself``: whether the box element answers to one (a boolean). Values: ``text``
    content, ``line`` text content with tidy blanks, ``shown`` visible text, ``attrs`` all attributes, ``node`` text and attributes.
    """

    choices: tuple[Chain | tuple[Chain, ...], ...]
    value: str = "text"
    every: bool = False
    itself: bool = False

    @property
    def types(self) -> tuple[T.DataType, pa.DataType]:
        if self.itself:
            return T.BooleanType(), pa.bool_()
        kind, arrow = VALUES[self.value]
        if not self.every:
            return T.ArrayType(kind), pa.list_(arrow)
        return (T.ArrayType(T.StructType([T.StructField("choice", _INT), T.StructField("id", _INT), T.StructField("v", kind)])),
                pa.list_(pa.struct([("choice", pa.int32()), ("id", pa.int32()), ("v", arrow)])))


@dataclass(frozen=True)
class Box:
    """Box elements and what is wanted of them.

    Every box has ``id``, ``end`` (the last id inside), ``attrs``, ``text`` (``text`` content, ``line`` with tidy blanks, there and beside, or ``shown`` visible text, if asked for) and ``beside``: the ``beside`` elements after it under the same parent,
    up to the next one with a tag in ``until``; with ``of_parent`` those after its parent.
    """

    chains: tuple[Chain, ...]
    finds: Mapping[str, Find]
    text: str | None = None
    beside: int = 0
    until: frozenset[str] = frozenset()
    of_parent: bool = False

    def fields(self) -> list[tuple[str, T.DataType, pa.DataType]]:
        beside = (T.ArrayType(T.StructType([T.StructField(n, k) for n, (k, _) in BESIDE.items()])), pa.list_(pa.struct([(n, k) for n, (_, k) in BESIDE.items()])))
        own = [("id", _INT, pa.int32()), ("end", _INT, pa.int32()), ("attrs", *VALUES["attrs"]), ("text", *VALUES["text"]), ("beside", *beside)]
        return own + [(name, *find.types) for name, find in self.finds.items()]


class _Plan:
    """All chains of all boxes in one automaton, and what its answers mean."""

    def __init__(self, boxes: Mapping[str, Box]):
        self.boxes, chains, self.opens, self.finds = boxes, [], [], []
        for name, box in boxes.items():
            for c in box.chains:
                self.opens.append((1 << len(chains), name))
                chains.append(c)
            for place, find in enumerate(box.finds.values()):
                for choice, either in enumerate(find.choices):
                    either = (either,) if isinstance(either, Chain) else either
                    self.finds.append(((1 << len(either)) - 1 << len(chains), name, place, choice, find))
                    chains.extend(either)
        self.automaton, self.known = Automaton(chains), {}

    def meaning(self, ends: int):
        """(names of the boxes that an element is, finds it answers to inside a box of each name: place, choice, find)."""
        found = self.known.get(ends)
        if found is None:
            if len(self.known) > Automaton.KEPT:
                self.known.clear()
            inside: dict[str, list] = {}
            for bit, name, place, choice, find in self.finds:
                own = inside.setdefault(name, [])
                if ends & bit and not (find.every and any(p == place for p, _, _ in own)):
                    own.append((place, choice, find))
            opens = list(dict.fromkeys(name for bit, name in self.opens if ends & bit))
            found = self.known[ends] = opens, {n: f for n, f in inside.items() if f}
        return found


class _Record:
    """A box being filled: its finds are lists of slots whose last entry takes the value once the element closes."""

    __slots__ = ("name", "box", "node", "end", "text", "finds", "beside")

    def __init__(self, name: str, box: Box, node: Element):
        self.name, self.box, self.node, self.end, self.text, self.beside = name, box, node, node.id, None, []
        self.finds = [False if f.itself else [] if f.every else [None] * len(f.choices) for f in box.finds.values()]


class _Extra:
    """What an open element owes: slots to fill as it closes, boxes that it is, boxes that wait for what follows its children or itself."""

    __slots__ = ("slots", "records", "waiting", "after")

    def __init__(self):
        self.slots, self.records, self.waiting, self.after = [], [], [], []


class _Boxes(Walk):
    def __init__(self, html: str, plan: _Plan, deepest: int = DEEPEST):
        self.plan, self.open, self.found = plan, [], {name: [] for name in plan.boxes}
        super().__init__(html, deepest)

    def _extra(self, node: Element) -> _Extra:
        if node.extra is None:
            node.extra = _Extra()
        return node.extra

    def opened(self, node: Element, parent: Element | None) -> None:
        node.state, ends = self.plan.automaton.step(parent.state if parent else 0, node.tag, node.attrs, node.classes)
        if parent is not None and parent.extra is not None and parent.extra.waiting:
            self._follows(node, parent.extra)
        if not ends:
            return
        opens, inside = self.plan.meaning(ends)
        if inside:
            for record in self.open:
                for place, choice, find in inside.get(record.name, ()):
                    if find.itself:
                        continue
                    slot = [choice, node.id, None]
                    if find.every:
                        record.finds[place].append(slot)
                    elif record.finds[place][choice] is None:
                        record.finds[place][choice] = slot
                    else:
                        continue
                    self._extra(node).slots.append((slot, find.value))
        for name in opens:
            record = _Record(name, self.plan.boxes[name], node)
            for place, _, find in inside.get(name, ()):
                if find.itself:
                    record.finds[place] = True
            self.open.append(record)
            self.found[name].append(record)
            self._extra(node).records.append(record)

    def _follows(self, node: Element, extra: _Extra) -> None:
        still = []
        for record in extra.waiting:
            if node.tag in record.box.until:
                continue
            slot = [node.id, node.id, node.tag, None]
            record.beside.append(slot)
            self._extra(node).slots.append((slot, "beside line" if record.box.text == "line" else "beside"))
            if len(record.beside) < record.box.beside:
                still.append(record)
        extra.waiting = still

    def closed(self, node: Element, parent: Element | None) -> None:
        extra = node.extra
        if extra is None:
            return
        text = None
        for slot, value in extra.slots:
            if text is None and value != "shown" and value != "attrs":
                text = "".join(self.pieces[node.text:])
            if value == "shown":
                slot[-1] = "".join(self.visible[node.shown:])
            elif value == "attrs":
                slot[-1] = list(node.attrs.items())
            elif value == "node":
                slot[-1] = {"text": text, "attrs": list(node.attrs.items())}
            else:
                slot[-1] = tidy_line(text) if value == "line" or value == "beside line" else text
            if value == "beside" or value == "beside line":
                slot[1] = self.next_id - 1
        for record in extra.records:
            self.open.remove(record)
            record.end = self.next_id - 1
            if record.box.text == "shown":
                record.text = "".join(self.visible[node.shown:])
            elif record.box.text:
                text = "".join(self.pieces[node.text:]) if text is None else text
                record.text = tidy_line(text) if record.box.text == "line" else text
            if record.box.beside and parent is not None:
                (self._extra(parent).after if record.box.of_parent else self._extra(parent).waiting).append(record)
        if extra.after and parent is not None:
            self._extra(parent).waiting.extend(extra.after)

    def rows(self, name: str) -> list[tuple]:
        """The boxes of a name in document order, one value per field."""
        out = []
        for r in self.found[name]:
            values = []
            for f, v in zip(r.box.finds.values(), r.finds):
                if f.every:
                    v = [dict(zip(("choice", "id", "v"), s)) for s in sorted(v, key=lambda s: s[:2])]
                elif not f.itself:
                    v = [None if s is None else s[2] for s in v]
                values.append(v)
            out.append((r.node.id, r.end, list(r.node.attrs.items()), r.text, [dict(zip(BESIDE, s)) for s in r.beside], *values))
        return out


def page_boxes(pages: DataFrame, boxes: Mapping[str, Box], carry: tuple[str, ...] = (), page_id: str = "page_id", html: str = "html", deepest: int = DEEPEST) -> DataFrame:
    """One row per page: ``carry`` and, for each name, its boxes in document order as an array of structs."""
    ship_package(pages.sparkSession)
    columns = [page_id, *carry]
    source = pages.select(*columns, html)
    fields = {name: box.fields() for name, box in boxes.items()}
    schema = T.StructType([*[source.schema[c] for c in columns], *[
        T.StructField(name, T.ArrayType(T.StructType([T.StructField(n, k) for n, k, _ in own]))) for name, own in fields.items()]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = _Plan(boxes)

        def build(text: str):
            page = _Boxes(text, plan, deepest)
            return [page.rows(name) for name in fields]

        def finish(carried, results):
            arrays = []
            for place, own in enumerate(fields.values()):
                rows = [row for r in results for row in r[place]]
                sizes = np.concatenate([[0], np.cumsum([len(r[place]) for r in results])]).astype(np.int32)
                values = [pa.array(list(v), kind) for v, (_, _, kind) in zip(zip(*rows) if rows else [()] * len(own), own)]
                arrays.append(pa.ListArray.from_arrays(pa.array(sizes), pa.StructArray.from_arrays(values, [n for n, _, _ in own])))
            return pa.RecordBatch.from_arrays([*carried, *arrays], schema.names)

        for batch in batches:
            yield from batched(batch, len(columns), build, finish)

    return source.mapInArrow(read, schema)


def spread(table: DataFrame, name: str, box: Box, carry: tuple[str, ...] = (), page_id: str = "page_id") -> DataFrame:
    """One row per box of a name of a ``page_boxes`` table: ``carry``, ``box_id``, ``box_end``, ``attrs``, ``text``, ``beside`` and the finds."""
    rows = table.select(page_id, *carry, F.explode(name).alias("_b"))
    return rows.select(page_id, *carry, F.col("_b.id").alias("box_id"), F.col("_b.end").alias("box_end"), "_b.attrs", "_b.text", "_b.beside",
                       *[F.col("_b").getField(n).alias(n) for n in box.finds])


def box_rows(pages: DataFrame, box: Box, carry: tuple[str, ...] = (), page_id: str = "page_id", **settings) -> DataFrame:
    """One row per box of the pages."""
    return spread(page_boxes(pages, {"_boxes": box}, carry, page_id, **settings), "_boxes", box, carry, page_id)


def first_of(name: str, clean: Callable[[Column], Column] = lambda c: c, choices: int = 1) -> Column:
    """The value of the first choice whose first element has one that is not empty; each choice is asked on its own."""
    return F.coalesce(*[F.nullif(clean(F.get(F.col(name), F.lit(i))), F.lit("")) for i in range(choices)])


def found(name: str, choices: int = 1) -> Column:
    """Whether any choice has found an element."""
    return F.coalesce(F.exists(F.col(name), lambda v: v.isNotNull()), F.lit(False))


def first_that(name: str, value: Callable[[Column], Column], test: Callable[[Column], Column] | None = None) -> Column:
    """Of an ``every`` find the first value, choice by choice and in document order, that is not empty and passes the test."""
    values = F.transform(F.col(name), lambda x: value(x["v"]))
    passes = (lambda v: F.length(v) > 0) if test is None else (lambda v: (F.length(v) > 0) & test(v))
    return F.get(F.filter(values, passes), F.lit(0))
