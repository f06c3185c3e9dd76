"""Structured data in pages: every nested object in the order it is written, products, FAQ, prices.

A block's text is walked once for its token positions: each object gets its written place and its interval of the text, at any depth. Spark parses
the interval into VARIANT where the object is used; VARIANT itself keeps members by name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import format_price, format_yen
from ..functions.text import (
    BLANK, as_col, blank_to_null, let, strip_tags, trim_blank, unique_faq, unique_specs, unique_strings,
)
from ..functions.urls import absolute_url
from ..session import ship_package
from .dom import BATCH_CHARS

SCRIPT = r"""(?is)<script[^>]*type\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script"""
#: Of JSON text: a string, or what opens, closes or separates.
MARK = re.compile(rb'"(?:[^"\\]|\\.)*"|[{}\[\],:]', re.S)
#: Characters that a row counts for besides its texts.
ROW_CHARS = 1_000
OBJECT = T.StructType([T.StructField("block_no", T.IntegerType()), T.StructField("place", T.ArrayType(T.IntegerType())),
                       T.StructField("start", T.IntegerType()), T.StructField("size", T.IntegerType())])


def _is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def _is_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


def _by_key(names: list[bytes]) -> list[int]:
    """Rank of every member: written order, but names that are whole numbers come first by number, as in a script's objects."""
    def key(k: int):
        text = names[k][1:-1]
        whole = text.isdigit() and (text == b"0" or text[:1] != b"0") and len(text) < 10
        return (0, int(text)) if whole else (1, k)

    order = [0] * len(names)
    for rank, k in enumerate(sorted(range(len(names)), key=key)):
        order[k] = rank
    return order


def written_objects(text: bytes) -> list[tuple[list[int], int, int]]:
    """(place, start, end) of every object of a JSON text, depth first in written order; places count members and list entries from 0.

    Works on token positions, at any depth; of a text that is no JSON it gives what it finds.
    """
    # open container: 0 start, 1 is an object, 2 names so far, 3 entries so far, 4 the container around it, 5 its entry there
    found, stack = [], []
    expect_name = False
    for mark in MARK.finditer(text):
        sign = mark.group()[:1]
        if sign in (b"{", b"["):
            around = stack[-1] if stack else None
            entry = None if around is None else len(around[2]) - 1 if around[1] else around[3]
            node = [mark.start(), sign == b"{", [], 0, around, entry, -1, None]
            if node[1]:
                found.append(node)
            stack.append(node)
            expect_name = node[1]
        elif sign in (b"}", b"]"):
            if stack:
                stack.pop()[6] = mark.end()
            expect_name = False
        elif sign == b",":
            if stack:
                stack[-1][3] += 1
                expect_name = stack[-1][1]
        elif sign == b'"' and expect_name and stack:
            stack[-1][2].append(mark.group())
            expect_name = False
    out = []
    for node in found:
        place, at = [], node
        while at[4] is not None:
            around = at[4]
            if around[1]:
                if around[7] is None:
                    around[7] = _by_key(around[2])
                place.append(around[7][at[5]] if 0 <= at[5] < len(around[7]) else 0)
            else:
                place.append(at[5])
            at = around
        if node[6] >= 0:
            out.append((place[::-1], node[0], node[6]))
    # members whose names are numbers move: the order of places is the depth-first order
    return sorted(out, key=lambda o: o[0])


def page_objects(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The pages (without ``html`` unless kept), ``blocks`` (UTF-8 texts) and ``objects``: every object of the blocks as (block_no, place, start, size), in document order.

    Blocks that are no JSON are null. A page is one row of the order of its size; ``object_node`` cuts an object from its block.
    """
    ship_package(pages.sparkSession)
    bodies = F.transform(F.regexp_extract_all("html", F.lit(SCRIPT), F.lit(1)), trim_blank)
    checked = F.transform(bodies, lambda b: F.when(F.try_parse_json(b).isNotNull(), b.cast("binary")))
    rest = [c for c in pages.columns if c != "html" or c in keep]
    source = pages.select(*rest, checked.alias("blocks"))
    schema = T.StructType([*source.schema, T.StructField("objects", T.ArrayType(OBJECT))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from with_objects(batch)

    return source.mapInArrow(read, schema)


def with_objects(batch: pa.RecordBatch, most: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """The rows with the objects of their last column, ``blocks``; passed on so that a batch answers for a bounded amount of text, however many rows came at once."""
    kind = pa.list_(pa.struct([("block_no", pa.int32()), ("place", pa.list_(pa.int32())), ("start", pa.int32()), ("size", pa.int32())]))
    rows, lo, held = [], 0, 0
    for i, blocks in enumerate(batch.column(batch.num_columns - 1)):
        blocks = blocks.as_py() or ()
        rows.append([{"block_no": number, "place": place, "start": a, "size": b - a}
                     for number, text in enumerate(blocks) if text is not None for place, a, b in written_objects(text)])
        # a row costs something without any text, too
        held += ROW_CHARS + sum(len(text) for text in blocks if text is not None)
        if held >= most or i + 1 == batch.num_rows:
            part = batch.slice(lo, i + 1 - lo)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, kind)], [*part.schema.names, "objects"])
            rows, lo, held = [], i + 1, 0


def object_node(o: Column, blocks: Column | str = "blocks") -> Column:
    """An object of ``page_objects`` as VARIANT."""
    return F.parse_json(F.get(as_col(blocks), o["block_no"]).substr(o["start"] + 1, o["size"]).cast("string"))


def jsonld_nodes(pages: DataFrame, carry: Sequence[str] = ("url",)) -> DataFrame:
    """Every object inside the blocks, depth first in written order: page_id, carry, block_no, place, node.

    ``place`` is the chain of positions from the block down; sorting by (block_no, place) walks the tree as it is written.
    """
    keep = ["page_id", *carry]
    rows = page_objects(pages.select(*keep, "html")).select(*keep, "blocks", F.explode("objects").alias("o"))
    return rows.select(*keep, "o.block_no", "o.place", object_node(F.col("o")).alias("node"))


def jsonld_is(node: Column | str, kind: str) -> Column:
    """Type test, any case; the type may be one text or a list."""
    node = as_col(node)
    kinds = F.coalesce(
        F.try_variant_get(node, '$["@type"]', "array<string>"), F.array(F.try_variant_get(node, '$["@type"]', "string"))
    )
    return F.coalesce(F.exists(kinds, lambda k: F.lower(k) == kind.lower()), F.lit(False))


def as_string(v: Column) -> Column:
    """Text (blanks tidied) or number as text; NULL for anything else, true/false included."""
    kind = F.schema_of_variant(v)
    text = blank_to_null(trim_blank(F.regexp_replace(F.try_variant_get(v, "$", "string"), BLANK + "{2,}", " ")))
    number = F.startswith(kind, F.lit("BIGINT")) | F.startswith(kind, F.lit("DECIMAL")) | F.startswith(kind, F.lit("DOUBLE"))
    value = F.try_variant_get(v, "$", "double")
    whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
    as_text = F.when(whole, value.cast("bigint").cast("string")).otherwise(F.try_variant_get(v, "$", "string"))
    return F.when(kind == "STRING", text).when(number, as_text)


def field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f'$["{name}"]', "variant")


def string_field(v: Column, name: str) -> Column:
    return as_string(field(v, name))


def objects(v: Column) -> Column:
    """The value as a list of objects: itself, or the object entries of a list."""
    empty = F.array().cast("array<variant>")
    many = F.filter(F.try_variant_get(v, "$", "array<variant>"), _is_object)
    return F.coalesce(F.when(_is_object(v), F.array(v)), many, empty)


def url_values(values: Column, base: Column) -> Column:
    """Absolute URLs of an array of values, each a text, an object (url, contentUrl, embedUrl) or a list of them."""

    def texts(x: Column) -> Column:
        plain = F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))
        named = F.array(*[string_field(x, n) for n in ("url", "contentUrl", "embedUrl")])
        return F.when(_is_object(x), named).otherwise(F.array(plain))

    flat = F.flatten(F.transform(values, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))))
    raw = F.filter(F.flatten(F.transform(flat, texts)), lambda t: t.isNotNull())
    return unique_strings(F.transform(raw, lambda t: absolute_url(base, t)))


def offer_price(offer: Column) -> Column:
    inner = field(offer, "priceSpecification")
    price, currency = string_field(offer, "price"), string_field(offer, "priceCurrency")
    return F.coalesce(
        format_price(price, currency),
        format_price(string_field(inner, "price"), F.coalesce(currency, string_field(inner, "priceCurrency"))),
    )


def faq_entry(v: Column) -> Column:
    """struct(question, answer) of a question object; NULL without a question."""
    question = string_field(v, "name")
    accepted = F.get(objects(field(v, "acceptedAnswer")), F.lit(0))
    answer = strip_tags(F.coalesce(string_field(accepted, "text"), string_field(accepted, "name")))
    return F.when(question.isNotNull(), F.struct(question.alias("question"), answer.alias("answer")))


def product_fields(node: Column, base: Column) -> dict[str, Column]:
    """Names, models, description, images, prices, availability, specs, videos of a product object."""
    offers = objects(field(node, "offers"))
    spec = F.transform(
        objects(field(node, "additionalProperty")),
        lambda p: F.struct(
            F.coalesce(string_field(p, "name"), string_field(p, "propertyID")).alias("label"),
            strip_tags(F.coalesce(string_field(p, "value"), string_field(p, "description"))).alias("value"),
        ),
    )
    models = F.array(*[string_field(node, n) for n in ("sku", "mpn", "model", "productID")])
    return {
        "name": string_field(node, "name"),
        "models": F.filter(models, lambda v: v.isNotNull()),
        "description": strip_tags(string_field(node, "description")),
        "images": url_values(F.array(field(node, "image")), base),
        "prices": F.filter(F.transform(offers, offer_price), lambda v: v.isNotNull()),
        "availability": F.filter(F.transform(offers, lambda o: string_field(o, "availability")), lambda v: v.isNotNull()),
        "specs": F.filter(spec, lambda s: s["value"].isNotNull()),
        "videos": url_values(F.array(field(node, "video")), base),
    }


def faq_entries(node: Column) -> Column:
    """Questions of an FAQ page and the node itself when it is a question, as struct(question, answer)."""
    none = F.array().cast("array<variant>")
    asked = F.concat(
        F.when(jsonld_is(node, "FAQPage"), objects(field(node, "mainEntity"))).otherwise(none),
        F.when(jsonld_is(node, "Question"), F.array(node)).otherwise(none),
    )
    return F.filter(F.transform(asked, faq_entry), lambda e: e.isNotNull())


def jsonld_products(nodes: DataFrame, base: str = "url") -> DataFrame:
    """One row per product object."""
    fields = product_fields(F.col("node"), F.col(base))
    found = nodes.filter(jsonld_is("node", "Product"))
    return found.select("page_id", "block_no", "place", *[c.alias(n) for n, c in fields.items()])


def jsonld_faq(nodes: DataFrame) -> DataFrame:
    """One row per question: page_id, block_no, place, entry_no, question, answer."""
    rows = nodes.select("page_id", "block_no", "place", F.posexplode(faq_entries(F.col("node"))).alias("entry_no", "e"))
    return rows.select("page_id", "block_no", "place", "entry_no", "e.question", "e.answer")


def object_record(base: str = "url") -> Column:
    """Of a row of ``page_objects``, in document order: all product, FAQ and video values, as a struct."""
    none = F.array().cast("array<string>")
    url = F.col(base)
    nodes = F.transform("objects", lambda o: object_node(o))
    # objects that say something are few: the others go before any field is read
    said = F.filter(nodes, lambda n: jsonld_is(n, "Product") | jsonld_is(n, "FAQPage") | jsonld_is(n, "Question") | jsonld_is(n, "VideoObject"))

    def read(n: Column) -> Column:
        product = F.struct(*[c.alias(name) for name, c in product_fields(n, url).items()])
        clips = url_values(F.array(*[field(n, name) for name in ("contentUrl", "embedUrl", "url")]), url)
        return F.struct(F.when(jsonld_is(n, "Product"), product).alias("p"), faq_entries(n).alias("f"), F.when(jsonld_is(n, "VideoObject"), clips).otherwise(none).alias("v"))

    rows = F.transform(said, read)

    def fields(l: Column) -> Column:
        products = F.filter(F.transform(l, lambda x: x["p"]), lambda p: p.isNotNull())
        one_of = lambda name: F.transform(products, lambda p: p[name])
        all_of = lambda name: F.flatten(F.transform(products, lambda p: p[name]))
        seen = F.flatten(F.transform(l, lambda x: F.concat(F.coalesce(x["p"]["videos"], none), x["v"])))
        return F.struct(
            unique_strings(one_of("name")).alias("ld_names"), unique_strings(all_of("models")).alias("ld_models"),
            unique_strings(one_of("description")).alias("ld_descriptions"), unique_strings(all_of("images")).alias("ld_images"),
            unique_strings(all_of("prices")).alias("ld_prices"), unique_strings(all_of("availability")).alias("ld_availability"),
            unique_specs(all_of("specs")).alias("ld_specs"), unique_faq(F.flatten(F.transform(l, lambda x: x["f"]))).alias("ld_faq"),
            unique_strings(seen).alias("ld_videos"))

    return let(rows, fields)


def jsonld_price(nodes: DataFrame, sku: str = "sku", url: str = "url") -> DataFrame:
    """Per page the first object, depth first, of this sku or URL ending that has an offer price.

    ``nodes`` carries the page's ``sku`` and ``url``. One map-side aggregation.
    """
    node = F.col("node")

    def price_of(offer: Column) -> Column:
        raw = field(offer, "price")
        number = F.when(F.schema_of_variant(raw) == "STRING", trim_blank(F.try_variant_get(raw, "$", "string")).try_cast("double"))
        return format_yen(F.coalesce(number, F.when(~F.startswith(F.schema_of_variant(raw), F.lit("BOOLEAN")), F.try_variant_get(raw, "$", "double"))))

    node_url = F.when(F.schema_of_variant(field(node, "url")) == "STRING", F.try_variant_get(node, "$.url", "string"))
    same = (F.length(F.col(sku)) > 0) & (F.try_variant_get(node, "$.sku", "string") == F.col(sku))
    same = F.coalesce(same, F.lit(False)) | F.coalesce((F.length(node_url) > 0) & F.endswith(F.col(url), node_url), F.lit(False))
    price = F.get(F.filter(F.transform(objects(field(node, "offers")), price_of), lambda p: p.isNotNull()), F.lit(0))
    hits = nodes.filter(same).select("page_id", F.struct("block_no", "place").alias("at"), price.alias("price"))
    best = hits.filter(F.col("price").isNotNull()).groupBy("page_id").agg(F.min(F.struct("at", "price")).alias("b"))
    return best.select("page_id", F.col("b.price").alias("price"))
