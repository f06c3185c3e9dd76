"""Official product pages: page fields, media, specification pairs, FAQ, the merged record.

A page is read once into one row: its fields, table rows, definition pairs, list items, headings with the elements after them, details elements
and structured data, each an array in document order. Everything after that is an expression on this row, so no
branch is shuffled, stored or joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import model_in_text, price_in_text
from ..functions.stock import availability_from_text, normalize_availability
from ..functions.text import (
    BLANK, blank_to_null, compact_spaces, contains_any, first_non_empty, trim_description, unique_faq,
    unique_specs, unique_strings,
)
from ..functions.urls import absolute_url, model_from_url
from .boxes import DOCUMENT, Box, Find, page_boxes
from .dom import chain, token as t
from .jsonld import object_record, page_objects

# Heading words and hosts of embedded videos.
SPEC_WORDS = ("仕様", "スペック", "spec", "specification", "specifications")
FAQ_WORDS = ("faq", "よくある質問", "q&a")
VIDEO_HOSTS = ("youtube.com", "youtu.be", "vimeo.com")
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
# Question and answer lines; the colon is optional and case does not matter.
SAME_LINE = rf"(?i)^(?:q|question|質問)[:：]?{BLANK}*(.+?)(?:{BLANK}+(?:a|answer|回答)[:：]?{BLANK}*(.+))$"
QUESTION = rf"(?i)^(?:q|question|質問)[:：]?{BLANK}*(.+)$"
ANSWER = rf"(?i)^(?:a|answer|回答)[:：]?{BLANK}*(.+)$"
NO_TEXTS = "array<string>"


def _empty() -> Column:
    return F.array().cast(NO_TEXTS)


_MAIN = (chain(t("main")), chain(t("article")), chain(t(attr=("role", "main"))))
PAGE = Box((DOCUMENT,), {
    "title": Find((chain(t("title")),), "line"),
    "og_title": Find((chain(t("meta", attr=("property", "is", "og:title"))),), "attrs"),
    "meta_description": Find((chain(t("meta", attr=("name", "description"))), chain(t("meta", attr=("property", "og:description")))), "attrs"),
    "canonical": Find((chain(t("link", attr=("rel", "canonical"))),), "attrs"),
    "meta_price": Find((chain(t("meta", attr=("property", "product:price:amount"))),), "attrs"),
    "og_image": Find((chain(t("meta", attr=("property", "og:image"))),), "attrs"),
    "h1": Find((chain(t("h1")),), "line", every=True),
    "main_text": Find((_MAIN, chain(t("body"))), "shown"),
    "paragraphs": Find((tuple(chain(*c.tokens, t("p")) for c in _MAIN),), "line", every=True),
    "pictures": Find((chain(t("img")),), "attrs", every=True),
    "players": Find(((chain(t("video")), chain(t("source"))),), "attrs", every=True),
    "frames": Find((chain(t("iframe")),), "attrs", every=True),
}, text="shown")
ROWS = Box((chain(t("tr")),), {"cells": Find(((chain(t("table"), t("td")), chain(t("table"), t("th"))),), "line", every=True)})
PAIRS = Box((chain(t("dl"), t("dt")),), {}, text="line", beside=1)
ITEMS = Box((chain(t("li")),), {}, text="line")
HEADED = Box(tuple(chain(t(h)) for h in HEADINGS), {}, text="line", beside=8, until=frozenset(HEADINGS))
DETAILS = Box((chain(t("details")),), {"summary": Find((chain(t("summary")),))}, text="text")
#: What the record needs of a page.
RECORD = {"page": PAGE, "rows": ROWS, "pairs": PAIRS, "items": ITEMS, "headings": HEADED, "details": DETAILS}
SPECS = {n: RECORD[n] for n in ("rows", "pairs", "items", "headings")}
FAQ = {n: RECORD[n] for n in ("rows", "pairs", "items", "headings", "details")}


def page_fields(url: str = "url") -> dict[str, Column]:
    """Titles, descriptions, canonical URL, headings, main text, price meta, images and videos of a row with its ``page``."""
    base, page = F.col(url), F.get(F.col("page"), F.lit(0))

    def content(name: str, choices: int = 1) -> Column:
        return F.coalesce(*[F.nullif(compact_spaces(F.get(page[name], F.lit(i))["content"]), F.lit("")) for i in range(choices)])

    def texts(name: str) -> Column:
        return F.transform(page[name], lambda x: x["v"])

    def srcset_urls(c: Column) -> Column:
        entries = F.filter(F.split(compact_spaces(c), ","), lambda e: e != "")
        first = F.transform(entries, lambda e: F.get(F.split(F.regexp_replace(e, f"^{BLANK}+", ""), BLANK), F.lit(0)))
        return F.transform(first, lambda e: absolute_url(base, e))

    pictures = F.flatten(F.transform(page["pictures"], lambda p: F.concat(F.array(absolute_url(base, p["v"]["src"])), srcset_urls(p["v"]["srcset"]))))
    players = F.transform(page["players"], lambda s: absolute_url(base, s["v"]["src"]))
    frames = F.filter(F.transform(page["frames"], lambda s: absolute_url(base, s["v"]["src"])), lambda s: contains_any(F.lower(s), VIDEO_HOSTS))
    body = F.coalesce(*[F.nullif(F.get(page["main_text"], F.lit(i)), F.lit("")) for i in (0, 1)], F.nullif(page["text"], F.lit("")))
    description = content("meta_description", 2)
    return {
        "title": F.nullif(F.get(page["title"], F.lit(0)), F.lit("")), "og_title": content("og_title"), "meta_description": description,
        "canonical_url": absolute_url(base, F.nullif(F.get(page["canonical"], F.lit(0))["href"], F.lit(""))),
        "h1_texts": unique_strings(texts("h1")), "body_text": compact_spaces(body),
        "description_texts": unique_strings(F.concat(F.array(description), F.slice(texts("paragraphs"), 1, 6))), "meta_price": content("meta_price"),
        "image_urls": unique_strings(F.concat(F.array(absolute_url(base, content("og_image"))), pictures)),
        "video_urls": unique_strings(F.concat(players, frames)),
    }


def extract_page_fields(pages: DataFrame, url: str = "url") -> DataFrame:
    """Page fields of every page; list values are in document order."""
    read = page_boxes(pages, {"page": PAGE}, (url,))
    return read.select("page_id", url, *[c.alias(n) for n, c in page_fields(url).items()])


def _lines(read: DataFrame) -> DataFrame:
    """``rows`` as (id, label, value) of table rows with two or more filled cells, ``pairs`` as (id, label, next_tag, value), ``items`` as (id, value)."""
    cells = F.transform("rows", lambda r: F.struct(r["id"].alias("id"), F.filter(r["cells"]["v"], lambda v: v != "").alias("v")))
    rows = F.transform(F.filter(cells, lambda r: F.size(r["v"]) >= 2), lambda r: F.struct(
        r["id"].alias("id"), F.get(r["v"], F.lit(0)).alias("label"), F.array_join(F.slice(r["v"], F.lit(2), F.size(r["v"])), " ").alias("value")))
    after = lambda p: F.get(p["beside"], F.lit(0))
    pairs = F.transform("pairs", lambda p: F.struct(
        p["id"].alias("id"), p["text"].alias("label"), after(p)["tag"].alias("next_tag"), after(p)["text"].alias("value")))
    items = F.filter(F.transform("items", lambda i: F.struct(i["id"].alias("id"), i["text"].alias("value"))), lambda i: i["value"] != "")
    return read.withColumns({"rows": rows, "pairs": pairs, "items": items})


def _entries(read: DataFrame) -> DataFrame:
    """``headings`` as (is_spec, is_faq, entries) of specification and FAQ headings.

    Entries are the texts of up to eight elements beside the heading, ended by the next heading. A table gives ``label: value``
    lines, a dl ``label: value`` pairs, an element with list items its items, any other its text. Lines are told by their place in the element's interval.
    """
    def named(text: Column, words: tuple[str, ...]) -> Column:
        return contains_any(F.lower(text), words)

    def inside(lines: str, b: Column, value) -> Column:
        return F.transform(F.filter(lines, lambda x: (x["id"] > b["id"]) & (x["id"] <= b["end"])), value)

    def pair(x: Column) -> Column:
        return F.when((x["label"] != "") & (x["value"] != ""), F.concat_ws(": ", x["label"], x["value"]))

    def block(b: Column) -> Column:
        items = inside("items", b, lambda x: x["value"])
        return (F.when(b["tag"] == "table", inside("rows", b, lambda x: F.concat_ws(": ", x["label"], x["value"])))
                .when(b["tag"] == "dl", inside("pairs", b, pair))
                .when(F.size(items) > 0, items).otherwise(F.array(b["text"])))

    wanted = F.filter("headings", lambda h: named(h["text"], SPEC_WORDS + FAQ_WORDS))
    entries = F.transform(wanted, lambda h: F.struct(
        named(h["text"], SPEC_WORDS).alias("is_spec"), named(h["text"], FAQ_WORDS).alias("is_faq"),
        unique_strings(F.flatten(F.transform(h["beside"], block)), tidy=True).alias("entries")))
    return read.withColumn("headings", entries)


def _specs() -> Column:
    """Specification pairs: table rows, then dl pairs, then lines after a specification heading."""
    kind = "array<struct<label:string,value:string>>"
    rows = F.transform("rows", lambda r: F.struct(r["label"].alias("label"), r["value"].alias("value")))
    pairs = F.transform(F.filter("pairs", lambda p: p["next_tag"] == "dd"), lambda p: F.struct(blank_to_null(p["label"]).alias("label"), p["value"].alias("value")))
    lines = F.flatten(F.transform(F.filter("headings", lambda h: h["is_spec"]), lambda h: h["entries"]))
    lines = F.transform(lines, lambda v: F.struct(F.lit(None).cast("string").alias("label"), v.alias("value")))
    return unique_specs(F.concat(rows.cast(kind), pairs.cast(kind), lines.cast(kind)), tidy=True)


def _faq() -> Column:
    """FAQ pairs: details elements, then lines after an FAQ heading."""
    kind = "array<struct<question:string,answer:string>>"

    def opened(d: Column) -> Column:
        summary = F.get(d["summary"], F.lit(0))
        at = F.instr(d["text"], summary)
        rest = F.concat(F.substr(d["text"], F.lit(1), at - 1), F.substr(d["text"], at + F.length(summary)))
        return F.struct(compact_spaces(summary).alias("question"), blank_to_null(compact_spaces(rest)).alias("answer"))

    details = F.transform(F.filter("details", lambda d: F.get(d["summary"], F.lit(0)).isNotNull()), opened)
    lines = F.flatten(F.transform(F.filter("headings", lambda h: h["is_faq"]), lambda h: qa_entries(h["entries"])))
    return unique_faq(F.concat(details.cast(kind), lines.cast(kind)))


def extract_specs(pages: DataFrame) -> DataFrame:
    """Specification pairs per page; pages without one are left out."""
    read = _entries(_lines(page_boxes(pages, SPECS)))
    return read.select("page_id", _specs().alias("specs"), F.exists("headings", lambda h: h["is_spec"]).alias("_named")).filter("size(specs) > 0 OR _named").drop("_named")


def qa_entries(entries: Column) -> Column:
    """Question and answer pairs of the lines after an FAQ heading.

    A line may hold both; a Q line takes the next line only when that is an A line; another line
    that ends with a question mark always takes the next line. Taken lines are not read again.
    """
    none = F.lit(None).cast("string")

    def step(acc: Column, i: Column) -> Column:
        line, following = F.get(entries, i), F.get(entries, i + 1)

        def pair(q: Column, a: Column) -> Column:
            return F.concat(acc["out"], F.array(F.struct(q.alias("question"), a.alias("answer"))))

        def state(skip: Column, out: Column) -> Column:
            return F.struct(skip.alias("skip"), out.alias("out"))

        no, yes = F.lit(False), F.lit(True)
        answered = F.coalesce(following.rlike(ANSWER), F.lit(False))
        return (
            F.when(acc["skip"], state(no, acc["out"]))
            .when(line.rlike(SAME_LINE), state(no, pair(F.regexp_extract(line, SAME_LINE, 1), F.regexp_extract(line, SAME_LINE, 2))))
            .when(line.rlike(QUESTION) & answered, state(yes, pair(F.regexp_extract(line, QUESTION, 1), F.regexp_extract(following, ANSWER, 1))))
            .when(line.rlike(QUESTION), state(no, pair(F.regexp_extract(line, QUESTION, 1), none)))
            .when(line.rlike("[?？]$"), state(yes, pair(line, following)))
            .otherwise(state(no, acc["out"]))
        )

    start = F.struct(
        F.lit(False).alias("skip"), F.array().cast("array<struct<question:string,answer:string>>").alias("out")
    )
    index = F.when(F.size(entries) > 0, F.sequence(F.lit(0), F.size(entries) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(index, start, step, lambda acc: acc["out"])


def extract_faq(pages: DataFrame) -> DataFrame:
    """FAQ pairs per page; pages without one are left out."""
    read = _entries(_lines(page_boxes(pages, FAQ)))
    return read.select("page_id", _faq().alias("faq")).filter("size(faq) > 0")


def official_records(pages: DataFrame, url: str = "url", carry: Sequence[str] = ()) -> DataFrame:
    """Merged record per page, with the columns to ``carry``: structured data first, page markup second, page text third. One pass over the pages, nothing shuffled."""
    read = page_boxes(page_objects(pages, keep=("html",)), RECORD, (url, *carry, "blocks", "objects"))
    read = _entries(_lines(read)).withColumn("ld", object_record(url))
    fields = read.select("page_id", url, *carry, *[c.alias(n) for n, c in page_fields(url).items()], _specs().alias("specs"), _faq().alias("faq"), "ld.*")

    def first(name: str) -> Column:
        return F.get(F.col(name), F.lit(0))

    return fields.select(
        "page_id", F.col(url).alias("product_url"), *carry,
        first_non_empty(first("ld_names"), "og_title", first("h1_texts"), "title").alias("product_name"),
        first_non_empty(first("ld_prices"), "meta_price", price_in_text("body_text")).alias("price"),
        first_non_empty(first("ld_models"), model_in_text("body_text"), model_from_url(url)).alias("model_number"),
        unique_specs(F.concat("ld_specs", "specs"), tidy=True).alias("specs"), unique_faq(F.concat("ld_faq", "faq"), tidy=True).alias("faq"),
        trim_description(first_non_empty(first("ld_descriptions"), first("description_texts"), "body_text")).alias("description_text"),
        unique_strings(F.concat("ld_images", "image_urls")).alias("image_urls"), unique_strings(F.concat("ld_videos", "video_urls")).alias("video_urls"),
        first_non_empty(normalize_availability(first("ld_availability")), availability_from_text("body_text")).alias("availability"),
        "title", "meta_description", "canonical_url", "h1_texts", "body_text",
    )
