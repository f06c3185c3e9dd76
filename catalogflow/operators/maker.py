"""Maker shop: product links, variants with codes, detail pages, price feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import format_yen, strip_price_marks
from ..functions.text import blank_to_null, extract, normalize_ws, trim_blank
from ..functions.urls import host_prefixed
from .boxes import DOCUMENT, Box, Find, box_rows, first_of, first_that
from .dom import chain, token as t

# Page classes in the order they are asked, words of the buy button.
BUTTON = [
    chain(t("a", cls="pdp-buy-btn-link")), chain(t("button", cls="salesInquiryModal")), chain(t(cls="wtbBtbwWithIcon")),
    chain(t("a", attr=("href", "#buy-btn"))),
    chain(t("button", part="salesInquiry")),
]
PRICE = [
    chain(t(part="price"), t("span")), chain(t("span", part="price")), chain(t("p", part="price")), chain(t(part="priceValue")),
]
OLD_PRICE = [chain(t(part="discount")), chain(t(part="original-price"))]
BUTTON_WORDS = "(購入する|販売店を探す|担当営業へのお問い合わせ)"
CODE = r"\(JAN[\s\x{00A0}\x{3000}]+(\d+)\)"
NUMBER_PREFIX = r"^製品型番:[\s\x{00A0}\x{3000}]*[^\s\x{00A0}\x{3000}]+[\s\x{00A0}\x{3000}]*"
NO_PRICE = "-"


def extract_product_links(nodes: DataFrame, host: str, url: str = "url") -> DataFrame:
    """Distinct product links of list pages: page_id, first_pos, product_url."""
    href = F.col("attrs")["href"]
    ok = (
        (F.col("tag") == "a") & F.contains(href, F.lit("/products/")) & F.contains(href, F.lit("sku="))
        & ~F.contains(href, F.lit("#")) & ~F.endswith(href, F.lit("/products"))
    )
    links = nodes.filter(ok).select(F.struct("page_id", "node_id").alias("at"), host_prefixed(host, href).alias("product_url"))
    return links.groupBy("product_url").agg(F.min("at").alias("at")).select(
        F.col("at.page_id").alias("page_id"), F.col("at.node_id").alias("first_pos"), "product_url"
    )


VARIANTS = Box((chain(t(cls="product-sku-list"), t(cls="show-for-b2c"), t("a")),), {}, beside=1, of_parent=True)


def extract_variants(pages: DataFrame, host: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Variant links with the code in the text of the element after theirs: page_id, carry, variant_pos, jan, variant_url."""
    pairs = box_rows(pages, VARIANTS, carry).select(
        "page_id", *carry, F.col("box_id").alias("variant_pos"), extract(F.get(F.col("beside"), F.lit(0))["text"], CODE).alias("jan"),
        blank_to_null(F.col("attrs")["href"]).alias("href"),
    )
    kept = pairs.filter(F.col("jan").isNotNull() & F.col("href").isNotNull())
    return kept.select("page_id", *carry, "variant_pos", "jan", host_prefixed(host, "href").alias("variant_url"))


def _after_yen(c: Column) -> Column:
    """The amount after the first yen mark up to a blank; '' without one."""
    part = F.get(F.split(trim_blank(c), "¥"), F.lit(1))
    return F.coalesce(trim_blank(F.get(F.split(part, r"[\s\x{00A0}\x{3000}]"), F.lit(0))), F.lit(""))


DETAIL = Box((DOCUMENT,), {"heading": Find((chain(t("h1")),)), "button": Find(tuple(BUTTON), every=True), "price": Find(tuple(PRICE), every=True), "old": Find((tuple(OLD_PRICE),))},
             text="shown")


def extract_detail(pages: DataFrame, url: str = "url") -> DataFrame:
    """Per detail page: title, button text, price on the page, old price. The page is the box."""
    found = box_rows(pages, DETAIL, (url,)).select(
        "page_id", url, first_of("heading", normalize_ws).alias("heading"), first_that("button", trim_blank).alias("button"),
        extract(normalize_ws("text"), BUTTON_WORDS).alias("words"), first_of("old", trim_blank).alias("old"),
        _after_yen(F.get(F.filter("price", lambda x: F.contains(x["v"], F.lit("¥")) & (F.length(_after_yen(x["v"])) > 0)), F.lit(0))["v"]).alias("price"),
    )
    found = found.withColumn("price", F.nullif("price", F.lit("")))
    title = trim_blank(F.regexp_replace("heading", NUMBER_PREFIX, ""))
    return found.select(
        "page_id", url, F.coalesce(blank_to_null(title), F.col("heading"), F.lit("")).alias("title"),
        F.coalesce("button", "words", F.lit("")).alias("button_text"), F.col("price").alias("page_price"),
        F.when(F.contains("old", F.lit("¥")), blank_to_null(_after_yen(F.col("old")))).alias("old_price"),
    )


def feed_price(feed: Column | str) -> Column:
    """Price of a feed entry: discount before list, formatted text before number; NULL without one."""
    entry = F.col(feed) if isinstance(feed, str) else feed
    chosen = F.coalesce(entry["discountPriceData"], entry["priceData"])
    shown = blank_to_null(chosen["formattedValue"])
    return F.coalesce(blank_to_null(strip_price_marks(shown)), format_yen(chosen["value"].try_cast("double")))


def complete_detail(detail: DataFrame, from_feed: Column | str, from_data: Column | str) -> DataFrame:
    """Price from the page, the feed or the structured data, else ``-``; the old price only for an "actual" price."""
    def none(c: Column | str) -> Column:
        c = F.col(c) if isinstance(c, str) else c
        return F.nullif(blank_to_null(c), F.lit(NO_PRICE))

    price = F.coalesce(none("page_price"), none(from_feed), none(from_data), F.lit(NO_PRICE))
    priced = detail.withColumn("price", price)
    actual = F.contains(F.lower("price"), F.lit("actual"))
    old = F.when(actual, F.coalesce("old_price", F.lit(NO_PRICE))).otherwise(NO_PRICE)
    return priced.withColumn("discount_price", old).drop("page_price", "old_price")
