"""Shop listings: mall, merchant, search A and search B pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import mall_price, strip_price_marks
from ..functions.text import (
    BLANK, as_col, compact_spaces, contains_any, crop_before, extract, first_text, null_if_same, trim_blank,
)
from ..functions.urls import absolute_url
from .boxes import Box, Find, box_rows, first_of, first_that, found
from .curate import keep_identified, rank_after_filter
from .dom import chain, token as t
from .joins import NO_CODE

# The code meta tag in both attribute orders.
CODE_META = (
    r"""(?i)<meta[^>]*itemprop=["']gtin13["'][^>]*content=["']([^"']+)""",
    r"""(?i)<meta[^>]*content=["']([^"']+)["'][^>]*itemprop=["']gtin13["']""",
)
# Page classes and words of each field, in the order they are asked.
SOLD_OUT_MARKS = ("売り切れ", "SOLD OUT")
PRICE_SHOWN = [
    chain(t(cls="a-price"), t(cls="a-offscreen")), chain(t(attr=("data-cy", "price-recipe")), t(cls="a-offscreen")),
]
TITLE_A = [
    chain(t("h2"), t("a"), t("span")), chain(t("h2"), t("span")),
    chain(t(attr=("data-cy", "title-recipe")), t("h2"), t("span")),
]
BRAND_A = [
    chain(t(cls=("a-row", "a-size-base", "a-color-secondary")), t(cls=("a-size-base", "a-color-base"))),
    chain(t(cls=("a-size-base-plus", "a-color-base"))),
]
PRICE_A = [
    *PRICE_SHOWN, chain(t(cls="a-price-range"), t(cls="a-offscreen")), chain(t(cls="a-price-whole")),
]
TITLE_B = [chain(t(cls="bcs_title"), t("a")), chain(t(cls="bcs_comp_title"), t("a")), chain(t("a", cls="bcs_item"))]
CATEGORY_B = [
    chain(t(cls="bcs_category"), t("a")), chain(t(cls="bcs_category"), t("span")),
    chain(t(part="category"), t("a")), chain(t(part="category"), t("span")),
]
STOCK_WORDS_B = ("在庫", "お取り寄せ", "販売終了", "予定数終了", "入荷次第", "カートに入れる", "出荷", "送料無料")


def jan_from_html(html: Column | str) -> Column:
    """The 13-digit code from a detail page, straight from the HTML text; the placeholder without one."""
    raw = F.coalesce(*[extract(as_col(html), p) for p in CODE_META])
    return F.coalesce(F.substring(trim_blank(raw), 1, 13), F.lit(NO_CODE))


def review_count(links: Column, labels: Column) -> Column:
    """Number in parentheses or first number of the first review link that has one, else of the labels."""
    from_links = F.get(
        F.filter(
            F.transform(links, lambda t: F.coalesce(extract(t, r"\(([0-9,]+)\)"), extract(t, r"([0-9][0-9,]*)"))),
            lambda v: v.isNotNull(),
        ),
        F.lit(0),
    )
    from_labels = F.get(
        F.filter(
            F.transform(
                labels,
                lambda t: F.when(t.rlike(r"^[0-9,]+$"), t).when(t.rlike("(?i)評価|rating|件"), extract(t, r"([0-9,]+)")),
            ),
            lambda v: v.isNotNull(),
        ),
        F.lit(0),
    )
    return F.coalesce(from_links, from_labels)


def delivery_label(texts: Column) -> Column:
    return F.get(F.filter(texts, lambda t: t.rlike("(?i)prime|お届け|配送|明日|本日")), F.lit(0))


def coupon_label(texts: Column) -> Column:
    return F.get(F.filter(texts, lambda t: F.contains(t, F.lit("クーポン")) & (F.length(t) <= 80)), F.lit(0))


def is_sponsored(text: Column | str) -> Column:
    return contains_any(as_col(text), ("スポンサー",))


_HEADING = (chain(t("h2"), t("a")),)
MALL = Box((chain(t(cls="searchresultitem")),), {
    "title": Find(_HEADING), "link": Find(_HEADING, "attrs"), "price_text": Find((chain(t(part="price-wrapper")),)),
    "data_price": Find((chain(t(attr=("data-price", "given", None))),), "attrs"), "points_text": Find((chain(t(part="points--"), t("span")),)),
    "gone_class": Find((chain(t(part="soldout")),), "attrs"),
}, text="text")


def extract_mall_items(pages: DataFrame, carry: Sequence[str] = ("url",)) -> DataFrame:
    """Mall list rows; rows without title or link are dropped."""
    boxes = box_rows(pages, MALL, tuple(carry))
    price = first_of("price_text", trim_blank)
    data_price = F.nullif(trim_blank(F.get(F.col("data_price"), F.lit(0))["data-price"]), F.lit(""))
    rows = boxes.select(
        "page_id", *[c for c in carry if c != "url"], F.col("box_id").alias("item_pos"), first_of("title", trim_blank).alias("title"),
        absolute_url("url", F.nullif(F.get(F.col("link"), F.lit(0))["href"], F.lit(""))).alias("url"), mall_price(data_price, price).alias("price"),
        crop_before(F.coalesce(first_of("points_text", trim_blank), F.lit("")), "ポイント").alias("points"),
        (contains_any(F.col("text"), SOLD_OUT_MARKS) | found("gone_class")).alias("soldout"),
        contains_any(price, ("〜",)).alias("has_variation"),
    )
    return keep_identified(rows, all_of=("title", "url"))


MERCHANT = Box((chain(t(cls="s-main-slot"), t(attr="data-asin")),), {
    # Of titles and shown prices the first in the document counts, whichever chain it answers to.
    "title": Find(((chain(t("h2"), t("a"), t("span")), chain(t("h2"), t("span"))),)),
    "shown": Find((tuple(PRICE_SHOWN),)), "whole": Find((chain(t(cls="a-price-whole")),)), "fraction": Find((chain(t(cls="a-price-fraction")),)),
})


def extract_merchant_items(pages: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Merchant list rows; the first box of an item code on a page counts."""
    boxes = box_rows(pages, MERCHANT, tuple(carry))
    whole = first_of("whole", trim_blank)
    price = F.coalesce(strip_price_marks(first_of("shown")), F.when(whole.isNotNull(), F.concat_ws(".", whole, first_of("fraction", trim_blank))), F.lit(""))
    rows = boxes.select("page_id", *carry, F.col("box_id").alias("item_pos"), F.col("attrs")["data-asin"].alias("asin"), trim_blank(F.get(F.col("title"), F.lit(0))).alias("title"), price.alias("price"))
    first = Window.partitionBy("page_id", "asin").orderBy("item_pos")
    unique = rows.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").filter(F.col("title").isNotNull())
    return unique.select("page_id", *carry, "item_pos", "asin", "title", "price")


_RESULT = t(attr=("data-component-type", "s-search-result"))
SEARCH_A = Box((chain(t(cls="s-main-slot"), _RESULT),), {
    "title": Find(tuple(TITLE_A)), "brand": Find(tuple(BRAND_A)), "price": Find(tuple(PRICE_A)), "rating": Find((chain(t(cls="a-icon-alt")),)),
    "reviews": Find((chain(t("a", attr=("href", "holds", "customerReviews"))),), "node", every=True),
    "review_labels": Find((
        chain(t(attr=("aria-label", "holds", "件の評価"))), chain(t(attr=("aria-label", "holds", "ratings"))),
        chain(t("a", attr=("href", "holds", "customerReviews")), t("span"))), every=True),
    "delivery": Find((
        chain(t(attr=("aria-label", "holds", "Prime"))), chain(t(cls="a-icon-prime")), chain(t(attr=("data-cy", "delivery-recipe")), t("span")),
        chain(t(cls=("a-color-base", "a-text-bold"))), chain(t(cls=("a-color-base", "a-size-base")))), every=True),
    "coupons": Find((chain(t(cls="s-coupon-unclipped")), chain(t(part="coupon")), chain(t(attr=("aria-label", "holds", "クーポン"))), chain(t("span"))), every=True),
    "image": Find((chain(t("img")),), "attrs"),
    "links": Find(((chain(t("h2"), t("a")), chain(t("a", cls=("a-link-normal", "s-no-outline")))),), "attrs"),
}, text="text")


def extract_search_items_a(pages: DataFrame, n: int = 20, carry: Sequence[str] = ("url",)) -> DataFrame:
    return search_items_a(box_rows(pages, SEARCH_A, tuple(carry)), n, carry)


def search_items_a(boxes: DataFrame, n: int = 20, carry: Sequence[str] = ("url",)) -> DataFrame:
    """Search shop A: the first ``n`` boxes of a page with their rank; rows that name nothing are dropped after."""
    clean = compact_spaces

    def number(x: Column) -> Column:
        said = F.coalesce(F.nullif(clean(x["attrs"]["aria-label"]), F.lit("")), clean(x["text"]))
        return F.coalesce(extract(said, r"\(([0-9,]+)\)"), extract(said, r"([0-9][0-9,]*)"))

    def counted(x: Column) -> Column:
        return F.when(clean(x).rlike("^[0-9,]+$"), clean(x)).when(clean(x).rlike("(?i)評価|rating|件"), extract(clean(x), "([0-9,]+)"))

    boxes = boxes.withColumn("asin", F.nullif(clean(F.col("attrs")["data-asin"]), F.lit(""))).filter(F.col("asin").isNotNull())
    # Ranks go by the boxes of one page; numbering them cuts each task's rows to ``n`` a page before they meet.
    order = Window.partitionBy("page_id").orderBy("box_id")
    found_rows = boxes.select(
        "page_id", *carry, "box_id", "asin", *[first_of(c, clean, len(chains)).alias(c) for c, chains in {"title": TITLE_A, "brand": BRAND_A, "price": PRICE_A, "rating": (0,)}.items()],
        F.coalesce(first_that("reviews", number), first_that("review_labels", counted)).alias("review_count"), is_sponsored(clean("text")).alias("is_sponsored"),
        first_that("delivery", clean, lambda v: v.rlike("(?i)prime|お届け|配送|明日|本日")).alias("prime_or_delivery_label"),
        first_that("coupons", clean, lambda v: F.contains(v, F.lit("クーポン")) & (F.length(v) <= 80)).alias("coupon_label"),
        F.nullif(F.get(F.col("image"), F.lit(0))["src"], F.lit("")).alias("image"), F.nullif(F.get(F.col("links"), F.lit(0))["href"], F.lit("")).alias("link"),
    )
    ranked = found_rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= max(1, n))
    rows = ranked.select(
        "page_id", *[c for c in carry if c != "url"], "rank", "asin", "title", null_if_same("brand", "title").alias("brand"), "price", "rating",
        "review_count", "is_sponsored", "prime_or_delivery_label", "coupon_label", absolute_url("url", "image").alias("image_url"),
        absolute_url("url", "link").alias("product_url"),
    )
    return keep_identified(rows, any_of=("asin", "title", "product_url"))


_PRODUCT_B = chain(t("a", attr=("href", "holds", "/bc/item/")))
SEARCH_B = Box((chain(t("li", cls="prod_box")), chain(t(id="ga_itam_list"), t("li", id_start="bcs_item")), chain(t(cls="bcs_listItem"), t("li"))), {
    "product": Find((_PRODUCT_B,), "attrs"), "links": Find(((*TITLE_B, _PRODUCT_B),), "attrs"), "title": Find(tuple(TITLE_B)), "image": Find((chain(t("img")),), "attrs"),
    "price": Find((chain(t(cls="bcs_price"), t(cls="val")), chain(t(cls="bcs_price")), chain(t(part="price")), chain(t("span")), chain(t("p"))), every=True),
    "points": Find((chain(t(cls="bcs_point"), t("span")), chain(t(cls="bcs_point")), chain(t(part="point")), chain(t("span")), chain(t("p"))), every=True),
    "stock": Find((chain(t(cls="bcs_zaiko")), chain(t(cls="bcs_nouki")), chain(t(part="zaiko")), chain(t(part="nouki")), chain(t("button")), chain(t("span")),
                   chain(t("p"))), every=True),
    "category": Find(tuple(CATEGORY_B)),
})


def extract_search_items_b(pages: DataFrame, n: int = 20, carry: Sequence[str] = ("url",)) -> DataFrame:
    return search_items_b(box_rows(pages, SEARCH_B, tuple(carry)), n, carry)


def search_items_b(boxes: DataFrame, n: int = 20, carry: Sequence[str] = ("url",)) -> DataFrame:
    """Search shop B: boxes with a product link, first per product URL, ranked 1..n per page."""
    clean = compact_spaces
    boxes = boxes.filter(found("product"))
    image = F.get(F.col("image"), F.lit(0))
    srcset = F.get(F.split(F.get(F.split(clean(image["srcset"]), ","), F.lit(0)), BLANK), F.lit(0))
    title = F.coalesce(first_of("title", clean, len(TITLE_B)), F.nullif(clean(image["alt"]), F.lit("")))
    rows = boxes.select(
        "page_id", *[c for c in carry if c != "url"], "box_id", title.alias("title"),
        first_that("price", clean, lambda v: (F.length(v) <= 40) & v.rlike("[¥￥]|円|税込") & v.rlike("[0-9]")).alias("price"),
        first_that("points", clean, lambda v: (F.length(v) <= 80) & v.rlike("ポイント|還元|%")).alias("point_label"),
        first_that("stock", clean, lambda v: (F.length(v) <= 120) & contains_any(v, STOCK_WORDS_B)).alias("stock_label"),
        absolute_url("url", F.nullif(F.get(F.col("links"), F.lit(0))["href"], F.lit(""))).alias("product_url"),
        absolute_url("url", first_text(image["src"], image["data-src"], srcset)).alias("image_url"),
        first_of("category", clean, len(CATEGORY_B)).alias("_category"),
    ).withColumn("category_label", null_if_same("_category", "title")).drop("_category")
    kept = F.coalesce(F.length("title") > 0, F.lit(False)) | F.col("product_url").isNotNull()
    ranked = rank_after_filter(rows, ["page_id"], "product_url", ["box_id"], kept, n)
    return ranked.drop("box_id")
