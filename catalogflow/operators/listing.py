"""Component listings: boxes to raw text fields, raw fields to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_sale_end, parse_sale_period
from ..functions.money import final_price, parse_coupon_yen, parse_price_yen, remove_coupon_text
from ..functions.specs import memory_specs_tags, memory_type_label, pick_type_label, ssd_specs
from ..functions.stock import normalize_stock
from ..functions.text import as_col, blank_to_null, combined_text, compact_spaces, first_text, trim_blank
from ..functions.urls import absolute_url, image_attr, product_number
from .boxes import Box, Find, box_rows, first_of
from .dom import Chain, chain, token as t

ITEM_BOX = t(cls="item_listbox")
# The page's classes for each field, in the order they are asked.
FIELD_CHAINS: dict[str, list[Chain]] = {
    "maker_text": [
        chain(t(cls="manufacturer"), t("a")), chain(t(cls="manufacturer")), chain(t(cls="brand"), t("a")),
        chain(t(cls="brand")), chain(t(cls="brand_series"), t(cls="brand"), t("a")),
    ],
    "product_name_text": [chain(t(cls="itemname1"), t("a")), chain(t(cls="itemname1"))],
    "product_number_text": [chain(t(cls="modelnum"))],
    "original_price_text": [chain(t(cls="real_price_box"), t(cls="real_price"))],
    "final_price_text": [
        chain(t(cls="price_box"), t(cls="price")), chain(t(cls="price_box_2"), t(cls="price")),
        chain(t(cls="price_box_2")), chain(t(cls="price_box")),
    ],
    "coupon_text": [
        chain(t(cls=("price_diff_2", "auto_coupon")), t("p")), chain(t(cls=("price_diff_2", "auto_coupon"))),
    ],
    "sale_text": [chain(t(cls="date-diff2"))],
    "stock_text": [chain(t(cls="nouki-msg"))],
    "spec_text": [chain(t(cls="itemname2"))],
}
TAG_CHAINS = [chain(t(cls="item-tags"), t("a")), chain(t(cls="itemtag"), t("a"))]
TAG_TEXT = chain(t(cls="itemtag"))


COMPONENT = Box((chain(ITEM_BOX),), {
    **{name: Find(tuple(chains)) for name, chains in FIELD_CHAINS.items()},
    "link": Find((chain(t("a", attr=("href", "starts", "/i/"))),), "attrs"),
    "image": Find((chain(t("img", cls="item-img")), chain(t("img"))), "attrs"),
    "tags_1": Find((TAG_CHAINS[0],), every=True), "tags_2": Find((TAG_CHAINS[1],), every=True), "tag_text": Find((TAG_TEXT,)),
})


def extract_component_items(pages: DataFrame, carry: Sequence[str] = ("url", "source_pos", "page_no")) -> DataFrame:
    """Raw text of each listing box. ``pages`` carries the page URL and its place in the run.

    The boxes are filled while the page is read; nothing is shuffled.
    """
    found = box_rows(pages, COMPONENT, tuple(carry))
    # A found image counts even when it has no address, hence the mark in front.
    image = [F.concat(F.lit("="), F.coalesce(image_attr(F.get(F.col("image"), F.lit(i))), F.lit(""))) for i in (0, 1)]
    image = F.coalesce(*[F.when(F.get(F.col("image"), F.lit(i)).isNotNull(), v) for i, v in enumerate(image)])
    filled = [F.filter(F.transform(F.col(n), lambda x: trim_blank(x["v"])), lambda v: v != "") for n in ("tags_1", "tags_2")]
    tag_text = F.nullif(trim_blank(F.get(F.col("tag_text"), F.lit(0))), F.lit(""))
    plain = F.when(tag_text.isNotNull(), F.array(tag_text)).otherwise(F.array().cast("array<string>"))
    tags = F.when(F.size(filled[0]) > 0, filled[0]).when(F.size(filled[1]) > 0, filled[1]).otherwise(plain)
    raw = found.select(
        "page_id", *[c for c in carry if c != "url"], F.col("box_id").alias("item_pos"),
        absolute_url("url", F.get(F.col("link"), F.lit(0))["href"], empty_is_base=True).alias("item_url"), F.col("url").alias("source_url"),
        absolute_url("url", F.substr(image, F.lit(2)), empty_is_base=True).alias("image_url"),
        *[F.coalesce(first_of(n, choices=len(chains)), F.lit("")).alias(n) for n, chains in FIELD_CHAINS.items()], tags.alias("tags"),
    ).withColumnRenamed("item_url", "url")
    order = (
        "maker_text", "product_name_text", "product_number_text", "original_price_text", "final_price_text",
        "coupon_text", "sale_text", "stock_text", "spec_text",
    )
    return raw.withColumn("combined_text", combined_text(*order, F.array_join("tags", " ")))


def type_component(raw: DataFrame, run_at: Column | str) -> DataFrame:
    """Raw listing rows to typed base columns; ``tags``, ``spec_text`` and ``full_text`` stay for the kind step.

    Each stage is a projection over the one before, so every pattern runs once per row.
    """
    run_at = as_col(run_at)
    full = raw.filter(F.length("url") > 0).withColumn("full_text", compact_spaces("combined_text"))
    parsed = full.withColumns(
        {
            "_coupon": parse_coupon_yen(first_text("coupon_text", "full_text")),
            "_price": parse_price_yen(
                first_text("final_price_text", remove_coupon_text("full_text", "coupon_text"))
            ),
            "_original": parse_price_yen("original_price_text")["price_yen"],
            "_sale": parse_sale_period(first_text("sale_text", "full_text"), run_at),
            "_stock": normalize_stock("stock_text"),
        }
    )
    price = final_price(F.col("_price.price_yen"), F.col("_coupon"))
    order = [c for c in ("page_id", "source_pos", "page_no", "item_pos") if c in raw.columns]
    return parsed.select(
        *order, "url", "source_url", blank_to_null("image_url").alias("image_url"),
        product_number(first_text("product_number_text", "full_text"), "url").alias("product_number"),
        blank_to_null(compact_spaces("maker_text")).alias("maker_name"),
        blank_to_null(compact_spaces("product_name_text")).alias("product_name"),
        price.alias("price_yen"), F.col("_price.price_raw").alias("price_raw"),
        F.coalesce("_original", "_price.price_yen").alias("original_price_yen"), price.alias("final_price_yen"),
        "_stock.in_stock", "_stock.in_stock_label", "_stock.stock_status",
        "_sale.sale_period_raw", "_sale.sale_start", "_sale.sale_end",
        parse_sale_end("sale_text", run_at).alias("sale_end_guess_jst"),
        "tags", "spec_text", "full_text",
    )


def memory_items(typed: DataFrame) -> DataFrame:
    specs = typed.withColumn("_s", memory_specs_tags(F.col("tags"), first_text("spec_text", "full_text")))
    label = memory_type_label(pick_type_label(F.col("tags")), "spec_text", F.col("_s.memory_ddr"))
    base = [c for c in typed.columns if c not in ("tags", "spec_text", "full_text")]
    return specs.select(*base, label.alias("memory_type_label"), F.col("tags").alias("item_tags"), "_s.*")


def ssd_items(typed: DataFrame) -> DataFrame:
    specs = typed.withColumn("_s", ssd_specs(F.col("tags"), first_text("spec_text", "full_text")))
    return specs.select(*[c for c in typed.columns if c not in ("tags", "spec_text", "full_text")], "_s.*")
