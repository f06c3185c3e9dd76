"""Prices, coupons and points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import BLANK, EDGE, LEFT, as_col, compact_spaces, contains_any, extract, extract_if, let, trim_blank

# Price and coupon patterns.
PRICE = rf"(?:¥|￥){BLANK}*([0-9][0-9,]*)|([0-9][0-9,]*){BLANK}*円"
COUPON_AFTER = rf"(?i)([0-9][0-9,]*){BLANK}*円{BLANK}*(?:引き|OFF|オフ)"
COUPON_BEFORE = rf"(?i)(?:¥|￥){BLANK}*([0-9][0-9,]*){BLANK}*(?:OFF|オフ)"
COUPON_WORDS = ("引き", "OFF", "オフ")
PRICE_DECIMAL = rf"(?:¥|￥){BLANK}*[0-9][0-9,]*(?:\.[0-9]+)?|[0-9][0-9,]*(?:\.[0-9]+)?{BLANK}*円"
MODEL = rf"{LEFT}[A-Z]{{1,6}}-[A-Z0-9]{{2,}}[A-Z0-9-]*{EDGE}"


def yen_number(raw: Column) -> Column:
    return F.regexp_replace(raw, ",", "").try_cast("bigint")


def parse_price_yen(c: Column | str) -> Column:
    """struct(price_yen, price_raw) of the first yen amount."""

    def build(text: Column) -> Column:
        amount = extract_if(text, ("¥", "￥", "円"), PRICE, 0)
        # The match holds one run of digits and commas; the rest is marks and blanks.
        return let(
            F.regexp_extract(amount, "[0-9,]+", 0), lambda r: F.struct(yen_number(r).alias("price_yen"), r.alias("price_raw"))
        )

    return let(compact_spaces(c), build)


def parse_coupon_yen(c: Column | str) -> Column:
    """Coupon amount, NULL without one."""

    def build(text: Column) -> Column:
        found = F.coalesce(extract(text, COUPON_AFTER), extract(text, COUPON_BEFORE))
        return F.when(contains_any(F.upper(text), COUPON_WORDS), yen_number(found))

    return let(compact_spaces(c), build)


def remove_coupon_text(c: Column | str, coupon: Column | str) -> Column:
    """The text without the first literal coupon text and without any coupon phrase."""
    text = F.coalesce(as_col(c), F.lit(""))
    coupon = as_col(coupon)
    at = F.instr(text, coupon)
    literal = F.when(
        (F.length(coupon) > 0) & (at > 0),
        F.concat(F.substr(text, F.lit(1), at - 1), F.lit(" "), F.substr(text, at + F.length(coupon))),
    ).otherwise(text)
    return F.regexp_replace(F.regexp_replace(literal, COUPON_AFTER, " "), COUPON_BEFORE, " ")


def final_price(price: Column | str, coupon: Column | str) -> Column:
    """Price less coupon, never below zero; the price itself without a coupon."""
    price, coupon = as_col(price), as_col(coupon)
    both = price.isNotNull() & coupon.isNotNull()
    return F.when(both, F.greatest(F.lit(0).cast("bigint"), price - coupon)).otherwise(price)


def price_in_text(c: Column | str) -> Column:
    """The first amount as written, decimals allowed."""
    return trim_blank(F.nullif(F.regexp_extract(as_col(c), PRICE_DECIMAL, 0), F.lit("")))


def model_in_text(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(as_col(c), MODEL, 0), F.lit(""))


def format_price(price: Column | str, currency: Column | str) -> Column:
    """``CUR N``, or the price alone without a currency; NULL without a price."""
    price = F.nullif(as_col(price), F.lit(""))
    currency = F.nullif(as_col(currency), F.lit(""))
    return F.when(price.isNotNull(), F.concat_ws(" ", currency, price))


def format_yen(c: Column | str) -> Column:
    """Rounded (half up) and grouped by thousands; NULL for a value that is no finite number."""
    value = as_col(c).cast("double")
    finite = ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    return F.when(finite, F.format_number(F.floor(value + 0.5).cast("bigint"), 0))


def strip_price_marks(c: Column | str) -> Column:
    """Amount text without yen marks, commas and blanks."""
    return F.regexp_replace(as_col(c), rf"[￥¥,]|{BLANK}", "")


def mall_price(data_price: Column | str, price_text: Column | str) -> Column:
    """The data attribute, else the text before the yen word without commas."""
    data = trim_blank(F.coalesce(as_col(data_price), F.lit("")))
    before = trim_blank(
        F.regexp_replace(F.substring_index(F.coalesce(as_col(price_text), F.lit("")), "円", 1), ",", "")
    )
    return F.coalesce(F.nullif(data, F.lit("")), before)
