"""Stock and availability labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col, blank_to_null, compact_spaces, contains_any, let, trim_blank

# Stock words, tested in this order.
IN_STOCK_WORDS = ("在庫あり", "即納", "販売中", "翌日出荷", "当日出荷")
OUT_OF_STOCK_WORDS = ("在庫切れ", "売り切れ", "入荷待ち", "お取り寄せ", "予約", "販売終了", "終息")
AVAILABLE_VALUES = ("instock", "in stock", "available", "在庫あり")
SOLD_OUT_VALUES = ("outofstock", "out of stock", "sold out", "売り切れ ", "在庫なし")
PREORDER_VALUES = ("preorder", "pre-order")
SOLD_OUT_PHRASES = ("売り切れ", "在庫なし", "sold out", "out of stock")


def normalize_stock(c: Column | str) -> Column:
    """struct(in_stock, in_stock_label, stock_status); in_stock stays NULL when unknown."""

    def build(text: Column) -> Column:
        here = contains_any(text, IN_STOCK_WORDS)
        gone = contains_any(text, OUT_OF_STOCK_WORDS)
        return F.struct(
            F.when(here, True).when(gone, False).alias("in_stock"),
            blank_to_null(text).alias("in_stock_label"),
            F.when(here, "in-stock").when(gone, "out-of-stock").alias("stock_status"),
        )

    return let(compact_spaces(c), build)


def normalize_availability(c: Column | str) -> Column:
    """Structured-data availability to a code; other text passes. "unavailable" counts as available."""
    text = trim_blank(F.coalesce(as_col(c), F.lit("")))
    lowered = F.lower(text)
    return (
        F.when(text == "", F.lit(None).cast("string"))
        .when(contains_any(lowered, AVAILABLE_VALUES), "in_stock")
        .when(contains_any(lowered, SOLD_OUT_VALUES), "out_of_stock")
        .when(contains_any(lowered, PREORDER_VALUES), "preorder")
        .otherwise(text)
    )


def availability_from_text(c: Column | str) -> Column:
    text = F.lower(as_col(c))
    return (
        F.when(contains_any(text, ("在庫あり",)), "in_stock")
        .when(contains_any(text, SOLD_OUT_PHRASES), "out_of_stock")
        .when(contains_any(text, ("available", "in stock")), "in_stock")
    )
