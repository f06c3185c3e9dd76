"""Fixed record schemas as DDL text. Codes stay strings; nothing is inferred."""

MALL_ITEMS = (
    "jan STRING, title STRING, price STRING, points STRING, url STRING, soldout BOOLEAN, has_variation BOOLEAN, crawled_at TIMESTAMP"
)
MERCHANT_ITEMS = ("asin STRING, title STRING, price STRING")
MAKER_ITEMS = (
    "jan STRING, title STRING, price STRING, button_text STRING, discount_price STRING, crawled_at TIMESTAMP"
)
# Positional snapshot files (no header): the columns of each shop's file.
MALL_SNAPSHOT = (
    "jan STRING, title STRING, price STRING, points STRING, crawled_at STRING, soldout_label STRING, variation_label STRING"
)
MERCHANT_SNAPSHOT = ("blank STRING, title STRING, price STRING, asin STRING")
MAKER_SNAPSHOT = (
    "jan STRING, title STRING, price STRING, button_text STRING, discount_price STRING, crawled_at STRING"
)
VIEWPORT = "STRUCT<width: INT, height: INT>"
CAPTURE_META = (
    "project STRING, target STRING, query STRING, url STRING, finalUrl STRING, crawledAt STRING, locale STRING, "
    f"timezone STRING, viewport {VIEWPORT}, headless BOOLEAN, loginStateLabel STRING, profileName STRING, "
    "blocked BOOLEAN, error STRUCT<name: STRING, message: STRING, stack: STRING>, httpStatus INT, status STRING"
)
PROJECT_CONFIG = (
    "project STRING, locale STRING, timezone STRING, viewport STRUCT<width: DOUBLE, height: DOUBLE>, headless BOOLEAN, "
    "officialUrls ARRAY<STRING>, queries MAP<STRING, ARRAY<STRING>>, loginStateLabel STRING, profileName STRING, "
    "outputFormats ARRAY<STRING>"
)
PRICE_FEED = (
    "code STRING, priceData STRUCT<formattedValue: STRING, value: STRING>, "
    "discountPriceData STRUCT<formattedValue: STRING, value: STRING>"
)
SEARCH_A_ITEM = (
    "rank INT, asin STRING, title STRING, brand STRING, price STRING, rating STRING, review_count STRING, "
    "is_sponsored BOOLEAN, prime_or_delivery_label STRING, coupon_label STRING, image_url STRING, product_url STRING"
)
SEARCH_B_ITEM = (
    "rank INT, title STRING, price STRING, point_label STRING, stock_label STRING, product_url STRING, image_url STRING, "
    "category_label STRING"
)
QUERY_PLAN = (
    "project STRING, source STRING, target STRING, query STRING, status STRING, crawled_at STRING, notes STRING"
)
