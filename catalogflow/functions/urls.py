"""URL columns: resolving, labels, parameters, predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import BLANK, NOT_BLANK, as_col, blank_to_null, compact_spaces, extract, extract_if, let, normalize_ws, trim_blank

# The parts of a URL: 1 scheme, 2 authority, 3 path, 4 "?query", 5 "#fragment".
PARTS = r"^([A-Za-z][A-Za-z0-9+.\-]*):(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"
ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
WEB = r"(?i)^https?://[^/?#\s]+"
# Last path parts that are category pages, not products.
CATEGORY_LEAVES = (
    "products", "hdd", "data-center-storage", "network-attached-storage", "accessories", "weekly-sale", "clearance",
)


def url_host(c: Column | str) -> Column:
    """Host name without port and user, NULL when the text is no absolute web URL."""
    host = F.regexp_replace(F.regexp_extract(as_col(c), PARTS, 2), "^.*@", "")
    return F.when(as_col(c).rlike(WEB), F.lower(F.regexp_replace(host, r":\d*$", "")))


def url_path(c: Column | str) -> Column:
    return F.when(as_col(c).rlike(WEB), F.regexp_extract(as_col(c), PARTS, 3))


def path_parts(c: Column | str) -> Column:
    """Non-empty path segments, NULL when the text is no absolute web URL."""
    return F.filter(F.split(url_path(c), "/"), lambda v: v != "")


def query_param(c: Column | str, name: str) -> Column:
    """Decoded value of the first parameter of that name."""
    query = F.regexp_extract(as_col(c), PARTS, 4)
    raw = F.regexp_extract(query, rf"[?&]{name}=([^&]*)", 1)
    return F.when(query.rlike(rf"[?&]{name}(=|&|$)"), F.coalesce(F.try_url_decode(raw), raw))


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments; text without them passes through untouched."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    tail = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    joined = F.regexp_replace(F.concat(F.array_join(folded, "/"), tail), "^/*", "/")
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), joined).otherwise(path)


def _percent(c: Column) -> Column:
    """Percent-encode blanks, quotes, angle brackets and everything outside ASCII."""
    special = r"[^\x21-\x7E]|[\"<>]"
    encoded = F.transform(
        F.split(c, ""),
        lambda ch: F.when(ch == " ", "%20").when(ch.rlike(special), F.url_encode(ch)).otherwise(ch),
    )
    return F.when(c.rlike(special), F.array_join(encoded, "")).otherwise(c)


def _tidy(c: Column) -> Column:
    """Canonical absolute URL: lower-case scheme and host, ``/`` for an empty path, no dot segments."""
    scheme = F.lower(F.regexp_extract(c, PARTS, 1))
    host = F.lower(F.regexp_extract(c, PARTS, 2))
    path = F.regexp_extract(c, PARTS, 3)
    web = scheme.isin("http", "https")
    path = F.when(web & (path == ""), "/").when(web, _without_dots(path)).otherwise(path)
    slashes = F.when(c.rlike(r"^[^:]+://"), F.lit("//")).otherwise(F.lit(""))
    rest = F.concat(F.regexp_extract(c, PARTS, 4), F.regexp_extract(c, PARTS, 5))
    whole = F.concat(scheme, F.lit(":"), slashes, host, _percent(F.concat(path, rest)))
    return F.when(~web | (host != ""), whole)


def absolute_url(base: Column | str, href: Column | str, empty_is_base: bool = False) -> Column:
    """Resolve ``href`` against ``base``; NULL when either is unusable.

    A blank ``href`` gives NULL, or the base page itself with ``empty_is_base``.
    """
    base, href = as_col(base), trim_blank(F.coalesce(as_col(href), F.lit("")))

    def build(h: Column) -> Column:
        has_base = base.rlike(WEB)
        scheme = F.regexp_extract(base, PARTS, 1)
        origin = F.concat(scheme, F.lit("://"), F.regexp_extract(base, PARTS, 2))
        path = F.regexp_extract(base, PARTS, 3)
        path = F.when(path == "", "/").otherwise(path)
        folder = F.regexp_replace(path, "[^/]*$", "")
        page = F.concat(origin, path, F.regexp_extract(base, PARTS, 4))
        blank = page if empty_is_base else F.lit(None).cast("string")
        full = (
            F.when((h == "") & has_base, blank)
            .when(h == "", F.lit(None).cast("string"))
            .when(h.rlike(ABSOLUTE), h)
            .when(~has_base, F.lit(None).cast("string"))
            .when(F.startswith(h, F.lit("//")), F.concat(scheme, F.lit(":"), h))
            .when(F.startswith(h, F.lit("/")), F.concat(origin, h))
            .when(F.startswith(h, F.lit("?")), F.concat(origin, path, h))
            .when(F.startswith(h, F.lit("#")), F.concat(page, h))
            .otherwise(F.concat(origin, folder, h))
        )
        return let(full, _tidy)

    return let(href, build)


def host_prefixed(host: str, href: Column | str) -> Column:
    """Links that are not https already get the shop's host in front."""
    href = as_col(href)
    return F.when(F.startswith(href, F.lit("https")), href).otherwise(F.concat(F.lit(host), href))


def product_number(text: Column | str, url: Column | str) -> Column:
    """The value after a number label, else the last URL path part of four or more characters."""
    # Labels in the order they are tried.
    labels = {"商品番号": "商品番号", "商品コード": "商品コード", "型番": "型番", "品番": "品番", "SKU": "(?i)SKU"}
    mark = rf"{BLANK}*[:：]{BLANK}*({NOT_BLANK}+)"

    def labelled(t: Column) -> Column:
        upper = F.upper(t)
        return F.coalesce(*[extract_if(t, (word,), label + mark, within=upper) for word, label in labels.items()])

    last = F.try_element_at(path_parts(url), F.lit(-1))
    return F.coalesce(let(compact_spaces(text), labelled), F.when(F.length(last) >= 4, last))


def model_from_url(c: Column | str) -> Column:
    """Decoded last path part; NULL for no path or a bad encoding. A plus stays a plus."""
    last = F.try_element_at(path_parts(c), F.lit(-1))
    return F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B")))


def capture_number(index: Column | str) -> Column:
    """One-based counter of at least two digits."""
    n = (as_col(index) + 1).cast("string")
    return F.lpad(n, F.greatest(F.lit(2), F.length(n)), F.lit("0"))


def query_label(query: Column | str, index: Column | str) -> Column:
    """``NN-query-words`` for a file name, at most 80 characters of the query."""
    slug = F.regexp_replace(normalize_ws(F.coalesce(as_col(query), F.lit(""))), BLANK + "+", "-")
    slug = F.substring(F.regexp_replace(slug, r'[\\/:*?"<>|]+', "-"), 1, 80)
    return F.concat(capture_number(index), F.lit("-"), F.coalesce(blank_to_null(slug), F.lit("query")))


def url_label(url: Column | str, index: Column | str) -> Column:
    """``NN-host-part-part``; text that is no URL stays as it is."""
    url = as_col(url)
    slug = F.array_join(F.concat(F.array(url_host(url)), path_parts(url)), "-")
    return F.concat(capture_number(index), F.lit("-"), F.coalesce(slug, url))


def safe_segment(c: Column | str, default: str = "unknown-project") -> Column:
    text = trim_blank(F.regexp_replace(F.coalesce(as_col(c), F.lit("")), r"[\\/]", "-"))
    return F.coalesce(blank_to_null(text), F.lit(default))


def search_url(base: str, param: str, query: Column | str, page: Column | int | None = None) -> Column:
    """``base?param=query``, with the page from the second one on."""
    url = F.concat(F.lit(f"{base}?{param}="), F.url_encode(as_col(query)))
    if page is None:
        return url
    page = page if isinstance(page, Column) else F.lit(page)
    return F.when(page > 1, F.concat(url, F.lit("&page="), page.cast("string"))).otherwise(url)


def merchant_urls(base: str, marketplace: str, merchant: Column | str, page: Column, epoch: Column) -> Column:
    """The five candidate list URLs of one merchant page, distinct, in order."""
    me = F.concat(F.lit("me="), F.url_encode(as_col(merchant)))
    market = F.concat(F.lit("marketplaceID="), F.url_encode(F.lit(marketplace)))
    at = F.when(page > 1, F.concat(F.lit("page="), page.cast("string")))
    items = F.lit("i=merchant-items")
    qid = F.concat(F.lit("qid="), epoch.cast("string"))

    def url(*parts: Column) -> Column:
        return F.concat(F.lit(f"{base}?"), F.concat_ws("&", *parts))

    return F.array_distinct(
        F.array(
            url(items, me, at), url(items, me, market, at), url(items, me, market, at, qid),
            url(me, market, at), url(me, at),
        )
    )


def page_param_pieces(url: Column | str) -> Column:
    """The texts between which the value of the ``page`` parameter goes, appended when absent; text that is no URL is one piece.

    Joining the pieces with a number is the URL of that page, so rows of many pages look at their URL once.
    """
    url = as_col(url)
    head = F.regexp_extract(url, r"^([^#]*)(#.*)?$", 1)
    tail = F.regexp_extract(url, r"^([^#]*)(#.*)?$", 2)
    param = r"([?&])page(=[^&#]*)?(?=&|#|$)"
    emptied = F.split(F.regexp_replace(url, param, "$1page="), r"(?<=[?&]page=)(?=&|#|$)")
    glue = F.when(F.contains(head, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    added = F.array(F.concat(head, glue, F.lit("page=")), tail)
    pieces = F.when(~url.rlike(WEB), F.array(url)).when(head.rlike(param), emptied).otherwise(added)
    return F.when(url.isNotNull(), pieces)


def join_page(pieces: Column | str, n: Column) -> Column:
    """The URL of page ``n`` from the pieces of ``page_param_pieces``."""
    return F.call_function("array_join", as_col(pieces), n.cast("string"))


def with_page_param(url: Column | str, n: Column | int) -> Column:
    """Set the ``page`` parameter, appended when absent; text that is no URL stays."""
    url = as_col(url)
    page = n if isinstance(n, Column) else F.lit(n)
    return F.when(~url.rlike(WEB), url).otherwise(join_page(page_param_pieces(url), page))


def page_number(selected: Column | str, url: Column | str) -> Column:
    """The selected pager item, else the ``page`` parameter, else 1; only positive numbers count."""

    def positive(c: Column) -> Column:
        n = trim_blank(c).try_cast("double")
        return F.when(n > 0, n.cast("bigint"))

    return F.coalesce(positive(as_col(selected)), positive(query_param(url, "page")), F.lit(1).cast("bigint"))


def is_product_url(c: Column | str) -> Column:
    """Under ``/products/`` with a sku, or deep enough and not a category page."""
    url = as_col(c)
    parts = path_parts(url)
    deep = (F.size(parts) >= 5) & ~F.try_element_at(parts, F.lit(-1)).isin(*CATEGORY_LEAVES)
    under = F.contains(url_path(url), F.lit("/products/"))
    return F.coalesce(under & (query_param(url, "sku").isNotNull() | deep), F.lit(False))


def redact_url_user(c: Column | str) -> Column:
    """Scheme and host only, user data as ``***@``; blank is NULL, other text stays."""
    text = as_col(c)
    scheme, authority = F.regexp_extract(text, PARTS, 1), F.regexp_extract(text, PARTS, 2)
    user = F.when(F.contains(authority, F.lit("@")), F.lit("***@")).otherwise(F.lit(""))
    host = F.lower(F.regexp_replace(authority, "^.*@", ""))
    host = F.when(F.lower(scheme) == "http", F.regexp_replace(host, ":80$", "")).otherwise(host)
    host = F.when(F.lower(scheme) == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    parsed = F.concat(F.lower(scheme), F.lit("://"), user, host)
    return blank_to_null(F.when((authority != "") & text.rlike(ABSOLUTE), parsed).otherwise(text))


# Fixed value: the result-count line of a search page, blanks removed.
RESULT_COUNT = r"([0-9,]+)結果の([0-9,]+)-([0-9,]+)"


def result_summary(c: Column | str) -> Column:
    """struct(total, start_no, end_no, is_valid) of the result-count line; NULL without one."""
    text = F.regexp_replace(as_col(c), BLANK + "+", "")

    def build(t: Column) -> Column:
        total, start, end = (F.regexp_replace(extract(t, RESULT_COUNT, i), ",", "").try_cast("bigint") for i in (1, 2, 3))
        found = F.struct(
            total.alias("total"), start.alias("start_no"), end.alias("end_no"), (end >= start).alias("is_valid")
        )
        return F.when(t.rlike(RESULT_COUNT), found)

    return let(text, build)


def expected_pages(summary: Column) -> Column:
    """Pages in all, 0 when unknown."""
    per_page = summary["end_no"] - summary["start_no"] + 1
    known = summary["is_valid"] & (summary["total"] > 0) & (per_page > 0)
    return F.coalesce(
        F.when(known, F.floor((summary["total"] + per_page - 1) / per_page).cast("bigint")), F.lit(0).cast("bigint")
    )


def resume_page(n: Column | str, per_page: int = 16) -> Column:
    """The list page to continue from after ``n`` stored items."""
    return F.greatest(F.lit(1).cast("bigint"), (F.floor(as_col(n) / per_page) + 1).cast("bigint"))


def image_attr(attrs: Column) -> Column:
    """Lazy-loading attributes before ``src``."""
    return F.coalesce(*[blank_to_null(attrs[name]) for name in ("data-original", "data-src", "src")])
