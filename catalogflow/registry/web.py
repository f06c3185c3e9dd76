"""URL columns, planning columns and capture status over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import status as st, urls
from ..operators import search
from ..plans.config import page_frontier
from .base import K, NWS, WS, Query, d_any, d_compact, d_get, d_norm, d_trim, listing, table, with_listing

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def add(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLES[name] = sql


def pages(s, d):
    return table(s, d, "pages").select("page_id", "url")


HOST = "lower(regexp_extract(url, '^https?://([^/?#:]+)', 1))"
PATH = "regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1)"
PARTS = f"list_filter(string_split({PATH}, '/'), lambda x: x <> '')"

add(
    "scl07_product_number",
    lambda s, d: listing(s, d).select("k", urls.product_number("product_number_text", "url").alias("v")),
    with_listing(f"""SELECT k, coalesce({d_get('t', f'商品番号{WS}*[:：]{WS}*({NWS}+)')}, {d_get('t', f'商品コード{WS}*[:：]{WS}*({NWS}+)')},
        {d_get('t', f'型番{WS}*[:：]{WS}*({NWS}+)')}, {d_get('t', f'品番{WS}*[:：]{WS}*({NWS}+)')},
        {d_get('t', f'(?i)SKU{WS}*[:：]{WS}*({NWS}+)')}, regexp_extract(url, '[^/]+$')) AS v
        FROM (SELECT k, url, {d_compact('product_number_text')} AS t FROM listing)"""),
)
add(
    "scl21_model_from_url",
    lambda s, d: pages(s, d).select("page_id", urls.model_from_url(F.concat(F.regexp_replace("url", "[?#].*$", ""), F.expr(
        "CASE page_id % 3 WHEN 0 THEN '/%E3%81%82+b' WHEN 1 THEN '/bad%zz' ELSE '' END"))).alias("v")),
    f"""SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'あ+b' WHEN 2 THEN {PARTS}[-1] END AS v FROM pages""",
)
add(
    "scl24_absolute_url",
    lambda s, d: pages(s, d).select("page_id", *[urls.absolute_url("url", F.lit(h)).alias(n) for n, h in {
        "root": "/a/../b c", "rel": "x/y.html", "up": "../z", "query": "?q=1", "mark": "#m", "scheme": "//cdn.example.com",
        "full": "HTTPS://Other.example.com/あ", "blank": "　"}.items()]),
    f"""SELECT page_id, o || '/b%20c' AS root, o || dir || 'x/y.html' AS rel, o || regexp_replace(dir, '[^/]*/$', '') || 'z' AS up,
        o || p || '?q=1' AS query, regexp_replace(o || p || q, '#.*$', '') || '#m' AS mark, regexp_extract(url, '^https?:') || '//cdn.example.com/' AS scheme,
        'https://other.example.com/%E3%81%82' AS full, NULL AS blank
        FROM (SELECT page_id, url, regexp_extract(url, '^https?://[^/?#]+') AS o, CASE WHEN {PATH} = '' THEN '/' ELSE {PATH} END AS p,
            regexp_replace(CASE WHEN {PATH} = '' THEN '/' ELSE {PATH} END, '[^/]*$', '') AS dir, regexp_extract(url, '[?][^#]*') AS q FROM pages)""",
)
add(
    "scl34_redact_url",
    lambda s, d: pages(s, d).select("page_id", urls.redact_url_user(F.expr(
        "CASE page_id % 3 WHEN 0 THEN replace(url, 'http://', 'http://me:pw@') WHEN 1 THEN url ELSE 'no url' END")).alias("v")),
    f"SELECT page_id, CASE page_id % 3 WHEN 0 THEN replace(split_part(url, '//', 1) || '//', 'http://', 'http://***@') || {HOST} WHEN 1 THEN split_part(url, '//', 1) || '//' || {HOST} ELSE 'no url' END AS v FROM pages",
)
add(
    "pln05_query_label",
    lambda s, d: table(s, d, "documents").select("doc_id", urls.query_label("text", "doc_id").alias("label")),
    f"""SELECT doc_id, lpad(cast(doc_id + 1 AS string), cast(greatest(2, length(cast(doc_id + 1 AS string))) AS INTEGER), '0') || '-' ||
        coalesce(nullif(substring(regexp_replace(regexp_replace({d_norm('text')}, '{WS}+', '-', 'g'), '[\\\\/:*?"<>|]+', '-', 'g'), 1, 80), ''), 'query')
        AS label FROM documents""",
)
add(
    "pln06_url_label",
    lambda s, d: pages(s, d).select("page_id", urls.url_label(F.expr("CASE WHEN page_id % 7 = 0 THEN 'raw text' ELSE url END"), "page_id").alias("label")),
    f"""SELECT page_id, lpad(cast(page_id + 1 AS string), cast(greatest(2, length(cast(page_id + 1 AS string))) AS INTEGER), '0') || '-' ||
        CASE WHEN page_id % 7 = 0 THEN 'raw text' ELSE array_to_string(list_prepend({HOST}, {PARTS}), '-') END AS label FROM pages""",
)
add(
    "pln07_safe_segment",
    lambda s, d: pages(s, d).select("page_id", urls.safe_segment(F.expr(
        "CASE WHEN page_id % 5 = 0 THEN '　' ELSE '　' || url || chr(92) || 'x ' END")).alias("v")),
    r"SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'unknown-project' ELSE replace(url, '/', '-') || '-x' END AS v FROM pages",
)
add(
    "pln08_search_url",
    lambda s, d: table(s, d, "part").select("p_partkey", urls.search_url("https://s.example.com/s", "k", F.concat(
        "p_name", F.lit(" & メモリ")), F.col("p_partkey") % 3).alias("u")),
    """SELECT p_partkey, 'https://s.example.com/s?k=' || replace(p_name, ' ', '+') || '+%26+%E3%83%A1%E3%83%A2%E3%83%AA' ||
        CASE WHEN p_partkey % 3 > 1 THEN '&page=2' ELSE '' END AS u FROM part""",
)
add(
    "pln09_merchant_urls",
    lambda s, d: table(s, d, "supplier").select("s_suppkey", F.posexplode(urls.merchant_urls(
        "https://s.example.com/s", "MKT", F.concat(F.lit("M"), F.col("s_suppkey").cast("string")), F.col("s_suppkey") % 3,
        F.lit(1700000000))).alias("pos", "u")),
    """SELECT s_suppkey, cast(pos AS INTEGER) AS pos, 'https://s.example.com/s?' || CASE pos WHEN 0 THEN 'i=merchant-items&' || m || p
        WHEN 1 THEN 'i=merchant-items&' || m || '&marketplaceID=MKT' || p WHEN 2 THEN 'i=merchant-items&' || m || '&marketplaceID=MKT' || p || '&qid=1700000000'
        WHEN 3 THEN m || '&marketplaceID=MKT' || p ELSE m || p END AS u
        FROM (SELECT s_suppkey, unnest([0, 1, 2, 3, 4]) AS pos, 'me=M' || cast(s_suppkey AS string) AS m,
            CASE WHEN s_suppkey % 3 > 1 THEN '&page=2' ELSE '' END AS p FROM supplier)""",
)
add(
    "pln10_with_page_param",
    lambda s, d: pages(s, d).select("page_id", urls.with_page_param("url", F.col("page_id") + 2).alias("u")),
    """SELECT page_id, CASE WHEN regexp_matches(url, '[?&]page=') THEN regexp_replace(url, '([?&]page=)[^&#]*', '\\1' || cast(page_id + 2 AS string))
        ELSE regexp_extract(url, '^[^#]*') || CASE WHEN contains(regexp_extract(url, '^[^#]*'), '?') THEN '&' ELSE '?' END || 'page=' ||
        cast(page_id + 2 AS string) || regexp_extract(url, '#.*$') END AS u FROM pages""",
)
SUMMARY = f"""CASE {K} % 5 WHEN 0 THEN 'no count' WHEN 1 THEN '1,' || lpad(cast({K} % 1000 AS string), 3, '0') || ' 結果の　40-20'
    ELSE cast({K} AS string) || ' 結果の 17-' || cast(17 + {K} % 30 AS string) END"""
D_SUM = f"""SELECT {K} AS k, {d_get('t', '([0-9,]+)結果の([0-9,]+)-([0-9,]+)', 1)} AS a, {d_get('t', '([0-9,]+)結果の([0-9,]+)-([0-9,]+)', 2)} AS b,
    {d_get('t', '([0-9,]+)結果の([0-9,]+)-([0-9,]+)', 3)} AS c FROM (SELECT {K}, regexp_replace({SUMMARY}, '{WS}+', '', 'g') AS t FROM part)"""


def summaries(s, d):
    return table(s, d, "part").select(F.col(K).alias("k"), urls.result_summary(F.expr(SUMMARY)).alias("r"))


add(
    "pln11_result_summary",
    lambda s, d: summaries(s, d).select("k", "r.total", "r.start_no", "r.end_no", "r.is_valid"),
    f"""SELECT k, cast(replace(a, ',', '') AS BIGINT) AS total, cast(b AS BIGINT) AS start_no, cast(c AS BIGINT) AS end_no,
        cast(c AS BIGINT) >= cast(b AS BIGINT) AS is_valid FROM ({D_SUM})""",
)
def expected_pages(s, d):
    """Pages of each summary from the frontier; summaries without a page keep one row."""
    rows = summaries(s, d).select("k", urls.expected_pages(F.col("r")).alias("n"))
    pages = page_frontier(rows, "n").withColumnRenamed("page_no", "page")
    return pages.unionByName(rows.filter("n IS NULL OR n <= 0"), allowMissingColumns=True)


add(
    "pln12_expected_pages",
    expected_pages,
    f"""WITH n AS (SELECT k, CASE WHEN c >= b AND a > 0 THEN (a + c - b) // (c - b + 1) ELSE 0 END AS n FROM (SELECT k,
            cast(replace(a, ',', '') AS BIGINT) AS a, cast(b AS BIGINT) AS b, cast(c AS BIGINT) AS c FROM ({D_SUM})))
        SELECT k, n, page FROM (SELECT k, n, unnest(generate_series(1, n)) AS page FROM n WHERE n > 0)
        UNION ALL SELECT k, n, NULL FROM n WHERE n = 0""",
)
add(
    "pln13_resume_page",
    lambda s, d: table(s, d, "part").select("p_partkey", urls.resume_page("p_partkey").alias("page")),
    "SELECT p_partkey, greatest(1, p_partkey // 16 + 1) AS page FROM part",
)
add(
    "ext28_page_number",
    lambda s, d: pages(s, d).select("page_id", urls.page_number(F.expr(
        "CASE page_id % 4 WHEN 0 THEN '　7 ' WHEN 1 THEN '0' WHEN 2 THEN 'x' END"), "url").alias("n")),
    """SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 7 ELSE coalesce(try_cast(nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS BIGINT), 1) END
        AS n FROM pages""",
)
DEEP = f"""'https://m.example.com/' || CASE {K} % 4 WHEN 0 THEN 'products/x?sku=' || cast({K} AS string) WHEN 1 THEN 'ja/products/a/b/' || p_type
    WHEN 2 THEN 'ja/products/a/b/hdd' ELSE 'ja/a/b/c/d' END"""
add(
    "flt8_is_product_url",
    lambda s, d: table(s, d, "part").select(F.col(K).alias("k"), urls.is_product_url(F.expr(DEEP)).alias("v")),
    f"SELECT {K} AS k, {K} % 4 IN (0, 1) AS v FROM part",
)
add(
    "ext03_image_attr",
    lambda s, d: table(s, d, "part").select(F.col(K).alias("k"), urls.image_attr(F.map_from_arrays(
        F.array(F.lit("src"), F.lit("data-src"), F.lit("data-original")),
        F.array("p_name", F.expr(f"CASE WHEN {K} % 2 = 0 THEN '' ELSE p_type END"), F.expr(f"CASE WHEN {K} % 3 = 0 THEN p_brand ELSE '' END")))).alias("v")),
    f"SELECT {K} AS k, CASE WHEN {K} % 3 = 0 THEN p_brand WHEN {K} % 2 = 1 THEN p_type ELSE p_name END AS v FROM part",
)
META = f"""'<html><meta ' || CASE {K} % 4 WHEN 0 THEN 'itemprop="gtin13" content=" 49' || lpad(cast({K} AS string), 11, '0') || '99"'
    WHEN 1 THEN 'content=''49' || lpad(cast({K} AS string), 11, '0') || ''' ITEMPROP=''gtin13'''
    WHEN 2 THEN 'itemprop="sku" content="1"' ELSE 'itemprop="gtin13" content=""' END || '>' || p_name"""
add(
    "ext06_jan_from_html",
    lambda s, d: table(s, d, "part").select(F.col(K).alias("k"), search.jan_from_html(F.expr(META)).alias("jan")),
    f"SELECT {K} AS k, CASE WHEN {K} % 4 < 2 THEN '49' || lpad(cast({K} AS string), 11, '0') ELSE '未セット' END AS jan FROM part",
)

# --- search sub-expressions -------------------------------------------------------------
LINKS = f"CASE {K} % 3 WHEN 0 THEN '5つ星 (1,' || lpad(cast({K} % 1000 AS string), 3, '0') || ')' WHEN 1 THEN cast({K} AS string) || '件' ELSE 'なし' END"
add(
    "ext08a_review_count",
    lambda s, d: table(s, d, "part").select(F.col(K).alias("k"), search.review_count(
        F.array(F.lit("レビュー"), F.expr(LINKS)), F.array(F.lit("abc"), F.expr(f"'評価 ' || cast({K} % 77 AS string)"))).alias("v")),
    f"""SELECT {K} AS k, CASE {K} % 3 WHEN 0 THEN '1,' || lpad(cast({K} % 1000 AS string), 3, '0') WHEN 1 THEN cast({K} AS string)
        ELSE cast({K} % 77 AS string) END AS v FROM part""",
)
add(
    "ext08b_delivery_label",
    lambda s, d: listing(s, d).select("k", search.delivery_label(F.array("stock_text", "maker_text", F.expr(
        "CASE WHEN k % 2 = 0 THEN '明日 お届け' ELSE 'Prime対象' END"), F.lit("配送"))).alias("v")),
    with_listing("SELECT k, CASE WHEN k % 2 = 0 THEN '明日 お届け' ELSE 'Prime対象' END AS v FROM listing"),
)
add(
    "ext08c_coupon_label",
    lambda s, d: listing(s, d).select("k", search.coupon_label(F.array("coupon_text", F.expr(
        "repeat('x', 40 + cast(k % 50 AS int)) || 'クーポン'"), F.expr("'クーポン ' || product_name_text"))).alias("v")),
    with_listing("""SELECT k, CASE WHEN 44 + k % 50 <= 80 THEN repeat('x', 40 + cast(k % 50 AS INTEGER)) || 'クーポン'
        ELSE 'クーポン ' || product_name_text END AS v FROM listing"""),
)
add(
    "ext08d_sponsored",
    lambda s, d: listing(s, d).select("k", search.is_sponsored(F.expr(
        "CASE WHEN k % 3 = 0 THEN product_name_text || 'スポンサー' ELSE product_name_text END")).alias("v")),
    with_listing("SELECT k, k % 3 = 0 AS v FROM listing"),
)
BODY = f"""p_name || CASE {K} % 6 WHEN 0 THEN '検索結果はありません' WHEN 1 THEN '該当する商品がありません' WHEN 2 THEN '一致する商品はありません' ELSE '' END"""
add(
    "ext10_no_results",
    lambda s, d: table(s, d, "part").select(F.col(K).alias("k"), st.has_no_results(F.expr(BODY), "a").alias("a"),
                                            st.has_no_results(F.expr(BODY), "b").alias("b")),
    f"SELECT {K} AS k, {K} % 6 IN (0, 2) AS a, {K} % 6 IN (0, 1) AS b FROM part",
)

# --- status -----------------------------------------------------------------------------
HTTP = "CASE page_id % 9 WHEN 0 THEN 403 WHEN 1 THEN 429 WHEN 2 THEN 404 WHEN 3 THEN 500 WHEN 4 THEN NULL ELSE 200 END"
TXT = "html || CASE page_id % 5 WHEN 0 THEN 'Robotics' WHEN 1 THEN 'ロボットではありません' WHEN 2 THEN 'アクセスが集中' WHEN 3 THEN 'Just a moment' ELSE '' END"


def captures(s, d):
    return table(s, d, "pages").select("page_id", "url", F.expr(HTTP).alias("http"), F.expr(TXT).alias("t"))


D_CAP = f"SELECT page_id, url, {HTTP} AS http, {TXT} AS t FROM pages"
D_REF = "coalesce(http IN (403, 429), false)"
D_BLOCKED = f"({D_REF} OR {d_any('lower(t)', st.BLOCKED_WORDS)})"
add(
    "flt2_is_blocked",
    lambda s, d: captures(s, d).select("page_id", st.is_blocked("http", "t").alias("blocked")),
    f"SELECT page_id, {D_BLOCKED} AS blocked FROM ({D_CAP})",
)
add(
    "flt3_blocked_variants",
    lambda s, d: captures(s, d).select("page_id", st.is_blocked_a("http", F.lit("x"), "t").alias("a"), st.is_blocked_b(
        F.expr("CASE WHEN page_id % 4 = 0 THEN 'chrome-error://x' ELSE url END"), "http", F.lit("x"), "t").alias("b"),
        st.is_challenge("t", "t").alias("challenge")),
    f"""SELECT page_id, {D_REF} OR {d_any('lower(t)', [w.lower() for w in st.BLOCKED_WORDS_A] + [st.CONTINUE_PAGE_A])} AS a,
        CASE WHEN page_id % 4 = 0 THEN {D_REF} ELSE {D_BLOCKED} OR {d_any('lower(t)', st.BLOCKED_WORDS_B)} END AS b,
        {d_any('t', (st.CHALLENGE_TITLE, *st.CHALLENGE_BODY))} AS challenge FROM ({D_CAP})""",
)
MSG = """event_type || CASE event_id % 8 WHEN 0 THEN ' 403 Forbidden' WHEN 1 THEN ' net::ERR_FAILED' WHEN 2 THEN ' Timeout 30000ms'
    WHEN 3 THEN ' Target page, context or browser has been closed' WHEN 4 THEN ' Page crashed' WHEN 5 THEN ' TLS alert' ELSE '' END"""
add(
    "flt4_error_class",
    lambda s, d: table(s, d, "events").select("event_id", F.expr(MSG).alias("m")).select(
        "event_id", st.is_blocked_error("m").alias("blocked"), st.is_transport_error("m").alias("transport"),
        st.is_retryable_error("m").alias("retryable"), st.is_timeout_error("m").alias("timeout"),
        st.is_closed_error("m").alias("closed"), st.is_crashed_error("m").alias("crashed")),
    """SELECT event_id, event_id % 8 = 0 AS blocked, event_id % 8 IN (1, 5) AS transport, event_id % 8 IN (2, 3) AS retryable,
        event_id % 8 IN (1, 2) AS timeout, event_id % 8 = 3 AS closed, event_id % 8 = 4 AS crashed FROM events""",
)
add(
    "flt5_official_status",
    lambda s, d: captures(s, d).select("page_id", st.official_status("http", st.is_blocked("http", "t")).alias("status")),
    f"""SELECT page_id, CASE WHEN {D_BLOCKED} THEN 'blocked' WHEN http = 404 THEN 'not_found' WHEN http >= 400 THEN 'error' ELSE 'ok' END
        AS status FROM ({D_CAP})""",
)
add(
    "flt6_search_status",
    lambda s, d: table(s, d, "part").select(F.col(K).alias("k"), st.search_status_b(st.has_no_results(F.expr(BODY), "b"), F.col(K) % 5).alias("status")),
    f"SELECT {K} AS k, CASE WHEN {K} % 6 IN (0, 1) OR {K} % 5 = 0 THEN 'no_results' ELSE 'ok' END AS status FROM part",
)
add(
    "flt7_failed_status",
    lambda s, d: table(s, d, "events").select("event_id", st.failed_status(st.is_blocked_error(F.expr(MSG)), F.expr(MSG)).alias("status")),
    "SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'blocked' WHEN 1 THEN 'transport_error' WHEN 5 THEN 'transport_error' ELSE 'error' END AS status FROM events",
)
