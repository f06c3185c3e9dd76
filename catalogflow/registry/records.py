"""Official pages, structured data, maker shop and page chains over pages composed from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import jsonld, maker, official, paging
from ..operators.curate import next_value, under_heading
from ..operators.dom import html_nodes
from ..operators.joins import with_feed_price
from .base import K, Query, d_compact, given_pages, table
from .markup import compose

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def add(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLES[name] = sql


KS = f"cast({K} AS string)"


def part_pages(s, d, html: str, site: str):
    """One page per part."""
    rows = table(s, d, "part").repartition(int(s.conf.get("spark.sql.shuffle.partitions")), K)
    return rows.select(F.col(K).alias("page_id"), F.concat(F.lit(site), F.col(K).cast("string")).alias("url"), F.expr(html).alias("html"))


# --- official pages ---------------------------------------------------------------------
SITE = "https://o.example.com/p/"
DATA = f"""CASE WHEN {K} % 2 = 0 THEN '<script type="application/ld+json">{{"@context":"x","@graph":[{{"@type":["Thing","product"],"name":"LD  ' || p_name ||
    '","sku":"SK-' || {KS} || '","description":"D<br/>' || {KS} || '","image":"/ld.png","offers":{{"price":' || {KS} || ',"priceCurrency":"JPY","availability":"https://schema.org/' ||
    CASE WHEN {K} % 4 = 0 THEN 'InStock' ELSE 'OutOfStock' END || '"}},"additionalProperty":[{{"name":"重さ","value":"' || {KS} || 'g"}}],"isRelated":{{"deep":[{{"@type":"Question","name":"内?"}}]}}}},' ||
    '{{"@type":"FAQPage","mainEntity":[{{"@type":"Question","name":"LDQ' || {KS} || '?","acceptedAnswer":{{"text":"<b>LDA</b>"}}}}]}}]}}</script>'
    ELSE '<script type="application/ld+json">{{broken</script>' END"""
OFFICIAL = f"""'<!DOCTYPE html><html><head><title>' || p_name || ' | shop</title><meta property="og:title" content="' || CASE WHEN {K} % 3 = 0 THEN '' ELSE p_brand || ' &amp; ' || p_name END ||
    '"><meta name="description" content="' || CASE WHEN {K} % 5 = 0 THEN '' ELSE p_type || '  desc' END || '"><meta property="og:description" content="og ' || {KS} ||
    '"><link rel="canonical" href="/c/' || {KS} || '"><meta property="og:image" content="/og.png">' || {DATA} || '</head><body><nav>AB-12</nav><main><h1> ' || p_name ||
    '<b> x</b></h1><p>first ' || {KS} || '<p>second</p><img src="/a' || {KS} || '.png" srcset="/b.png 1x, c.png 2x"><video src="/v.mp4"></video><iframe src="https://www.youtube.com/embed/' || {KS} ||
    '"></iframe><iframe src="https://other.example.com/"></iframe><table><tr><th>色<td>赤' || {KS} || '<tr><td>only<td> <tr><td>型<td>A<td>B</table><dl><dt>幅<dd>' || {KS} ||
    'mm<dt>空</dt><dt>重<dd>1</dl><h2>製品仕様</h2><ul><li>軽い<li>強い' || {KS} || '</ul><p>以上</p><table><tr><td>奥行<td>5</table><h2>よくある質問</h2><p>Q: 何 ' || {KS} ||
    '?</p><p>A：答え</p><p>保証は?</p><p>1年</p><p>quality x</p><details><summary>開閉?</summary> はい ' || {KS} || '</details>' || CASE WHEN {K} % 3 = 1 THEN '<p>¥1,234 在庫あり</p>' ELSE '' END || '</main></body></html>'"""


def official_pages(s, d):
    return part_pages(s, d, OFFICIAL, SITE)


add(
    "ext16_page_fields",
    lambda s, d: official.extract_page_fields(official_pages(s, d)).select(
        "page_id", "title", "og_title", "meta_description", "canonical_url", F.array_join("h1_texts", "/").alias("h1"),
        F.array_join("description_texts", "/").alias("descriptions")),
    f"""SELECT {K} AS page_id, p_name || ' | shop' AS title, CASE WHEN {K} % 3 <> 0 THEN p_brand || ' & ' || p_name END AS og_title,
        CASE WHEN {K} % 5 = 0 THEN 'og ' || {KS} ELSE p_type || ' desc' END AS meta_description, 'https://o.example.com/c/' || {KS} AS canonical_url,
        p_name || ' x' AS h1, CASE WHEN {K} % 5 = 0 THEN 'og ' || {KS} ELSE p_type || ' desc' END || '/first ' || {KS} || '/second/以上/Q: 何 ' || {KS} || '?/A：答え/保証は?' AS descriptions FROM part""",
)
add(
    "ext16_given_pages",
    lambda s, d: official.extract_page_fields(given_pages(s, d)).select("page_id", "title", F.array_join("h1_texts", "/").alias("h1")),
    f"""SELECT page_id, nullif({d_compact("replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&amp;', '&')")}, '') AS title,
        {d_compact("replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '&amp;', '&')")} AS h1 FROM pages""",
)
add(
    "ext17_image_urls",
    lambda s, d: official.extract_page_fields(official_pages(s, d)).select("page_id", F.array_join("image_urls", " ").alias("v")),
    f"SELECT {K} AS page_id, 'https://o.example.com/og.png https://o.example.com/a' || {KS} || '.png https://o.example.com/b.png https://o.example.com/p/c.png' AS v FROM part",
)
add(
    "ext18_video_urls",
    lambda s, d: official.extract_page_fields(official_pages(s, d)).select("page_id", F.array_join("video_urls", " ").alias("v")),
    f"SELECT {K} AS page_id, 'https://o.example.com/v.mp4 https://www.youtube.com/embed/' || {KS} AS v FROM part",
)
D_SPECS = f"""'{{"label":"色","value":"赤' || {KS} || '"}},{{"label":"型","value":"A B"}},{{"label":"奥行","value":"5"}},{{"label":"幅","value":"' || {KS} ||
    'mm"}},{{"label":"重","value":"1"}},{{"label":null,"value":"軽い"}},{{"label":null,"value":"強い' || {KS} || '"}},{{"label":null,"value":"以上"}},{{"label":null,"value":"奥行: 5"}}]'"""
D_FAQ = f"""'{{"question":"開閉?","answer":"はい ' || {KS} || '"}},{{"question":"何 ' || {KS} ||
    '?","answer":"答え"}},{{"question":"保証は?","answer":"1年"}},{{"question":"uality x","answer":null}}]'"""
JSON_OPTIONS = {"ignoreNullFields": "false"}
add(
    "ext23_specs",
    lambda s, d: official.extract_specs(official_pages(s, d)).select("page_id", F.to_json("specs", JSON_OPTIONS).alias("v")),
    f"SELECT {K} AS page_id, '[' || {D_SPECS} AS v FROM part",
)
add(
    "ext24_faq",
    lambda s, d: official.extract_faq(official_pages(s, d)).select("page_id", F.to_json("faq", JSON_OPTIONS).alias("v")),
    f"SELECT {K} AS page_id, '[' || {D_FAQ} AS v FROM part",
)
add(
    "ext25_official_records",
    lambda s, d: official.official_records(official_pages(s, d)).select(
        "page_id", "product_url", "product_name", "price", "model_number", F.to_json("specs", JSON_OPTIONS).alias("specs"),
        F.to_json("faq", JSON_OPTIONS).alias("faq"), "description_text", F.array_join("image_urls", " ").alias("images"), "availability"),
    f"""SELECT {K} AS page_id, '{SITE}' || {KS} AS product_url, CASE WHEN {K} % 2 = 0 THEN 'LD ' || p_name WHEN {K} % 3 <> 0 THEN p_brand || ' & ' || p_name ELSE p_name || ' x' END AS product_name,
        CASE WHEN {K} % 2 = 0 THEN 'JPY ' || {KS} WHEN {K} % 3 = 1 THEN '¥1,234' END AS price, CASE WHEN {K} % 2 = 0 THEN 'SK-' || {KS} ELSE {KS} END AS model_number,
        '[' || CASE WHEN {K} % 2 = 0 THEN '{{"label":"重さ","value":"' || {KS} || 'g"}},' ELSE '' END || {D_SPECS} AS specs,
        '[' || CASE WHEN {K} % 2 = 0 THEN '{{"question":"内?","answer":null}},{{"question":"LDQ' || {KS} || '?","answer":"LDA"}},' ELSE '' END || {D_FAQ} AS faq,
        CASE WHEN {K} % 2 = 0 THEN 'D ' || {KS} WHEN {K} % 5 = 0 THEN 'og ' || {KS} ELSE p_type || ' desc' END AS description_text,
        CASE WHEN {K} % 2 = 0 THEN 'https://o.example.com/ld.png ' ELSE '' END || 'https://o.example.com/og.png https://o.example.com/a' || {KS} || '.png https://o.example.com/b.png https://o.example.com/p/c.png' AS images,
        CASE WHEN {K} % 4 = 0 THEN 'in_stock' WHEN {K} % 2 = 0 THEN 'out_of_stock' WHEN {K} % 3 = 1 THEN 'in_stock' END AS availability FROM part""",
)

# --- structured data --------------------------------------------------------------------
# Twelve objects inside each other, with members out of name order before and behind the inner one.
DEPTH = 12
NESTED = """'<script type="application/ld+json">' || array_join(transform(sequence(1, %d), i -> '{"z":"{","name":"n' || cast(i AS string) || '-' || %s || '","a":[' ||
    cast(i AS string) || ','), '') || '{}' || repeat('],"B":{"@id":"]","name":"b\\\\" }"}}', %d) || '</script><script type="application/ld+json">[{"name":"second"}]</script>'""" % (DEPTH, KS, DEPTH)
add(
    "ext19_jsonld_nodes",
    lambda s, d: jsonld.jsonld_nodes(part_pages(s, d, NESTED, SITE)).select(
        "page_id", "block_no", F.concat_ws(".", F.col("place").cast("array<string>")).alias("place"), jsonld.string_field(F.col("node"), "name").alias("name")),
    f"""SELECT {K} AS page_id, cast(0 AS INTEGER) AS block_no, array_to_string(list_concat(flatten(list_transform(range(i), lambda x: [2, 1])), t), '.') AS place,
        CASE WHEN len(t) = 1 THEN 'b" }}' WHEN i < {DEPTH} THEN 'n' || cast(i + 1 AS string) || '-' || {KS} END AS name
        FROM part, (SELECT i, unnest([[]::INTEGER[], [3]]) AS t FROM range({DEPTH} + 1) r(i)) WHERE i < {DEPTH} OR len(t) = 0
        UNION ALL SELECT {K}, 1, '0', 'second' FROM part""",
)
add(
    "ext20_jsonld_types",
    lambda s, d: jsonld.jsonld_nodes(official_pages(s, d)).select("page_id", F.concat_ws(".", F.col("place").cast("array<string>")).alias("place"), *[
        jsonld.jsonld_is("node", t).alias(t.lower()) for t in ("PRODUCT", "Question", "FAQPage")]),
    f"""SELECT {K} AS page_id, place, place = '1.0' AS product, place IN ('1.0.7.0.0', '1.1.1.0') AS question, place = '1.1' AS faqpage
        FROM part, unnest(['', '1.0', '1.0.5', '1.0.6.0', '1.0.7', '1.0.7.0.0', '1.1', '1.1.1.0', '1.1.1.0.2']) AS u(place) WHERE {K} % 2 = 0""",
)
add(
    "ext21_jsonld_products",
    lambda s, d: jsonld.jsonld_products(jsonld.jsonld_nodes(official_pages(s, d))).select(
        "page_id", "name", F.array_join("models", "/").alias("models"), "description", F.array_join("images", " ").alias("images"),
        F.array_join("prices", "/").alias("prices"), F.array_join("availability", "/").alias("availability"), F.to_json("specs").alias("specs")),
    f"""SELECT {K} AS page_id, 'LD ' || p_name AS name, 'SK-' || {KS} AS models, 'D ' || {KS} AS description, 'https://o.example.com/ld.png' AS images,
        'JPY ' || {KS} AS prices, 'https://schema.org/' || CASE WHEN {K} % 4 = 0 THEN 'InStock' ELSE 'OutOfStock' END AS availability,
        '[{{"label":"重さ","value":"' || {KS} || 'g"}}]' AS specs FROM part WHERE {K} % 2 = 0""",
)
add(
    "ext22_jsonld_faq",
    lambda s, d: jsonld.jsonld_faq(jsonld.jsonld_nodes(official_pages(s, d))).select("page_id", "question", "answer"),
    f"""SELECT {K} AS page_id, q AS question, CASE WHEN q = '内?' THEN NULL ELSE 'LDA' END AS answer
        FROM part, unnest(['内?', 'LDQ' || {KS} || '?', 'LDQ' || {KS} || '?']) AS u(q) WHERE {K} % 2 = 0""",
)
add(
    "scl26_as_string",
    lambda s, d: table(s, d, "events").select("event_id", jsonld.as_string(F.parse_json(F.expr(
        """CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN '" ' || event_type || '   x "' WHEN 2 THEN cast(event_id AS string)
        WHEN 3 THEN 'true' ELSE '" "' END"""))).alias("v")),
    "SELECT event_id, CASE event_id % 5 WHEN 1 THEN event_type || ' x' WHEN 2 THEN cast(event_id AS string) END AS v FROM events",
)

# --- maker shop -------------------------------------------------------------------------
HOST = "https://maker.example.com"
LINKS = f"""'<div class="clp-product-listing-wrap"><a href="' || CASE k % 6 WHEN 0 THEN '/ja/products/a' WHEN 1 THEN '/ja/products/x?sku=S' || cast(k AS string) || '#top'
    WHEN 2 THEN 'https://maker.example.com/ja/products/x?sku=S' || cast(k % 100 AS string) ELSE '/ja/products/x?sku=S' || cast(k % 100 AS string) END || '">x</a></div>'"""


def link_pages(s, d):
    return compose(table(s, d, "part").withColumnRenamed(K, "k"), LINKS, "<html><body>", "</body></html>", f"{HOST}/list/")


add(
    "ext11_product_links",
    lambda s, d: maker.extract_product_links(html_nodes(link_pages(s, d), tags=("a",)), HOST).select("page_id", "product_url"),
    f"""SELECT min(k // 20) AS page_id, '{HOST}/ja/products/x?sku=S' || cast(k % 100 AS string) AS product_url FROM (SELECT {K} AS k FROM part)
        WHERE k % 6 >= 2 GROUP BY k % 100""",
)
VARIANT = f"""'<html><body><h1>製品型番: X' || {KS} || '　' || p_name || '</h1><div id="product-model-number" class="product-sku-list">' ||
    '<div><span class="show-for-b2c"><a href="/v?sku=A' || {KS} || '">A</a></span><span>x (JAN 0' || lpad({KS}, 12, '4') || ')</span></div>' ||
    '<div><span class="show-for-b2c"><a href="https://maker.example.com/v?sku=B' || {KS} || '">B</a></span><span>' || CASE WHEN {K} % 2 = 0 THEN '(JAN 1)' ELSE 'none' END || '</span></div>' ||
    '<div><span class="show-for-b2b"><a href="/c">C</a></span><span>(JAN 5)</span></div></div>' ||
    CASE {K} % 4 WHEN 0 THEN '<a class="pdp-buy-btn-link"> </a><a class="pdp-buy-btn-link"> 購入 </a>' WHEN 1 THEN '<a href="#buy-btn">買う</a>' WHEN 2 THEN '<p>販売店を探す</p>' ELSE '' END ||
    CASE {K} % 5 WHEN 0 THEN '<p class="price-x"><span>税込 ¥1,' || {KS} || ' 円</span></p>' WHEN 1 THEN '<span class="my-price">¥Actual9</span><b class="discount-a">¥77 x</b>'
        WHEN 2 THEN '<script type="application/ld+json">{{"@type":"Product","sku":"P' || {KS} || '","offers":[{{"price":"' || {KS} || '.5"}}]}}</script>' ELSE '' END || '</body></html>'"""


def variant_pages(s, d):
    return part_pages(s, d, VARIANT, f"{HOST}/p?sku=P")


add(
    "ext12_variants",
    lambda s, d: maker.extract_variants(variant_pages(s, d), HOST).select("page_id", "jan", "variant_url"),
    f"""SELECT {K} AS page_id, '0' || lpad({KS}, 12, '4') AS jan, '{HOST}/v?sku=A' || {KS} AS variant_url FROM part
        UNION ALL SELECT {K}, '1', '{HOST}/v?sku=B' || {KS} FROM part WHERE {K} % 2 = 0""",
)


def feed_rows(s, d):
    return table(s, d, "part").filter(f"{K} % 3 > 0").select(F.concat(F.lit("P"), F.col(K).cast("string")).alias("code"),
        F.lit(1).alias("feed_pos"), F.expr(f"""named_struct('formattedValue', CASE WHEN {K} % 3 = 1 THEN '￥ ' || {KS} || ',000' ELSE '' END, 'value', {KS} || '234.5')""").alias("priceData"),
        F.expr(f"CASE WHEN {K} % 7 = 0 THEN named_struct('formattedValue', cast(NULL AS string), 'value', '9' || {KS}) END").alias("discountPriceData"))


D_FEED = f"""CASE WHEN {K} % 3 > 0 THEN CASE WHEN {K} % 7 = 0 THEN format('{{:,}}', cast('9' || {KS} AS BIGINT)) WHEN {K} % 3 = 1 THEN {KS} || '000'
    ELSE format('{{:,}}', cast({KS} || '235' AS BIGINT)) END END"""
add(
    "ext14_feed_price",
    lambda s, d: with_feed_price(variant_pages(s, d).select("page_id", "url"), feed_rows(s, d), url="url").select(
        "page_id", maker.feed_price(F.struct("priceData", "discountPriceData")).alias("price")),
    f"SELECT {K} AS page_id, {D_FEED} AS price FROM part",
)


def data_prices(s, d):
    pages = variant_pages(s, d)
    return jsonld.jsonld_price(jsonld.jsonld_nodes(pages.withColumn("sku", F.concat(F.lit("P"), F.col("page_id").cast("string"))), carry=("url", "sku")))


add(
    "ext15_jsonld_price",
    data_prices,
    f"SELECT {K} AS page_id, format('{{:,}}', {K} + 1) AS price FROM part WHERE {K} % 5 = 2",
)


def details(s, d):
    pages = variant_pages(s, d)
    detail = maker.extract_detail(pages)
    priced = with_feed_price(detail, feed_rows(s, d), url="url").join(data_prices(s, d).withColumnRenamed("price", "data_price"), "page_id", "left")
    return maker.complete_detail(priced, maker.feed_price(F.struct("priceData", "discountPriceData")), "data_price")


add(
    "ext13_maker_detail",
    lambda s, d: details(s, d).select("page_id", "title", "button_text", "price", "discount_price"),
    f"""SELECT {K} AS page_id, p_name AS title, CASE {K} % 4 WHEN 0 THEN '購入' WHEN 1 THEN '買う' WHEN 2 THEN '販売店を探す' ELSE '' END AS button_text,
        CASE {K} % 5 WHEN 0 THEN '1,' || {KS} WHEN 1 THEN 'Actual9' ELSE coalesce({D_FEED}, CASE WHEN {K} % 5 = 2 THEN format('{{:,}}', {K} + 1) END, '-') END AS price,
        CASE WHEN {K} % 5 = 1 THEN '77' ELSE '-' END AS discount_price FROM part""",
)

# --- paging -----------------------------------------------------------------------------
NEXT = f"""'<html><head>' || CASE WHEN {K} % 8 = 0 THEN '<link rel="next" href="/l/' || cast({K} + 1 AS string) || '">' ELSE '' END ||
    '</head><body><div class="item_listbox"><a href="/x">次へ</a></div>' || CASE {K} % 8 WHEN 6 THEN '<div class="item_listbox_area"><a href="/l/' || cast({K} + 1 AS string) || '">次へ</a></div>'
    WHEN 7 THEN '<div class="pagination"><p class="next"><a>none</a><a href="/last">l</a></p></div><div class="pager"><a class="next" href="/l/' || cast({K} + 1 AS string) || '">g</a></div>' WHEN 1 THEN '<ul class="pagination"><li class="next"><a href="' || cast({K} + 1 AS string) || '">go</a></ul>'
    WHEN 2 THEN '<a href="/no" aria-disabled="true">次へ</a><li class="disabled"><a href="/no">次へ</a></li><a class="disabled" href="/no">Next</a><a href="/l/' || cast({K} + 1 AS string) || '"> 次へ </a>'
    WHEN 3 THEN '<a class="disabled" href="/no">次へ</a>' WHEN 4 THEN '<a href="/w">次</a><a rel="next" href="/l/' || cast({K} + 1 AS string) || '?p=1">z</a>' ELSE '' END || '</body></html>'"""
add(
    "ext26_next_links",
    lambda s, d: paging.next_links(part_pages(s, d, NEXT, "https://n.example.com/l/")),
    f"""SELECT {K} AS page_id, 'https://n.example.com/l/' || {KS} AS url, 'https://n.example.com/l/' || cast({K} + 1 AS string) ||
        CASE WHEN {K} % 8 = 4 THEN '?p=1' ELSE '' END AS next_url FROM part WHERE {K} % 8 IN (0, 1, 2, 4, 6, 7)""",
)
# Chains of up to 97 pages, some of which turn back; every third link is captured twice.
EDGE = f"CASE WHEN {K} % 97 = 96 THEN {K} - 20 WHEN {K} % 241 = 240 THEN NULL ELSE {K} + 1 END"
D_CHAIN = f"""WITH RECURSIVE e AS (SELECT {K} AS a, {EDGE} AS b FROM part),
    w AS (SELECT {K} AS s, {K} AS here, 1 AS page_no, [{K}] AS seen FROM part
        UNION ALL SELECT s, b, page_no + 1, list_append(seen, b) FROM w JOIN e ON a = here WHERE b IS NOT NULL AND NOT list_contains(seen, b))
    SELECT 'u' || cast(s AS string) AS source_url, page_no, 'u' || cast(here AS string) AS page_url, {{truncated}} AS truncated FROM w"""


def page_chains(s, d, max_pages=None):
    part = table(s, d, "part").select(F.col(K).alias("k"), F.concat(F.lit("u"), F.col(K).cast("string")).alias("url"))
    edges = table(s, d, "part").select(F.col(K).alias("k"), F.concat(F.lit("u"), F.col(K).cast("string")).alias("url"), F.expr(f"'u' || cast({EDGE} AS string)").alias("next_url"))
    edges = edges.union(edges.filter("k % 3 = 0")).drop("k")
    return paging.page_chain(edges, part.select(F.col("url").alias("source_url")), max_pages)


add("ext27_page_chain", page_chains, D_CHAIN.format(truncated="false"))
add(
    "ext27_page_chain_limited",
    lambda s, d: page_chains(s, d, 40),
    D_CHAIN.format(truncated="max(page_no) OVER (PARTITION BY s) > 40") + " QUALIFY page_no <= 40",
)

# --- windows inside a page --------------------------------------------------------------
add(
    "win5_next_sibling",
    lambda s, d: html_nodes(given_pages(s, d), tags=("li",)).select(
        "page_id", F.col("sib_pos").alias("pos"), "text", next_value("text", ["page_id", "parent_id"], "sib_pos").alias("beside")),
    """SELECT page_id, cast(pos AS INTEGER) AS pos, l[pos] AS text, l[pos + 1] AS beside FROM (SELECT page_id, l, unnest(generate_series(1, len(l))) AS pos
        FROM (SELECT page_id, list_transform(regexp_extract_all(html, '<li><a [^>]*>([^<]*)</a>', 1), lambda x: replace(x, '&amp;', '&')) AS l FROM pages))""",
)
add(
    "win6_under_heading",
    lambda s, d: under_heading(html_nodes(given_pages(s, d)).filter(F.col("tag").isin("h1", "p", "ul", "div")), ["page_id", "parent_id"], "node_id",
                               F.col("tag") == "h1", 8).select("page_id", F.col("after_heading").alias("n"), "tag", "text"),
    """SELECT page_id, cast(n AS INTEGER) AS n, 'p' AS tag, replace(replace(replace(regexp_replace(l[n + 1], '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;', '&'), '&nbsp;', ' ') AS text
        FROM (SELECT page_id, l, unnest(range(1, least(8, len(l) - 1) + 1)) AS n FROM (
            SELECT page_id, string_split(regexp_extract(html, '(?s)</h1>(.*)</article>', 1), '<p>') AS l FROM pages))""",
)
