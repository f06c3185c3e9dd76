"""Text, price, date, specification, URL and status columns over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, money, specs, status, stock, text, urls
from .base import (
    K, LISTING_TEXT, NWS, RUN_AT, WS, Query, d_any, d_compact, d_get, d_norm, d_num, d_trim, listing, table,
    with_listing,
)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def add(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLES[name] = sql


def part(spark, sf):
    return table(spark, sf, "part")


def run_at():
    return F.lit(RUN_AT).cast("timestamp")


# --- text -------------------------------------------------------------------------------
DIRTY = "chr(160) || text || '　　' || chr(9)"
add(
    "scl01_compact_spaces",
    lambda s, d: table(s, d, "documents").select("doc_id", F.md5(text.compact_spaces(
        F.concat(F.lit(" "), "text", F.lit("　　\t")))).alias("digest")),
    f"SELECT doc_id, md5({d_compact(DIRTY)}) AS digest FROM documents",
)
add(
    "scl02_normalize_ws",
    lambda s, d: table(s, d, "documents").select("doc_id", F.md5(text.normalize_ws(
        F.concat(F.lit(" "), "text", F.lit("　　\t")))).alias("digest")),
    f"SELECT doc_id, md5({d_norm(DIRTY)}) AS digest FROM documents",
)
add(
    "scl16_first_non_empty",
    lambda s, d: listing(s, d).select("k", text.first_non_empty(
        "coupon_text", "stock_text", "product_name_text").alias("v")),
    with_listing(f"""SELECT k, coalesce(nullif({d_trim('coupon_text')}, ''), nullif({d_trim('stock_text')}, ''),
        nullif({d_trim('product_name_text')}, '')) AS v FROM listing"""),
)
add(
    "scl22_trim_description",
    lambda s, d: table(s, d, "documents").select("doc_id", F.length(text.trim_description("text")).alias("n"),
                                                 F.md5(text.trim_description("text")).alias("digest")),
    f"""WITH t AS (SELECT doc_id, {d_trim('text')} AS v FROM documents WHERE text <> ''),
        c AS (SELECT doc_id, CASE WHEN length(v) > 12000 THEN substring(v, 1, 12000) || '...' ELSE v END AS v FROM t)
        SELECT d.doc_id, cast(length(v) AS INTEGER) AS n, md5(v) AS digest FROM documents d LEFT JOIN c USING (doc_id)""",
)
add(
    "scl23_strip_tags",
    lambda s, d: table(s, d, "pages").select("page_id", F.md5(text.strip_tags("html")).alias("digest")),
    f"""SELECT page_id, md5(nullif({d_trim(f"regexp_replace(regexp_replace(regexp_replace(html, '(?i)<br{WS}*/?>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '{WS}{{2,}}', ' ', 'g')")}, ''))
        AS digest FROM pages""",
)
add(
    "scl27_unique_strings",
    lambda s, d: listing(s, d).select("k", F.array_join(text.unique_strings(F.split(
        F.concat_ws("|", "tags_text", "stock_text", "tags_text", F.lit("新品 ")), r"\|")), "/").alias("v")),
    with_listing(f"""SELECT k, list_aggregate(list(v ORDER BY first_pos), 'string_agg', '/') AS v FROM (
        SELECT k, v, min(pos) AS first_pos FROM (
            SELECT k, {d_trim('x')} AS v, pos FROM (
                SELECT k, unnest(parts) AS x, generate_subscripts(parts, 1) AS pos FROM (
                    SELECT k, string_split(concat_ws('|', tags_text, stock_text, tags_text, '新品 '), '|') AS parts
                    FROM listing)))
        WHERE v <> '' GROUP BY k, v) GROUP BY k"""),
)
add(
    "scl28_unique_structs",
    lambda s, d: listing(s, d).select("k", text.unique_specs(F.array(
        F.struct(F.col("maker_text").alias("label"), F.col("stock_text").alias("value")),
        F.struct(F.concat(F.lit(" "), "maker_text").alias("label"), F.trim("stock_text").alias("value")),
        F.struct(F.lit("  ").alias("label"), F.col("coupon_text").alias("value")))).alias("pairs"))
    .select("k", F.to_json("pairs", {"ignoreNullFields": "false"}).alias("v")),
    with_listing(f"""SELECT k, '[' || concat_ws(',',
        CASE WHEN {d_trim('stock_text')} <> '' THEN '{{"label":"' || maker_text || '","value":"' || {d_trim('stock_text')} || '"}}' END,
        CASE WHEN {d_trim('coupon_text')} <> '' THEN '{{"label":null,"value":"' || {d_trim('coupon_text')} || '"}}' END) || ']' AS v
        FROM listing"""),
)
add(
    "scl30_crop",
    lambda s, d: listing(s, d).select("k", text.crop_before("final_price_text", "円").alias("before_yen"),
                                      text.crop_after("final_price_text", "¥").alias("after_mark")),
    with_listing(f"""SELECT k, {d_trim("split_part(final_price_text, '円', 1)")} AS before_yen,
        CASE WHEN contains(final_price_text, '¥') THEN regexp_extract(split_part(final_price_text, '¥', 2), '^{NWS}*') END
        AS after_mark FROM listing"""),
)
add(
    "scl32_parse_flag",
    lambda s, d: table(s, d, "events").select("event_id", text.parse_flag(F.expr(
        "CASE event_id % 6 WHEN 0 THEN ' No ' WHEN 1 THEN 'off' WHEN 2 THEN '0' WHEN 3 THEN '　' WHEN 4 THEN event_type END"),
        True).alias("flag")),
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN false WHEN 1 THEN false WHEN 2 THEN false ELSE true END AS flag
        FROM events""",
)
add(
    "scl33_redact_headers",
    lambda s, d: table(s, d, "events").select("event_id", F.array_join(F.array_sort(F.map_keys(text.redact_headers(
        F.create_map(F.lit("Set-Cookie"), F.col("event_type"), F.expr(
            "CASE WHEN event_id % 2 = 0 THEN 'AUTHORIZATION' ELSE 'accept' END"), F.col("event_type"),
            F.lit("x-" ) , F.col("props"))))), ",").alias("kept")),
    "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'x-' ELSE 'accept,x-' END AS kept FROM events",
)
add(
    "scl35_names_and_snippet",
    lambda s, d: table(s, d, "documents").select("doc_id", F.array_join(text.names_sorted_distinct(
        F.array("source", "lang", "source")), ",").alias("names"), text.snippet("text", 80).alias("snippet")),
    """SELECT doc_id, CASE WHEN source = lang THEN lang WHEN source < lang THEN source || ',' || lang
        ELSE lang || ',' || source END AS names, substring(text, 1, 80) AS snippet FROM documents""",
)
add(
    "scl36_error_struct",
    lambda s, d: table(s, d, "events").select("event_id", text.error_struct(F.expr(
        "CASE event_id % 3 WHEN 0 THEN 'TimeoutError: ' || event_type || chr(10) || ' at x' WHEN 1 THEN event_type END"))
        .alias("e")).select("event_id", "e.name", "e.message", "e.stack"),
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'TimeoutError' END AS name,
        CASE WHEN event_id % 3 < 2 THEN event_type END AS message,
        CASE WHEN event_id % 3 = 0 THEN 'TimeoutError: ' || event_type || chr(10) || ' at x' END AS stack FROM events""",
)
add(
    "ext04_combined_text",
    lambda s, d: listing(s, d).select("k", text.combined_text(
        "maker_text", "product_name_text", "product_number_text", "coupon_text", F.array_join("tags", " ")).alias("v")),
    with_listing("""SELECT k, maker_text || ' ' || product_name_text || ' ' || product_number_text || ' ' || coupon_text
        || ' ' || replace(tags_text, '|', ' ') AS v FROM listing"""),
)
add(
    "ext08e_null_if_same",
    lambda s, d: listing(s, d).select("k", text.null_if_same("maker_text", F.expr(
        "CASE WHEN k % 3 = 0 THEN maker_text WHEN k % 3 = 1 THEN 'x' END")).alias("v")),
    with_listing("SELECT k, CASE WHEN k % 3 <> 0 THEN maker_text END AS v FROM listing"),
)
add(
    "src05_url_list",
    lambda s, d: table(s, d, "pages").select("page_id", F.posexplode(text.url_list(
        F.expr("CASE WHEN page_id % 4 = 0 THEN ' , ,' ELSE url || ' ,　' || url || '/b,, ' END"), F.concat(F.lit(" "), "url")))
        .alias("pos", "entry")),
    """SELECT page_id, 0 AS pos, url AS entry FROM pages
        UNION ALL SELECT page_id, 1, url || '/b' FROM pages WHERE page_id % 4 <> 0""",
)

# --- money ------------------------------------------------------------------------------
D_PRICE = rf"(?:¥|￥){WS}*([0-9][0-9,]*)|([0-9][0-9,]*){WS}*円"
D_COUPON_1 = rf"(?i)([0-9][0-9,]*){WS}*円{WS}*(?:引き|OFF|オフ)"
D_COUPON_2 = rf"(?i)(?:¥|￥){WS}*([0-9][0-9,]*){WS}*(?:OFF|オフ)"


def d_price_raw(c: str) -> str:
    return f"coalesce({d_get(c, D_PRICE, 1)}, {d_get(c, D_PRICE, 2)})"


def d_coupon(c: str) -> str:
    return d_num(f"coalesce({d_get(c, D_COUPON_1)}, {d_get(c, D_COUPON_2)})")


LONG = f"SELECT {K} AS k, {LISTING_TEXT} AS t FROM part"


def long_text(s, d):
    return part(s, d).select(F.col(K).alias("k"), F.expr(LISTING_TEXT).alias("t"))


add(
    "scl03_price_yen",
    lambda s, d: long_text(s, d).select("k", money.parse_price_yen("t").alias("p")).select("k", "p.price_yen", "p.price_raw"),
    f"SELECT k, {d_num(d_price_raw('t'))} AS price_yen, {d_price_raw('t')} AS price_raw FROM ({LONG})",
)
add(
    "scl04_coupon_yen",
    lambda s, d: listing(s, d).select("k", money.parse_coupon_yen("coupon_text").alias("coupon_yen")),
    with_listing(f"SELECT k, {d_coupon('coupon_text')} AS coupon_yen FROM listing"),
)
add(
    "scl05_remove_coupon_text",
    lambda s, d: listing(s, d).select("k", money.remove_coupon_text(
        F.concat_ws(" ", "final_price_text", "coupon_text", F.lit("300円OFF"), "coupon_text"), "coupon_text").alias("v")),
    with_listing(f"""SELECT k, regexp_replace(regexp_replace(
        CASE WHEN coupon_text = '' THEN t ELSE concat(substring(t, 1, p - 1), ' ', substring(t, p + length(coupon_text))) END,
        '{D_COUPON_1}', ' ', 'g'), '{D_COUPON_2}', ' ', 'g') AS v FROM (SELECT k, coupon_text, t, instr(t, coupon_text) AS p
        FROM (SELECT *, concat_ws(' ', final_price_text, coupon_text, '300円OFF', coupon_text) AS t FROM listing))"""),
)
add(
    "scl06_final_price",
    lambda s, d: listing(s, d).select("k", money.parse_price_yen("final_price_text")["price_yen"].alias("p"),
                                      money.parse_price_yen("original_price_text")["price_yen"].alias("o"),
                                      money.parse_coupon_yen("coupon_text").alias("c"))
    .select("k", money.final_price("p", "c").alias("final_price_yen"), F.coalesce("o", "p").alias("original_price_yen")),
    with_listing(f"""SELECT k, CASE WHEN p IS NOT NULL AND c IS NOT NULL THEN greatest(0, p - c) ELSE p END AS final_price_yen,
        coalesce(o, p) AS original_price_yen FROM (SELECT k, {d_num(d_price_raw('final_price_text'))} AS p,
        {d_num(d_price_raw('original_price_text'))} AS o, {d_coupon('coupon_text')} AS c FROM listing)"""),
)
add(
    "scl19_price_in_text",
    lambda s, d: part(s, d).select(F.col(K).alias("k"), money.price_in_text(F.concat(
        F.lit("定価 "), F.col("p_retailprice").cast("decimal(12,2)").cast("string"), F.lit(" 円です"))).alias("v")),
    f"""SELECT {K} AS k, nullif(regexp_extract('定価 ' || cast(cast(p_retailprice AS decimal(12,2)) AS string) || ' 円です',
        '(?:¥|￥){WS}*[0-9][0-9,]*(?:\\.[0-9]+)?|[0-9][0-9,]*(?:\\.[0-9]+)?{WS}*円', 0), '') AS v FROM part""",
)
MODEL_TEXT = f"p_name || 'は型番AB-' || cast({K} AS string) || 'Z-' || p_brand || 'です x' || p_type || '-99'"
add(
    "scl20_model_in_text",
    lambda s, d: part(s, d).select(F.col(K).alias("k"), money.model_in_text(F.expr(MODEL_TEXT)).alias("v")),
    rf"SELECT {K} AS k, nullif(regexp_extract({MODEL_TEXT}, '\b[A-Z]{{1,6}}-[A-Z0-9]{{2,}}[A-Z0-9-]*\b'), '') AS v FROM part",
)
add(
    "scl25_format_price",
    lambda s, d: part(s, d).select(F.col(K).alias("k"), money.format_price(
        F.expr(f"CASE WHEN {K} % 3 > 0 THEN cast({K} AS string) END"),
        F.expr(f"CASE WHEN {K} % 2 > 0 THEN 'JPY' END")).alias("v")),
    f"""SELECT {K} AS k, CASE WHEN {K} % 3 > 0 THEN CASE WHEN {K} % 2 > 0 THEN 'JPY ' ELSE '' END || cast({K} AS string) END
        AS v FROM part""",
)
add(
    "scl29_format_yen",
    lambda s, d: table(s, d, "lineitem").select("l_orderkey", "l_linenumber", money.format_yen("l_extendedprice").alias("v")),
    """SELECT l_orderkey, l_linenumber, format('{:,}', cast(floor(l_extendedprice + 0.5) AS BIGINT)) AS v FROM lineitem""",
)

# --- dates ------------------------------------------------------------------------------
D_STAMP = rf"(\d{{1,2}})/(\d{{1,2}}){WS}+(\d{{1,2}}):(\d{{2}})"
D_RANGE = rf"{D_STAMP}{WS}*(?:[~〜\-]|から){WS}*{D_STAMP}"
D_UNTIL = rf"{D_STAMP}{WS}*まで"


def d_iso(c: str, pattern: str, first: int) -> str:
    m, dd, h, mi = (f"lpad({d_get(c, pattern, first + i)}, 2, '0')" for i in range(4))
    return f"('2024-' || {m} || '-' || {dd} || 'T' || {h} || ':' || {mi} || ':00+09:00')"


add(
    "scl08_sale_period",
    lambda s, d: listing(s, d).select("k", dates.parse_sale_period("sale_text", run_at()).alias("p"))
    .select("k", "p.sale_period_raw", "p.sale_start", "p.sale_end"),
    with_listing(f"""SELECT k, nullif(t, '') AS sale_period_raw, {d_iso('t', D_RANGE, 1)} AS sale_start,
        coalesce({d_iso('t', D_RANGE, 5)}, {d_iso('t', D_UNTIL, 1)}) AS sale_end
        FROM (SELECT k, {d_compact('sale_text')} AS t FROM listing)"""),
)
add(
    "scl09_sale_end",
    lambda s, d: long_text(s, d).select("k", dates.parse_sale_end("t", run_at()).alias("sale_end_guess_jst")),
    f"SELECT k, {d_iso('t', D_UNTIL, 1)} AS sale_end_guess_jst FROM ({LONG})",
)
add(
    "scl31_time_formats",
    lambda s, d: table(s, d, "events").select("event_id", dates.iso_utc("ts").alias("iso"), dates.run_stamp("ts").alias("stamp"),
                                              dates.run_name("event_type", "ts").alias("run_name")),
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(cast(extract('millisecond' FROM ts) % 1000 AS string), 3, '0') || 'Z' AS iso,
        strftime(ts, '%Y-%m-%d_%H-%M-%S') AS stamp, event_type || '_' || strftime(ts, '%Y-%m-%d_%H-%M-%S') AS run_name
        FROM events""",
)

# --- stock ------------------------------------------------------------------------------
add(
    "scl10_stock",
    lambda s, d: listing(s, d).select("k", stock.normalize_stock("stock_text").alias("p"))
    .select("k", "p.in_stock", "p.in_stock_label", "p.stock_status"),
    with_listing(f"""SELECT k, CASE WHEN here THEN true WHEN gone THEN false END AS in_stock, nullif(t, '') AS in_stock_label,
        CASE WHEN here THEN 'in-stock' WHEN gone THEN 'out-of-stock' END AS stock_status
        FROM (SELECT k, t, regexp_matches(t, '在庫あり|即納|販売中|翌日出荷|当日出荷') AS here,
            regexp_matches(t, '在庫切れ|売り切れ|入荷待ち|お取り寄せ|予約|販売終了|終息') AS gone
            FROM (SELECT k, {d_compact('stock_text')} AS t FROM listing))"""),
)
AVAIL = f"""CASE {K} % 9 WHEN 0 THEN 'https://schema.org/InStock' WHEN 1 THEN 'unavailable' WHEN 2 THEN ' OutOfStock '
    WHEN 3 THEN '売り切れ 中' WHEN 4 THEN '売り切れ' WHEN 5 THEN 'Pre-Order' WHEN 6 THEN '　' WHEN 7 THEN p_type END"""
add(
    "scl17_availability",
    lambda s, d: part(s, d).select(F.col(K).alias("k"), stock.normalize_availability(F.expr(AVAIL)).alias("v")),
    f"""SELECT {K} AS k, CASE {K} % 9 WHEN 0 THEN 'in_stock' WHEN 1 THEN 'in_stock' WHEN 2 THEN 'out_of_stock'
        WHEN 3 THEN 'out_of_stock' WHEN 4 THEN '売り切れ' WHEN 5 THEN 'preorder' WHEN 7 THEN p_type END AS v FROM part""",
)
add(
    "scl18_availability_from_text",
    lambda s, d: part(s, d).select(F.col(K).alias("k"), stock.availability_from_text(F.concat(
        F.lit("x"), F.coalesce(F.expr(AVAIL), F.lit("")), F.expr(f"CASE WHEN {K} % 2 = 0 THEN 'Sold out' ELSE '' END")))
        .alias("v")),
    f"""SELECT {K} AS k, CASE WHEN {K} % 2 = 0 OR {K} % 9 IN (3, 4) THEN 'out_of_stock' WHEN {K} % 9 = 1 THEN 'in_stock' END
        AS v FROM part""",
)

# --- specifications ---------------------------------------------------------------------
NUM = r"\d+(?:\.\d+)?"
G = rf"(?i)({NUM}){WS}*GB{WS}*\({WS}*({NUM}){WS}*GB{WS}*[x×]{WS}*(\d{{1,2}}){WS}*\)"
PS = rf"(?i)({NUM}){WS}*GB{WS}*[x×]{WS}*(\d{{1,2}})"
MD = rf"(?i)({NUM}){WS}*GB{WS}*モジュール"
ST = rf"(?i)(\d{{1,2}}){WS}*(?:枚組|枚|kit|セット)"
TOT = rf"(?i)(\d{{1,4}}(?:\.\d+)?){WS}*GB\b"
DDR1, DDR2 = rf"(?i)\bLP?DDR{WS}*([34-6])\b", r"(?i)\bDDR([34-6])\b"
SP1, SP2 = rf"(?i)\bDDR[34-6](?:-|{WS})?(\d{{3,5}})\b", rf"(?i)\b(\d{{3,5}}){WS}*(?:MT/S|MHZ)\b"


def dbl(c: str, pattern: str, group: int = 1) -> str:
    return f"try_cast({d_get(c, pattern, group)} AS DOUBLE)"


def d_text_specs(source: str, key: str = "k") -> str:
    """Check SQL: specifications of ``t``."""
    return f"""SELECT {key}, ddr AS memory_ddr, gb2 AS memory_capacity_gb, cast(speed AS INTEGER) AS memory_speed,
        cast(sticks AS INTEGER) AS sticks, coalesce(per, CASE WHEN sticks > 0 THEN gb2 / sticks END) AS memory_capacity_per_stick_gb
        FROM (SELECT *, coalesce(gb, per * sticks) AS gb2 FROM (SELECT {key},
            'DDR' || coalesce({d_get('t', DDR1)}, {d_get('t', DDR2)}) AS ddr,
            coalesce({dbl('t', SP1)}, {dbl('t', SP2)}) AS speed,
            coalesce({dbl('t', G, 1)}, {dbl('t', PS, 1)} * {dbl('t', PS, 2)}, {dbl('t', TOT)}) AS gb,
            coalesce({dbl('t', G, 2)}, {dbl('t', PS, 1)}, {dbl('t', MD)}) AS per,
            coalesce({dbl('t', G, 3)}, {dbl('t', PS, 2)}, {dbl('t', ST)}) AS sticks FROM ({source})))"""


SPEC_COLS = ("memory_ddr", "memory_capacity_gb", "memory_speed", "sticks", "memory_capacity_per_stick_gb")
add(
    "scl12_memory_specs_text",
    lambda s, d: long_text(s, d).select("k", specs.memory_specs_text("t").alias("p")).select("k", *[F.col(f"p.{c}") for c in SPEC_COLS]),
    d_text_specs(f"SELECT k, {d_compact('t')} AS t FROM ({LONG})"),
)
add(
    "scl12_memory_specs_spec_text",
    lambda s, d: listing(s, d).select("k", specs.memory_specs_text("spec_text").alias("p"))
    .select("k", *[F.col(f"p.{c}") for c in SPEC_COLS]),
    with_listing(d_text_specs(f"SELECT k, {d_compact('spec_text')} AS t FROM listing")),
)
DT = rf"(?i)\bDDR{WS}*([34-6])\b"
EX = rf"(?i)^({NUM}){WS}*GB$"
SZ = rf"(?i)^({NUM}){WS}*(TB|GB)$"
RG = rf"(?i)({NUM}){WS}*(TB|GB){WS}*以上[〜~～\-]{WS}*({NUM}){WS}*(TB|GB)"
LO = rf"(?i)({NUM}){WS}*(TB|GB){WS}*以上"
UP1, UP2 = rf"(?i)^[〜~～]{WS}*({NUM}){WS}*(TB|GB)$", rf"(?i)[〜~～\-]{WS}*({NUM}){WS}*(TB|GB)$"
SZT = rf"(?i)({NUM}){WS}*(TB|GB)\b"


def d_tag_rows(source: str) -> str:
    """Check SQL: the filled tags of ``source(k, tags)`` with their place."""
    return f"""SELECT k, pos, t FROM (SELECT k, generate_subscripts(tags, 1) AS pos, unnest(tags) AS raw, {d_compact('raw')} AS t FROM ({source})) WHERE t <> ''"""


def d_first(*patterns: str) -> str:
    return "coalesce(" + ", ".join(f"min_by(t, pos) FILTER (WHERE regexp_matches(t, '{p}'))" for p in patterns) + ")"


def d_tag_specs(source: str) -> str:
    """Check SQL: memory specifications of ``source(k, tags, spec)``."""
    def first(pattern: str) -> str:
        return f"min_by({dbl('t', pattern)}, pos) FILTER (WHERE regexp_matches(t, '{pattern}'))"

    def last(group: int) -> str:
        return f"max_by({dbl('t', G, group)}, pos) FILTER (WHERE regexp_matches(t, '{G}'))"

    speed = f"coalesce({dbl('t', SP1)}, {dbl('t', SP2)})"
    return f"""SELECT k, ddr AS memory_ddr, coalesce(gb, per2 * sticks) AS memory_capacity_gb, cast(speed AS INTEGER) AS memory_speed,
        cast(sticks AS INTEGER) AS sticks, per2 AS memory_capacity_per_stick_gb
        FROM (SELECT *, coalesce(per, CASE WHEN sticks > 0 THEN gb / sticks END) AS per2 FROM (
            SELECT fb.k, coalesce(ddr, memory_ddr) AS ddr, coalesce(speed, memory_speed) AS speed, coalesce(g1, ex, memory_capacity_gb) AS gb,
                coalesce(g3, st, fb.sticks) AS sticks, coalesce(g2, md, memory_capacity_per_stick_gb) AS per
            FROM ({d_text_specs(f"SELECT k, {d_compact('spec')} AS t FROM ({source})")}) fb LEFT JOIN (
                SELECT k, min_by('DDR' || {d_get('t', DT)}, pos) FILTER (WHERE {d_get('t', DT)} IS NOT NULL) AS ddr,
                    min_by({speed}, pos) FILTER (WHERE {speed} IS NOT NULL) AS speed, {last(1)} AS g1, {last(2)} AS g2, {last(3)} AS g3,
                    {first(EX)} AS ex, {first(MD)} AS md, {first(ST)} AS st FROM ({d_tag_rows(source)}) GROUP BY k) tg ON fb.k = tg.k))"""


def d_type_label(source: str) -> str:
    """Check SQL: type label of ``source(k, tags, spec_text, ddr)``."""
    written = f"regexp_extract({d_compact('spec_text')}, '(?i)(DDR{WS}*[34-6](?:(?:-|{WS})?\\d{{3,5}})?)', 1)"
    return f"""SELECT l.k, coalesce(label, nullif(upper(regexp_replace({written}, '{WS}+', ' ', 'g')), ''), ddr) AS label FROM ({source}) l LEFT JOIN (
        SELECT k, coalesce(min_by(t, pos) FILTER (WHERE {d_get('t', DT)} IS NOT NULL), min_by(t, pos)) AS label
        FROM ({d_tag_rows(source)}) GROUP BY k) tg ON l.k = tg.k"""


def d_gb(v: str, u: str) -> str:
    return f"cast(floor(try_cast({v} AS DOUBLE) * CASE upper({u}) WHEN 'TB' THEN 1000 WHEN 'GB' THEN 1 END + 0.5) AS INTEGER)"


def d_word(w: str) -> str:
    return f"(?:^|[^A-Za-z0-9_]){w}(?:$|[^A-Za-z0-9_])"


def d_ssd_specs(source: str) -> str:
    """Check SQL: SSD specifications of ``source(k, tags, spec)``."""
    rows = f"SELECT *, regexp_matches(t, '{RG}') AS is_range FROM ({d_tag_rows(source)})"
    bounds = f"""SELECT *, CASE WHEN is_range THEN {d_gb(d_get('t', RG, 1), d_get('t', RG, 2))} ELSE {d_gb(d_get('t', LO, 1), d_get('t', LO, 2))} END AS lo,
        CASE WHEN is_range THEN {d_get('t', RG, 3)} ELSE coalesce({d_get('t', UP1, 1)}, {d_get('t', UP2, 1)}) END AS uv,
        CASE WHEN is_range THEN {d_get('t', RG, 4)} ELSE coalesce({d_get('t', UP1, 2)}, {d_get('t', UP2, 2)}) END AS uu FROM ({rows})"""
    per_item = f"""SELECT k, max(lo) AS lo, max({d_gb('uv', 'uu')}) AS up, max_by(uv || upper(uu), pos) FILTER (WHERE uv IS NOT NULL) AS up_text,
        min_by(t, pos) FILTER (WHERE regexp_matches(t, '{SZ}')) AS exact,
        {d_first('(?i)M[.]2', d_word('2280'), d_word('2242'), d_word('2230'), '2[.]5')} AS form_tag,
        {d_first('(?i)NVMe', '(?i)SATA', '(?i)PCIe', f'(?i)Serial{WS}*ATA')} AS if_tag, string_agg(t, ' | ' ORDER BY pos) AS tags_text FROM ({bounds}) GROUP BY k"""
    joined = f"""SELECT l.k, {d_compact('l.spec')} AS t, a.* EXCLUDE (k), up IS NOT NULL AND (lo IS NULL OR up > lo) AS wins
        FROM ({source}) l LEFT JOIN ({per_item}) a ON l.k = a.k"""
    resolved = f"""SELECT *, CASE WHEN wins THEN up ELSE coalesce({d_gb(d_get('exact', SZ, 1), d_get('exact', SZ, 2))}, lo) END AS gb,
        CASE WHEN wins THEN up_text ELSE exact END AS cap FROM ({joined})"""
    return f"""SELECT k, coalesce(gb, CASE WHEN cap IS NULL THEN {d_gb(d_get('t', SZT, 1), d_get('t', SZT, 2))} END) AS capacity_gb,
        coalesce(cap, {d_get('t', SZT, 1)} || upper({d_get('t', SZT, 2)})) AS capacity_text,
        coalesce(if_tag, upper({d_get('t', r'(?i)\b(NVMe|SATA|PCIe)\b')})) AS interface_text,
        coalesce(form_tag, {d_get('t', r'(?i)\b(M\.2|2280|2242|2230|2\.5)\b')}) AS form_factor, tags_text FROM ({resolved})"""


TAGGED = "SELECT k, string_split(tags_text, '|') AS tags, spec_text AS spec, spec_text, NULL AS ddr FROM listing"
add(
    "scl13_memory_specs_tags",
    lambda s, d: listing(s, d).select("k", specs.memory_specs_tags(F.col("tags"), "spec_text").alias("p"))
    .select("k", *[F.col(f"p.{c}") for c in SPEC_COLS]),
    with_listing(d_tag_specs(TAGGED)),
)
add(
    "scl11_memory_type_label",
    lambda s, d: listing(s, d).select("k", specs.memory_type_label(
        specs.pick_type_label(F.col("tags")), "spec_text", specs.memory_specs_text("spec_text")["memory_ddr"]).alias("label")),
    with_listing(d_type_label(TAGGED)),
)
add(
    "scl14_ssd_specs",
    lambda s, d: listing(s, d).select("k", specs.ssd_specs(F.col("tags"), "spec_text").alias("p")).select("k", "p.*"),
    with_listing(d_ssd_specs(TAGGED)),
)
add(
    "scl15_to_gb",
    lambda s, d: part(s, d).select(F.col(K).alias("k"), specs.to_gb(F.expr("cast(p_size AS string) || '.5'"), F.expr(
        f"CASE {K} % 3 WHEN 0 THEN 'tb' WHEN 1 THEN 'GB' ELSE 'MB' END")).alias("gb")),
    f"""SELECT {K} AS k, CASE {K} % 3 WHEN 0 THEN p_size * 1000 + 500 WHEN 1 THEN p_size + 1 END AS gb FROM part""",
)
