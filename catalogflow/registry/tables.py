"""Curation, joins, reports and lifecycle over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, status as st, urls
from ..functions.text import compact_spaces
from ..operators import aggregates as agg, curate, joins, lifecycle
from .base import K, LISTING_TEXT, RUN_AT, Query, d_any, d_compact, d_get, listing, table, with_listing
from .scalars import LONG, d_coupon, d_num, d_price_raw, long_text

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def add(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLES[name] = sql


# A row order of lineitem that identifies a row.
ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
O = ", ".join(ORDER)
KEY = "CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN '' ELSE 'P' || cast(l_partkey AS string) END"


def rows(s, d):
    return table(s, d, "lineitem").select(*ORDER, F.expr(KEY).alias("key"))


D_ROWS = f"SELECT {O}, {KEY} AS key FROM lineitem"

# --- dedup ------------------------------------------------------------------------------
add(
    "ded1_first_wins",
    lambda s, d: curate.first_wins(rows(s, d), "key", ORDER),
    f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY {O}) AS rn FROM ({D_ROWS}) WHERE key <> '') WHERE rn = 1",
)
add(
    "ded2_first_wins_after_resume",
    lambda s, d: curate.first_wins(joins.skip_done(rows(s, d), table(s, d, "part").filter("p_partkey % 5 = 0").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("key")), "key"), "key", ORDER),
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY {O}) AS rn FROM ({D_ROWS})
        WHERE key <> '' AND key NOT IN (SELECT 'P' || cast(p_partkey AS string) FROM part WHERE p_partkey % 5 = 0)) WHERE rn = 1""",
)
add(
    "ded3_first_wins_blank_kept",
    lambda s, d: curate.first_wins(rows(s, d), "key", ORDER, blank_keys="keep"),
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(key, '') ORDER BY {O}) AS rn FROM ({D_ROWS}))
        WHERE rn = 1 OR coalesce(key, '') = ''""",
)
add(
    "ded4_first_url_wins",
    lambda s, d: curate.first_wins(curate.keep_identified(listing(s, d).withColumn("url", F.expr(
        "CASE WHEN k % 4 = 0 THEN NULL ELSE 'https://shop.example.com/bc/item/' || cast(k % 97 AS string) END"))
        .withColumn("title", F.expr("CASE WHEN k % 8 = 0 THEN NULL ELSE product_name_text END")), any_of=("title", "url")),
        "url", ["k"], blank_keys="keep").select("k", "url", "title"),
    with_listing("""SELECT k, url, title FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY k) AS rn FROM (
        SELECT k, CASE WHEN k % 4 = 0 THEN NULL ELSE 'https://shop.example.com/bc/item/' || cast(k % 97 AS string) END AS url,
            CASE WHEN k % 8 = 0 THEN NULL ELSE product_name_text END AS title FROM listing)
        WHERE url IS NOT NULL OR title IS NOT NULL) WHERE rn = 1 OR url IS NULL"""),
)

# --- ranks, limits, windows -------------------------------------------------------------
add(
    "win1_rank_before_filter",
    lambda s, d: curate.rank_before_filter(rows(s, d).withColumn("query", F.col("l_suppkey")), ["query"], ORDER,
                                           F.length("key") > 0, 20).select("query", "rank", "key", *ORDER),
    f"""SELECT l_suppkey AS query, rank, key, {O} FROM (SELECT *, cast(row_number() OVER (PARTITION BY l_suppkey ORDER BY {O}) AS INTEGER)
        AS rank FROM ({D_ROWS})) WHERE rank <= 20 AND key <> ''""",
)
add(
    "win2_rank_after_filter",
    lambda s, d: curate.rank_after_filter(rows(s, d).withColumn("query", F.col("l_suppkey") % 10), ["query"], "key", ORDER,
                                          F.col("l_linenumber") > 2, 20).select("query", "rank", "key", *ORDER),
    f"""SELECT query, rank, key, {O} FROM (SELECT *, cast(row_number() OVER (PARTITION BY query ORDER BY {O}) AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY query, key ORDER BY {O}) AS rn
            FROM (SELECT *, l_suppkey % 10 AS query FROM ({D_ROWS})) WHERE l_linenumber > 2)
        WHERE rn = 1 OR coalesce(key, '') = '') WHERE rank <= 20""",
)
add(
    "srt3_top_n_per_query",
    lambda s, d: curate.top_n(table(s, d, "events").select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"], 5)
    .select("user_id", "event_id", "rank"),
    """SELECT user_id, event_id, rank FROM (SELECT *, cast(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER)
        AS rank FROM events) WHERE rank <= 5""",
)
add(
    "win_block_numbering",
    lambda s, d: curate.block_number(table(s, d, "events").select("event_type", "event_id"), ["event_type"], "event_id",
                                     shift=6),
    "SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS row_no FROM events",
)
add(
    "pln14_product_window",
    lambda s, d: curate.row_window(table(s, d, "part").select("p_partkey", "p_name"), "p_partkey", 150, 400),
    "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 400 OFFSET 150",
)
add(
    "srt5_offset_only",
    lambda s, d: curate.row_window(table(s, d, "events").select("event_id", "event_type"), "event_id", 777, 0),
    "SELECT event_id, event_type FROM events ORDER BY event_id OFFSET 777",
)
add(
    "srt5_sparse_ordinal",
    lambda s, d: curate.row_window(table(s, d, "events").select("event_id", "event_type", F.expr("(event_id * 7919 % 1000003) * 1000000007").alias("place")), "place", 50, 9000),
    "SELECT event_id, event_type, (event_id * 7919 % 1000003) * 1000000007 AS place FROM events ORDER BY place LIMIT 9000 OFFSET 50",
)
add(
    "win4_stop_after_blocked",
    lambda s, d: agg.stop_after_blocked(table(s, d, "events").select(
        "event_id", (F.col("user_id") % 10).alias("run"), F.col("user_id").alias("idx"),
        F.expr("CASE WHEN user_id % 37 = 5 THEN 'blocked' WHEN event_type = 'error' THEN 'transport_error' ELSE 'ok' END")
        .alias("status")), "run", "idx"),
    """WITH e AS (SELECT event_id, user_id % 10 AS run, user_id AS idx,
            CASE WHEN user_id % 37 = 5 THEN 'blocked' WHEN event_type = 'error' THEN 'transport_error' ELSE 'ok' END AS status FROM events),
        q AS (SELECT run, idx, bool_and(status IN ('blocked', 'transport_error')) AS b FROM e GROUP BY ALL),
        w AS (SELECT run, idx, coalesce(max(cast(b AS INTEGER)) OVER (PARTITION BY run ORDER BY idx
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped FROM q)
        SELECT e.* FROM e JOIN w USING (run, idx) WHERE stopped = 0""",
)
# --- sorts ------------------------------------------------------------------------------


def typed(s, d):
    from ..functions import money, specs

    return long_text(s, d).select(
        "k", money.parse_price_yen("t")["price_yen"].alias("final_price_yen"),
        specs.memory_specs_text("t")["memory_ddr"].alias("memory_ddr"),
        F.expr("CASE WHEN k % 9 = 0 THEN NULL ELSE 'pn-' || lpad(cast(k % 500 AS string), 4, '0') END").alias("product_number"),
        F.lit(1).alias("source_pos"), F.lit(1).alias("page_no"), F.col("k").alias("item_pos"))


D_TYPED = f"""SELECT k, {d_num(d_price_raw('t'))} AS final_price_yen, 'DDR' || nullif(regexp_extract(t, 'DDR([34-6])', 1), '') AS memory_ddr,
    CASE WHEN k % 9 = 0 THEN NULL ELSE 'pn-' || lpad(cast(k % 500 AS string), 4, '0') END AS product_number FROM ({LONG})"""
add(
    "srt1_sort_memory",
    lambda s, d: curate.sort_memory(typed(s, d)).select("k", "final_price_yen", "memory_ddr", "product_number"),
    f"""SELECT * FROM ({D_TYPED}) ORDER BY CASE memory_ddr WHEN 'DDR4' THEN 0 WHEN 'DDR5' THEN 1 ELSE 9 END,
        final_price_yen NULLS LAST, coalesce(product_number, ''), k""",
)
add(
    "srt2_sort_ssd",
    lambda s, d: curate.sort_ssd(typed(s, d)).select("k", "final_price_yen", "product_number"),
    f"""SELECT k, final_price_yen, product_number FROM ({D_TYPED}) ORDER BY final_price_yen NULLS LAST,
        coalesce(product_number, ''), k""",
)
add(
    "srt4_sample_first",
    lambda s, d: curate.sample_first(curate.sort_memory(typed(s, d)).select("k", "final_price_yen", "product_number"), 3),
    f"""SELECT k, final_price_yen, product_number FROM ({D_TYPED}) ORDER BY CASE memory_ddr WHEN 'DDR4' THEN 0 WHEN 'DDR5' THEN 1
        ELSE 9 END, final_price_yen NULLS LAST, coalesce(product_number, ''), k LIMIT 3""",
)

# --- sets -------------------------------------------------------------------------------
add(
    "set1_append_pages",
    lambda s, d: curate.append_all([
        table(s, d, "supplier").select(F.lit(1).alias("source_pos"), F.col("s_suppkey").alias("item_pos"), F.col("s_name").alias("title")),
        table(s, d, "customer").select(F.lit(2).alias("source_pos"), F.col("c_custkey").alias("item_pos"), F.col("c_name").alias("title"))]),
    """SELECT 1 AS source_pos, s_suppkey AS item_pos, s_name AS title FROM supplier
        UNION ALL SELECT 2, c_custkey, c_name FROM customer""",
)
add(
    "set2_union_of_keys",
    lambda s, d: curate.append_all([table(s, d, "supplier").select("s_suppkey", F.col("s_name").alias("name")),
                                    table(s, d, "customer").select(F.col("c_name").alias("name"), "c_mktsegment")]),
    """SELECT s_suppkey, s_name AS name, NULL AS c_mktsegment FROM supplier
        UNION ALL SELECT NULL, c_name, c_mktsegment FROM customer""",
)
add(
    "set3_ordered_array_union",
    lambda s, d: table(s, d, "part").select("p_partkey", F.array_join(curate.ordered_union(
        F.array("p_brand", "p_type"), F.array("p_type", "p_name", "p_brand")), "|").alias("v")),
    "SELECT p_partkey, p_brand || '|' || p_type || '|' || p_name AS v FROM part",
)
add(
    "flt1_keep_identified",
    lambda s, d: curate.keep_identified(listing(s, d), any_of=("coupon_text", "stock_text"), all_of=("product_number_text",))
    .select("k", "coupon_text", "stock_text", "product_number_text"),
    with_listing("""SELECT k, coupon_text, stock_text, product_number_text FROM listing WHERE product_number_text <> ''
        AND (coupon_text <> '' OR stock_text <> '')"""),
)

# --- joins ------------------------------------------------------------------------------
add(
    "j1_items_with_detail_code",
    lambda s, d: joins.with_detail_code(rows(s, d).withColumn("url", F.col("l_partkey")), table(s, d, "part")
        .filter("p_partkey % 3 > 0").select(F.col("p_partkey").alias("url"), F.expr(
            "CASE WHEN p_partkey % 4 = 0 THEN '' ELSE lpad(cast(p_partkey AS string), 13, '4') END").alias("jan"))),
    f"""SELECT {O}, key, l_partkey AS url, CASE WHEN l_partkey % 3 > 0 AND l_partkey % 4 > 0 AND p_partkey IS NOT NULL
        THEN lpad(cast(p_partkey AS string), 13, '4') ELSE '未セット' END AS jan
        FROM ({D_ROWS}) LEFT JOIN part ON p_partkey = l_partkey""",
)
add(
    "j2_variants_with_detail",
    lambda s, d: joins.with_variant_detail(table(s, d, "part").select("p_partkey", F.expr(
        """filter(transform(sequence(0, 2), i -> named_struct('jan', '49' || cast(p_partkey * 3 + i AS string),
            'href', '/p?sku=' || cast((p_partkey * 3 + i) % 4999 AS string))), v -> p_partkey % 5 > 0)""").alias("variants")),
        table(s, d, "orders").select(F.concat(F.lit("/p?sku="), F.col("o_orderkey").cast("string")).alias("variant_url"), "o_totalprice")),
    """SELECT p_partkey, cast(i AS INTEGER) AS variant_pos, '49' || cast(p_partkey * 3 + i AS string) AS jan,
        '/p?sku=' || cast((p_partkey * 3 + i) % 4999 AS string) AS variant_url, o_totalprice
        FROM (SELECT p_partkey, unnest([0, 1, 2]) AS i FROM part WHERE p_partkey % 5 > 0)
        LEFT JOIN orders ON o_orderkey = (p_partkey * 3 + i) % 4999""",
)
add(
    "j3_variant_feed_price",
    lambda s, d: joins.with_feed_price(table(s, d, "part").select("p_partkey", F.concat(
        F.lit("https://m.example.com/p?sku=S"), (F.col("p_partkey") % 300).cast("string")).alias("variant_url")),
        table(s, d, "events").select(F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("code"),
                                     F.col("event_id").alias("feed_pos"), "value")).select("p_partkey", "sku", "value"),
    """SELECT p_partkey, 'S' || cast(p_partkey % 300 AS string) AS sku, value FROM part
        LEFT JOIN (SELECT user_id, min_by(value, event_id) AS value FROM events GROUP BY user_id) ON user_id = p_partkey % 300""",
)
add(
    "j4_skip_done",
    lambda s, d: joins.skip_done(table(s, d, "part").select(F.col("p_partkey").cast("string").alias("jan"), "p_name"),
                                 table(s, d, "lineitem").filter("l_quantity > 48").select(F.col("l_partkey").cast("string").alias("jan")), "jan"),
    """SELECT cast(p_partkey AS string) AS jan, p_name FROM part
        WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)""",
)
add(
    "j5_only_staged",
    lambda s, d: joins.only_staged(table(s, d, "supplier").select("s_suppkey", "s_name"),
                                   table(s, d, "lineitem").filter("l_quantity > 49").withColumnRenamed("l_suppkey", "s_suppkey"), "s_suppkey"),
    "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49)",
)
add(
    "j6_plan_with_results",
    lambda s, d: joins.plan_with_results(
        table(s, d, "customer").select(F.col("c_custkey").alias("query"), "c_name"),
        table(s, d, "events").filter("event_type = 'purchase'").select(F.col("user_id").alias("query"), "event_id",
                                                                       F.lit(True).alias("is_sponsored")),
        empty_status="no_results", false_columns=("is_sponsored",)),
    """SELECT c_custkey AS query, c_name, event_id, coalesce(is_sponsored, false) AS is_sponsored,
        CASE WHEN event_id IS NULL THEN 'no_results' ELSE 'ok' END AS status
        FROM customer LEFT JOIN (SELECT user_id, event_id, true AS is_sponsored FROM events WHERE event_type = 'purchase')
        ON user_id = c_custkey""",
)
add(
    "j7_run_constants",
    lambda s, d: joins.with_run_context(table(s, d, "supplier").select("s_suppkey"), joins.RunContext(
        "demo", "a", "search-a", "2024-07-05T01:02:03.000Z")),
    """SELECT s_suppkey, 'demo' AS project, 'a' AS source, 'search-a' AS target, '2024-07-05T01:02:03.000Z' AS crawled_at FROM supplier""",
)
add(
    "j9_pair_by_position",
    lambda s, d: listing(s, d).select("k", F.posexplode(joins.pair_by_position(
        F.split("product_number_text", "[:：]"), F.split("stock_text", " "))).alias("n", "p")).select("k", "p.pos", "p.left", "p.right"),
    with_listing("""SELECT k, cast(pos - 1 AS INTEGER) AS pos, a[pos] AS left, b[pos] AS right FROM (
        SELECT k, a, b, unnest(generate_series(1, len(a))) AS pos FROM (SELECT k,
            string_split(replace(product_number_text, '：', ':'), ':') AS a, string_split(stock_text, ' ') AS b FROM listing))"""),
)

# --- aggregates -------------------------------------------------------------------------
STATUS_SQL = """CASE event_type WHEN 'view' THEN 'ok' WHEN 'click' THEN 'no_results' WHEN 'purchase' THEN 'blocked' ELSE 'error' END"""
add(
    "agg1_status_rollup",
    lambda s, d: agg.status_rollup(table(s, d, "events").select(F.expr("'p' || cast(user_id % 7 AS string)").alias("project"),
        F.expr(STATUS_SQL).alias("status")), ["project"], st.STATUS_B),
    f"""SELECT 'p' || cast(user_id % 7 AS string) AS project, count(*) FILTER (WHERE s = 'ok') AS ok,
        count(*) FILTER (WHERE s = 'no_results') AS no_results, count(*) FILTER (WHERE s = 'blocked') AS blocked,
        0::BIGINT AS transport_error, count(*) FILTER (WHERE s = 'error') AS error
        FROM (SELECT user_id, {STATUS_SQL} AS s FROM events) GROUP BY 1""",
)
add(
    "agg2_page_yield",
    lambda s, d: agg.page_yield(rows(s, d).withColumn("page_no", F.col("l_orderkey") % 40), curate.first_wins(
        rows(s, d).withColumn("page_no", F.col("l_orderkey") % 40), "key", ORDER), ["page_no"], F.length("key") > 0),
    f"""WITH r AS (SELECT *, l_orderkey % 40 AS page_no FROM ({D_ROWS})),
        u AS (SELECT page_no FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY {O}) AS rn FROM r WHERE key <> '') WHERE rn = 1)
        SELECT page_no, listed, extracted, coalesce(n, 0) AS unique_items, extracted - coalesce(n, 0) AS skipped_duplicates
        FROM (SELECT page_no, count(*) AS listed, count(*) FILTER (WHERE key <> '') AS extracted FROM r GROUP BY 1)
        LEFT JOIN (SELECT page_no, count(*) AS n FROM u GROUP BY 1) USING (page_no)""",
)
add(
    "agg3_items_per_page",
    lambda s, d: agg.items_per_page(table(s, d, "lineitem"), ["l_returnflag", "l_linenumber"]),
    "SELECT l_returnflag, l_linenumber, count(*) AS items FROM lineitem GROUP BY ALL",
)
add(
    "agg4_cleanup_report",
    lambda s, d: agg.cleanup_report(table(s, d, "orders"), F.col("o_orderdate") < "1998-01-01", F.col("o_orderstatus") == "F",
                                    F.col("o_orderstatus") == "P", ["o_orderpriority"]),
    """SELECT o_orderpriority, count(*) FILTER (WHERE e) AS expired_before, count(*) FILTER (WHERE e AND o_orderstatus = 'F') AS deleted,
        count(*) FILTER (WHERE e AND o_orderstatus = 'P') AS failures, count(*) FILTER (WHERE e AND o_orderstatus <> 'F') AS remaining_expired
        FROM (SELECT *, o_orderdate < '1998-01-01' AS e FROM orders) GROUP BY 1""",
)
add(
    "agg5_distinct_urls_in_order",
    lambda s, d: agg.distinct_in_order(table(s, d, "pages").select(F.regexp_replace("url", r"[?#].*$", "").alias("url"), "page_id"),
                                       "url", "page_id"),
    "SELECT regexp_replace(url, '[?#].*$', '') AS url, min(page_id) AS first_pos FROM pages GROUP BY 1",
)
add(
    "agg6_blocked_queries",
    lambda s, d: agg.blocked_queries(table(s, d, "events").select("user_id", F.expr(
        "CASE WHEN user_id % 9 = 0 THEN 'blocked' WHEN event_type = 'error' THEN 'transport_error' ELSE 'ok' END").alias("status")), ["user_id"]),
    """SELECT user_id, bool_and(user_id % 9 = 0 OR event_type = 'error') AS query_blocked FROM events GROUP BY 1""",
)
add(
    "agg7_capacity_bounds",
    lambda s, d: agg.capacity_bounds(listing(s, d), ["source_pos"]),
    with_listing("""SELECT source_pos, max(gb) AS upper_gb, min(gb) AS lower_gb FROM (SELECT k, source_pos, max(try_cast(nullif(
        regexp_extract(t, '([0-9]+)GB', 1), '') AS INTEGER)) AS gb FROM (SELECT k, source_pos, unnest(string_split(tags_text, '|')) AS t
        FROM listing) GROUP BY 1, 2) GROUP BY 1"""),
)

# --- lifecycle --------------------------------------------------------------------------
FILE_NAME = """'/out/' || CASE WHEN o_orderkey % 50 = 0 THEN 'notes' ELSE CASE WHEN o_orderkey % 20 = 1 THEN '' ELSE o_orderpriority || '_' END ||
    o_stamp END || CASE o_orderkey % 3 WHEN 0 THEN '.csv' WHEN 1 THEN '' ELSE '.jsonl' END"""
LISTING_ROWS = "o_orderkey, o_orderpriority, o_orderdate, o_orderkey % 3 = 1 AS is_dir"


def files(s, d):
    base = table(s, d, "orders").withColumn("o_stamp", dates.run_stamp("o_orderdate"))
    return base.select(F.expr(f"{FILE_NAME}").alias("path"), F.expr("o_orderkey % 3 = 1").alias("is_dir"),
                       F.col("o_orderdate").alias("modified_at"))


D_FILES = f"""SELECT {FILE_NAME} AS path, o_orderkey % 3 = 1 AS is_dir, o_orderdate AS modified_at
    FROM (SELECT *, strftime(o_orderdate, '%Y-%m-%d_%H-%M-%S') AS o_stamp FROM orders)"""
D_STAMP_RE = r"\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}"
add(
    "win3_retention_marks",
    lambda s, d: lifecycle.retention_marks(files(s, d), 3).select("path", "segment", "stamp", "removable"),
    f"""WITH f AS (SELECT path, is_dir, CASE WHEN is_dir THEN n ELSE regexp_replace(n, '\\.[^.]*$', '') END AS stem
            FROM (SELECT *, regexp_extract(path, '[^/]*$') AS n FROM ({D_FILES}))),
        p AS (SELECT path, is_dir, CASE WHEN is_dir AND regexp_full_match(stem, '{D_STAMP_RE}') THEN '__default__'
            ELSE nullif(regexp_extract(stem, '^(.+)_({D_STAMP_RE})$', 1), '') END AS segment,
            nullif(regexp_extract(stem, '({D_STAMP_RE})$', 1), '') AS stamp FROM f)
        SELECT path, segment, stamp, dense_rank() OVER (PARTITION BY is_dir, segment ORDER BY stamp DESC) > 3 AS removable
        FROM p WHERE segment IS NOT NULL AND stamp IS NOT NULL""",
)
add(
    "lif1_removable_paths",
    lambda s, d: lifecycle.removable_paths(files(s, d), float("nan")),
    f"SELECT path FROM ({ORACLES['win3_retention_marks']}) WHERE removable",
)
add(
    "lif2_expired_files",
    lambda s, d: files(s, d).filter(lifecycle.is_expired("modified_at", "is_dir", F.lit("1998-03-31 10:00:00").cast("timestamp")))
    .select("path", F.date_format("modified_at", "yyyy-MM-dd").alias("day")),
    f"SELECT path, strftime(modified_at, '%Y-%m-%d') AS day FROM ({D_FILES}) WHERE NOT is_dir AND modified_at < TIMESTAMP '1998-03-03 10:00:00'",
)
add(
    "lif2_month_before",
    lambda s, d: table(s, d, "orders").select("o_orderkey", F.date_format(dates.one_month_before("o_orderdate"), "yyyy-MM-dd").alias("cutoff")),
    """SELECT o_orderkey, strftime(make_date(CASE WHEN m = 1 THEN y - 1 ELSE y END, CASE WHEN m = 1 THEN 12 ELSE m - 1 END, 1)
        + cast(extract(day FROM o_orderdate) - 1 AS INTEGER), '%Y-%m-%d') AS cutoff
        FROM (SELECT *, extract(year FROM o_orderdate) AS y, extract(month FROM o_orderdate) AS m FROM orders)""",
)
add(
    "lif3_upload_set",
    lambda s, d: lifecycle.upload_set(table(s, d, "lineitem").select(F.concat(F.lit("/out/"), F.col("l_orderkey").cast("string"))
        .alias("path")), table(s, d, "orders").filter("o_orderstatus = 'F'").select(
            F.concat(F.lit("/out/"), F.col("o_orderkey").cast("string")).alias("path"))),
    """SELECT DISTINCT '/out/' || cast(l_orderkey AS string) AS path FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
add(
    "lif4_resume_state",
    lambda s, d: lifecycle.resume_state(rows(s, d), "key"),
    f"SELECT n AS stored, greatest(1, n // 16 + 1) AS next_page FROM (SELECT count(*) FILTER (WHERE trim(key) <> '') AS n FROM ({D_ROWS}))",
)
