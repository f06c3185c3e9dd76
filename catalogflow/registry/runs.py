"""Configs, plans, readers, writers and streams, as round trips over the given tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.status import STATUS_A, STATUS_B, STATUS_OFFICIAL
from ..operators import aggregates as agg, joins
from ..plans import config, jobs
from ..schemas import MALL_SNAPSHOT, PROJECT_CONFIG
from ..session import ensure_checkpoint_dir
from ..sources import capture_source, captures, sinks
from ..streaming import ingest
from .base import K, Query, RUN_AT, given_pages, table
from .markup import ORACLES as MARKUP
from .markup import D_MALL, D_SEARCH_A, D_SEARCH_B, component_raw, mall_pages, merchant_pages, search_a_pages, search_b_pages
from .records import HOST, KS, SITE, feed_rows, link_pages, official_pages, variant_pages
from .records import ORACLES as RECORDS
from .web import META, SUMMARY
from .web import ORACLES as WEB

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def add(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLES[name] = sql


def scratch(s) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(s)}/runs-{uuid.uuid4().hex}"


# --- configs and plans ------------------------------------------------------------------
CONFIG_JSON = f"""concat('{{"project":" ', p_brand, '-', {K}, ' ","locale":"', CASE WHEN {K} % 3 = 0 THEN ' ' ELSE 'en-US' END, '","viewport":{{"width":',
    {K} - 3, '.6,"height":0}},"officialUrls":[" https://o.example.com/', {K}, ' ",""],"queries":{{"a":[" ', p_name, ' ",""," "],"b":["x', {K}, '","y"]}},"outputFormats":',
    CASE {K} % 3 WHEN 0 THEN '["pdf"]' WHEN 1 THEN '["jsonl","csv","jsonl"]' ELSE '["csv"]' END, '}}')"""


def configs(s, d):
    """Config texts written as JSON lines and read with the config schema."""
    path = scratch(s)
    table(s, d, "part").select(F.expr(CONFIG_JSON).alias("value")).write.text(path)
    return config.normalize_config(s.read.schema(PROJECT_CONFIG).json(path))


D_PROJECT = f"p_brand || '-' || cast({K} AS string)"
def config_files(s, d):
    """One config file per supplier, with line breaks inside, read as files."""
    path = scratch(s)
    text = F.regexp_replace(F.expr(CONFIG_JSON.replace("p_brand", "'s'").replace("p_name", "s_name").replace(K, "s_suppkey")), ',"', ',\n  "')
    # the given table lies in one split, and a file takes far longer to write than its bytes say
    rows = table(s, d, "supplier").repartition(int(s.conf.get("spark.sql.shuffle.partitions")), "s_suppkey")
    rows.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return config.read_project_config(s, path)


add(
    "src04_project_config",
    lambda s, d: config_files(s, d).select("project", "locale", "timezone", "viewport.width", "viewport.height", "login_state_label",
                                           "profile_name", F.array_join("official_urls", " ").alias("urls"), F.array_join("output_formats", ",").alias("formats"),
                                           F.array_join(F.col("queries")["a"], "/").alias("queries")),
    """SELECT 's-' || cast(s_suppkey AS string) AS project, CASE WHEN s_suppkey % 3 = 0 THEN 'ja-JP' ELSE 'en-US' END AS locale, 'Asia/Tokyo' AS timezone,
        cast(CASE WHEN s_suppkey > 3 THEN s_suppkey - 2 WHEN s_suppkey = 3 THEN 1 ELSE 1920 END AS INTEGER) AS width, 1080 AS height, 'anonymous' AS login_state_label,
        NULL AS profile_name, 'https://o.example.com/' || cast(s_suppkey AS string) AS urls,
        CASE s_suppkey % 3 WHEN 0 THEN 'csv,jsonl' WHEN 1 THEN 'jsonl,csv' ELSE 'csv' END AS formats, s_name AS queries FROM supplier""",
)
add(
    "pln01_query_plan",
    lambda s, d: config.query_plan(configs(s, d), "b", "b", "search-b", "2024-07-05T01:02:03.000Z", notes="n"),
    f"""SELECT {D_PROJECT} AS project, 'b' AS source, 'search-b' AS target, q AS query, 'pending_browsermcp' AS status,
        '2024-07-05T01:02:03.000Z' AS crawled_at, 'n' AS notes FROM part, unnest(['x' || cast({K} AS string), 'y']) AS u(q)""",
)
add(
    "pln02_channel_queries",
    lambda s, d: config.channel_queries(configs(s, d), "a"),
    f"SELECT {D_PROJECT} AS project, 0 AS query_pos, p_name AS query FROM part",
)
add(
    "pln03_first_query",
    lambda s, d: config.first_query(configs(s, d)),
    f"SELECT {D_PROJECT} AS project, p_name AS query, 'https://o.example.com/' || cast({K} AS string) AS url FROM part",
)
add(
    "pln04_pair_by_position",
    lambda s, d: table(s, d, "part").select(F.col(K).alias("k"), F.explode(joins.pair_by_position(
        F.split("p_name", " "), F.slice(F.array("p_brand", "p_type"), F.lit(1), (F.col(K) % 3).cast("int")))).alias("p")).select("k", "p.pos", "p.left", "p.right"),
    f"""SELECT k, cast(pos - 1 AS INTEGER) AS pos, a[pos] AS left, CASE WHEN pos <= k % 3 THEN b[pos] END AS right FROM (SELECT {K} AS k, string_split(p_name, ' ') AS a,
        [p_brand, p_type] AS b, unnest(generate_series(1, len(string_split(p_name, ' ')))) AS pos FROM part)""",
)

# --- sources ----------------------------------------------------------------------------
CAPTURE_PATH = f"""'s3://bucket/root/' || p_brand || '/search-a/2024-07-05_01-02-03/' || CASE WHEN {K} % 2 = 0 THEN '01-' || p_type || '/page.html'
    ELSE 'source-' || lpad(cast({K} % 90 AS string), 2, '0') || '-page-07.html' END"""
add(
    "src01_capture_paths",
    lambda s, d: table(s, d, "part").select(F.col(K).alias("k"), *captures.capture_path_fields(F.expr(CAPTURE_PATH))),
    f"""SELECT {K} AS k, 's3://bucket/root/' || p_brand || '/search-a/2024-07-05_01-02-03' || CASE WHEN {K} % 2 = 0 THEN '/01-' || p_type ELSE '' END AS capture_dir,
        p_brand AS project, 'search-a' AS target, '2024-07-05_01-02-03' AS run_stamp, CASE WHEN {K} % 2 = 0 THEN '01-' || p_type END AS label,
        CASE WHEN {K} % 2 = 1 THEN {K} % 90 END AS source_pos, CASE WHEN {K} % 2 = 1 THEN 7 END AS page_no FROM part""",
)


def capture_meta(s, d):
    texts = table(s, d, "pages").select("page_id", F.to_json(F.struct(
        F.lit("demo").alias("project"), "url", F.struct(F.lit(1920).alias("width"), F.lit(1080).alias("height")).alias("viewport"),
        (F.col("page_id") % 2 == 0).alias("blocked"),
        F.when(F.col("page_id") % 3 == 0, F.struct(F.lit("E").alias("name"), F.lit("m").alias("message"))).alias("error"))).alias("value"))
    return texts.select("page_id", captures.parse_capture_meta("value").alias("m")).select(
        "page_id", "m.url", "m.viewport.width", "m.blocked", F.col("m.error.name").alias("error_name"))


add(
    "src02_capture_meta",
    capture_meta,
    "SELECT page_id, url, 1920 AS width, page_id % 2 = 0 AS blocked, CASE WHEN page_id % 3 = 0 THEN 'E' END AS error_name FROM pages",
)


# Captures of the given pages: three projects, a run a day.
VISIT = "concat('p', page_id % 3, '/search/2024-07-', lpad(1 + page_id % 28, 2, '0'), '_01-02-03/', lpad(page_id, 8, '0'))"


def page_files(s, d, root, which="true"):
    pages = given_pages(s, d).filter(which)
    capture_source.write_capture_files(pages.select(F.expr(f"concat({VISIT}, '/page.html')").alias("name"), F.col("html").alias("text")), root)


def meta_files(s, d, root, which="true"):
    texts = given_pages(s, d).filter(which).select(F.expr(f"concat({VISIT}, '/metadata.json')").alias("name"), F.to_json(F.struct(
        F.lit("demo").alias("project"), "url", F.struct(F.lit(1920).alias("width"), F.lit(1080).alias("height")).alias("viewport"),
        (F.col("page_id") % 2 == 0).alias("blocked"),
        F.when(F.col("page_id") % 3 == 0, F.struct(F.lit("E").alias("name"), F.lit("m").alias("message"))).alias("error"))).alias("text"))
    capture_source.write_capture_files(texts, root)


def read_visits(s, d):
    root = scratch(s)
    page_files(s, d, root)
    return capture_source.read_capture_files(s, root).select(
        F.col("label").cast("bigint").alias("page_id"), "project", "target", "run_stamp", F.md5(F.col("text").cast("binary")).alias("text"),
        F.expr("substr(capture_dir, -8)").alias("folder"))


D_VISITS = """SELECT page_id, 'p' || cast(page_id % 3 AS string) AS project, 'search' AS target, '2024-07-' || lpad(cast(1 + page_id % 28 AS string), 2, '0') || '_01-02-03' AS run_stamp,
    md5(html) AS text, lpad(cast(page_id AS string), 8, '0') AS folder FROM pages"""
add("src01_read_captures", read_visits, D_VISITS)
add(
    "src01_read_some_runs",
    lambda s, d: read_visits(s, d).filter("run_stamp >= '2024-07-20' AND project IN ('p0', 'p2')"),
    f"SELECT * FROM ({D_VISITS}) WHERE run_stamp >= '2024-07-20' AND project IN ('p0', 'p2')",
)


def read_metas(s, d):
    root = scratch(s)
    page_files(s, d, root)
    meta_files(s, d, root)
    return capture_source.read_capture_meta_files(s, root).select(
        F.col("label").cast("bigint").alias("page_id"), "meta.url", "meta.viewport.width", "meta.blocked", F.col("meta.error.name").alias("error_name"), "run_stamp")


add(
    "src02_read_capture_meta",
    read_metas,
    """SELECT page_id, url, 1920 AS width, page_id % 2 = 0 AS blocked, CASE WHEN page_id % 3 = 0 THEN 'E' END AS error_name,
        '2024-07-' || lpad(cast(1 + page_id % 28 AS string), 2, '0') || '_01-02-03' AS run_stamp FROM pages""",
)


def listing_round_trip(s, d):
    root = scratch(s)
    table(s, d, "events").repartition(4, "event_type").write.partitionBy("event_type").parquet(root)
    files = captures.read_listing(s, root).filter(F.col("path").endswith(".parquet"))
    held = s.read.parquet(root).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"), F.first("_metadata.file_size").alias("size"))
    files = files.join(held, "path").withColumn("segment", F.regexp_extract("path", "event_type=([a-z]+)", 1))
    return files.groupBy("segment").agg(
        F.sum("n").alias("rows"), F.bool_and(~F.col("is_dir")).alias("are_files"), F.bool_and(F.col("length") == F.col("size")).alias("sizes"), F.bool_and(
            F.col("modified_at").isNotNull()).alias("times"))


add(
    "src06_file_listing",
    listing_round_trip,
    "SELECT event_type AS segment, count(*) AS rows, true AS are_files, true AS sizes, true AS times FROM events GROUP BY 1",
)

# --- sinks ------------------------------------------------------------------------------


def mall_rows(s, d):
    return table(s, d, "lineitem").select(
        F.lpad(F.col("l_partkey").cast("string"), 13, "0").alias("jan"), F.expr("'a \"q\", ' || l_returnflag || chr(10) || 'x'").alias("title"),
        F.expr("CASE WHEN l_linenumber = 1 THEN NULL ELSE cast(l_orderkey AS string) END").alias("price"), F.lit("").alias("points"),
        F.col("l_shipdate").alias("crawled_at"), (F.col("l_linenumber") == 2).alias("soldout"), (F.col("l_linenumber") == 3).alias("has_variation"))


def snapshot_round_trip(s, d):
    path = scratch(s)
    sinks.write_snapshot_csv(sinks.mall_snapshot(mall_rows(s, d)), path)
    return captures.read_snapshot(s, path, MALL_SNAPSHOT).select(*[F.coalesce(c, F.lit("")).alias(c) for c in (
        "jan", "title", "price", "points", "crawled_at", "soldout_label", "variation_label")])


D_SNAP = """SELECT lpad(cast(l_partkey AS string), 13, '0') AS jan, 'a "q", ' || l_returnflag || chr(10) || 'x' AS title,
    CASE WHEN l_linenumber = 1 THEN '' ELSE cast(l_orderkey AS string) END AS price, '' AS points, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000Z') AS crawled_at,
    CASE WHEN l_linenumber = 2 THEN '売り切れ ' ELSE '' END AS soldout_label, CASE WHEN l_linenumber = 3 THEN 'バリエーション有り' ELSE '' END AS variation_label FROM lineitem"""
add("snk1_src3_snapshot_csv", snapshot_round_trip, D_SNAP)


def component_round_trip(kind):
    """The published table of one kind, written and read back: every cell of every column as text."""
    def query(s, d):
        path = scratch(s)
        make = jobs.memory_table if kind == "memory" else jobs.ssd_table
        sinks.write_component_csv(make(component_raw(s, d), F.lit(RUN_AT).cast("timestamp")), kind, path)
        rows = s.read.csv(path, header=True, quote='"', escape='"', multiLine=True)
        return rows.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns])
    return query


for component in ("memory", "ssd"):
    add("snk2_component_csv" + ("_ssd" if component == "ssd" else ""), component_round_trip(component),
        f"SELECT coalesce(cast(COLUMNS(*) AS VARCHAR), '') FROM ({MARKUP[f'job_component_{component}_table']})")


def jsonl_round_trip(s, d):
    path = scratch(s)
    rows = table(s, d, "events").select("event_id", F.expr("CASE WHEN event_id % 2 = 0 THEN event_type END").alias("label"))
    sinks.write_jsonl(rows, path)
    raw = s.read.text(path).select(F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), F.contains("value", F.lit('"label":null')).alias("null_kept"))
    back = captures.read_jsonl_run(s, path, "event_id BIGINT, label STRING")
    return back.join(raw, "event_id")


add(
    "snk3_src7_jsonl",
    jsonl_round_trip,
    "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type END AS label, event_id % 2 = 1 AS null_kept FROM events",
)
add(
    "snk4_flatten_for_csv",
    lambda s, d: sinks.flatten_for_csv(table(s, d, "part").select(
        F.col(K).alias("k"), F.struct(F.col("p_brand").alias("b"), F.lit(None).cast("string").alias("n")).alias("nested"), F.array("p_type", "p_name").alias("list"),
        (F.col(K) % 2 == 0).alias("flag"), F.expr(f"CASE WHEN {K} % 3 > 0 THEN p_name END").alias("maybe"))),
    f"""SELECT cast({K} AS string) AS k, '{{"b":"' || p_brand || '","n":null}}' AS nested, '["' || p_type || '","' || p_name || '"]' AS list,
        CASE WHEN {K} % 2 = 0 THEN 'true' ELSE 'false' END AS flag, CASE WHEN {K} % 3 > 0 THEN p_name ELSE '' END AS maybe FROM part""",
)


def run_round_trip(s, d):
    root = scratch(s)
    csv, jsonl = sinks.write_run(table(s, d, "supplier").select("s_suppkey", "s_name"), root, "demo", "2024-07-05_01-02-03", [])
    a = s.read.csv(csv, header=True).select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"), F.col("s_name").alias("csv_name"))
    return a.join(s.read.schema("s_suppkey BIGINT, s_name STRING").json(jsonl), "s_suppkey")


add("snk5_write_run", run_round_trip, "SELECT s_suppkey, s_name AS csv_name, s_name FROM supplier")


def run_table(s, d):
    root = scratch(s)
    rows = table(s, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("kind"), F.date_trunc("year", "o_orderdate").alias("at"))
    for _ in range(2):  # the second write is a retry
        sinks.append_run_table(rows, root, "kind", "at")
    return s.read.parquet(root).select("o_orderkey", F.col("target").cast("string").alias("target"), F.col("run_ts").cast("string").alias("run_ts"))


add(
    "snk6_run_table",
    run_table,
    "SELECT o_orderkey, o_orderstatus AS target, strftime(date_trunc('year', o_orderdate), '%Y-%m-%d_%H-%M-%S') AS run_ts FROM orders",
)


def latest(s, d):
    path = f"{scratch(s)}/latest"
    sinks.publish_latest(table(s, d, "supplier").withColumn("s_name", F.lit("old")), path)
    sinks.publish_latest(table(s, d, "supplier"), path)
    return sinks.read_latest(s, path).select("s_suppkey", "s_name")


add("snk7_publish_latest", latest, "SELECT s_suppkey, s_name FROM supplier")
add(
    "snk8_run_manifest",
    lambda s, d: sinks.run_manifest(table(s, d, "lineitem").withColumnRenamed("l_suppkey", "source_url"), F.lit(RUN_AT).cast("timestamp"), keys=["l_returnflag"]),
    "SELECT l_returnflag, '2024-07-05T01:02:03.000Z' AS scraped_at, count(DISTINCT l_suppkey) AS source_count, count(*) AS count FROM lineitem GROUP BY 1",
)
def gated(s, d):
    """A published run, then an empty one that must not appear; the counts are those that the writes have observed."""
    path, rows = f"{scratch(s)}/latest", table(s, d, "supplier")
    written = sinks.publish_latest(rows, path, at_least=1)
    try:
        refused = sinks.publish_latest(rows.filter("s_suppkey < 0"), path, at_least=1)
    except ValueError:
        refused = -1
    kept = sinks.require_rows(sinks.read_latest(s, path), "no rows")
    return kept.select("s_suppkey", F.lit(written).alias("written"), F.lit(refused).alias("refused"))


add("snk9_require_rows", gated, "SELECT s_suppkey, count(*) OVER () AS written, -1 AS refused FROM supplier")

# --- jobs -------------------------------------------------------------------------------
# Visits of composed result pages: page ids say what went wrong. Runs are the tens of pages; in every third run of shop A the fifth query is blocked.
PAGE = "page_id"
GOES = f"""CASE WHEN {PAGE} % 30 = 5 THEN 'blocked' WHEN {PAGE} % 10 = 7 THEN 'transport_error' WHEN {PAGE} % 10 = 2 THEN 'error'
    WHEN {PAGE} % 10 = 3 THEN 'empty' ELSE 'ok' END"""


def search_visits(pages):
    """One visited query per page, with the page, response or error that the visit met."""
    goes = F.expr(GOES)
    html = F.when(goes == "blocked", "<html><head><title>x</title></head><body><p>入力された文字を下に表示 powered and protected by</p></body></html>")
    html = html.when(goes.isin("transport_error", "error"), F.lit("")).when(goes == "empty", "<html><head><title>y</title></head><body><p>nothing</p></body></html>")
    return pages.select(
        "page_id", F.expr(f"{PAGE} div 10").alias("run"), F.lit("demo").alias("project"), F.expr(f"concat('q', {PAGE})").alias("query"),
        F.expr(f"cast({PAGE} % 10 AS int)").alias("query_pos"), "url", html.otherwise(F.col("html")).alias("html"), F.col("url").alias("search_url"),
        F.concat("url", F.lit("&f")).alias("final_url"), F.when(goes == "ok", 200).alias("http_status"), F.lit("t").alias("crawled_at"),
        F.expr(f"concat('dir/', {PAGE})").alias("artifact_dir"), F.when(goes.isin("transport_error", "error"), "Error").alias("error_name"),
        F.when(goes == "transport_error", "net::ERR_FAILED").when(goes == "error", "boom").alias("error_message"))


def d_visits(site, empty):
    """The visits that count, in DuckDB: those of a run up to its first query without any page, blocked or not reached."""
    return f"""SELECT * FROM (SELECT *, min(CASE WHEN status IN ('blocked', 'transport_error') THEN {PAGE} % 10 END) OVER (PARTITION BY {PAGE} // 10) AS stop FROM (
        SELECT {PAGE}, 'demo' AS project, 'q' || cast({PAGE} AS string) AS query, '{site}' || cast({PAGE} AS string) AS search_url,
            '{site}' || cast({PAGE} AS string) || '&f' AS final_url, replace({GOES}, 'empty', '{empty}') AS status, {GOES} = 'blocked' AS blocked, 't' AS crawled_at,
            'dir/' || cast({PAGE} AS string) AS artifact_dir, CASE WHEN {GOES} IN ('transport_error', 'error') THEN 'Error' END AS error_name,
            CASE {GOES} WHEN 'transport_error' THEN 'net::ERR_FAILED' WHEN 'error' THEN 'boom' END AS error_message, {GOES} = 'ok' AS shown
        FROM (SELECT DISTINCT {K} // 20 AS {PAGE} FROM part))) WHERE stop IS NULL OR {PAGE} % 10 <= stop"""


def d_records(columns, items, site, empty, source, target):
    made = {"source": f"'{source}'", "target": f"'{target}'", "is_sponsored": "coalesce(is_sponsored, false)"}
    listed = ", ".join(f"{made[c]} AS {c}" if c in made else c for c in columns)
    return f"SELECT {listed} FROM ({d_visits(site, empty)}) v LEFT JOIN ({items}) r ON r.page_id = v.page_id AND v.shown"


D_RECORDS_A = d_records(jobs.RECORD_A, D_SEARCH_A, "https://a.example.com/s?k=", "ok", "amazon", "market-amazon-search")
D_RECORDS_B = d_records(jobs.RECORD_B, D_SEARCH_B, "https://b.example.com/s?q=", "no_results", "bic", "market-bic-search")
add("job_search_a_records", lambda s, d: jobs.search_a_records(search_visits(search_a_pages(s, d))), D_RECORDS_A)
add("job_search_b_records", lambda s, d: jobs.search_b_records(search_visits(search_b_pages(s, d))), D_RECORDS_B)


def d_rollup(records, statuses):
    return f"SELECT project, target, {', '.join(f'count(*) FILTER (status = {chr(39)}{x}{chr(39)}) AS {x}' for x in statuses)} FROM ({records}) GROUP BY ALL"


add(
    "job_search_a_summary",
    lambda s, d: agg.status_rollup(jobs.search_a_records(search_visits(search_a_pages(s, d))), ["project", "target"], STATUS_A),
    d_rollup(D_RECORDS_A, STATUS_A),
)
add(
    "job_search_b_summary",
    lambda s, d: agg.status_rollup(jobs.search_b_records(search_visits(search_b_pages(s, d))), ["project", "target"], STATUS_B),
    d_rollup(D_RECORDS_B, STATUS_B),
)

def twice(pages):
    """List pages of which each was captured again later."""
    return pages.unionByName(pages.withColumn("page_id", -F.col("page_id") - 1))


def mall_job(s, d):
    """List pages and saved detail pages (some twice, every ninth missing) to the mall snapshot."""
    details = table(s, d, "part").filter(f"{K} % 9 <> 0").select(
        F.concat(F.lit("https://mall.example.com/item/"), F.col(K).cast("string")).alias("url"), F.expr(META).alias("html"))
    details = details.union(details.filter(F.length("html") % 2 == 0))
    rows = jobs.mall_snapshot_rows(twice(mall_pages(s, d)), details, F.lit(RUN_AT).cast("timestamp"))
    return rows.withColumn("title", F.regexp_replace("title", "[ ]{2,}", " ")).withColumn("crawled_at", F.col("crawled_at").cast("string"))


add(
    "job_mall_snapshot",
    mall_job,
    f"""SELECT CASE WHEN k % 9 <> 0 AND k % 4 < 2 THEN '49' || lpad(cast(k AS string), 11, '0') ELSE '未セット' END AS jan, title, price, points, '{RUN_AT}' AS crawled_at,
        CASE WHEN soldout THEN '売り切れ ' END AS soldout_label, CASE WHEN has_variation THEN 'バリエーション有り' END AS variation_label FROM ({D_MALL})""",
)


def merchant_job(s, d):
    """List pages, captured twice, to the rows that a snapshot with every fifth code lacks."""
    snapshot = table(s, d, "part").filter(f"{K} % 5 = 0").select(
        F.lit("").alias("blank"), F.lit("t").alias("title"), F.lit("1").alias("price"), F.expr(f"concat(' B0', lpad(cast({K} AS string), 6, '0'), ' ')").alias("asin"))
    rows = jobs.merchant_snapshot_rows(twice(merchant_pages(s, d)), snapshot)
    return rows.withColumn("title", F.regexp_replace("title", "[ ]{2,}", " "))


add(
    "job_merchant_snapshot",
    merchant_job,
    f"""SELECT '' AS blank, title, price, asin FROM ({MARKUP['ext07_merchant_items']}) WHERE asin NOT IN
        (SELECT 'B0' || lpad(cast({K} AS string), 6, '0') FROM part WHERE {K} % 5 = 0)""",
)

# Every product page lists the parts that end in its number; pairs of parts share a code. Every 13th detail page is missing, every tenth code is stored.
JAN = "lpad(cast({k} AS string), 13, '0')"


def maker_job(s, d):
    parts = table(s, d, "part").withColumn("n", F.expr(f"{K} % 100"))
    entry = F.expr(f"""'<div><b class="show-for-b2c"><a href="/p?sku=P' || {KS} || '">v</a></b><i>x (JAN ' || {JAN.format(k=f"{K} div 2")} || ')</i></div>'""")
    products = parts.groupBy("n").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(K).alias("k"), entry.alias("e")))), lambda x: x["e"]), "").alias("list"))
    products = products.select(F.col("n").alias("page_id"), F.expr(f"'{HOST}/ja/products/x?sku=S' || cast(n AS string)").alias("url"),
                               F.expr("""'<div id="product-model-number" class="product-sku-list">' || list || '</div>'""").alias("html"))
    details = variant_pages(s, d).filter("page_id % 13 <> 0")
    stored = table(s, d, "part").filter(f"{K} div 2 % 10 = 0").select(F.expr(JAN.format(k=f"{K} div 2")).alias("jan"))
    return jobs.maker_snapshot_rows(link_pages(s, d), products, details, feed_rows(s, d), stored, HOST, F.lit(RUN_AT))


add(
    "job_maker_snapshot",
    maker_job,
    f"""WITH linked AS (SELECT k % 100 AS n, min(k) AS first FROM (SELECT {K} AS k FROM part) WHERE k % 6 >= 2 GROUP BY 1),
        fresh AS (SELECT k, first FROM (SELECT {K} AS k FROM part) JOIN linked ON n = k % 100 WHERE k % 13 <> 0 AND k // 2 % 10 <> 0),
        one AS (SELECT k FROM fresh QUALIFY row_number() OVER (PARTITION BY k // 2 ORDER BY first, k) = 1)
        SELECT {JAN.format(k="k // 2")} AS jan, title, price, button_text, discount_price, '{RUN_AT}' AS crawled_at FROM one JOIN ({RECORDS['ext13_maker_detail']}) r ON r.page_id = k""",
)

# Visits of official pages: every tenth of some kind is not found, unavailable, blocked by its page or its error, or fails without a page.
OFFICIAL_GOES = f"""CASE {K} % 10 WHEN 7 THEN 'not_found' WHEN 3 THEN 'unavailable' WHEN 5 THEN 'blocked' WHEN 9 THEN 'failed' WHEN 8 THEN 'refused' ELSE 'ok' END"""
CAPTCHA = "<html><head><title>x</title></head><body><p>solve the Captcha</p></body></html>"


def official_visits(s, d):
    goes = F.expr(OFFICIAL_GOES.replace(K, "page_id"))
    return official_pages(s, d).select(
        "page_id", F.lit("demo").alias("project"), F.col("url").alias("product_url"), F.col("url").alias("final_url"),
        F.when(goes == "blocked", CAPTCHA).when(~goes.isin("failed", "refused"), F.col("html")).alias("html"),
        F.when(goes == "not_found", 404).when(goes == "unavailable", 503).when(~goes.isin("failed", "refused"), 200).alias("http_status"),
        F.lit(RUN_AT).alias("crawled_at"), F.concat(F.lit("dir/"), "page_id").alias("artifact_dir"), F.when(goes.isin("failed", "refused"), "Error").alias("error_name"),
        F.when(goes == "failed", "net::ERR_FAILED").when(goes == "refused", "Access Denied by host").alias("error_message"))


def official_job(s, d):
    options = {"ignoreNullFields": "false"}
    return jobs.official_site_records(official_visits(s, d)).select(
        "project", "source", "target", "product_url", "final_url", "http_status", "status", "product_name", "price", "model_number", F.to_json("specs", options).alias("specs"),
        F.to_json("faq", options).alias("faq"), "description_text", F.array_join("image_urls", " ").alias("images"), F.size("video_urls").alias("videos"), "availability", "title",
        "blocked", "crawled_at", "artifact_dir", "error_name", "error_message")


D_OFFICIAL = f"""SELECT 'demo' AS project, 'official-site' AS source, 'market-official-site' AS target, '{SITE}' || {KS} AS product_url, '{SITE}' || {KS} AS final_url,
    cast(CASE g WHEN 'not_found' THEN 404 WHEN 'unavailable' THEN 503 WHEN 'failed' THEN NULL WHEN 'refused' THEN NULL ELSE 200 END AS INTEGER) AS http_status,
    CASE g WHEN 'unavailable' THEN 'error' WHEN 'failed' THEN 'error' WHEN 'refused' THEN 'blocked' ELSE g END AS status,
    CASE WHEN g = 'blocked' THEN 'x' WHEN page THEN product_name END AS product_name, CASE WHEN page THEN price END AS price,
    CASE WHEN g = 'blocked' THEN {KS} WHEN page THEN model_number END AS model_number, CASE WHEN page THEN specs ELSE '[]' END AS specs, CASE WHEN page THEN faq ELSE '[]' END AS faq,
    CASE WHEN g = 'blocked' THEN 'solve the Captcha' WHEN page THEN description_text END AS description_text, CASE WHEN page THEN images ELSE '' END AS images,
    cast(CASE WHEN page THEN 2 ELSE 0 END AS INTEGER) AS videos, CASE WHEN page THEN availability END AS availability,
    CASE WHEN g = 'blocked' THEN 'x' WHEN page THEN p_name || ' | shop' END AS title, g IN ('blocked', 'refused') AS blocked, '{RUN_AT}' AS crawled_at, 'dir/' || {KS} AS artifact_dir,
    CASE WHEN g IN ('failed', 'refused') THEN 'Error' END AS error_name, CASE g WHEN 'failed' THEN 'net::ERR_FAILED' WHEN 'refused' THEN 'Access Denied by host' END AS error_message
    FROM (SELECT *, g NOT IN ('blocked', 'failed', 'refused') AS page FROM (SELECT *, {OFFICIAL_GOES} AS g FROM part)) v JOIN ({RECORDS['ext25_official_records']}) r ON r.page_id = v.{K}"""
add("job_official_records", official_job, D_OFFICIAL)
add(
    "job_official_summary",
    lambda s, d: agg.status_rollup(jobs.official_site_records(official_visits(s, d)), ["project", "target"], STATUS_OFFICIAL),
    d_rollup(D_OFFICIAL, STATUS_OFFICIAL),
)


def frontier_job(s, d):
    """Merchants with a result-count line, some without, and the codes that are stored of them."""
    lines = table(s, d, "part").select(F.col(K).alias("merchant"), F.expr(f"'https://m.example.com/s?me=M' || {KS}").alias("url"), F.expr(SUMMARY).alias("summary"))
    snapshot = table(s, d, "lineitem").select(F.col("l_partkey").alias("merchant"), F.expr("CASE WHEN l_linenumber = 1 THEN ' ' ELSE 'B0' END").alias("asin"))
    return jobs.merchant_frontier(lines, snapshot, 4)


add(
    "job_merchant_frontier",
    frontier_job,
    f"""WITH n AS (SELECT k, max(n) AS n FROM ({WEB['pln12_expected_pages']}) GROUP BY k), stored AS (SELECT l_partkey AS k, count(*) FILTER (l_linenumber <> 1) AS c FROM lineitem GROUP BY 1),
        begun AS (SELECT n.k, n, greatest(1, coalesce(c, 0) // 4 + 1) AS start FROM n LEFT JOIN stored ON stored.k = n.k)
        SELECT k AS merchant, page_no, 'https://m.example.com/s?me=M' || cast(k AS string) || '&page=' || cast(page_no AS string) AS page_url
        FROM (SELECT k, unnest(CASE WHEN n > 0 THEN generate_series(start, n) ELSE [start] END) AS page_no FROM begun)""",
)

STAMPS = [f"2024-07-0{i}_01-02-03" for i in range(1, 6)]


def target_job(s, d):
    """Five runs of the component target: gate, both formats, publication, pruning, upload set; then the files that are left are counted."""
    root = scratch(s)
    table_rows = sinks.component_columns(jobs.memory_table(component_raw(s, d), F.lit(RUN_AT).cast("timestamp")), "memory")
    rows = sinks.require_rows(table_rows, "no rows")
    for i, stamp in enumerate(STAMPS):
        report = jobs.run_target(rows.filter(f"length(`URL`) % 5 <> {i}"), root, "memory", stamp, keep=3)
    counts = []
    for stamp in STAMPS:
        for kind, read in (("csv", lambda p: s.read.csv(p, header=True, quote='"', escape='"', multiLine=True)), ("jsonl", lambda p: s.read.schema("`URL` string").json(p))):
            counts.append(read(f"{root}/memory_{stamp}.{kind}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"memory_{stamp}.{kind}").alias("path"), "n"))
    latest = sinks.read_latest(s, f"{root}/latest/memory").agg(F.count(F.lit(1)).alias("latest"))
    return report.join(reduce(DataFrame.union, counts), "path").join(latest)


D_RUNS = f"""SELECT 'memory_' || stamp || '.' || kind AS path, 'memory' AS segment, stamp, i < 2 AS removable, i = 4 AS upload,
    (SELECT count(*) FROM m WHERE length("URL") % 5 <> i) AS n, (SELECT count(*) FROM m WHERE length("URL") % 5 <> 4) AS latest
    FROM (SELECT unnest({STAMPS}) AS stamp, unnest(range(5)) AS i) s, unnest(['csv', 'jsonl']) AS u(kind)"""
add("job_run_target", target_job, f"WITH m AS MATERIALIZED ({MARKUP['job_component_memory_table']}) {D_RUNS}")

# --- streams ----------------------------------------------------------------------------


def event_files(s, d, root: str):
    """The events table as two deliveries of several files each."""
    rows = table(s, d, "events").select("event_id", "user_id", "event_type")
    for i in range(2):
        rows.filter(F.col("event_id") % 2 == i).repartition(3, "event_id").write.mode("append").parquet(f"{root}/in")
        yield i


def stream_ingest(s, d):
    root = scratch(s)
    for _ in event_files(s, d, root):
        stream = ingest.capture_stream(s, f"{root}/in", "event_id BIGINT, user_id BIGINT, event_type STRING", 2)
        ingest.ingest_captures(stream, f"{root}/out", f"{root}/ck")
    return s.read.parquet(f"{root}/out").select("event_id", "user_id", "event_type")


def stream_first_seen(s, d):
    root = scratch(s)
    for delivery in event_files(s, d, root):
        stream = ingest.capture_stream(s, f"{root}/in", "event_id BIGINT, user_id BIGINT, event_type STRING")
        stream = stream.withColumn("key", F.concat_ws("-", "user_id", "event_type"))
        # each delivery with a checkpoint of its own over the same sink
        ingest.ingest_first_seen(stream, f"{root}/out", f"{root}/ck{delivery}", "key", ["event_id"])
    return s.read.parquet(f"{root}/out").select("key", "event_id")


def stream_captures(s, d):
    """Page files and metadata files in two deliveries, pages before and after their metadata; every seventh page has none."""
    root = scratch(s)
    deliveries = [("page_id % 2 = 0", "page_id % 7 <> 0 AND page_id % 3 = 0"), ("page_id % 2 = 1", "page_id % 7 <> 0 AND page_id % 3 > 0")]

    def run():
        joined = ingest.pages_with_meta(ingest.page_stream(s, f"{root}/in"), ingest.meta_stream(s, f"{root}/in"), "60 days")
        ingest.ingest_captures(joined, f"{root}/out", f"{root}/ck")

    for pages, metas in deliveries:
        page_files(s, d, f"{root}/in", pages)
        meta_files(s, d, f"{root}/in", metas)
        run()
    # a run long after: pages that have waited in vain come without metadata
    late = s.createDataFrame([("p/search/2030-01-01_00-00-00/late/page.html", "<p>late</p>"), ("p/search/2030-01-01_00-00-00/late/metadata.json", "{}")], "name string, text string")
    capture_source.write_capture_files(late, f"{root}/in")
    run()
    rows = s.read.parquet(f"{root}/out").filter("project != 'p'")
    return rows.select(F.col("label").cast("bigint").alias("page_id"), "meta.url", F.md5(F.col("html").cast("binary")).alias("text"))


add(
    "str1_capture_files",
    stream_captures,
    "SELECT page_id, CASE WHEN page_id % 7 <> 0 THEN url END AS url, md5(html) AS text FROM pages",
)
add("str1_incremental_ingest", stream_ingest, "SELECT event_id, user_id, event_type FROM events")
# The first delivery holds the even ids: a key keeps its smallest even id, else its smallest odd one.
add(
    "str2_first_seen",
    stream_first_seen,
    """SELECT cast(user_id AS string) || '-' || event_type AS key, coalesce(min(event_id) FILTER (event_id % 2 = 0), min(event_id)) AS event_id
        FROM events GROUP BY 1""",
)
