"""End-to-end jobs composed from the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import status as st, urls
from ..operators import maker, search
from ..operators.aggregates import stop_after_blocked
from ..operators.curate import INPUT_ORDER, first_wins, sort_memory, sort_ssd
from ..operators.boxes import DOCUMENT, Box, Find, page_boxes, spread
from ..operators.dom import chain, html_nodes, token
from ..operators.jsonld import jsonld_nodes, jsonld_price
from ..operators.joins import skip_done, with_detail_code, with_feed_price
from ..operators.lifecycle import retention_marks, upload_set
from ..operators.listing import memory_items, ssd_items, type_component
from ..operators.official import official_records
from ..session import stored
from ..sources.captures import read_listing
from ..sources.sinks import mall_snapshot, publish_latest, require_rows, write_run
from .config import page_frontier

#: What a search job knows of a visit besides its items.
VISIT = ("search_url", "final_url", "status", "blocked", "crawled_at", "artifact_dir", "error_name", "error_message")
RECORD_A = (
    "project", "source", "target", "query", "rank", "asin", "title", "brand", "price", "rating", "review_count", "is_sponsored",
    "prime_or_delivery_label", "coupon_label", "image_url", "product_url", *VISIT,
)
RECORD_OFFICIAL = (
    "project", "source", "target", "product_url", "final_url", "http_status", "status", "product_name", "price", "model_number", "specs", "faq",
    "description_text", "image_urls", "video_urls", "availability", "title", "meta_description", "canonical_url", "h1_texts", "blocked", "crawled_at",
    "artifact_dir", "error_name", "error_message",
)
RECORD_B = (
    "project", "source", "target", "query", "rank", "title", "price", "point_label", "stock_label", "product_url", "image_url",
    "category_label", *VISIT,
)


def memory_table(raw: DataFrame, run_at: Column | str) -> DataFrame:
    """Raw component rows to the published memory table: typed, first URL wins, sorted.

    Typing comes before the dedup shuffle, so the sampling pass of the sort reads typed rows
    instead of running the patterns again.
    """
    return sort_memory(first_wins(memory_items(type_component(raw, run_at)), "url", _order(raw)))


def ssd_table(raw: DataFrame, run_at: Column | str) -> DataFrame:
    """As ``memory_table`` for SSD listings."""
    return sort_ssd(first_wins(ssd_items(type_component(raw, run_at)), "url", _order(raw)))


def _order(raw: DataFrame) -> list[str]:
    return [c for c in INPUT_ORDER if c in raw.columns]


#: Title and visible text of a page.
SEEN = Box((DOCUMENT,), {"title": Find((chain(token("title")),)), "body": Find((chain(token("body")),), "shown")})


def _visits(pages: DataFrame, read: DataFrame, shop: str) -> DataFrame:
    """Each visited query with its status, from the page's title and text, the response and the error of the visit."""
    page = F.get(F.col("seen"), F.lit(0))
    texts = read.select("page_id", F.get(page["title"], F.lit(0)).alias("_title"), F.get(page["body"], F.lit(0)).alias("_text"))
    seen = pages.drop("html", "url").join(texts, "page_id", "left")
    if shop == "a":
        blocked = st.is_blocked_a("http_status", "_title", "_text")
    else:
        blocked = st.is_blocked_b("final_url", "http_status", "_title", "_text")
    failed = F.col("error_message").isNotNull()
    blocked = F.coalesce(blocked, F.lit(False)) | (failed & F.coalesce(st.is_blocked_error("error_message"), F.lit(False)))
    seen = seen.withColumn("blocked", blocked)
    reason = F.when(failed, st.failed_status("blocked", "error_message")).when(F.col("blocked"), "blocked")
    empty = F.coalesce(st.has_no_results("_text", shop), F.lit(False))
    return seen.withColumn("status", F.coalesce(reason, F.lit("ok"))).withColumn("_empty", empty).drop("_title", "_text")


def _search_records(pages: DataFrame, shop: str, n: int, columns: tuple[str, ...], source: str, target: str) -> DataFrame:
    box, extract = (search.SEARCH_A, search.search_items_a) if shop == "a" else (search.SEARCH_B, search.search_items_b)
    read = stored(page_boxes(pages, {"seen": SEEN, "items": box}, ("url",)))
    visits = _visits(pages, read, shop)
    visits = stored(stop_after_blocked(visits, "run", "query_pos"))
    items = stored(extract(spread(read, "items", box, ("url",)), n).drop("url"))
    if shop == "b":
        found = items.select("page_id").distinct().withColumn("_items", F.lit(1))
        visits = visits.join(found, "page_id", "left").withColumn(
            "status", F.when(F.col("status") == "ok", st.search_status_b("_empty", F.coalesce("_items", F.lit(0)))).otherwise(F.col("status")))
    hits = visits.filter("status = 'ok'").join(items, "page_id")
    bare = visits.join(hits.select("page_id").distinct(), "page_id", "left_anti")
    if shop == "a":
        bare = bare.withColumn("is_sponsored", F.lit(False))
    rows = hits.unionByName(bare, allowMissingColumns=True).withColumns({"source": F.lit(source), "target": F.lit(target)})
    return rows.select(*columns)


def search_a_records(pages: DataFrame, n: int = 20) -> DataFrame:
    """Records of search shop A: the items of every page that shows some, one placeholder with the reason for every other query.

    ``pages``: page_id, run, project, query, query_pos, url, html, search_url, final_url, http_status, crawled_at, artifact_dir, error_name,
    error_message; one row per visited query. Of each run, queries after the first wholly blocked one are left out.
    """
    return _search_records(pages, "a", n, RECORD_A, "amazon", "market-amazon-search")


def search_b_records(pages: DataFrame, n: int = 20) -> DataFrame:
    """As ``search_a_records`` for search shop B, where a page without items is ``no_results``."""
    return _search_records(pages, "b", n, RECORD_B, "bic", "market-bic-search")


def mall_snapshot_rows(pages: DataFrame, details: DataFrame, crawled_at: Column) -> DataFrame:
    """The snapshot of a mall shop: list items, first by URL (items without one all stay), with the code of their detail page.

    ``pages``: page_id, url, html of the list pages in page order; ``details``: url, html of saved detail pages, of which
    one per URL counts, the one with the smallest html.
    """
    items = search.extract_mall_items(pages)
    items = first_wins(items, "url", ("page_id", "item_pos"), blank_keys="keep")
    codes = details.select("url", search.jan_from_html("html").alias("jan"), "html")
    codes = first_wins(codes, "url", ("html",)).select("url", "jan")
    return mall_snapshot(with_detail_code(items, codes).withColumn("crawled_at", crawled_at))


def merchant_snapshot_rows(pages: DataFrame, snapshot: DataFrame) -> DataFrame:
    """New rows of a merchant's snapshot: items of the pages whose code it does not hold yet, the first of each code.

    ``pages``: page_id, html; ``snapshot``: the rows so far (blank, title, price, asin). The result has the same four columns.
    """
    items = search.extract_merchant_items(pages)
    fresh = skip_done(items, snapshot.select(F.trim("asin").alias("asin")), "asin")
    rows = first_wins(fresh, "asin", ("page_id", "item_pos"))
    return rows.select(F.lit("").alias("blank"), "title", "price", "asin")


def maker_snapshot_rows(
    list_pages: DataFrame, product_pages: DataFrame, detail_pages: DataFrame, feed: DataFrame, snapshot: DataFrame, host: str, crawled_at: Column
) -> DataFrame:
    """New rows of a maker's snapshot: every variant of the products that the list pages link to whose code the snapshot does not hold yet.

    ``list_pages``, ``product_pages``, ``detail_pages``: page_id, url, html; ``feed``: code, feed_pos and price structs; ``snapshot``: the rows so far. Products
    go in the order of their first link, variants as they are listed; a variant whose page was not captured leaves its code to the next
    that has it. Codes that are stored already are left out before any detail page is read.
    """
    links = maker.extract_product_links(html_nodes(list_pages, tags=("a",)), host).withColumnsRenamed({"page_id": "list_no", "product_url": "url"})
    # product pages are few and long: dealt out by page, read once, with their link passing through the reader. A partitioning
    # by one column could be that of the rows as they come, which adaptive execution may have put into a single task.
    linked = product_pages.join(links, "url").select("page_id", "url", "html", "list_no", "first_pos")
    linked = linked.repartition(int(linked.sparkSession.conf.get("spark.sql.shuffle.partitions")), "page_id", "url")
    variants = maker.extract_variants(linked, host, ("list_no", "first_pos"))
    fresh = stored(skip_done(variants, snapshot, "jan").withColumnRenamed("page_id", "product_id"))
    # one page per URL counts, and only pages that a fresh variant asks for are read
    pages = first_wins(detail_pages.join(fresh.select(F.col("variant_url").alias("url")).distinct(), "url", "left_semi"), "url", ("page_id",))
    pages = stored(pages.withColumn("sku", urls.query_param("url", "sku")))
    details = with_feed_price(maker.extract_detail(pages), feed, url="url")
    data = jsonld_price(jsonld_nodes(pages, carry=("url", "sku"))).withColumnRenamed("price", "data_price")
    details = maker.complete_detail(details.join(data, "page_id", "left"), maker.feed_price(F.struct("priceData", "discountPriceData")), "data_price")
    rows = fresh.join(details.withColumnRenamed("url", "variant_url").drop("page_id", "sku"), "variant_url")
    rows = first_wins(rows, "jan", ("list_no", "first_pos", "variant_pos", "product_id"))
    return rows.select("jan", "title", "price", "button_text", "discount_price", crawled_at.alias("crawled_at"))


def official_site_records(visits: DataFrame) -> DataFrame:
    """One record per visited official URL: what the page says, the status of the visit, and its run columns.

    ``visits``: page_id, project, product_url, final_url, html (null if no page came), http_status, crawled_at, artifact_dir, error_name,
    error_message. A visit that failed is blocked or an error by its message and the page that came, if any; fields of a page that did not come are null.
    """
    failed, came = F.col("error_message").isNotNull(), F.col("_visit.came")
    carried = [c for c in visits.columns if c not in ("html", "page_id")]
    # what is known of a visit goes through the reader with its page, so that nothing is joined
    visit = F.struct(*carried, F.col("html").isNotNull().alias("came")).alias("_visit")
    pages = visits.select("page_id", F.coalesce("final_url", "product_url").alias("url"), visit, "html")
    fields = official_records(pages, carry=("_visit",)).drop("product_url")
    said = [F.when(came, F.col(c)).alias(c) for c in fields.columns if c not in ("page_id", "_visit")]
    rows = fields.select("page_id", *[F.col(f"_visit.{c}").alias(c) for c in carried], *said)
    text = F.coalesce("body_text", F.lit(""))
    blocked = st.is_blocked("http_status", text) | (failed & F.coalesce(st.is_blocked_error("error_message"), F.lit(False)))
    rows = rows.withColumn("blocked", F.coalesce(blocked, F.lit(False)))
    broken = F.when(F.col("blocked"), "blocked").otherwise("error")
    status = F.when(failed, broken).otherwise(st.official_status("http_status", "blocked"))
    lists = {c: F.coalesce(c, F.array().cast(rows.schema[c].dataType)) for c in ("specs", "faq", "image_urls", "video_urls", "h1_texts")}
    rows = rows.withColumns({"status": status, "source": F.lit("official-site"), "target": F.lit("market-official-site"), **lists})
    return rows.select(*RECORD_OFFICIAL)


def merchant_frontier(summaries: DataFrame, snapshot: DataFrame, per_page: int = 16) -> DataFrame:
    """List pages that a merchant's run still has to read: merchant, page_no, page_url.

    ``summaries``: merchant, url and the result-count line of its first page; ``snapshot``: merchant and code of the rows so far. A merchant goes on at the page
    that its stored codes lead to; one without a count reads that page alone.
    """
    done = snapshot.filter(F.length(F.trim("asin")) > 0).groupBy("merchant").agg(F.count(F.lit(1)).alias("stored"))
    rows = summaries.join(done, "merchant", "left").withColumn("start", urls.resume_page(F.coalesce("stored", F.lit(0)), per_page))
    rows = rows.withColumns({"pages": urls.expected_pages(urls.result_summary("summary")), "pieces": urls.page_param_pieces("url")})
    last = F.when(F.col("pages") > 0, F.col("pages")).otherwise(F.col("start"))
    pages = page_frontier(rows.select("merchant", "pieces", "start", last.alias("last")), "last", "start")
    return pages.select("merchant", "page_no", urls.join_page("pieces", F.col("page_no")).alias("page_url"))


def run_target(rows: DataFrame, root: str, target: str, stamp: str, keep: int = 3) -> DataFrame:
    """Gate, write, publish and prune one run of a target; one row per file of its runs: path, segment, stamp, removable, upload.

    An empty run fails before anything is written. Rows are computed once, for the gate, both formats and the published version. Runs beyond the
    newest ``keep`` are marked removable; the files of this run are to be uploaded. Deleting and uploading stay with the caller.
    """
    spark = rows.sparkSession
    rows = require_rows(rows, f"{target}: no rows")
    paths = write_run(rows, root, target, stamp)
    publish_latest(rows, f"{root}/latest/{target}", at_least=1)
    # a written run is a folder of part files: its name is what is kept or pruned
    names = read_listing(spark, root).select(F.regexp_extract("path", rf"^(.*/{target}_[^/]*)/[^/]*$", 1).alias("path")).filter("path != ''").distinct()
    marks = retention_marks(names.withColumn("is_dir", F.lit(False)), keep)
    ends = F.substring_index("path", "/", -1)
    wanted = spark.createDataFrame([(p.rpartition("/")[2],) for p in paths], "path string")
    upload = upload_set(wanted, marks.select(ends.alias("path"))).select(F.col("path").alias("_name"), F.lit(True).alias("_upload"))
    marks = marks.withColumn("_name", ends).join(upload, "_name", "left")
    return marks.select(F.col("_name").alias("path"), "segment", "stamp", "removable", F.coalesce("_upload", F.lit(False)).alias("upload"))
