"""Scalar columns, with the engine traps: word boundary, blanks, no match, order of rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalogflow.functions import dates, money, specs, status, stock, text, urls


def test_blanks(one):
    assert one(lambda: text.compact_spaces("v"), v=" a　b\t\tc　　d ") == "a　b c d"
    assert one(lambda: text.normalize_ws("v"), v="　a　b\n\nc ") == "a b c"
    assert one(lambda: text.compact_spaces("v"), v=None) == ""
    assert one(lambda: text.trim_blank("v"), v="﻿　x　") == "x"
    assert one(lambda: text.compact_spaces("v"), v="a   b") == "a b"


def test_first_rules_keep_or_skip_empty(one):
    assert one(lambda: text.first_text("a", "b"), a="", b="x") == "x"
    assert one(lambda: text.first_text("a", "b"), a=" ", b="x") == " "
    assert one(lambda: text.first_non_empty("a", "b"), a="　", b=" x ") == "x"


def test_strip_tags_and_description(one):
    assert one(lambda: text.strip_tags("v"), v="a<BR/>b<i>c</i>  ") == "a b c"
    assert one(lambda: text.strip_tags("v"), v="<p></p>") is None
    assert one(lambda: text.trim_description("v"), v="x" * 12001) == "x" * 12000 + "..."
    assert one(lambda: text.trim_description("v"), v="") is None


def test_error_struct(one):
    e = one(lambda: text.error_struct("v"), v="TimeoutError: slow\n at x")
    assert (e.name, e.message) == ("TimeoutError", "slow") and e.stack.endswith("at x")
    e = one(lambda: text.error_struct("v"), v="plain: text")
    assert (e.name, e.message, e.stack) == (None, "plain: text", None)


@pytest.mark.parametrize("v,yen,raw", [
    ("¥ 1,980 税込", 1980, "1,980"), ("1,234円〜", 1234, "1,234"), ("￥99", 99, "99"), ("12 34", None, None),
    ("", None, None), (None, None, None), ("5円 ¥3", 5, "5"),
])
def test_price(one, v, yen, raw):
    got = one(lambda: money.parse_price_yen("v"), v=v)
    assert (got.price_yen, got.price_raw) == (yen, raw)


def test_coupon_and_final_price(one):
    assert one(lambda: money.parse_coupon_yen("v"), v="いま 500 円　引き") == 500
    assert one(lambda: money.parse_coupon_yen("v"), v="￥1,200 off") == 1200
    assert one(lambda: money.parse_coupon_yen("v"), v="500円") is None
    assert one(lambda: money.final_price("p", "c"), p=100, c=500) == 0
    assert one(lambda: money.remove_coupon_text("v", "c"), v="a 500円OFF b 500円OFF", c="500円OFF") == "a   b  "
    assert one(lambda: money.format_yen("v"), v="1234567.5") == "1,234,568"


def test_model_number_ends_like_a_browser_pattern(one):
    assert one(lambda: money.model_in_text("v"), v="型番AB-12Z-x です") == "AB-12Z-"
    assert one(lambda: money.model_in_text("v"), v="のAB-12を") == "AB-12"


def test_sale_period(spark):
    run = F.lit("2024-12-30 00:00:00").cast("timestamp")
    rows = spark.createDataFrame([("12/28 0:00から1/4 23:59",), ("8/5 23:59まで",), ("　",)], "v STRING").select(
        dates.parse_sale_period("v", run).alias("p")).collect()
    assert (rows[0].p.sale_start, rows[0].p.sale_end) == ("2024-12-28T00:00:00+09:00", "2024-01-04T23:59:00+09:00")
    assert (rows[1].p.sale_start, rows[1].p.sale_end) == (None, "2024-08-05T23:59:00+09:00")
    assert rows[2].p.sale_period_raw is None


def test_month_before_overflows(spark):
    got = spark.sql("SELECT timestamp'2023-03-31 10:00:00' AS t").select(dates.one_month_before("t").cast("string")).first()[0]
    assert got == "2023-03-03 10:00:00"


def test_stock_and_availability(one):
    assert one(lambda: stock.normalize_stock("v"), v="予約 即納").in_stock is True
    assert one(lambda: stock.normalize_stock("v"), v="お取り寄せ").stock_status == "out-of-stock"
    unknown = one(lambda: stock.normalize_stock("v"), v="確認中")
    assert unknown.in_stock is None and unknown.in_stock_label == "確認中"
    assert one(lambda: stock.normalize_availability("v"), v="unavailable") == "in_stock"
    assert one(lambda: stock.normalize_availability("v"), v="PreOrder") == "preorder"
    assert one(lambda: stock.availability_from_text("v"), v="在庫なし available") == "out_of_stock"


@pytest.mark.parametrize("v,want", [
    ("DDR5メモリ 32GBのメモリ", ("DDR5", 32.0, None, None, None)),
    ("DDR 5", (None, None, None, None, None)),
    ("LPDDR 5 4800MHz", ("DDR5", None, 4800, None, None)),
    ("DDR5-4800 32GB(16GB×2)", ("DDR5", 32.0, 4800, 2, 16.0)),
    ("8GBモジュール 2枚組", (None, 8.0, None, 2, 8.0)),
    ("8gbモジュール 4kit", (None, 8.0, None, 4, 8.0)),
    ("16GB 2枚", (None, 16.0, None, 2, 8.0)),
    ("0.5GB x 4", (None, 2.0, None, 4, 0.5)),
])
def test_memory_text(one, v, want):
    got = one(lambda: specs.memory_specs_text("v"), v=v)
    assert tuple(got) == want


def test_memory_tags(one):
    tags = ["8GB", "16GB(8GB×2)", "64GB( 16GB x 4 )", "DDR 5"]
    got = one(lambda: specs.memory_specs_tags(F.col("t"), "f"), t=tags, f="DDR4 3200MHz")
    assert tuple(got) == ("DDR5", 64.0, 3200, 4, 16.0)
    got = one(lambda: specs.memory_specs_tags(F.col("t"), "f"), t=["32GB", "2枚組"], f="")
    assert tuple(got) == (None, 32.0, None, 2, 16.0)
    assert one(lambda: specs.pick_type_label(F.col("t")), t=["新品", "DDR5 SDRAM"]) == "DDR5 SDRAM"
    assert one(lambda: specs.memory_type_label("b", "s", "d"), b="", s="x ddr5-4800 y", d="DDR4") == "DDR5-4800"


@pytest.mark.parametrize("tags,fallback,want", [
    (["1TB以上〜2TB", "NVMe SSD", "M.2 2280"], "", (2000, "2TB", "NVMe SSD", "M.2 2280")),
    (["〜960GB", "Serial ATA"], "", (960, "960GB", "Serial ATA", None)),
    (["500GB", "500GB以上"], "", (500, "500GB", None, None)),
    (["1TB以上"], "1.5TB nvme 2.5", (1000, "1.5TB", "NVME", "2.5")),
    ([], "2242 の 480gb", (480, "480GB", None, "2242")),
])
def test_ssd(one, tags, fallback, want):
    got = one(lambda: specs.ssd_specs(F.col("t"), "f"), t=tags, f=fallback)
    assert (got.capacity_gb, got.capacity_text, got.interface_text, got.form_factor) == want


@pytest.mark.parametrize("href,want", [
    ("b?c=1", "https://h.example.com/x/b?c=1"), ("../b", "https://h.example.com/b"), ("./", "https://h.example.com/x/"),
    ("/あ b", "https://h.example.com/%E3%81%82%20b"), ("//c.example.com", "https://c.example.com/"),
    ("?q", "https://h.example.com/x/a?q"), ("#f", "https://h.example.com/x/a?z=1#f"), ("mailto:a@b", "mailto:a@b"),
    ("", None), (None, None),
])
def test_absolute_url(one, href, want):
    assert one(lambda: urls.absolute_url("base", "h"), base="https://h.example.com/x/a?z=1#t", h=href) == want


def test_urls(one):
    assert one(lambda: urls.absolute_url("base", "h"), base="no url", h="x") is None
    assert one(lambda: urls.query_label("q", "i"), q=" a　b/c:*d ", i=99) == "100-a-b-c-d"
    assert one(lambda: urls.query_label("q", "i"), q=" ", i=0) == "01-query"
    assert one(lambda: urls.url_label("u", "i"), u="https://h.example.com:8/a//b?c", i=1) == "02-h.example.com-a-b"
    assert one(lambda: urls.with_page_param("u", 3), u="https://h.example.com/a?page=1&b=2#x") == "https://h.example.com/a?page=3&b=2#x"
    assert one(lambda: urls.page_number("t", "u"), t="0", u="https://h.example.com/?page=x") == 1
    assert one(lambda: urls.model_from_url("u"), u="https://h.example.com/a/bad%zz") is None
    assert one(lambda: urls.product_number("t", "u"), t="SKU： ab c", u=None) == "ab"
    assert one(lambda: urls.product_number("t", "u"), t="", u="https://h.example.com/abc") is None
    assert one(lambda: urls.redact_url_user("u"), u="http://me:pw@Proxy:80/x") == "http://***@proxy"
    s = one(lambda: urls.result_summary("t"), t="1,200 結果の 17 - 32")
    assert (s.total, s.start_no, s.end_no, s.is_valid) == (1200, 17, 32, True)
    assert one(lambda: urls.result_summary("t"), t="20結果の9-1").is_valid is False


def test_status(one):
    assert one(lambda: status.is_blocked("s", "t"), s=200, t="about Robotics") is True
    assert one(lambda: status.is_blocked("s", "t"), s=429, t=None) is True
    assert one(lambda: status.official_status("s", F.lit(False)), s=404) == "not_found"
    assert one(lambda: status.failed_status(F.lit(False), "m"), m="net::ERR_X") == "transport_error"
    assert one(lambda: status.is_blocked_b("u", "s", "t", "t"), u="chrome-error://x", s=200, t="captcha") is False
