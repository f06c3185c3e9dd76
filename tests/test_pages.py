"""Node table, shop pages, official pages, structured data, paging: hand-written mini pages."""

from __future__ import annotations

import json
import random
import re
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalogflow.functions import text
from catalogflow.operators import boxes, dom, jsonld, listing, maker, official, paging, search
from catalogflow.operators.dom import Automaton, chain, contained, html_nodes, marked, nodes_of, page_table, parse_page, token as t
from catalogflow.operators.joins import with_feed_price
from catalogflow.plans import jobs

URL = "https://shop.example.com/list/"


def pages(spark, *htmls):
    rows = [(i, f"{URL}{i}", 1, i, h) for i, h in enumerate(htmls, 1)]
    return spark.createDataFrame(rows, "page_id BIGINT, url STRING, source_pos INT, page_no INT, html STRING")


def nodes(spark, *htmls, **settings):
    return html_nodes(pages(spark, *htmls), carry=("url", "source_pos", "page_no"), **settings)


def tags(html):
    return [(r["node_id"], r["end_id"], r["tag"], r["text"]) for r in sorted(parse_page(html), key=lambda r: r["node_id"])]


def test_implied_ends_and_raw_text():
    got = tags("<ul><li>a<li>b<ul><li>c</ul></ul><p>x<p>y<div>z</div></p><script>if(a<b)'</p>'</script><!-- <p> -->&lt;")
    names = [g[2] for g in got]
    assert names == ["#document", "ul", "li", "li", "ul", "li", "p", "p", "div", "script"]
    assert [g[3] for g in got if g[2] == "li"] == ["a", "bc", "c"]
    assert [g[3] for g in got if g[2] == "p"] == ["x", "y"]


def test_broken_markup_is_whole():
    # A quote that never ends turns its tag into text.
    assert [g[2] for g in tags("<a href='x>y</a><b>ok</b>")] == ["#document", "b"]
    rows = tags("<table><tr><td>1<td>2<tr><td>3</table>tail <br/>< 5 <img src=a>")
    assert [g[2] for g in rows].count("td") == 3
    doc = parse_page("<body>a<script>s</script><p>b</p>c</body>")[-1]
    assert doc["tag"] == "#document" and doc["visible_text"].split() == ["a", "b", "c"]
    assert parse_page("")[0]["tag"] == "#document"
    long = "<div>" * 3000 + "x"
    assert len(parse_page(long)) == 3001


def test_selectors_and_containment(spark):
    marks = {"box_a": [chain(t(cls="box"), t("a"))], "a": [chain(t(cls="a"))], "part": [chain(t(part="box"), t("a"))], "l": [chain(t(id="l"))],
             "child": [chain(t(cls="box"), t("a", child=True)), chain(t("p"), t("a", child=True))]}
    n = nodes(spark, '<div class="box a-b"><p class="x"><a id=l>1</a></p></div><div class="boxes"><a>2</a></div>', marks=marks)
    assert [r.text for r in n.filter(marked("box_a")).collect()] == ["1"]
    assert n.filter(marked("a")).isEmpty()
    assert n.filter(marked("part")).count() == 2
    assert n.filter(marked("l")).count() == n.filter(marked("child")).count() == 1


def test_containment_against_brute_force(spark):
    html = "<div><p>a<p>b<ul><li><div><a>x</a><a>y</a></div><li></ul></div>" * 9 + "<b>" * 40 + "<i>deep</i>"
    n = nodes(spark, html, "<p>one</p>", "")
    rows = n.select("page_id", "node_id", "end_id", "tag").collect()
    box = n.filter(F.col("tag").isin("div", "ul", "b", "#document", "li")).select("page_id", F.col("node_id").alias("box_id"), "end_id")
    got = sorted((r.page_id, r.box_id, r.node_id) for r in contained(box, n.select("page_id", "node_id", "tag")).collect())
    assert got == sorted((b.page_id, b.node_id, r.node_id) for b in rows if b.tag in ("div", "ul", "b", "#document", "li") for r in rows
                         if r.page_id == b.page_id and b.node_id <= r.node_id <= b.end_id)


def brute_chain(c, path) -> bool:
    """Whether the last element of a path of (tag, attrs) answers to the chain, by trying every way."""
    def fits(token, at):
        tag, attrs = path[at]
        return token.fits_class(tag, attrs.get("class", "").split()) and token.fits_values(attrs)

    def below(k, at):
        if k < 0:
            return True
        places = [at - 1] if c.tokens[k + 1].child else range(at)
        return any(i >= 0 and fits(c.tokens[k], i) and below(k - 1, i) for i in places)

    return fits(c.tokens[-1], len(path) - 1) and below(len(c.tokens) - 2, len(path) - 1)


def test_automaton_against_every_path():
    rng = random.Random(8)
    tokens = [t("a"), t("b", cls="x"), t(cls=("x", "y")), t(part="y"), t(id="i"), t(attr=("href", "holds", "q")), t("a", child=True), t(cls="x", child=True), t(id_start="i", child=True)]
    chains = [chain(*[rng.choice(tokens[:6]), *[rng.choice(tokens) for _ in range(rng.randrange(3))]]) for _ in range(40)]
    automaton = Automaton(chains)
    for _ in range(300):
        path, state = [], 0
        for _ in range(rng.randrange(1, 9)):
            attrs = {k: rng.choice(v) for k, v in {"class": ["x", "x y", "zyz", ""], "id": ["i", "ii", "k"], "href": ["pqr", ""]}.items() if rng.random() < 0.6}
            path.append((rng.choice("ab"), attrs))
            state, ends = automaton.step(state, path[-1][0], attrs, attrs.get("class", "").split())
            assert [bool(ends >> i & 1) for i in range(len(chains))] == [brute_chain(c, path) for c in chains]


def test_boxes_inside_boxes(spark):
    box = boxes.Box((chain(t(cls="box")),), {
        "first": boxes.Find((chain(t("i")), chain(t("b"))), "node"), "all": boxes.Find((chain(t("b")), chain(t(cls="k"))), every=True),
        "top": boxes.Find((chain(t("body"), t(cls="box", child=True)),), itself=True)}, text="text", beside=2, until=frozenset(("h1",)))
    html = "<body><div class=box>1<b class=k>2</b><div class=box><b>3</b><u class=k>4</u></div><p>5</p><h1>6</h1></div><p>7</p><p>8</p><p>9</p></body>"
    outer, inner = boxes.box_rows(pages(spark, html), box).orderBy("box_id").collect()
    assert (outer.text, inner.text) == ("1234" + "56", "34") and (outer.top, inner.top) == (True, False)
    assert outer.first[0] is None and outer.first[1].text == "2" and outer.first[1].attrs == {"class": "k"} and inner.first[1].text == "3"
    assert [(x.choice, x.v) for x in outer.all] == [(0, "2"), (0, "3"), (1, "4")] and [(x.choice, x.v) for x in inner.all] == [(0, "3"), (1, "4")]
    assert [x.text for x in outer.beside] == ["7", "8"] and [x.text for x in inner.beside] == ["5"]
    assert outer.box_end == 8 and inner.box_end == 6


@pytest.mark.parametrize("extract", [
    listing.extract_component_items, search.extract_mall_items, search.extract_search_items_b, official.official_records, official.extract_specs, official.extract_faq,
    paging.next_links, maker.extract_detail])
def test_reading_pages_shuffles_nothing(spark, extract):
    """Fields come from the page's own row: the only exchange is that of a rank, where there is one."""
    frame = extract(pages(spark, "<p>x</p>"))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
    assert ("Window" in plan) == (extract is search.extract_search_items_b)


def test_deep_page_is_not_copied(spark):
    """A page of 1 MB, 500 elements deep, gives a table of the order of its size."""
    html = "".join(f'<div class="c{k} wide">' for k in range(500)) + "text " * 200_000
    table = page_table(pages(spark, html))
    size = table.select((F.length("page_text") + F.length("page_shown") + F.length(F.to_json("nodes"))).alias("n")).first().n
    assert size < 4 * len(html)
    assert nodes_of(table).filter("node_id = 250").select(F.length("text").alias("n")).first().n == 1_000_000


ITEM = """<div class="item_listbox"><a href="/i/{k}">x</a><img class="item-img" data-original="/p/{k}.jpg" src="b.gif">
<p class="manufacturer"><a>Maker</a></p><p class="itemname1"><a>Memory {k}</a></p><p class="modelnum">型番：M-{k}</p>
<div class="price_box"><span class="price">{price}</span></div><span class="nouki-msg">在庫あり</span>
<div class="item-tags"><a>DDR5</a><a> </a><a>32GB(16GB×2)</a></div></div>"""


def test_component_listing_to_table(spark):
    plain = '<div class="item_listbox"><p class="itemtag"> DDR4 SDRAM </p><p class="itemname2">8GB 3200MHz</p><b class="price_box">¥1,000 </b></div>'
    html = ITEM.format(k=1, price="¥20,000") + ITEM.format(k=2, price="¥5,000") + ITEM.format(k=1, price="¥9") + plain
    raw = listing.extract_component_items(pages(spark, html))
    rows = jobs.memory_table(raw, F.lit("2024-07-05").cast("timestamp")).collect()
    assert [(r.product_number, r.final_price_yen, r.memory_ddr) for r in rows] == [
        (None, 1000, "DDR4"), ("M-2", 5000, "DDR5"), ("M-1", 20000, "DDR5")]
    assert rows[0].url == URL + "1" and rows[0].memory_speed == 3200 and rows[0].item_tags == ["DDR4 SDRAM"]
    assert rows[1].image_url == "https://shop.example.com/p/2.jpg" and rows[1].item_tags == ["DDR5", "32GB(16GB×2)"]
    assert (rows[1].memory_capacity_gb, rows[1].sticks, rows[1].in_stock) == (32.0, 2, True)


def test_mall(spark):
    html = """<div class="searchresultitem"><h2><a href="/a"> T </a></h2><span class="price-wrapper--q">1,234円〜</span></div>
    <div class="searchresultitem"><h2><a href="/b">U</a></h2><b data-price=" 99 "></b><i class="x-soldout"></i></div>
    <div class="searchresultitem"><h2><a href="/c"></a></h2></div>"""
    got = search.extract_mall_items(pages(spark, html)).orderBy("item_pos").collect()
    assert [(r.title, r.price, r.soldout, r.has_variation) for r in got] == [("T", "1234", False, True), ("U", "99", True, False)]


def test_merchant_first_code_on_page(spark):
    box = '<div data-component-type="s-search-result" data-asin="{a}"><h2><span>{t}</span></h2><span class="a-price"><b class="a-offscreen">￥1,000</b></span></div>'
    html = "<div class='s-main-slot'>" + box.format(a="A", t="one") + box.format(a="A", t="two") + box.format(a="", t="none") + "</div>"
    html += "<div data-asin='Z'><h2><span>outside</span></h2></div>"
    got = search.extract_merchant_items(pages(spark, html, html)).collect()
    assert sorted((r.page_id, r.asin, r.title, r.price) for r in got) == [(1, "A", "one", "1000"), (2, "A", "one", "1000")]


def test_search_b_dedups_and_ranks(spark):
    html = """<ul class="bcs_listItem"><li><a href="/bc/item/1/">x</a><img alt="only image" src=""  data-src="/i.png"></li>
    <li><p class="bcs_title"><a href="/bc/item/1/">dup</a></p></li><li><a href="/other">no</a></li>
    <li><p class="bcs_title"><a href="/bc/item/2/">Two</a></p><span>1,000円（税込）</span></li></ul>"""
    got = search.extract_search_items_b(pages(spark, html)).orderBy("rank").collect()
    assert [(r.rank, r.title, r.price) for r in got] == [(1, "only image", None), (2, "Two", "1,000円（税込）")]
    assert got[0].image_url == "https://shop.example.com/i.png"


def qa(one, lines):
    return [(r.question, r.answer) for r in one(lambda: official.qa_entries(F.col("t")), t=lines)]


def test_question_lines(one):
    assert qa(one, ["Q: 何? A: これ"]) == [("何?", "これ")]
    assert qa(one, ["Q1", "A: x", "次は?", "はい"]) == [("1", "x"), ("次は?", "はい")]
    assert qa(one, ["quality matters", "b"]) == [("uality matters", None)]
    assert qa(one, ["a?", "b?", "c?"]) == [("a?", "b?"), ("c?", None)]
    assert qa(one, ["text", "質問：幅", "回答：5"]) == [("幅", "5")]
    assert qa(one, []) == []


def test_official_record(spark):
    data = {"@type": "Product", "name": "N", "sku": "S", "offers": {"price": 5, "priceCurrency": "JPY", "availability": "OutOfStock"}}
    html = f"""<title>T</title><script type="application/ld+json">{json.dumps(data)}</script><script type='application/ld+json'>{{no</script>
    <main><h1>H</h1><h2>Spec</h2><ul><li>a<li>b</ul><p>c</p><h3>x</h3><p>not</p><details><summary>S?</summary>ans</details></main>"""
    p = pages(spark, html)
    r = official.official_records(p).first()
    assert (r.product_name, r.price, r.model_number, r.availability, r.title) == ("N", "JPY 5", "S", "out_of_stock", "T")
    assert [(s.label, s.value) for s in r.specs] == [(None, "a"), (None, "b"), (None, "c")]
    assert [(q.question, q.answer) for q in r.faq] == [("S?", "ans")]


def test_structured_data_of_any_depth(spark):
    def nested(n: int) -> str:
        return '<script type="application/ld+json">' + '{"a":[0,' * n + "{}" + "]}" * n + "</script>"

    assert jsonld.jsonld_nodes(pages(spark, nested(8))).count() == 9
    deep = jsonld.jsonld_nodes(pages(spark, nested(30), nested(2), "<p>none</p>"))
    assert {r["page_id"]: r["count"] for r in deep.groupBy("page_id").count().collect()} == {1: 31, 2: 3}
    longest = deep.filter("page_id = 1").orderBy(F.size("place").desc()).first()
    assert longest.place == [0, 1] * 30


def walk(value, place=()):
    """Every object of a parsed value depth first, members as a script sees them: whole-number names first, others as written."""
    if isinstance(value, list):
        for i, v in enumerate(value):
            yield from walk(v, (*place, i))
    elif isinstance(value, dict):
        yield list(place), value
        whole = [k for k in value if k.isdigit() and (k == "0" or k[0] != "0") and len(k) < 10]
        names = sorted(whole, key=int) + [k for k in value if k not in whole]
        for i, k in enumerate(names):
            yield from walk(value[k], (*place, i))


def test_written_order_against_a_parsed_walk():
    rng = random.Random(3)

    def value(depth: int):
        kind = rng.randrange(6 if depth else 3)
        if kind < 3:
            return rng.choice(["a{b", 'q"\\', "]", 1.5, None, True, "日本,:"])
        if kind == 3:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        names = rng.sample(["z", "a", "10", "2", "01", "@type", "m[", "é", "x:y"], rng.randrange(5))
        return {k: value(depth - 1) for k in names}

    for _ in range(400):
        data = {"z": value(6), "a": value(6), "3": value(5)}
        text = json.dumps(data, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])).encode()
        got = [(place, json.loads(text[a:b])) for place, a, b in jsonld.written_objects(text)]
        assert got == list(walk(data))
    for broken in (b"", b"{", b"}{", b'{"a":[}', b'["', b"]]"):
        jsonld.written_objects(broken)


def test_first_product_is_the_first_written(spark):
    data = '{"z":{"@type":"Product","name":"first","sku":"S","offers":{"price":1}},"a":{"@type":"Product","name":"second","sku":"S","offers":{"price":2}}}'
    p = pages(spark, f'<script type="application/ld+json">{data}</script>')
    r = official.official_records(p).first()
    assert (r.product_name, r.price, r.model_number) == ("first", "1", "S")
    priced = jsonld.jsonld_price(jsonld.jsonld_nodes(p.withColumn("sku", F.lit("S")), carry=("url", "sku")))
    assert priced.first().price == "1"


def test_maker_variants_and_feed(spark):
    html = """<div class="product-sku-list"><div><b class="show-for-b2c"><a href="/v?sku=X1">v</a></b><i>(JAN 0123456789012)</i></div>
    <div><b class="show-for-b2c"><a href="/v?sku=X2">v</a></b></div></div>"""
    got = maker.extract_variants(pages(spark, html), "https://m.example.com").collect()
    assert [(r.jan, r.variant_url) for r in got] == [("0123456789012", "https://m.example.com/v?sku=X1")]
    feed = spark.createDataFrame(
        [("X1", 2, (None, "7"), None), ("X1", 1, ("￥1,000", None), (None, "899.5"))],
        "code STRING, feed_pos INT, priceData STRUCT<formattedValue: STRING, value: STRING>, discountPriceData STRUCT<formattedValue: STRING, value: STRING>")
    priced = with_feed_price(maker.extract_variants(pages(spark, html), "https://m.example.com"), feed)
    assert priced.select(maker.feed_price(F.struct("priceData", "discountPriceData")).alias("p")).first().p == "900"


def test_next_link_choices(spark):
    a = '<div class="pager"><a class="next" href="p2">n</a></div><a href="/t">次へ</a>'
    b = '<li class="disabled"><a href="/no">次</a></li><a href="/yes"> 次 </a>'
    c = '<div class="item_listbox"><a href="/in">Next</a></div>'
    d = '<div class="item_listbox_area"><a href="/l/2">次へ</a></div>'
    e = '<div class="pagination"><p class="next"><a>x</a><a href="/last">l</a></p></div><p class="pager"><a class="next" href="/good">g</a></p>'
    f = '<a rel="next" class="next">x</a><p class="pagination"><a class="next" href="/second">s</a></p><a href="/t">»</a>'
    g = '<p class="pagination"><a rel="next" class="next">x</a><a class="next" href="/second">s</a></p><a href="/t">»</a>'
    site = "https://shop.example.com"
    got = {r.page_id: r.next_url for r in paging.next_links(pages(spark, a, b, c, d, e, f, g)).collect()}
    assert got == {1: URL + "p2", 2: site + "/yes", 4: site + "/l/2", 5: site + "/good", 6: site + "/second", 7: site + "/t"}


@pytest.mark.parametrize("unit", ["<p ", '<a href="x ', "<a b='x \" ", "<b>x", "</script ", "<a", '<p "x" '])
@pytest.mark.parametrize("tail", ["", ">"])
def test_broken_pages_take_linear_time(unit, tail):
    def seconds(size: int) -> float:
        text, start = unit * (size // len(unit)) + tail, time.process_time()
        assert len(parse_page(text)) >= 1
        return time.process_time() - start

    small, large = min(seconds(250_000) for _ in range(2)), seconds(1_000_000)
    assert large < 10 * small + 1


def test_deep_nesting_holds_bounded_rows():
    rows = parse_page("<b>x" * 4000)
    assert len(rows) == 4001
    depth = {0: 0}
    for r in sorted(rows, key=lambda r: r["node_id"])[1:]:
        depth[r["node_id"]] = depth[r["parent_id"]] + 1
    assert max(depth.values()) == 511
    assert rows[-1]["text"] is None and "".join(r["own_text"] for r in sorted(rows, key=lambda r: r["node_id"])) == "x" * 4000
    assert max(len(parse_page("<b>" * 9, deepest=k)[-1]["tag"]) for k in (2, 5)) == len("#document")


@pytest.mark.parametrize("limit", [None, 1, 2, 3, 7, 50, 99])
def test_page_chain_against_walk(spark, limit):
    edge = {f"u{i}": f"u{i + 1}" for i in range(70)} | {"c1": "c2", "c2": "c3", "c3": "c1", "s": "s"}
    edges = spark.createDataFrame(list(edge.items()), "url STRING, next_url STRING")
    starts = ["u0", "u60", "c2", "s", "lonely"]
    got = paging.page_chain(edges, spark.createDataFrame([(s,) for s in starts], "source_url STRING"), limit)
    want = set()
    for s in starts:
        at, seen = s, []
        while at and at not in seen and len(seen) < (limit or 10_000):
            seen.append(at)
            at = edge.get(at)
        cut = bool(at and at not in seen)
        want |= {(s, i, u, cut) for i, u in enumerate(seen, 1)}
    rows = [(r.source_url, r.page_no, r.page_url, r.truncated) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_plain_tags_are_read_in_one_step(monkeypatch):
    """Only what is no plain tag goes the careful way; both ways read a page alike."""
    asked, careful = [], dom.Tags.following
    monkeypatch.setattr(dom.Tags, "following", lambda self, pos: asked.append(pos) or careful(self, pos))
    html = "<main><p class='a b'>x &amp; y<p title=\"1 > 0\">z<img src=a/></main>" * 50
    odd = "<!-- c --><a href='x<y'>l</a>< b <a\"b c='>"
    got = parse_page(html + odd)
    assert len(asked) <= 6
    monkeypatch.setattr(dom, "PLAIN", re.compile(r"(?!)()()()()"))
    asked.clear()
    assert parse_page(html + odd) == got and len(asked) > 200


def test_lines_of_the_reader_equal_tidy_text(spark):
    rng, signs = random.Random(3), list("ab \t\n\r\x0b\x0c\xa0\x85　 ﻿ é仕\U0001f600\x1c\x00​") + ["  "]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(9))) for _ in range(4000)]
    c = text.compact_spaces("v")
    rows = spark.createDataFrame([(v,) for v in texts], "v string").select("v", c.alias("c"), text.unique_strings(F.array(c)).alias("a"), text.unique_strings(F.array(c), tidy=True).alias("b"))
    assert all(boxes.tidy_line(r.v) == r.c and r.a == r.b for r in rows.collect())


def test_readers_answer_for_bounded_text_however_many_rows_come():
    """A batch of 10,000 pages is passed on in parts, so that a worker does not hold objects of all of them at once."""
    body = [b'{"a":[{"b":1},{"b":2}]}', None, b"[]"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10_000)), pa.array([body, None] * 5_000, pa.list_(pa.binary()))], ["page_id", "blocks"])
    parts = list(jsonld.with_objects(batch))
    assert max(p.num_rows for p in parts) <= 500
    whole = pa.Table.from_batches(parts)
    assert whole.select(["page_id", "blocks"]).equals(pa.Table.from_batches([batch]))
    places = [(0, []), (0, [0, 0]), (0, [0, 1])]
    assert [[(o["block_no"], o["place"]) for o in row] for row in whole["objects"].to_pylist()] == [places, []] * 5_000
    assert list(jsonld.with_objects(batch.slice(0, 0))) == []
    pages = pa.RecordBatch.from_arrays([pa.array(range(4_000)), pa.array(["x" * 2_000] * 4_000)], ["page_id", "html"])
    held = list(dom.batched(pages, 1, len, lambda carried, results: (len(carried[0]), sum(results))))
    assert max(chars for _, chars in held) <= 1_000_000 and sum(n for n, _ in held) == 4_000
