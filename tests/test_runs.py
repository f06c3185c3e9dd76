"""Readers, writers, configs and streams on files in a new folder."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from catalogflow.functions import urls
from catalogflow.plans import config, jobs
from catalogflow.registry import runs
from catalogflow.schemas import MALL_SNAPSHOT, MERCHANT_SNAPSHOT
from catalogflow.sources import capture_source, captures, sinks
from catalogflow.streaming import ingest


def test_ragged_snapshot(spark, tmp_path):
    text = '﻿"0123","T ""q""","1","2","t"\n"9","a\nb","","","t","売り切れ "\n"8","c","","","t","","バリエーション有り"'
    (tmp_path / "s.csv").write_text(text, encoding="utf-8")
    rows = {r.jan: r for r in captures.read_snapshot(spark, str(tmp_path / "s.csv"), MALL_SNAPSHOT).collect()}
    assert rows["0123"].title == 'T "q"' and rows["0123"].soldout_label is None
    assert rows["9"].title == "a\nb" and rows["9"].soldout_label == "売り切れ "
    assert rows["8"].variation_label == "バリエーション有り"
    (tmp_path / "m.csv").write_text('﻿,"t","5","B01"\n', encoding="utf-8")
    row = captures.read_snapshot(spark, str(tmp_path / "m.csv"), MERCHANT_SNAPSHOT).first()
    assert (row.title, row.asin) == ("t", "B01")


def test_captures_and_meta(spark, tmp_path):
    visit = tmp_path / "proj" / "search-a" / "2024-07-05_01-02-03" / "01-query"
    visit.mkdir(parents=True)
    (visit / "page.html").write_text("<p>a\nb</p>", encoding="utf-8")
    (visit / "metadata.json").write_text(json.dumps({"project": "proj", "url": "u", "viewport": {"width": 1, "height": 2}, "blocked": True}, indent=2))
    (tmp_path / "run").mkdir()
    (tmp_path / "run" / "source-02-page-03.html").write_text("x")
    pages = captures.read_captures(spark, str(tmp_path))
    joined = pages.join(captures.read_capture_meta(spark, str(tmp_path)).drop("project", "target"), "capture_dir").first()
    assert (joined.html, joined.project, joined.target, joined.run_stamp, joined.label) == (
        "<p>a\nb</p>", "proj", "search-a", "2024-07-05_01-02-03", "01-query")
    assert joined.blocked is True and joined.viewport.height == 2
    listed = pages.filter("source_pos = 2").first()
    assert listed.page_no == 3
    assert captures.read_listing(spark, str(tmp_path)).count() == 3


def test_formats_and_gate(spark, tmp_path):
    assert sinks.output_formats([]) == ["csv", "jsonl"] and sinks.output_formats(["jsonl", "pdf", "jsonl"]) == ["jsonl"]
    with pytest.raises(ValueError, match="none"):
        sinks.require_rows(spark.range(0), "none")
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, named_struct('x', 1, 'y', CAST(NULL AS INT)) AS c, true AS d")
    csv, jsonl = sinks.write_run(df, str(tmp_path), "t", "s")
    line = "".join(p.read_text() for p in (tmp_path / "t_s.jsonl").glob("part-*.json")).strip()
    assert json.loads(line) == {"a": 1, "b": None, "c": {"x": 1, "y": None}, "d": True}
    text = "".join(p.read_text() for p in (tmp_path / "t_s.csv").glob("part-*.csv"))
    assert text == '"a","b","c","d"\n"1","","{""x"":1,""y"":null}","true"\n'


def test_empty_run_is_not_published(spark, tmp_path):
    path = str(tmp_path / "latest")
    assert sinks.publish_latest(spark.range(5), path, at_least=1) == 5
    with pytest.raises(ValueError, match="too few"):
        sinks.publish_latest(spark.range(5).filter("id > 9"), path, at_least=1)
    assert sinks.read_latest(spark, path).count() == 5
    assert sinks.publish_latest(spark.range(0), path) == 0 and sinks.read_latest(spark, path).count() == 0


def test_capture_source_opens_only_what_a_filter_leaves(spark, tmp_path):
    rows = [(f"p{i % 2}/t{i % 4 // 2}/2024-07-0{1 + i % 3}_00-00-00/{'' if i % 5 == 0 else f'l{i}/'}{i}.html", f"é{i}") for i in range(24)]
    assert capture_source.write_capture_files(spark.createDataFrame(rows, "name string, text string").repartition(3), str(tmp_path)) == 24
    (tmp_path / "p0" / "notes.txt").write_text("x")
    (tmp_path / "p0" / "t0" / "no-run").mkdir()
    found = capture_source.read_capture_files(spark, str(tmp_path))
    assert sorted(r.text for r in found.collect()) == sorted(t for _, t in rows)
    one = found.filter("run_stamp = '2024-07-02_00-00-00'")
    want = {(n.split("/")[0], n.split("/")[1], n.split("/")[3] if n.count("/") == 4 else None, t) for n, t in rows if "07-02" in n}
    for file in [*tmp_path.glob("*/*/2024-07-01*/**/*.html"), *tmp_path.glob("*/*/2024-07-03*/**/*.html")]:
        file.unlink()
        file.symlink_to("/nowhere")  # opening one fails
    assert {(r.project, r.target, r.label, r.text) for r in one.collect()} == want
    assert found.filter("project IN ('p1') AND run_stamp > '2024-07-01_99' AND run_stamp < '2024-07-03'").count() == len([1 for w in want if w[0] == "p1"])
    assert found.filter("project = 'none'").isEmpty()
    with pytest.raises(Exception):
        found.collect()


def test_pages_meet_their_metadata_in_any_order(spark, tmp_path):
    def deliver(*names):
        rows = [(n, json.dumps({"url": n}) if n.endswith("json") else n) for n in names]
        capture_source.write_capture_files(spark.createDataFrame(rows, "name string, text string"), str(tmp_path / "in"))
        joined = ingest.pages_with_meta(ingest.page_stream(spark, str(tmp_path / "in")), ingest.meta_stream(spark, str(tmp_path / "in")), "2 days")
        ingest.ingest_captures(joined, str(tmp_path / "out"), str(tmp_path / "ck"))
        rows = spark.read.parquet(str(tmp_path / "out")).collect()
        return sorted((r.label, r.meta.url[-20:] if r.meta else None) for r in rows)

    run = "p/t/2024-07-01_00-00-00"
    assert deliver(f"{run}/a/page.html", f"{run}/b/metadata.json", f"{run}/c/page.html") == []
    got = deliver(f"{run}/a/metadata.json", f"{run}/b/page.html")
    assert [g[0] for g in got] == ["a", "b"] and all(g[1].endswith(f"/{g[0]}/metadata.json") for g in got)
    late = "p/t/2024-07-09_00-00-00"
    got = deliver(f"{late}/d/page.html", f"{late}/d/metadata.json")
    assert [g[0] for g in got] == ["a", "b", "c", "d"] and got[2] == ("c", None)


def test_config_defaults_and_errors(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"project": " p ", "queries": {"z": [" ", "q1 "], "a": []}, "profileName": None,
                                                 "officialUrls": [" u "], "viewport": {"width": 800.4}, "outputFormats": ["xml"]}, indent=1))
    cfg = config.read_project_config(spark, str(tmp_path / "c.json"))
    row = cfg.first()
    assert (row.project, row.locale, row.timezone, row.login_state_label, row.profile_name) == ("p", "ja-JP", "Asia/Tokyo", "anonymous", None)
    assert (row.viewport.width, row.viewport.height, row.queries, row.output_formats) == (800, 1080, {"z": ["q1"]}, ["csv", "jsonl"])
    assert config.first_query(cfg).first().query == "q1" and config.official_urls(cfg).first().url == "u"
    plan = config.query_plan(cfg, "z", "b", "t", "now", "by hand").first()
    assert (plan.query, plan.status) == ("q1", "pending_browsermcp")
    with pytest.raises(Exception, match="at least one"):
        config.channel_queries(cfg, "a").collect()
    (tmp_path / "d.json").write_text('{"project": " "}')
    with pytest.raises(Exception, match="required"):
        config.read_project_config(spark, str(tmp_path / "d.json")).collect()


def test_streams_continue(spark, tmp_path):
    src, out, seen = (str(tmp_path / n) for n in ("in", "out", "seen"))
    for step in range(3):
        batch = spark.createDataFrame([(step * 10 + i, f"k{i % 3 + step}") for i in range(10)], "id BIGINT, key STRING")
        batch.coalesce(1).write.mode("append").parquet(src)
        stream = ingest.capture_stream(spark, src, "id BIGINT, key STRING", 1)
        ingest.ingest_captures(stream, out, str(tmp_path / "ck1"))
        ingest.ingest_first_seen(stream, seen, str(tmp_path / "ck2"), "key", ["id"])
    assert spark.read.parquet(out).count() == 30
    assert sorted((r.id, r.key) for r in spark.read.parquet(seen).collect()) == [(0, "k0"), (1, "k1"), (2, "k2"), (12, "k3"), (22, "k4")]


def test_first_seen_survives_a_new_checkpoint(spark, tmp_path):
    src, seen = str(tmp_path / "in"), str(tmp_path / "seen")
    for step in range(2):
        spark.createDataFrame([(step * 10 + i, f"k{i + step}") for i in range(2)], "id BIGINT, key STRING").write.mode("append").parquet(src)
        stream = ingest.capture_stream(spark, src, "id BIGINT, key STRING")
        for _ in range(2):  # the second start finds nothing new
            ingest.ingest_first_seen(stream, seen, str(tmp_path / f"ck{step}"), "key", ["id"])
    assert sorted((r.id, r.key) for r in spark.read.parquet(seen).collect()) == [(0, "k0"), (1, "k1"), (11, "k2")]


def test_first_seen_costs_what_a_batch_brings(spark, tmp_path):
    """Later runs read the new rows and what the run before has kept, not the sink; state answers for the rest."""
    src, seen, ck = (str(tmp_path / n) for n in ("in", "seen", "ck"))
    read = []
    for step in range(5):
        spark.createDataFrame([(step * 100 + i, f"k{(step * 20 + i) % 90}", f"v{step}") for i in range(40)], "id BIGINT, key STRING, v STRING").write.mode("append").parquet(src)
        query = ingest.ingest_first_seen(ingest.capture_stream(spark, src, "id BIGINT, key STRING, v STRING"), seen, ck, "key", ["id"])
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
    rows = spark.read.parquet(seen).collect()
    assert len(rows) == 90 == len({r.key for r in rows})
    first = {}
    for step in range(5):
        for i in range(40):
            first.setdefault(f"k{(step * 20 + i) % 90}", step * 100 + i)
    assert {r.key: r.id for r in rows} == first
    assert read[0] == 40 and max(read[1:]) <= 40 + 40


def test_writes_can_be_repeated(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "2024-07-05 01:02:03"), (2, "b", "2024-07-05 01:02:03"), (3, "b", "2024-07-06 01:02:03")], "id INT, kind STRING, at STRING")
    df = df.withColumn("at", df["at"].cast("timestamp"))
    table, latest = str(tmp_path / "table"), str(tmp_path / "latest")
    for _ in range(2):
        sinks.append_run_table(df, table, "kind", "at")
        sinks.publish_latest(df, latest)
        paths = sinks.write_run(df, str(tmp_path), "t", "s")
    assert spark.read.parquet(table).count() == 3
    assert sinks.read_latest(spark, latest).count() == 3
    assert spark.read.csv(paths[0], header=True).count() == spark.read.json(paths[1]).count() == 3
    sinks.append_run_table(df.filter("id = 3"), table, "kind", "at")
    assert spark.read.parquet(table).count() == 3
    sinks.publish_latest(sinks.read_latest(spark, latest).filter("id > 1"), latest)  # reads what it replaces
    assert sinks.read_latest(spark, latest).count() == 2


def test_frontier_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(config, "FRONTIER_BLOCK", 7)
    rows = spark.createDataFrame([("a", 20), ("b", 7), ("c", 0), ("d", None), ("e", 1)], "k STRING, pages INT")
    got = {}
    for r in config.page_frontier(rows).collect():
        got.setdefault(r.k, []).append(r.page_no)
    assert {k: sorted(v) for k, v in got.items()} == {"a": list(range(1, 21)), "b": list(range(1, 8)), "e": [1]}


def test_frontier_is_dealt_out(spark):
    """One row with many pages is work for many tasks, and the frontier starts where the merchant goes on."""
    rows = spark.createDataFrame([("a", 400_000, 7)], "k string, pages bigint, start bigint").coalesce(1)
    pages = config.page_frontier(rows, "pages", "start")
    assert (pages.agg(F.min("page_no"), F.max("page_no"), F.count("*")).first()) == (7, 400_000, 399_994)
    assert pages.select(F.spark_partition_id().alias("p")).distinct().count() == 8
    assert config.page_frontier(rows, "pages", F.lit(400_001)).count() == 0


def test_frontier_is_small_on_disk(spark, tmp_path, monkeypatch):
    """Page numbers of the same range lie together in a task, so a file of the frontier takes less than a byte a row; odd sizes and starts lose no page."""
    rows = spark.range(400).select("id", F.lit(20_000).alias("pages"))
    config.page_frontier(rows).write.parquet(str(tmp_path / "f"))
    back = spark.read.parquet(str(tmp_path / "f")).groupBy("id").agg(F.count("*").alias("n"), F.countDistinct("page_no").alias("d"), F.max("page_no").alias("last"))
    assert [tuple(r) for r in back.groupBy("n", "d", "last").count().collect()] == [(20_000, 20_000, 20_000, 400)]
    assert sum(f.stat().st_size for f in (tmp_path / "f").glob("*.parquet")) < 400 * 20_000
    monkeypatch.setattr(config, "FRONTIER_BLOCK", 7)
    monkeypatch.setattr(config, "FRONTIER_RANGE", 3)
    some = spark.createDataFrame([(1, 30, 1), (2, 30, 9), (3, 14, 14), (4, 15, 15), (5, 3, 4), (6, 8, None), (7, None, 1), (8, 5, -3)], "k int, pages int, start int")
    got = sorted((r.k, r.page_no) for r in config.page_frontier(some, "pages", "start").collect())
    assert got == [(k, n) for k, a, b in ((1, 1, 30), (2, 9, 30), (3, 14, 14), (4, 15, 15), (6, 1, 8), (8, 1, 5)) for n in range(a, b + 1)]


def test_merchant_frontier_urls(spark):
    """The URL is taken apart once for each merchant: every spelling gives what the page-by-page column gives."""
    spelled = ["https://h.example.com/a", "https://h.example.com/a?page=1&b=2#x", "https://h.example.com/a?b=2&page#page=4", "https://h.example.com/a?page=1?page&page=2", "text", "text?page=3"]
    lines = spark.createDataFrame([(i, u, "9 結果の 1-3") for i, u in enumerate(spelled)] + [(9, None, None)], "merchant int, url string, summary string")
    rows = jobs.merchant_frontier(lines, spark.createDataFrame([(1, "B0")] * 4 + [(1, " ")], "merchant int, asin string"), 4)
    found = {(r.merchant, r.page_no): r.page_url for r in rows.collect()}
    assert sorted(found) == sorted([(m, n) for m in range(6) for n in (1, 2, 3) if (m, n) != (1, 1)] + [(9, 1)])
    assert found[9, 1] is None and "pieces" in str(rows._jdf.queryExecution().analyzed())
    want = ["https://h.example.com/a?page=2", "https://h.example.com/a?page=2&b=2#x", "https://h.example.com/a?b=2&page=2#page=4", "https://h.example.com/a?page=2&page=2", "text", "text?page=3"]
    assert [found[m, 2] for m in range(6)] == want
    assert [r.u for r in lines.orderBy("merchant").select(urls.with_page_param("url", 2).alias("u")).collect()] == [*want, None]


def test_page_batches_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    """Many small files are one batch; a smaller bound makes more batches of the same rows."""
    rows = [(f"p/t/2024-07-01_00-00-00/{i}/page.html", f"{i:>100}") for i in range(12)]
    capture_source.write_capture_files(spark.createDataFrame(rows, "name string, text string"), str(tmp_path / "in"))
    for bound, batches in ((ingest.BATCH_BYTES, 1), (400, 3)):
        monkeypatch.setattr(ingest, "BATCH_BYTES", bound)
        ingest.ingest_captures(ingest.page_stream(spark, str(tmp_path / "in")), str(tmp_path / f"out{bound}"), str(tmp_path / f"ck{bound}"))
        assert len([f for f in (tmp_path / f"ck{bound}" / "commits").iterdir() if f.name.isdigit()]) == batches
        assert sorted(r.html for r in spark.read.parquet(str(tmp_path / f"out{bound}")).collect()) == sorted(t for _, t in rows)


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    """Neither a job for each run of a target nor a task for each folder or file; the session's settings come back."""
    rows = [(f"p/t/2024-07-{run:02}_00-00-00/{i}/page.html", str(i)) for run in range(1, 13) for i in range(34)]
    capture_source.write_capture_files(spark.createDataFrame(rows, "name string, text string"), str(tmp_path / "in"))
    tracker = spark.sparkContext.statusTracker()

    def tasks(group):
        return [sum(tracker.getStageInfo(s).numTasks for s in tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(group)]

    spark.sparkContext.setJobGroup("named", "named")
    try:
        pages = ingest.page_stream(spark, str(tmp_path / "in"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    query = ingest.ingest_captures(pages, str(tmp_path / "out"), str(tmp_path / "ck"))
    named, run = tasks("named"), tasks(query.runId)
    assert len(named) == 1 and len(run) <= 4 and max(named + run) <= 16
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.threshold") == "32"


def test_stream_join_has_one_store_a_partition(spark, tmp_path, monkeypatch):
    """A new checkpoint keeps the state of both sides in one store; one that began with four goes on and loses nothing."""
    four = {k: v for k, v in ingest.STATE.items() if "stateFormatVersion" not in k}

    def run(case, state, name, text):
        capture_source.write_capture_files(spark.createDataFrame([(f"p/t/2024-07-01_00-00-00/a/{name}", text)], "name string, text string"), str(tmp_path / case / "in"))
        monkeypatch.setattr(ingest, "STATE", state)
        joined = ingest.pages_with_meta(ingest.page_stream(spark, str(tmp_path / case / "in")), ingest.meta_stream(spark, str(tmp_path / case / "in")))
        ingest.ingest_captures(joined, str(tmp_path / case / "out"), str(tmp_path / case / "ck"))

    new = ingest.STATE
    for case, first, stores in (("old", four, 8 * 4), ("new", new, 0)):
        run(case, first, "page.html", "<p>x</p>")
        run(case, new, "metadata.json", '{"url": "u"}')
        assert [(r.html, r.meta.url) for r in spark.read.parquet(str(tmp_path / case / "out")).collect()] == [("<p>x</p>", "u")]
        assert len([f for f in (tmp_path / case / "ck/state/0").glob("[0-9]*/*-key*") if f.is_dir()]) == stores


def test_official_records_join_nothing(spark):
    """What is known of a visit goes through the reader: no join, so nothing of the pages can be broadcast; a visit without a page keeps nulls."""
    kinds = "page_id int, project string, product_url string, final_url string, html string, http_status int, crawled_at string, artifact_dir string, error_name string, error_message string"
    rows = [(1, "p", "u1", "f1", "<title>t</title><p>x</p>", 200, "c", "d", None, None), (2, "p", "u2", None, None, None, "c", "d", "Error", "net::ERR_FAILED"),
            (3, "p", "u3", None, "", 200, "c", "d", None, None)]
    records = jobs.official_site_records(spark.createDataFrame(rows, kinds))
    assert "Join" not in str(records._jdf.queryExecution().optimizedPlan())
    got = {r.product_url: r for r in records.collect()}
    assert (got["u1"].title, got["u1"].status, got["u1"].final_url, got["u1"].specs) == ("t", "ok", "f1", [])
    assert (got["u2"].title, got["u2"].status, got["u2"].model_number, got["u2"].specs, got["u2"].error_name) == (None, "error", None, [], "Error")
    assert (got["u3"].status, got["u3"].title, got["u3"].h1_texts) == ("ok", None, [])


def test_config_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """The suppliers lie in one split; one task must not write a file for each of them."""
    monkeypatch.setattr(runs, "scratch", lambda s: str(tmp_path / "c"))
    rows = runs.QUERIES["src04_project_config"](spark, "/root/testdata/sf0.01")
    names = [f.name for f in (tmp_path / "c").glob("part-*")]
    assert len(names) == rows.count() == 100 and len({n.split("-")[1] for n in names}) == 8


def test_product_pages_are_dealt_out_and_read_once(spark, monkeypatch):
    """Few long product pages do not meet in one task, and their link goes through the reader."""
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(jobs, "stored", kept)
    runs.maker_job(spark, "/root/testdata/sf0.001")
    product = next(p for p in plans if "variant_pos" in p)
    assert "REPARTITION_BY_NUM" in product.split("MapInArrow")[1].split("Join")[0]
    assert "first_pos" in product.split("MapInArrow")[1].split("\n")[0]
