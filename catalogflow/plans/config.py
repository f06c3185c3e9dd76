"""Project configs, query plans and page windows as small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, trim_blank
from ..schemas import PROJECT_CONFIG
from ..sources.sinks import FORMATS

# Defaults of a project config and of plan rows.
LOCALE, TIMEZONE, LOGIN_LABEL = "ja-JP", "Asia/Tokyo", "anonymous"
WIDTH, HEIGHT = 1920, 1080
PENDING = "pending_browsermcp"


def _entries(values: Column) -> Column:
    """Trimmed non-blank texts, NULL when none is left."""
    kept = F.filter(F.transform(values, lambda v: trim_blank(F.coalesce(v, F.lit("")))), lambda v: v != "")
    return F.when(F.size(kept) > 0, kept)


def _setting(name: str, default: str | None = None) -> Column:
    text = blank_to_null(trim_blank(F.col(name)))
    return text if default is None else F.coalesce(text, F.lit(default))


def _positive(value: Column, default: int) -> Column:
    return F.when(value > 0, F.floor(value + 0.5)).otherwise(default).cast("int")


def normalize_config(raw: DataFrame) -> DataFrame:
    """Trimmed settings with defaults; a missing project fails the row that lacks it."""
    project = _setting("project")
    queries = F.map_filter(F.transform_values("queries", lambda k, v: _entries(v)), lambda k, v: v.isNotNull())
    formats = F.array_distinct(F.filter(_entries(F.col("outputFormats")), lambda f: f.isin(*FORMATS)))
    return raw.select(
        F.when(project.isNull(), F.raise_error(F.lit("project is required")).cast("string")).otherwise(project).alias("project"),
        _setting("locale", LOCALE).alias("locale"), _setting("timezone", TIMEZONE).alias("timezone"),
        F.struct(
            _positive(F.col("viewport.width"), WIDTH).alias("width"), _positive(F.col("viewport.height"), HEIGHT).alias("height")
        ).alias("viewport"),
        "headless", _entries(F.col("officialUrls")).alias("official_urls"),
        F.when(F.size(queries) > 0, queries).alias("queries"),
        _setting("loginStateLabel", LOGIN_LABEL).alias("login_state_label"), _setting("profileName").alias("profile_name"),
        F.when(F.size(formats) > 0, formats).otherwise(F.array(*[F.lit(f) for f in FORMATS])).alias("output_formats"),
    )


def read_project_config(spark: SparkSession, path: str) -> DataFrame:
    """Project config files, one JSON object each."""
    return normalize_config(spark.read.schema(PROJECT_CONFIG).json(path, multiLine=True))


def _required(values: Column, what: str) -> Column:
    missing = F.raise_error(F.lit(f"at least one entry is required: {what}")).cast("array<string>")
    return F.when(F.coalesce(F.size(values), F.lit(0)) > 0, values).otherwise(missing)


def channel_queries(config: DataFrame, channel: str) -> DataFrame:
    """One row per query of the channel: project, query_pos, query. No query fails."""
    queries = _required(F.try_element_at(F.col("queries"), F.lit(channel)), f"queries.{channel}")
    return config.select("project", F.posexplode(queries).alias("query_pos", "query"))


def official_urls(config: DataFrame) -> DataFrame:
    """One row per official URL: project, url_pos, url. No URL fails."""
    return config.select("project", F.posexplode(_required(F.col("official_urls"), "officialUrls")).alias("url_pos", "url"))


def first_query(config: DataFrame) -> DataFrame:
    """Per project the first query over all channels in key order, and the first official URL."""
    return config.select(
        "project", F.get(F.flatten(F.map_values("queries")), F.lit(0)).alias("query"),
        F.get("official_urls", F.lit(0)).alias("url"),
    )


def query_plan(
    config: DataFrame, channel: str, source: str, target: str, crawled_at: str, notes: str, status: str = PENDING
) -> DataFrame:
    """One pending row per query of the channel."""
    return channel_queries(config, channel).select(
        "project", F.lit(source).alias("source"), F.lit(target).alias("target"), "query", F.lit(status).alias("status"),
        F.lit(crawled_at).alias("crawled_at"), F.lit(notes).alias("notes"),
    )


#: Pages that one row of the first step of a frontier stands for, and pages that lie together in a task's rows.
FRONTIER_BLOCK, FRONTIER_RANGE = 10_000, 512


def page_frontier(summaries: DataFrame, pages: Column | str = "pages", start: Column | str | None = None) -> DataFrame:
    """List pages ``start`` (1 unless given) to n of each row with a known page count, as ``page_no``.

    Made in steps, blocks, ranges and the pages of a range, so that no row holds a list as long as a count read from a page. Blocks are dealt out
    evenly in between: a table of a single split, or a row with a huge count, becomes work for every task. A task goes through its blocks range by
    range, so that the same few page numbers come again and again: a columnar file holds them in less than a tenth of the space that long runs take.
    """
    def number(c: Column | str) -> Column:
        return (F.col(c) if isinstance(c, str) else c).cast("bigint")

    def cut(rows: DataFrame, size: int, name: str) -> DataFrame:
        """Each row once for every ``size`` page numbers that it has some of, cut to these."""
        at, long = F.col(name), F.lit(size).cast("bigint")
        rows = rows.withColumn(name, F.explode(F.sequence(F.expr(f"(_from - 1) div {size}"), F.expr(f"(_upto - 1) div {size}"))))
        return rows.withColumns({"_from": F.greatest("_from", at * long + 1), "_upto": F.least("_upto", (at + 1) * long)})

    first = F.lit(1).cast("bigint") if start is None else F.greatest(number(start), F.lit(1).cast("bigint"))
    blocks = cut(summaries.withColumns({"_upto": number(pages), "_from": first}).filter("_upto >= _from"), FRONTIER_BLOCK, "_block")
    blocks = blocks.drop("_block").repartition(int(summaries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = cut(blocks, FRONTIER_RANGE, "_range").sortWithinPartitions("_range")
    return ranges.withColumn("page_no", F.explode(F.sequence("_from", "_upto"))).drop("_from", "_upto", "_range")
