"""Next-page links and the chains of pages they form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import trim_blank
from ..functions.urls import absolute_url
from ..session import stored
from .boxes import DOCUMENT, Box, Find, box_rows
from .dom import chain, token as t

# Where list pages keep the next link, in the order they are asked, and its texts.
NEXT_CHAINS = [
    chain(t("ul", cls="listnavi"), t("li", id="listnavi_next"), t("a")), chain(t(id="listnavi_next"), t("a")),
    chain(t(cls="pagination"), t(cls="next"), t("a")), chain(t(cls="pager"), t(cls="next"), t("a")),
    chain(t(cls="pagination"), t("a", cls="next")), chain(t(cls="pager"), t("a", cls="next")),
]
NEXT_TEXT = "^(次へ|次|NEXT|Next|›|»|＞|≫|>)$"


_LINK = chain(t("a"))
NEXT = Box((DOCUMENT,), {
    "named_first": Find((chain(t("link", attr=("rel", "next"))), chain(t("a", attr=("rel", "next"))), *NEXT_CHAINS), "attrs"),
    "links": Find((_LINK,), "node", every=True),
    # a link is off if it or its parent is disabled
    "off": Find(((chain(t("a", attr=("aria-disabled", "true"))), chain(t("a", cls="disabled")), chain(t(cls="disabled"), t("a", child=True))),), every=True),
    "in_item": Find((chain(t(cls="item_listbox"), t("a")),), every=True),
})


def next_links(pages: DataFrame, url: str = "url") -> DataFrame:
    """Next page of each page that has one: page_id, url, next_url.

    The first element of every choice is tested on its own, as one may answer to several. The first choice whose
    first element has a link wins; a choice whose first has none passes on. Links known by their text must have one to count.
    """
    found = box_rows(pages, NEXT, (url,))
    ids = F.transform(F.concat("off", "in_item"), lambda x: x["id"])
    named = F.filter("links", lambda x: (F.length(x["v"]["attrs"]["href"]) > 0) & trim_blank(x["v"]["text"]).rlike(NEXT_TEXT) & ~F.array_contains(ids, x["id"]))
    first = F.transform("named_first", lambda a: F.nullif(a["href"], F.lit("")))
    href = F.coalesce(F.get(F.filter(first, lambda h: h.isNotNull()), F.lit(0)), F.get(named, F.lit(0))["v"]["attrs"]["href"])
    return found.select("page_id", url, href.alias("href")).filter(F.col("href").isNotNull()).select(
        "page_id", url, absolute_url(url, "href").alias("next_url"))


#: Doublings between two stored steps.
DOUBLINGS = 2


def _cycles(link: DataFrame) -> DataFrame:
    """(at, least) of the pages that lie on a cycle, with the cycle's smallest page, by pointer jumping.

    A step doubles twice: who still goes on after four times as many links, where to, and the smallest page on the way. Pages whose chain ends drop out. Once
    no page drops out, no page is left that others lead to only from outside, and no smallest page changes, what is led to is the cycles.
    """
    ahead, before = link.select("at", F.col("to").alias("jump"), F.col("at").alias("least")), None
    while True:
        for _ in range(DOUBLINGS):
            left, right = ahead.alias("l"), ahead.alias("r")
            ahead = left.join(right, F.col("l.jump") == F.col("r.at")).select("l.at", "r.jump", F.least("l.least", "r.least").alias("least"))
        ahead = stored(ahead)
        now = ahead.agg(F.count(F.lit(1)), F.count_distinct("jump"), F.expr("bit_xor(xxhash64(at, least))")).first()
        if not now[0] or now == before:
            return stored(ahead.join(ahead.select(F.col("jump").alias("at")), "at", "left_semi").select("at", "least"))
        before = now


def _ranked(pages: DataFrame, along: DataFrame) -> DataFrame:
    """(at, chain, dist) of every page: the last page of its chain of ``along`` links and the links up to it, by pointer jumping."""
    last = F.col("to").isNull()
    ranks = pages.join(along, "at", "left").select("at", F.coalesce("to", "at").alias("chain"), F.when(last, 0).otherwise(1).cast("long").alias("dist"), last.alias("ends"))
    while True:
        for _ in range(DOUBLINGS):
            left, right = ranks.alias("l"), ranks.alias("r")
            ranks = left.join(right, F.col("l.chain") == F.col("r.at")).select("l.at", "r.chain", (F.col("l.dist") + F.col("r.dist")).alias("dist"), "r.ends")
        open_ranks = Observation()
        ranks = stored(ranks.observe(open_ranks, F.count_if(~F.col("ends")).alias("open")))
        if not open_ranks.get["open"]:
            return ranks.drop("ends")


def _onward(out: DataFrame) -> DataFrame:
    """(chain, onto, d, base) of every chain that follows a chain, once for all who come along: entered ``d`` links before its end, ``base`` pages after the first chain's end.

    ``out`` has the same columns for the chain right behind, with base 0; jumps over 1, 2, 4, … chains are joined to what is known.
    """
    known = jump = out
    while not jump.isEmpty():  # few chains follow a chain that follows a chain
        def then(first: DataFrame) -> DataFrame:
            left, right = first.alias("l"), jump.alias("r")
            base = F.col("l.base") + F.col("l.d") + 1 + F.col("r.base")
            return left.join(right, F.col("l.onto") == F.col("r.chain")).select("l.chain", "r.onto", "r.d", base.alias("base"))

        known, jump = stored(known.unionByName(then(known))), stored(then(jump))
    return known


def page_chain(edges: DataFrame, sources: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Pages reached from each source in order: source_url, page_no, page_url, truncated.

    ``edges(url, next_url)``: of several rows for one URL the smallest next link counts. A chain ends at a page without a link, before a page
    it has already seen, or after ``max_pages`` pages (None: no limit); ``truncated`` says that this limit cut the source's chain.

    Pages are ranked once for all sources: cycles are cut before their smallest page; of the links into a page one goes on its chain, and every page knows its
    chain and its distance from the chain's end. A source is a place in a chain plus the chains behind it; pages are spread at the very end, where each
    chain is kept once. Joins before that hold one row per page, and their number grows with the logarithm of the longest chain.
    """
    limit = max_pages if max_pages and max_pages > 0 else None
    link = edges.filter((F.length("url") > 0) & (F.length("next_url") > 0)).groupBy(F.col("url").alias("at")).agg(F.min("next_url").alias("to"))
    link = stored(link)
    starts = sources.filter(F.length("source_url") > 0).select("source_url").distinct()
    cycles = _cycles(link)
    link = stored(link.join(cycles, "at", "left").filter("least IS NULL OR to != least").withColumn("turns", F.col("least").isNotNull()).drop("least"))
    # a cycle's links go on its chain; its smallest page, which nothing may go on to, begins it
    heads = cycles.filter("at = least").select(F.col("at").alias("to"))
    along = link.join(heads, "to", "left_anti").groupBy("to").agg(F.min_by("at", F.struct(~F.col("turns"), "at")).alias("at"))
    along = stored(along)
    pages = link.select("at").union(link.select("to")).union(starts).distinct()
    ranks = _ranked(pages, along)
    out = link.join(along, ["at", "to"], "left_anti").select(F.col("at").alias("chain"), F.col("to").alias("at")).join(ranks.withColumnRenamed("chain", "onto"), "at")
    onward = _onward(stored(out.select("chain", "onto", F.col("dist").alias("d"), F.lit(0).cast("long").alias("base"))))
    rings = cycles.join(ranks, "at").groupBy("chain").agg(F.count(F.lit(1)).alias("ring"))
    own = starts.join(ranks, starts["source_url"] == ranks["at"]).select("source_url", "chain", F.col("dist").alias("d"), F.lit(0).cast("long").alias("base"))
    later = own.withColumnRenamed("base", "_none").join(onward.withColumnsRenamed({"d": "e"}), "chain")
    later = later.select("source_url", F.col("onto").alias("chain"), F.col("e").alias("d"), (F.col("d") + 1 + F.col("base")).alias("base"))
    parts = own.unionByName(later).join(rings, "chain", "left")
    whole = parts.groupBy("source_url").agg(F.sum(F.coalesce("ring", F.col("d") + 1)).alias("total"))
    if limit is not None:
        parts = parts.filter(F.col("base") < limit)
    members = ranks.select("chain", "dist", F.col("at").alias("page_url"))
    # from the place of entry to the end; round a cycle, then from its beginning to the place of entry
    step = F.when(F.col("dist") <= F.col("d"), F.col("d") - F.col("dist")).otherwise(F.col("d") + F.col("ring") - F.col("dist"))
    rows = parts.join(members, "chain").filter("dist <= d OR ring IS NOT NULL")
    rows = rows.select("source_url", (F.col("base") + step + 1).cast("int").alias("page_no"), "page_url")
    if limit is None:
        return rows.withColumn("truncated", F.lit(False))
    return rows.filter(F.col("page_no") <= limit).join(whole, "source_url").select("source_url", "page_no", "page_url", (F.col("total") > limit).alias("truncated"))
