"""Row to curated table: first-wins dedup, ranks, windows of rows, sort orders."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import as_col, trim_blank
from ..session import stored

# The columns that carry input order from extraction on; together they identify a row.
INPUT_ORDER = ("source_pos", "page_no", "item_pos")


def first_wins(
    df: DataFrame, key: Column | str, order: Sequence[str] = INPUT_ORDER, blank_keys: str = "drop"
) -> DataFrame:
    """The first row of each key in input order.

    ``blank_keys``: ``drop`` rows without a key, or ``keep`` all of them. ``order`` must identify
    a row. The ``= 1`` filter lets Spark cut every map task to one row per key before the
    shuffle, so a hot key costs one row per task. Kept blank rows are spread by their own
    order columns instead of meeting in one group.
    """
    value = trim_blank(F.coalesce(as_col(key), F.lit("")))
    keyed = df.withColumn("_key", value)
    if blank_keys == "keep":
        keyed = keyed.withColumn("_own", F.when(F.col("_key") == "", F.struct(*order)))
        window = Window.partitionBy("_key", "_own").orderBy(*order)
    else:
        keyed = keyed.filter(F.length(as_col(key)) > 0).withColumn("_key", as_col(key)).withColumn("_own", F.lit(None))
        window = Window.partitionBy("_key").orderBy(*order)
    return keyed.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_key", "_own", "_rn")


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int = 20, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each key with their rank; cut to ``n`` per task before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= max(1, n))


def rank_before_filter(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Column, n: int = 20
) -> DataFrame:
    """Rank and cut first, filter then: ranks may have gaps."""
    return top_n(df, keys, order, n).filter(keep)


def rank_after_filter(
    df: DataFrame, keys: Sequence[str], unique_key: str, order: Sequence[str], keep: Column, n: int = 20
) -> DataFrame:
    """Filter and dedup inside each key first, rank then: ranks are 1..n. Blank unique keys stay."""
    kept = df.filter(keep).withColumn("_own", F.when(F.coalesce(F.col(unique_key), F.lit("")) == "", F.struct(*order)))
    window = Window.partitionBy(*keys, unique_key, "_own").orderBy(*order)
    unique = kept.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn", "_own")
    return top_n(unique, keys, order, n)


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_{c}"]) for c in columns])


def block_number(
    df: DataFrame, keys: Sequence[str], ordinal: Column | str, name: str = "row_no", shift: int = 16
) -> DataFrame:
    """Dense 1..n numbering per key by a non-negative whole-number ordinal, without one task per key.

    Rows are numbered inside blocks of 2**shift ordinals; the counts of the blocks before are
    summed in two levels. A key with any number of rows is spread over its blocks.
    """
    blocked = df.withColumn("_ord", as_col(ordinal).cast("bigint")).withColumn("_b", F.shiftright("_ord", shift))
    counts = blocked.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n")).withColumn("_s", F.shiftright("_b", shift))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    inner = counts.withColumn(
        "_in", F.coalesce(F.sum("_n").over(before.partitionBy(*keys, "_s").orderBy("_b")), F.lit(0))
    )
    upper = counts.groupBy(*keys, "_s").agg(F.sum("_n").alias("_n"))
    upper = upper.withColumn("_up", F.coalesce(F.sum("_n").over(before.partitionBy(*keys).orderBy("_s")), F.lit(0)))
    upper = upper.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_s").alias("__s"), "_up")
    offsets = inner.join(upper, _same(inner, upper, [*keys, "_s"]))
    offsets = offsets.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("_b").alias("__b"), (F.col("_in") + F.col("_up")).alias("_off")
    )
    numbered = blocked.withColumn(
        "_pos", F.row_number().over(Window.partitionBy(*keys, "_b").orderBy("_ord"))
    )
    joined = numbered.join(offsets, _same(numbered, offsets, [*keys, "_b"]))
    return joined.withColumn(name, (F.col("_pos") + F.col("_off")).cast("bigint")).select(*df.columns, name)


def range_number(df: DataFrame, ordinal: Column | str, name: str = "row_no") -> DataFrame:
    """Dense 1..n numbering of all rows by an ordinal of any kind, dense or sparse.

    Rows are dealt into ranges of the ordinal and stored, so that a range stays what it is; they are numbered inside their range, and
    the sizes of the ranges before are added: only this list of ranges meets in one task.
    """
    ranged = df.withColumn("_ord", as_col(ordinal)).repartitionByRange("_ord").withColumn("_range", F.spark_partition_id())
    ranged = stored(ranged)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(Window.partitionBy("_range").orderBy("_ord"))
    numbered = ranged.withColumn("_own", own).join(sizes.select("_range", before.alias("_before")), "_range")
    return numbered.withColumn(name, (F.col("_own") + F.col("_before")).cast("bigint")).select(*df.columns, name)


def row_window(df: DataFrame, ordinal: Column | str, offset: float | None, limit: float | None) -> DataFrame:
    """Skip ``offset`` rows in order, keep ``limit``; a bad or non-positive setting means none."""
    def whole(v: float | None) -> int:
        return int(v) if v is not None and v == v and abs(v) != float("inf") and v > 0 else 0

    start, size = whole(offset), whole(limit)
    if not start and not size:
        return df
    numbered = range_number(df, ordinal, "_row_no").filter(F.col("_row_no") > start)
    if size:
        numbered = numbered.filter(F.col("_row_no") <= start + size)
    return numbered.drop("_row_no")


def next_value(value: str, partition: Sequence[str], order: str) -> Column:
    """The value of the next sibling or line; the partition is one page or one parent element."""
    return F.lead(value).over(Window.partitionBy(*partition).orderBy(order))


def under_heading(
    df: DataFrame, partition: Sequence[str], order: str, is_heading: Column, at_most: int = 8
) -> DataFrame:
    """Rows after each heading up to the next one, at most ``at_most``: adds heading_pos, after_heading."""
    window = Window.partitionBy(*partition).orderBy(order)
    marked = df.withColumn("_h", F.when(is_heading, F.col(order)))
    seen = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = marked.withColumn("heading_pos", F.last("_h", ignorenulls=True).over(seen))
    inside = marked.filter(F.col("heading_pos").isNotNull() & F.col("_h").isNull()).drop("_h")
    nth = F.row_number().over(Window.partitionBy(*partition, "heading_pos").orderBy(order))
    return inside.withColumn("after_heading", nth).filter(F.col("after_heading") <= at_most)


def sort_memory(df: DataFrame) -> DataFrame:
    """DDR4, DDR5, others; price with missing last; product number in locale order; then input order."""
    ddr = F.upper(F.coalesce(F.col("memory_ddr"), F.lit("")))
    return df.orderBy(
        F.when(ddr == "DDR4", 0).when(ddr == "DDR5", 1).otherwise(9), *_price_then_number(), *_input_order(df)
    )


def sort_ssd(df: DataFrame) -> DataFrame:
    """Price with missing last; product number in locale order; then input order."""
    return df.orderBy(*_price_then_number(), *_input_order(df))


def _price_then_number() -> list[Column]:
    number = F.coalesce(F.col("product_number"), F.lit(""))
    return [F.col("final_price_yen").asc_nulls_last(), F.collate(number, "UNICODE")]


def _input_order(df: DataFrame) -> list[Column]:
    return [F.col(c) for c in INPUT_ORDER if c in df.columns]


def sample_first(df: DataFrame, n: int = 3) -> DataFrame:
    """First rows of a sorted table (a top-k plan, no full sort)."""
    return df.limit(n)


def append_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ordered_union(a: Column | str, b: Column | str) -> Column:
    """All of ``a``, then what ``b`` adds, in order."""
    return F.array_distinct(F.concat(as_col(a), as_col(b)))


def keep_identified(df: DataFrame, any_of: Sequence[str] = (), all_of: Sequence[str] = ()) -> DataFrame:
    """Rows whose identifying columns are filled."""
    for name in all_of:
        df = df.filter(F.length(F.col(name)) > 0)
    if any_of:
        df = df.filter(reduce(lambda x, y: x | y, [F.coalesce(F.length(F.col(c)) > 0, F.lit(False)) for c in any_of]))
    return df
