"""Sale periods and run stamps. The year always comes from the run time that is passed in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import BLANK, as_col, blank_to_null, compact_spaces, extract_if, let

# Fixed values: "M/D H:MM" and the words between or after two of them.
STAMP = rf"(\d{{1,2}})/(\d{{1,2}}){BLANK}+(\d{{1,2}}):(\d{{2}})"
SALE_RANGE = rf"{STAMP}{BLANK}*(?:[~〜\-]|から){BLANK}*{STAMP}"
SALE_UNTIL = rf"{STAMP}{BLANK}*まで"


def _two(c: Column) -> Column:
    return F.lpad(c, 2, "0")


def _iso(match: Column, first: int, run_at: Column) -> Column:
    """ISO time of the ``first``-th stamp in a short matched text."""
    numbers = F.regexp_extract_all(match, F.lit(r"(\d+)"), F.lit(1))
    month, day, hour, minute = (F.get(numbers, F.lit(first + i)) for i in range(4))
    return F.concat(
        F.date_format(run_at, "yyyy"), F.lit("-"), _two(month), F.lit("-"), _two(day),
        F.lit("T"), _two(hour), F.lit(":"), _two(minute), F.lit(":00+09:00"),
    )


def parse_sale_period(c: Column | str, run_at: Column | str) -> Column:
    """struct(sale_period_raw, sale_start, sale_end)."""
    run_at = as_col(run_at)

    def found(text: Column) -> Column:
        return F.struct(
            text.alias("text"), extract_if(text, ("/",), SALE_RANGE, 0).alias("both"),
            extract_if(text, ("まで",), SALE_UNTIL, 0).alias("until"),
        )

    def build(m: Column) -> Column:
        return F.struct(
            blank_to_null(m["text"]).alias("sale_period_raw"),
            _iso(m["both"], 0, run_at).alias("sale_start"),
            F.coalesce(_iso(m["both"], 4, run_at), _iso(m["until"], 0, run_at)).alias("sale_end"),
        )

    return let(let(compact_spaces(c), found), build)


def parse_sale_end(c: Column | str, run_at: Column | str) -> Column:
    run_at = as_col(run_at)
    return _iso(let(compact_spaces(c), lambda text: extract_if(text, ("まで",), SALE_UNTIL, 0)), 0, run_at)


def iso_utc(c: Column | str) -> Column:
    """ISO time with milliseconds; the session time zone is UTC."""
    return F.date_format(as_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def run_stamp(c: Column | str) -> Column:
    return F.date_format(as_col(c), "yyyy-MM-dd_HH-mm-ss")


def run_name(target: Column | str, run_at: Column | str) -> Column:
    """``<target>_<stamp>``"""
    return F.concat(as_col(target), F.lit("_"), run_stamp(run_at))


def one_month_before(c: Column | str) -> Column:
    """Same day of the month before; a day that month lacks runs over into the next month."""
    t = as_col(c)
    first = F.add_months(F.trunc(t, "month"), -1)
    shifted = F.date_add(first, F.dayofmonth(t) - 1)
    return shifted.cast("timestamp") + (t - F.date_trunc("day", t))
