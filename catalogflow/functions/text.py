"""Text normalisation and small string/array helpers.

Java regular expressions treat Japanese letters as word characters at ``\\b`` and know only
ASCII blanks, so every pattern here uses the explicit classes below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The blanks that a browser's \s and trim() know.
BLANK = r"[\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
NOT_BLANK = r"[^\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
# ASCII word boundary: left side and right side of a token.
LEFT = r"(?<![A-Za-z0-9_])"
RIGHT = r"(?![A-Za-z0-9_])"
# Either side, for a token that may end in a non-word character.
EDGE = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` that gives NULL, not '', when nothing matches."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


# Characters that are surely no blank, or the plain blank; text outside it takes the exact path.
ORDINARY = r"[^ -~\x{00A1}-\x{167F}\x{3001}-\x{FEFE}\x{FF00}-\x{10FFFF}]"


def _once(c: Column | str, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once; a named column needs no binding."""
    return body(F.col(c)) if isinstance(c, str) else let(c, body)


def _unusual(c: Column) -> Column:
    return c.rlike(ORDINARY)


def _ends(c: Column) -> Column:
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def trim_blank(c: Column | str) -> Column:
    """Trimmed of every kind of blank. Text with plain blanks only needs no pattern."""
    return _once(c, lambda v: F.when(_unusual(v), _ends(v)).otherwise(F.trim(v)))


def _needs_patterns(c: Column) -> Column:
    return _unusual(c) | F.contains(c, F.lit("  "))


def compact_spaces(c: Column | str) -> Column:
    """NULL to '', hard blanks and line ends to a blank, runs of blanks to one, trimmed."""

    def build(v: Column) -> Column:
        plain = F.translate(v, "\u00a0\t\r\n", "    ")
        exact = _ends(F.regexp_replace(plain, BLANK + "{2,}", " "))
        return F.when(v.isNull(), "").when(_needs_patterns(v), exact).otherwise(F.trim(v))

    return _once(c, build)


def normalize_ws(c: Column | str) -> Column:
    """Every run of blanks to one blank, trimmed."""
    return _once(
        c, lambda v: F.when(_needs_patterns(v), _ends(F.regexp_replace(v, BLANK + "+", " "))).otherwise(F.trim(v))
    )


def plain_blanks(c: Column | str) -> Column:
    """Every kind of blank as a plain one."""
    return _once(c, lambda v: F.when(_unusual(v), F.regexp_replace(v, BLANK, " ")).otherwise(v))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def first_non_empty(*cols: Column | str) -> Column:
    """First value that is not blank after trimming, trimmed."""
    return F.coalesce(*[blank_to_null(trim_blank(c)) for c in cols])


def first_text(*cols: Column | str) -> Column:
    """First value that is neither NULL nor ''."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def strip_tags(c: Column | str) -> Column:
    """Markup to blanks; NULL when no text is left."""
    plain = F.regexp_replace(as_col(c), r"(?i)<br\s*/?>", " ")
    plain = F.regexp_replace(plain, r"<[^>]+>", " ")
    return blank_to_null(trim_blank(F.regexp_replace(plain, BLANK + "{2,}", " ")))


def trim_description(c: Column | str, limit: int = 12000) -> Column:
    """Trimmed text, cut with ``...`` past ``limit`` characters."""
    text = trim_blank(c)
    cut = F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)
    return F.when(F.length(as_col(c)) > 0, cut)


def _trimmed(v: Column, tidy: bool = False) -> Column:
    """``trim_blank`` of a value that costs nothing to name again. Ends of ``tidy`` text are trimmed already, but for blanks before a last U+0085."""
    return F.when(F.contains(v, F.lit("\u0085")) if tidy else _unusual(v), _ends(v)).otherwise(v if tidy else F.trim(v))


def unique_strings(values: Column, tidy: bool = False) -> Column:
    """Trimmed, non-blank, distinct, in order; NULL array to empty. ``tidy`` values come from ``compact_spaces`` or the reader's lines."""
    # a NULL is left out by the filter
    trimmed = F.transform(values, lambda v: _trimmed(v, tidy))
    return F.coalesce(F.array_distinct(F.filter(trimmed, lambda v: v != "")), F.array().cast("array<string>"))


def _or_null(v: Column, tidy: bool) -> Column:
    """The trimmed value, NULL for ''."""
    if tidy:
        return F.when(v != "", _trimmed(v, tidy))
    return blank_to_null(trim_blank(v))


def unique_specs(values: Column, tidy: bool = False) -> Column:
    """Distinct ``(label, value)`` pairs, trimmed; pairs without a value go. ``tidy`` as in ``unique_strings``."""
    clean = F.transform(values, lambda s: F.struct(_or_null(s["label"], tidy).alias("label"), _trimmed(s["value"], tidy).alias("value")))
    return F.array_distinct(F.filter(clean, lambda s: s["value"] != ""))


def unique_faq(values: Column, tidy: bool = False) -> Column:
    """Distinct ``(question, answer)`` pairs, trimmed; pairs without a question go. ``tidy`` as in ``unique_strings``."""
    clean = F.transform(values, lambda s: F.struct(_trimmed(s["question"], tidy).alias("question"), _or_null(s["answer"], tidy).alias("answer")))
    return F.array_distinct(F.filter(clean, lambda s: s["question"] != ""))


def crop_before(c: Column | str, flag: str) -> Column:
    """Text before the first ``flag``, trimmed (the whole text when absent)."""
    return trim_blank(F.substring_index(as_col(c), flag, 1))


def crop_after(c: Column | str, flag: str) -> Column:
    """Text after the first ``flag`` up to the next ``flag`` or blank; NULL when absent."""
    part = F.get(F.split(as_col(c), flag.replace("$", r"\$")), F.lit(1))
    return F.get(F.split(part, BLANK), F.lit(0))


def combined_text(*cols: Column | str) -> Column:
    """All fields joined by one blank; a missing field still adds its blank."""
    return F.concat_ws(" ", *[F.coalesce(as_col(c), F.lit("")) for c in cols])


def null_if_same(a: Column | str, b: Column | str) -> Column:
    """``a`` unless it equals ``b``; NULL for ''."""
    a, b = as_col(a), as_col(b)
    return F.when(a.eqNullSafe(b), F.lit(None)).otherwise(blank_to_null(a))


def parse_flag(c: Column | str, default: bool | Column) -> Column:
    """0/false/no/off is false, other text true, blank the default."""
    text = F.lower(trim_blank(F.coalesce(as_col(c), F.lit(""))))
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.when(text == "", fallback).otherwise(~text.isin("0", "false", "no", "off"))


def names_sorted_distinct(values: Column) -> Column:
    return F.array_sort(F.array_distinct(values))


def snippet(c: Column | str, n: int) -> Column:
    return F.substring(as_col(c), 1, n)


def redact_headers(headers: Column) -> Column:
    """Header map without the ones that carry credentials."""
    return F.map_filter(headers, lambda k, v: ~F.lower(k).isin("set-cookie", "cookie", "authorization"))


def error_struct(c: Column | str) -> Column:
    """Error text ``Name: message`` plus stack lines to a struct; plain text is only a message."""
    text = as_col(c)
    named = r"(?s)^([A-Za-z_$][A-Za-z0-9_$.]*(?:Error|Exception)): ?([^\n]*)(?:\n(.*))?$"
    has_name = text.rlike(named)
    return F.when(
        text.isNotNull(),
        F.struct(
            extract(text, named, 1).alias("name"),
            F.when(has_name, F.regexp_extract(text, named, 2)).otherwise(text).alias("message"),
            F.when(F.contains(text, F.lit("\n")) & has_name, text).alias("stack"),
        ),
    )


def extract_if(c: Column, words: list[str] | tuple[str, ...], pattern: str, group: int = 1, within: Column | None = None) -> Column:
    """``extract`` that runs the pattern only where one of the words it needs occurs (in ``within``)."""
    return F.when(contains_any(c if within is None else within, words), extract(c, pattern, group))


def contains_any(c: Column, words: list[str] | tuple[str, ...]) -> Column:
    """True when any of the words is a substring (false for NULL)."""

    def test(v: Column) -> Column:
        hit = F.contains(v, F.lit(words[0]))
        for word in words[1:]:
            hit = hit | F.contains(v, F.lit(word))
        return F.coalesce(hit, F.lit(False))

    return test(c) if len(words) == 1 else let(c, test)


def split_list(c: Column | str) -> Column:
    """Comma-separated list to trimmed non-blank entries, in order."""
    parts = F.split(F.coalesce(as_col(c), F.lit("")), f"{BLANK}*,{BLANK}*")
    return F.filter(F.transform(parts, trim_blank), lambda v: v != "")


def url_list(list_col: Column | str, single_col: Column | str) -> Column:
    """The list setting, or the single setting when the list is empty."""
    single = trim_blank(F.coalesce(as_col(single_col), F.lit("")))
    one = F.filter(F.array(single), lambda v: v != "")
    return let(split_list(list_col), lambda many: F.when(F.size(many) > 0, many).otherwise(one))
