"""Memory and SSD specifications from tags and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import BLANK, LEFT, RIGHT, as_col, blank_to_null, compact_spaces, extract, extract_if, let, plain_blanks

# Specification patterns, in the order they are tried.
N = r"\d+(?:\.\d+)?"
DDR_TEXT = (rf"(?i){LEFT}LP?DDR{BLANK}*([34-6]){RIGHT}", rf"(?i){LEFT}DDR([34-6]){RIGHT}")
DDR_TAG = rf"(?i){LEFT}DDR{BLANK}*([34-6]){RIGHT}"
DDR_SPEC = rf"(?i)(DDR{BLANK}*[34-6](?:(?:-|{BLANK})?\d{{3,5}})?)"
SPEED = (
    rf"(?i){LEFT}DDR[34-6](?:-|{BLANK})?(\d{{3,5}}){RIGHT}",
    rf"(?i){LEFT}(\d{{3,5}}){BLANK}*(?:MT/S|MHZ){RIGHT}",
)
GROUPED = rf"(?i)({N}){BLANK}*GB{BLANK}*\({BLANK}*({N}){BLANK}*GB{BLANK}*[x×]{BLANK}*(\d{{1,2}}){BLANK}*\)"
PER_STICK = rf"(?i)({N}){BLANK}*GB{BLANK}*[x×]{BLANK}*(\d{{1,2}})"
MODULE = rf"(?i)({N}){BLANK}*GB{BLANK}*モジュール"
STICKS = rf"(?i)(\d{{1,2}}){BLANK}*(?:枚組|枚|kit|セット)"
TOTAL = rf"(?i)(\d{{1,4}}(?:\.\d+)?){BLANK}*GB{RIGHT}"
EXACT_GB = rf"(?i)^({N}){BLANK}*GB$"
EXACT_SIZE = rf"(?i)^({N}){BLANK}*(TB|GB)$"
SIZE_RANGE = rf"(?i)({N}){BLANK}*(TB|GB){BLANK}*以上[〜~～\-]{BLANK}*({N}){BLANK}*(TB|GB)"
SIZE_FROM = rf"(?i)({N}){BLANK}*(TB|GB){BLANK}*以上"
SIZE_TO = (rf"(?i)^[〜~～]{BLANK}*({N}){BLANK}*(TB|GB)$", rf"(?i)[〜~～\-]{BLANK}*({N}){BLANK}*(TB|GB)$")
SIZE_TEXT = rf"(?i)({N}){BLANK}*(TB|GB){RIGHT}"
FORM_TAGS = (r"(?i)M\.2", rf"{LEFT}2280{RIGHT}", rf"{LEFT}2242{RIGHT}", rf"{LEFT}2230{RIGHT}", r"2\.5")
INTERFACE_TAGS = (r"(?i)NVMe", r"(?i)SATA", r"(?i)PCIe", rf"(?i)Serial{BLANK}*ATA")
INTERFACE_TEXT = rf"(?i){LEFT}(NVMe|SATA|PCIe){RIGHT}"
FORM_TEXT = rf"(?i){LEFT}(M\.2|2280|2242|2230|2\.5){RIGHT}"


def clean_tags(tags: Column) -> Column:
    """Tags with compacted blanks, blank ones dropped; NULL to empty."""
    return F.coalesce(
        F.filter(F.transform(tags, compact_spaces), lambda t: t != ""), F.array().cast("array<string>")
    )


def first_group(tags: Column, pattern: str, group: int = 1) -> Column:
    """The pattern's group in the first tag that matches."""
    hit = F.get(F.filter(tags, lambda t: t.rlike(pattern)), F.lit(0))
    return extract(hit, pattern, group)


def first_tag(tags: Column, *patterns: str) -> Column:
    """The first tag that matches the first pattern with a match."""

    def hit(pattern: str) -> Column:
        return F.get(F.filter(tags, lambda t: t.rlike(pattern)), F.lit(0))

    return F.coalesce(*[hit(p) for p in patterns])


def pick_type_label(tags: Column) -> Column:
    """The first tag with a DDR code, else the first tag."""
    return let(clean_tags(tags), lambda ts: F.coalesce(first_tag(ts, DDR_TAG), F.get(ts, F.lit(0))))


def memory_type_label(base_label: Column | str, spec_text: Column | str, ddr: Column | str) -> Column:
    """The label, else the DDR code as written in the spec text, else the parsed code."""
    written = extract(compact_spaces(spec_text), DDR_SPEC)
    written = compact_spaces(F.regexp_replace(F.upper(written), BLANK + "+", " "))
    return F.coalesce(
        blank_to_null(compact_spaces(base_label)), blank_to_null(written), blank_to_null(compact_spaces(ddr))
    )


def _ddr(code: Column) -> Column:
    return F.when(code.isNotNull(), F.concat(F.lit("DDR"), code))


def _memory_struct(ddr: Column, gb: Column, speed: Column, sticks: Column, per: Column) -> Column:
    return F.struct(
        ddr.alias("memory_ddr"),
        gb.cast("double").alias("memory_capacity_gb"),
        speed.cast("int").alias("memory_speed"),
        sticks.cast("int").alias("sticks"),
        per.cast("double").alias("memory_capacity_per_stick_gb"),
    )


def _back_fill(s: Column, total_first: bool) -> Column:
    """Fill total from per-stick x sticks and per-stick from total / sticks, in the given order."""
    gb, sticks, per = s["memory_capacity_gb"], s["sticks"], s["memory_capacity_per_stick_gb"]
    if total_first:
        gb = F.coalesce(gb, per * sticks)
        per = F.coalesce(per, F.when(sticks > 0, gb / sticks))
    else:
        per = F.coalesce(per, F.when(sticks > 0, gb / sticks))
        gb = F.coalesce(gb, per * sticks)
    return _memory_struct(s["memory_ddr"], gb, s["memory_speed"], sticks, per)


def memory_specs_text(c: Column | str) -> Column:
    """struct(memory_ddr, memory_capacity_gb, memory_speed, sticks, memory_capacity_per_stick_gb).

    Each pattern runs once, only where a word it needs occurs; its groups are then read from the
    short match.
    """

    def matches(t: Column) -> Column:
        # Upper-case text with plain blanks matches upper-case patterns in the same places, without
        # folding case and testing every kind of blank at each step.
        def hit(words: tuple[str, ...], pattern: str, group: int) -> Column:
            simple = pattern.removeprefix("(?i)").replace("[x×]", "[X×]").replace("kit", "KIT").replace(BLANK, " ")
            return extract_if(t, words, simple, group)

        return F.struct(
            F.coalesce(hit(("LDDR", "LPDDR"), DDR_TEXT[0], 1), hit(("DDR",), DDR_TEXT[1], 1)).alias("ddr"),
            F.coalesce(hit(("DDR",), SPEED[0], 1), hit(("MT/S", "MHZ"), SPEED[1], 1)).alias("speed"),
            hit(("(",), GROUPED, 0).alias("grouped"),
            hit(("X", "×"), PER_STICK, 0).alias("per_stick"),
            hit(("モジュール",), MODULE, 1).alias("module"),
            hit(("枚", "KIT", "セット"), STICKS, 1).alias("sticks"),
            hit(("GB",), TOTAL, 1).alias("total"),
        )

    def found(m: Column) -> Column:
        def num(name: str) -> Column:
            return m[name].try_cast("double")

        def group(name: str, pattern: str, i: int) -> Column:
            return extract(m[name], pattern.replace(BLANK, " "), i).try_cast("double")

        per_stick, per_sticks = group("per_stick", PER_STICK, 1), group("per_stick", PER_STICK, 2)
        return _memory_struct(
            _ddr(m["ddr"]),
            F.coalesce(group("grouped", GROUPED, 1), per_stick * per_sticks, num("total")),
            num("speed"),
            F.coalesce(group("grouped", GROUPED, 3), per_sticks, num("sticks")),
            F.coalesce(group("grouped", GROUPED, 2), per_stick, num("module")),
        )

    found_in = let(let(F.upper(plain_blanks(compact_spaces(c))), matches), found)
    return let(found_in, lambda s: _back_fill(s, total_first=True))


def memory_specs_tags(tags: Column, fallback: Column | str) -> Column:
    """As ``memory_specs_text``: tags first, the fallback text for what they leave open.

    A grouped tag ``T GB(P GB x n)`` overrides and the last one wins; other fields take the first tag.
    """

    def found(ts: Column) -> Column:
        grouped = F.try_element_at(F.filter(ts, lambda t: t.rlike(GROUPED)), F.lit(-1))

        def group(i: int) -> Column:
            return extract(grouped, GROUPED, i).try_cast("double")

        def num(pattern: str) -> Column:
            return first_group(ts, pattern).try_cast("double")

        speed_hit = F.get(F.filter(ts, lambda t: t.rlike(SPEED[0]) | t.rlike(SPEED[1])), F.lit(0))
        speed = F.coalesce(extract(speed_hit, SPEED[0]), extract(speed_hit, SPEED[1])).try_cast("double")
        return _memory_struct(
            _ddr(first_group(ts, DDR_TAG)),
            F.coalesce(group(1), num(EXACT_GB)),
            speed,
            F.coalesce(group(3), num(STICKS)),
            F.coalesce(group(2), num(MODULE)),
        )

    def merge(both: Column) -> Column:
        t, f = both["t"], both["f"]
        names = ("memory_ddr", "memory_capacity_gb", "memory_speed", "sticks", "memory_capacity_per_stick_gb")
        return _memory_struct(*[F.coalesce(t[n], f[n]) for n in names])

    both = F.struct(let(clean_tags(tags), found).alias("t"), memory_specs_text(fallback).alias("f"))
    return let(let(both, merge), lambda s: _back_fill(s, total_first=False))


def to_gb(value: Column | str, unit: Column | str) -> Column:
    """Whole gigabytes; a terabyte is 1000; another unit gives NULL."""
    number = as_col(value).try_cast("double")
    unit = F.upper(as_col(unit))
    return F.when(unit == "TB", F.floor(number * 1000 + 0.5)).when(unit == "GB", F.floor(number + 0.5)).cast("int")


def ssd_specs(tags: Column, fallback: Column | str) -> Column:
    """struct(capacity_gb, capacity_text, interface_text, form_factor, tags_text)."""

    def bounds(tag: Column) -> Column:
        is_range = tag.rlike(SIZE_RANGE)
        to = F.when(tag.rlike(SIZE_TO[0]), F.struct(extract(tag, SIZE_TO[0]).alias("v"), extract(tag, SIZE_TO[0], 2).alias("u")))
        to = F.coalesce(
            to,
            F.when(tag.rlike(SIZE_TO[1]), F.struct(extract(tag, SIZE_TO[1]).alias("v"), extract(tag, SIZE_TO[1], 2).alias("u"))),
        )
        to = F.when(
            is_range, F.struct(extract(tag, SIZE_RANGE, 3).alias("v"), extract(tag, SIZE_RANGE, 4).alias("u"))
        ).otherwise(to)
        low = F.when(
            is_range, to_gb(extract(tag, SIZE_RANGE, 1), extract(tag, SIZE_RANGE, 2))
        ).otherwise(to_gb(extract(tag, SIZE_FROM, 1), extract(tag, SIZE_FROM, 2)))
        return let(
            to,
            lambda t: F.struct(
                low.alias("lower"),
                to_gb(t["v"], t["u"]).alias("upper"),
                F.concat(t["v"], F.upper(t["u"])).alias("upper_text"),
            ),
        )

    def found(ts: Column) -> Column:
        exact = first_tag(ts, EXACT_SIZE)
        return F.struct(
            exact.alias("exact_text"),
            to_gb(extract(exact, EXACT_SIZE, 1), extract(exact, EXACT_SIZE, 2)).alias("exact_gb"),
            F.transform(ts, bounds).alias("bounds"),
            first_tag(ts, *INTERFACE_TAGS).alias("interface_text"),
            first_tag(ts, *FORM_TAGS).alias("form_factor"),
            blank_to_null(F.array_join(ts, " | ")).alias("tags_text"),
        )

    def resolve(both: Column) -> Column:
        s, text = both["s"], both["text"]
        lower = F.array_max(F.transform(s["bounds"], lambda b: b["lower"]))
        upper = F.array_max(F.transform(s["bounds"], lambda b: b["upper"]))
        last = F.try_element_at(F.filter(s["bounds"], lambda b: b["upper"].isNotNull()), F.lit(-1))
        wins = upper.isNotNull() & (lower.isNull() | (upper > lower))
        return F.struct(
            F.when(wins, upper).otherwise(F.coalesce(s["exact_gb"], lower)).alias("gb"),
            F.when(wins, last["upper_text"]).otherwise(s["exact_text"]).alias("cap"),
            F.struct(extract(text, SIZE_TEXT, 1).alias("v"), extract(text, SIZE_TEXT, 2).alias("u")).alias("size"),
            F.coalesce(s["interface_text"], F.upper(extract(text, INTERFACE_TEXT))).alias("interface_text"),
            F.coalesce(s["form_factor"], extract(text, FORM_TEXT)).alias("form_factor"),
            s["tags_text"].alias("tags_text"),
        )

    def finish(r: Column) -> Column:
        from_text = F.when(r["cap"].isNull(), to_gb(r["size"]["v"], r["size"]["u"]))
        return F.struct(
            F.coalesce(r["gb"], from_text).alias("capacity_gb"),
            F.coalesce(r["cap"], F.concat(r["size"]["v"], F.upper(r["size"]["u"]))).alias("capacity_text"),
            r["interface_text"].alias("interface_text"),
            r["form_factor"].alias("form_factor"),
            r["tags_text"].alias("tags_text"),
        )

    both = F.struct(let(clean_tags(tags), found).alias("s"), compact_spaces(fallback).alias("text"))
    return let(let(both, resolve), finish)
