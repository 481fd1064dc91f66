"""Display text and links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
PROFILE_BASE = "https://github.com/"
PARADIGM_CLASSES = {
    "functional": "badge-secondary",
    "object-oriented": "badge-primary",
    "systems": "badge-error",
    "concurrent": "badge-accent",
}
DEFAULT_PARADIGM_CLASS = "badge-ghost"
RANK_CLASSES = {1: "badge-warning", 2: "badge-neutral", 3: "badge-accent"}
DEFAULT_RANK_CLASS = "badge-ghost"

# One link of a header: <url>; rel="next", standing between commas.
NEXT_LINK = r'(?:^|,)\s*<([^,;]*)>\s*;\s*rel="next"\s*;*\s*(?:,|$)'


def compact_number(n: Column) -> Column:
    """1234567 -> 1.2M, 1999 -> 1.9K, 42 -> 42. Tenths are cut off, not rounded."""

    def scaled(tenth: int, unit: str) -> Column:
        tenths = F.call_function("div", n, F.lit(tenth))
        return F.concat(
            F.call_function("div", tenths, F.lit(10)).cast("string"),
            F.lit("."),
            (tenths % 10).cast("string"),
            F.lit(unit),
        )

    return (
        F.when(n >= 1_000_000, scaled(100_000, "M"))
        .when(n >= 1_000, scaled(100, "K"))
        .otherwise(n.cast("string"))
    )


def clock_label(millis: Column, zone: str | None = None) -> Column:
    """HH:mm of an epoch-millisecond value, in ``zone`` or else the session time zone."""
    if zone is None:
        return F.date_format(F.timestamp_millis(millis), "HH:mm")
    wall = F.convert_timezone(
        F.lit("UTC"),
        F.lit(zone),
        F.timestamp_add("MILLISECOND", millis, F.lit("1970-01-01").cast("timestamp_ntz")),
    )
    return F.date_format(wall, "HH:mm")


def tier_label(tier: Column) -> Column:
    return F.when(tier == "1", "Tier 1").when(tier == "2", "Tier 2").otherwise("Tier 3")


def paradigm_class(paradigm: Column) -> Column:
    return _choose(paradigm, PARADIGM_CLASSES, DEFAULT_PARADIGM_CLASS)


def rank_class(rank: Column) -> Column:
    return _choose(rank, RANK_CLASSES, DEFAULT_RANK_CLASS)


def profile_link(key: Column, base: str = PROFILE_BASE) -> Column:
    return F.concat(F.lit(base), key)


def next_page_link(header: Column) -> Column:
    """The rel="next" address of a Link response header, or null."""
    return F.nullif(F.regexp_extract(header, NEXT_LINK, 1), F.lit(""))


def _choose(value: Column, options: dict, default: str) -> Column:
    chosen = None
    for option, label in options.items():
        hit = value == F.lit(option)
        chosen = F.when(hit, label) if chosen is None else chosen.when(hit, label)
    return chosen.otherwise(default)
