"""Panes: events counted once per short stretch of time, as states that merge.

A sliding window copies each event into every window it lies in. Here an event goes into one pane, and a
window, or any longer range, is the merge of its panes: counts add up, and distinct values are merged
either exactly, from one row for each value of a pane, or as sketches of fixed size. What is
copied into windows is these rows, of which there are far fewer than events.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgemeter import schemas

# 4,096 registers: a standard error of 1.04 / 64, and at most a few KB a sketch.
SKETCH_BITS = 12
SKETCH_RSD = 1.04 / 2 ** (SKETCH_BITS / 2)

_UNITS = {"second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6}


def duration_us(text: str) -> int:
    """A length such as ``10 minutes`` in microseconds."""
    number, unit = text.split()
    return int(number) * _UNITS[unit.removesuffix("s")]


def _sketch(column: str) -> Column:
    """A sketch passes over blank text, which is a value here, so each text gets a mark in front."""
    return F.hll_sketch_agg(F.concat(F.lit("="), F.col(column)), SKETCH_BITS)


def pane_states(events: DataFrame, pane: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per pane (and group of ``by``): counts that add up, and sketches of its repositories and
    contributors that merge. Batch or stream. Times in epoch ms, the end not included."""
    return (
        events.groupBy(F.window("event_ts", pane), *by)
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_if(F.col("event_type") == "PushEvent").alias("push_count"),
            _sketch("repo_name").alias("repo_sketch"),
            _sketch("actor_login").alias("actor_sketch"),
        )
        .select(
            F.unix_millis("window.start").alias("pane_start"),
            F.unix_millis("window.end").alias("pane_end"),
            *by,
            "event_count",
            "push_count",
            "repo_sketch",
            "actor_sketch",
        )
    )


def merged_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States with the same keys as one."""
    return states.groupBy(*keys).agg(
        F.sum("event_count").alias("event_count"),
        F.sum("push_count").alias("push_count"),
        F.hll_union_agg("repo_sketch").alias("repo_sketch"),
        F.hll_union_agg("actor_sketch").alias("actor_sketch"),
    )


def estimated(states: DataFrame) -> DataFrame:
    """Sketches as the numbers they estimate: ``repo_count`` and ``contributor_count``."""
    return states.withColumns(
        {
            "repo_count": F.hll_sketch_estimate("repo_sketch"),
            "contributor_count": F.hll_sketch_estimate("actor_sketch"),
        }
    ).drop("repo_sketch", "actor_sketch")


def _windows_of(pane_us: Column, size_us: int, slide_us: int) -> Column:
    """Starts of the windows that hold the pane: multiples of the slide after pane - size, up to it."""
    last = pane_us - F.pmod(pane_us, F.lit(slide_us))
    oldest = pane_us - size_us
    first = oldest - F.pmod(oldest, F.lit(slide_us)) + slide_us
    return F.when(first <= last, F.sequence(first, last, F.lit(slide_us)))


def window_activity_panes(
    events: DataFrame,
    exact: bool = False,
    size: str = schemas.WINDOW_SIZE,
    slide: str = schemas.WINDOW_SLIDE,
) -> DataFrame:
    """``window_activity`` by panes, as long as what divides both size and slide (batch).

    Exact repositories need a row for each (pane, repository); otherwise there is one row a pane.
    A slide above the size leaves gaps, whose events are in no window.
    """
    size_us, slide_us = duration_us(size), duration_us(slide)
    step = gcd(size_us, slide_us)
    if exact:
        at = F.unix_micros("event_ts")
        states = events.groupBy((at - F.pmod(at, F.lit(step))).alias("pane"), "repo_name").agg(
            F.count_if(F.col("event_type") == "PushEvent").alias("push_count")
        )
    else:
        states = pane_states(events, f"{step // 10**6} seconds").withColumn(
            "pane", F.col("pane_start") * 1000
        )
    placed = states.withColumn("start", F.explode(_windows_of(F.col("pane"), size_us, slide_us)))
    if exact:
        # A repository's rows of a window first become one; then counting needs no distinct.
        merged = (
            placed.groupBy("start", "repo_name")
            .agg(F.sum("push_count").alias("push_count"))
            .groupBy("start")
            .agg(F.count("repo_name").alias("repo_count"), F.sum("push_count").alias("push_count"))
        )
    else:
        merged = estimated(merged_states(placed, ["start"]))
    return merged.select(
        F.expr("start div 1000").alias("window_start"),
        F.expr(f"(start + {size_us}) div 1000").alias("window_end"),
        "repo_count",
        "push_count",
    )


DAY_MS = 86_400_000


def range_states(states: DataFrame, ranges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The states of all panes that lie wholly in each range, merged, per group of ``by``.

    ``ranges`` has ``range_id``, ``range_start`` and ``range_end`` (epoch ms, the end not included), and they may
    overlap. Panes meet ranges by the days that a range touches, so no pane is held
    against every range. A range without panes gives no row.
    """

    def day(at: Column) -> Column:
        return F.floor(at / DAY_MS)

    touched = ranges.where("range_start < range_end").select(
        "range_id",
        "range_start",
        "range_end",
        F.explode(F.sequence(day(F.col("range_start")), day(F.col("range_end") - 1))).alias("day"),
    )
    placed = (
        states.withColumn("day", day(F.col("pane_start")))
        .join(touched, "day")
        .where("pane_start >= range_start and pane_end <= range_end")
    )
    return merged_states(placed, ["range_id", *by])
