"""Top-k, recent windows, ranks and totals for display.

Every order is total, so results do not depend on partitioning. ``orderBy().limit()``
plans as TakeOrderedAndProject: each task keeps k rows and only those are merged.
Rank and share windows come after the limit, over a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgemeter import schemas
from forgemeter.functions import labels

# Order of the repository panel per sort key. Ties fall as they do when a list that is
# already in descending (activity, name) order is sorted ascending and reversed.
REPO_ORDERS = {
    "activity": (("activity_count", False), ("repo_name", True)),
    "stars": (("star_count", False), ("activity_count", True), ("repo_name", True)),
    "forks": (("fork_count", False), ("activity_count", True), ("repo_name", True)),
}


def _first_by_key(table: DataFrame, key: str, scan_limit: int | None) -> DataFrame:
    return table if scan_limit is None else table.orderBy(key).limit(scan_limit)


def top_repos(
    repos: DataFrame, scan_limit: int | None = None, limit: int = schemas.REPO_TOP
) -> DataFrame:
    """Busiest repositories, over all rows or over the first ``scan_limit`` in key order."""
    scanned = _first_by_key(repos, "repo_name", scan_limit)
    return scanned.orderBy(F.desc("activity_count"), F.desc("repo_name")).limit(limit)


def top_actors(
    actors: DataFrame, scan_limit: int | None = None, limit: int = schemas.ACTOR_TOP
) -> DataFrame:
    scanned = _first_by_key(actors, "actor_login", scan_limit)
    return scanned.orderBy(F.desc("activity_count"), F.desc("actor_login")).limit(limit)


def recent_windows(windows: DataFrame, limit: int = schemas.WINDOW_TOP) -> DataFrame:
    return windows.orderBy(F.desc("window_start")).limit(limit)


def windows_since(windows: DataFrame, since: int) -> DataFrame:
    """Windows that start later than ``since`` (epoch ms), oldest first."""
    return windows.where(F.col("window_start") > since).orderBy("window_start")


def append_windows(
    shown: DataFrame, added: DataFrame, keep: int = schemas.WINDOW_TOP
) -> DataFrame:
    """The list after new windows arrive, one row per window, newest ``keep``."""
    both = shown.withColumn("_turn", F.lit(0)).unionByName(added.withColumn("_turn", F.lit(1)))
    values = [c for c in shown.columns if c != "window_start"]
    merged = both.groupBy("window_start").agg(F.max_by(F.struct(*values), "_turn").alias("w"))
    merged = merged.select("window_start", *[F.col(f"w.{v}").alias(v) for v in values])
    return recent_windows(merged.select(*shown.columns), keep)


def _ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.orderBy(*order)).cast("long")
    return rows.withColumn("rank", rank).withColumn(
        "rank_class", labels.rank_class(F.col("rank"))
    )


def repo_panel(
    snapshot: DataFrame, sort_key: str = "activity", limit: int = schemas.PANEL_TOP
) -> DataFrame:
    """The repository panel over the ``top_repos`` snapshot, by activity, stars or forks."""
    spec = REPO_ORDERS[sort_key]
    order = [F.asc(c) if ascending else F.desc(c) for c, ascending in spec]
    top = _ranked(snapshot.orderBy(*order).limit(limit), order)
    return top.select(
        "rank",
        "rank_class",
        "repo_name",
        labels.profile_link(F.col("repo_name")).alias("link"),
        F.col(spec[0][0]).alias("metric"),
        labels.compact_number(F.col(spec[0][0])).alias("metric_text"),
    )


def contributor_panel(snapshot: DataFrame, limit: int = schemas.PANEL_TOP) -> DataFrame:
    order = [F.desc("activity_count"), F.asc("actor_login")]
    top = _ranked(snapshot.orderBy(*order).limit(limit), order)
    return top.select(
        "rank",
        "rank_class",
        "actor_login",
        labels.profile_link(F.col("actor_login")).alias("link"),
        "activity_count",
        labels.compact_number(F.col("activity_count")).alias("activity_text"),
    )


def language_panel(languages: DataFrame, limit: int = schemas.PANEL_TOP) -> DataFrame:
    order = [F.desc("total_activity"), F.desc("language")]
    top = _ranked(languages.orderBy(*order).limit(limit), order)
    return top.select(
        "rank",
        "rank_class",
        "language",
        "paradigm",
        labels.paradigm_class(F.col("paradigm")).alias("paradigm_class"),
        labels.tier_label(F.col("tier")).alias("tier_label"),
        *[
            labels.compact_number(F.col(c)).alias(f"{c}_text")
            for c in ("total_stars", "total_forks", "total_pushes")
        ],
        "total_activity",
        "repo_count",
    )


def window_panel(
    windows: DataFrame,
    value: str = "count",
    shown: int = schemas.WINDOW_SHOWN,
    kept: int = schemas.WINDOW_TOP,
    zone: str | None = None,
) -> DataFrame:
    """The last windows, oldest first, each with its clock label and share of the maximum."""
    recent = recent_windows(recent_windows(windows, kept), shown)
    top = F.max(value).over(Window.partitionBy())
    return recent.select(
        "window_start",
        labels.clock_label(F.col("window_start"), zone).alias("label"),
        F.col(value),
        top.alias("max_value"),
        F.try_divide(F.col(value).cast("double"), top.cast("double")).alias("share"),
    ).orderBy("window_start")


def overview_totals(snapshot: DataFrame) -> DataFrame:
    """Totals over the shown repositories. Contributors add up per repository: a person
    active in two of them counts twice."""
    sums = {
        "stars": "star_count",
        "forks": "fork_count",
        "pushes": "push_count",
        "contributors": "contributor_count",
    }
    totals = snapshot.agg(
        F.count(F.lit(1)).alias("repos"),
        *[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(n) for n, c in sums.items()],
    )
    return totals.withColumns(
        {f"{n}_text": labels.compact_number(F.col(n)) for n in sums}
    )


def high_water(rows: DataFrame, measure: str, previous: int = 0) -> DataFrame:
    """One row: the greatest measure, or ``previous`` when there are no rows."""
    mark = F.coalesce(F.max(measure), F.lit(previous).cast("long"))
    return rows.agg(mark.alias("high_water"))
