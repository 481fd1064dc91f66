"""The statistics: per repository, per contributor, per language, per sliding window.

All sums and counts have fixed-width buffers, so Spark aggregates by hash and combines on
the map side: a repository, contributor or window that holds a third of all events reaches
its reducer as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgemeter import schemas
from forgemeter.operators.lookups import attach_rankings


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def _events_of(event_type: str) -> Column:
    return F.count_if(_is(event_type))


def _push_weight() -> Column:
    weight = F.when(_is("PushEvent"), F.col("trend_weight")).otherwise(F.lit(0).cast("long"))
    return F.coalesce(F.sum(weight), F.lit(0).cast("long"))


def _distinct(column: str, exact: bool) -> Column:
    if exact:
        return F.count_distinct(column)
    return F.approx_count_distinct(column, schemas.DISTINCT_RSD)


def _greatest_language() -> Column:
    return F.max(F.when(F.col("language") != "", F.col("language")))


_COUNTS = ["star_count", "fork_count", "push_count", "push_weight", "activity_count"]


def _repo_counts() -> list[Column]:
    return [
        _events_of("WatchEvent").alias("star_count"),
        _events_of("ForkEvent").alias("fork_count"),
        _events_of("PushEvent").alias("push_count"),
        _push_weight().alias("push_weight"),
        F.count(F.lit(1)).alias("activity_count"),
    ]


def repo_counters(events: DataFrame, exact: bool = False) -> DataFrame:
    """Per repository: stars, forks, pushes, push weight, activity and contributors."""
    return events.groupBy("repo_name").agg(
        *_repo_counts(), _distinct("actor_login", exact).alias("contributor_count")
    )


def repo_stats(events: DataFrame, exact: bool = False) -> DataFrame:
    """``repo_counters`` with the greatest non-blank language of the repository.

    The approximate form is one pass and the only one that can stream. Its text buffer
    (the language) makes Spark aggregate by sort; an exact distinct count on top would sort
    the rows twice. The exact form, for batch only, therefore counts and finds the language
    in hash steps, counts contributors in a narrow pass, and joins the two, which are
    both partitioned by repository already.
    """
    if not exact:
        return events.groupBy("repo_name").agg(
            *_repo_counts(),
            _distinct("actor_login", exact).alias("contributor_count"),
            _greatest_language().alias("event_language"),
        )
    contributors = events.groupBy("repo_name").agg(
        _distinct("actor_login", exact).alias("contributor_count")
    )
    columns = ["repo_name", *_COUNTS, "contributor_count", "event_language"]
    return repo_activity(events).join(contributors, "repo_name").select(*columns)


def repo_activity(events: DataFrame) -> DataFrame:
    """``repo_stats`` without contributors, in two hash steps (batch only).

    Counting by (repository, language) first leaves the text buffer of the greatest
    language to a second step over far fewer rows.
    """
    return (
        events.groupBy("repo_name", "language")
        .agg(*_repo_counts())
        .groupBy("repo_name")
        .agg(*[F.sum(c).alias(c) for c in _COUNTS], _greatest_language().alias("event_language"))
    )


def actor_stats(events: DataFrame) -> DataFrame:
    """Events per contributor; the null group is dropped below the aggregate."""
    return (
        events.groupBy("actor_login")
        .agg(F.count(F.lit(1)).alias("activity_count"))
        .where(F.col("actor_login").isNotNull())
    )


def window_activity(
    events: DataFrame,
    exact: bool = False,
    size: str = schemas.WINDOW_SIZE,
    slide: str = schemas.WINDOW_SLIDE,
) -> DataFrame:
    """Per sliding window: distinct active repositories, and pushes. Starts in epoch ms."""
    return (
        events.groupBy(F.window("event_ts", size, slide))
        .agg(
            _distinct("repo_name", exact).alias("repo_count"),
            _events_of("PushEvent").alias("push_count"),
        )
        .select(
            F.unix_millis("window.start").alias("window_start"),
            F.unix_millis("window.end").alias("window_end"),
            "repo_count",
            "push_count",
        )
    )


def language_stats(repos: DataFrame, rankings: DataFrame) -> DataFrame:
    """Totals per language over repository rows (batch, or inside ``foreachBatch``).

    Repositories without a language are left out; a language the dimension does not list
    gets the lowest tier and unknown traits.
    """
    listed = repos.where(F.col("event_language").isNotNull() & (F.col("event_language") != ""))
    totals = listed.groupBy("event_language").agg(
        *[F.sum(c).alias(total) for c, total in _LANGUAGE_TOTALS.items()],
        F.count(F.lit(1)).alias("repo_count"),
    )
    return _ranked_totals(totals, rankings)


_LANGUAGE_TOTALS = {
    "star_count": "total_stars",
    "fork_count": "total_forks",
    "push_count": "total_pushes",
    "activity_count": "total_activity",
}


def _ranked_totals(totals: DataFrame, rankings: DataFrame) -> DataFrame:
    """Totals by ``event_language`` with the traits of the language."""
    return attach_rankings(totals, rankings).select(
        F.col("event_language").alias("language"),
        F.coalesce("tier", F.lit(schemas.DEFAULT_TIER)).alias("tier"),
        F.coalesce("paradigm", F.lit(schemas.DEFAULT_PARADIGM)).alias("paradigm"),
        F.coalesce("type", F.lit(schemas.DEFAULT_LANG_TYPE)).alias("lang_type"),
        *_LANGUAGE_TOTALS.values(),
        "repo_count",
    )


def changed_language_stats(
    totals: DataFrame, old: DataFrame, new: DataFrame, rankings: DataFrame
) -> DataFrame:
    """``language_stats`` after a change, from those before it and the changed repositories' rows before
    and after: the old rows are taken out and the new ones added. A language without repositories goes."""
    measures = [*_LANGUAGE_TOTALS.values(), "repo_count"]

    def signed(repos: DataFrame, sign: int) -> DataFrame:
        listed = repos.where(F.col("event_language").isNotNull() & (F.col("event_language") != ""))
        return listed.select(
            "event_language",
            *[(F.col(c) * sign).cast("long").alias(total) for c, total in _LANGUAGE_TOTALS.items()],
            F.lit(sign).cast("long").alias("repo_count"),
        )

    before = totals.select(F.col("language").alias("event_language"), *measures)
    merged = (
        before.unionByName(signed(old, -1))
        .unionByName(signed(new, 1))
        .groupBy("event_language")
        .agg(*[F.sum(m).alias(m) for m in measures])
        .where("repo_count > 0")
    )
    return _ranked_totals(merged, rankings)
