"""Left lookups that add a dimension to events or repositories.

No join is forced to broadcast here: Catalyst broadcasts a dimension whose known size is
below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise. The one explicit
broadcast is of at most ``HOT_LIMIT`` rows by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_LIMIT = 1_000
SPREAD = 4_096


def frequent_keys(events: DataFrame, key: str, limit: int = HOT_LIMIT) -> DataFrame:
    """The most frequent keys, at most ``limit``; counts are combined before the shuffle."""
    return (
        events.where(F.col(key) != "")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), F.asc(key))
        .limit(min(limit, HOT_LIMIT))
        .select(key)
    )


def hot_repo_languages(
    events: DataFrame, repo_languages: DataFrame, limit: int = HOT_LIMIT
) -> DataFrame:
    """Languages of the busiest repositories, null where none is known."""
    hot = frequent_keys(events, "repo_name", limit)
    found = repo_languages.join(F.broadcast(hot), "repo_name").select("repo_name", "language")
    return hot.join(found, "repo_name", "left")


def lookup_repo_language(
    events: DataFrame,
    repo_languages: DataFrame,
    hot: DataFrame | None = None,
    spread_by: str = "event_id",
) -> DataFrame:
    """Add ``language`` by repository name; empty when unknown or when the name is blank.

    ``repo_languages`` has one row per repository. When it is too large to broadcast the
    join shuffles on the name, and one busy repository would land in one task. Therefore
    rows that need no shuffled lookup carry a spread number other than 0, which matches
    nothing and scatters them: blank names, and the repositories listed in ``hot``
    (``hot_repo_languages``), whose language comes from a broadcast of bounded size.
    ``spread_by`` should differ from row to row, so remove duplicates first.
    """
    scatter = F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)).cast("int") + 1
    settled = F.col("repo_name").isNull() | (F.col("repo_name") == "")
    rows = events
    if hot is not None:
        listed = hot.limit(HOT_LIMIT).select(
            "repo_name", F.col("language").alias("_hot_language"), F.lit(True).alias("_hot")
        )
        rows = rows.join(F.broadcast(listed), "repo_name", "left")
        settled = settled | F.coalesce(F.col("_hot"), F.lit(False))
        answer = [F.col("_hot_language"), F.col("_language")]
    else:
        answer = [F.col("_language")]
    rows = rows.withColumn("_spread", F.when(settled, scatter).otherwise(F.lit(0)))
    known = repo_languages.where(F.col("repo_name") != "").select(
        "repo_name", F.lit(0).alias("_spread"), F.col("language").alias("_language")
    )
    return rows.join(known, ["repo_name", "_spread"], "left").select(
        *events.columns, F.coalesce(*answer, F.lit("")).alias("language")
    )


def attach_rankings(repos: DataFrame, rankings: DataFrame) -> DataFrame:
    """Repositories with the tier, paradigm and type of their language (exact match)."""
    language = F.nullif(F.col("event_language"), F.lit(""))
    return repos.join(rankings, language == rankings["language"], "left")
