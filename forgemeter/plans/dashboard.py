"""Reads for display: current snapshots as messages, and the gate on re-emission."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.operators.messages import all_messages, list_message, list_messages
from forgemeter.operators.ranking import recent_windows, top_actors, top_repos
from forgemeter.operators.scan import with_earlier
from forgemeter.session import new_run_folder
from forgemeter.sources import changelog


def snapshot_messages(
    spark: SparkSession,
    root: str,
    repo_scan: int | None = None,
    actor_scan: int | None = None,
) -> DataFrame:
    """The five current snapshots in their sending order.

    ``repo_scan`` / ``actor_scan`` rank only the first rows in key order, as a reader with a
    bounded scan would; by default all rows are ranked. A long list of languages comes in parts.
    """

    def read(table: changelog.KeyedTable) -> DataFrame:
        return changelog.read_table(spark, root, table)

    return all_messages(
        list_message(recent_windows(read(changelog.NEW_REPOS)), "Snapshot", ["window_start"], True),
        list_message(
            recent_windows(read(changelog.PUSH_SPEED)), "PushSpeedSnapshot", ["window_start"], True
        ),
        list_message(
            top_repos(read(changelog.REPO), repo_scan),
            "RepoStatsSnapshot",
            ["activity_count", "repo_name"],
            True,
        ),
        list_messages(
            read(changelog.LANGUAGE),
            "LanguageStatsSnapshot",
            ["language"],
            new_run_folder(spark, "messages"),
        ),
        list_message(
            top_actors(read(changelog.ACTOR), actor_scan),
            "ActorStatsSnapshot",
            ["activity_count", "actor_login"],
            True,
        ),
    )


def gate_history(
    events: DataFrame, every: str = "1 day", key: str = "repo_name", staging: str | None = None
) -> DataFrame:
    """Which refreshes of the top list would have been sent, had it been refreshed ``every``.

    A refresh is sent when the greatest cumulative activity has grown since the one before.
    Counts shrink to (key, interval) before anything is ordered. Both the running totals of a key and the
    running maximum over intervals are scans in ranges, so neither a busy key nor fine
    intervals meet in one task. ``staging`` is a fresh folder for their steps.
    """
    staging = staging or new_run_folder(events.sparkSession, "gate")
    per_interval = events.groupBy(key, F.window("event_ts", every)["end"].alias("at")).agg(
        F.count(F.lit(1)).alias("n")
    )
    order, none = [F.col("at")], F.lit(0).cast("long")
    counted = with_earlier(per_interval, order, "n", "sum", f"{staging}/totals", by=[key])
    peaks = (
        counted.select("at", (F.coalesce("earlier", none) + F.col("n")).alias("total"))
        .groupBy("at")
        .agg(F.max("total").alias("peak"))
    )
    before = F.coalesce("earlier", none)
    return with_earlier(peaks, order, "peak", "max", f"{staging}/peaks").select(
        F.unix_millis("at").alias("refreshed_at"),
        F.greatest("peak", before).alias("high_water"),
        (F.col("peak") > before).alias("sent"),
    )
