"""Batch statistics: clean events to the five result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter import schemas
from forgemeter.functions.cells import window_key
from forgemeter.functions.codec import decode_records
from forgemeter.operators.aggregates import (
    actor_stats,
    language_stats,
    repo_stats,
    window_activity,
)
from forgemeter.operators.validate import keep_valid
from forgemeter.sources import changelog


def clean_events(records: DataFrame, event_time: str = "record") -> DataFrame:
    """Records to validated events."""
    return keep_valid(decode_records(records, event_time)).select(*schemas.CLEAN.names)


def window_table(activity: DataFrame, measure: str) -> DataFrame:
    """``window_activity`` as a keyed window table of one measure."""
    return activity.select(
        window_key(F.col("window_start")).alias("row_key"),
        F.col(measure).alias("count"),
        "window_start",
        "window_end",
    )


def build_tables(
    spark: SparkSession,
    events: DataFrame,
    rankings: DataFrame,
    root: str,
    batch_id: int | None = None,
    exact: bool = False,
) -> None:
    """Write all five tables as one batch, by default under the next free id.

    The events are read once per kind of group (window, repository, contributor). What two
    tables share is written first and read back, not computed twice, so an executor lost
    later costs a re-read only. For the same reason the events should be a stored table.
    """
    if batch_id is None:
        batch_id = changelog.next_batch(spark, root)
    repos = repo_stats(events, exact)
    changelog.write_batch(repos, root, changelog.REPO, batch_id)
    stored = changelog.read_latest(spark, root, changelog.REPO, batch_id)
    languages = language_stats(stored, rankings)
    changelog.write_batch(languages, root, changelog.LANGUAGE, batch_id)

    changelog.write_batch(actor_stats(events), root, changelog.ACTOR, batch_id)

    staging = f"{root}/window_activity/batch_id={batch_id}"
    window_activity(events, exact).write.mode("overwrite").parquet(staging)
    activity = spark.read.parquet(staging)
    for table, measure in (
        (changelog.NEW_REPOS, "repo_count"),
        (changelog.PUSH_SPEED, "push_count"),
    ):
        changelog.write_batch(window_table(activity, measure), root, table, batch_id)
