"""One event per id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_events(
    events: DataFrame, first_by: str | None = None, key: str = "event_id"
) -> DataFrame:
    """Batch: one row per id, the first by ``first_by`` when copies can differ.

    Both forms are aggregates with a map-side step, so a huge group of copies shrinks to
    one row per task before it is shuffled.
    """
    if first_by is None:
        return events.dropDuplicates([key])
    others = [c for c in events.columns if c != key]
    return (
        events.groupBy(key)
        .agg(F.min_by(F.struct(*others), first_by).alias("first"))
        .select(key, *[F.col(f"first.{c}").alias(c) for c in others])
        .select(*events.columns)
    )


def dedup_stream(
    events: DataFrame,
    event_time: str,
    delay: str,
    key: str = "event_id",
    spread_copies: bool = False,
) -> DataFrame:
    """Streaming: the first arrival of each id; state is bounded by event time.

    The state keeps an id and its expiry only, and copies stream past it one by one, so a
    hot id costs time in proportion to its copies but no memory. Where single ids may hold
    a large part of a micro-batch, ``spread_copies`` removes copies per source task first,
    which scatters them over all tasks and leaves one per source task for the exact step.
    It costs a second shuffle and state.
    """
    events = events.withWatermark(event_time, delay)
    if spread_copies:
        sliced = events.withColumn("_slice", F.spark_partition_id())
        events = sliced.dropDuplicatesWithinWatermark([key, "_slice"]).drop("_slice")
    return events.dropDuplicatesWithinWatermark([key])
