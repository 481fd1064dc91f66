"""The generic ``events`` table seen as repository events.

``events`` has (event_id, ts, user_id, event_type, value, props); this maps it to the
columns of the event model so that every operator can run on it, batch or streaming.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the mapping.
TYPE_MAP = {
    "view": "WatchEvent",
    "signup": "ForkEvent",
    "click": "PushEvent",
    "purchase": "PullRequestEvent",
    "error": "ReleaseEvent",
}


def utc_instant(wall: Column, session_zone: str) -> Column:
    """A zone-less UTC timestamp as an instant.

    The cast reads it in the session's zone. In a zone other than UTC an hour may come twice, so there
    the microseconds since the epoch are counted without a zone.
    """
    if session_zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, wall))
    return wall.cast("timestamp")


def canonical_events(events: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """All events, or only those of the given types, which then is a filter of the scan."""
    if types is not None:
        events = events.where(
            F.col("event_type").isin([name for name, kind in TYPE_MAP.items() if kind in types])
        )
    # json_tuple is a generator, so later filters stay above it and the text is parsed once;
    # a plain expression would be copied into every filter on a column made of it.
    keyed = events.select(
        "event_id", "ts", "user_id", "event_type", "value", F.json_tuple("props", "k").alias("k")
    ).withColumn("k", F.col("k").cast("long"))
    kind = F.col("event_type")
    zone = events.sparkSession.conf.get("spark.sql.session.timeZone")
    mapped = None
    for name, event_type in TYPE_MAP.items():
        mapped = (
            F.when(kind == name, event_type)
            if mapped is None
            else mapped.when(kind == name, event_type)
        )
    language = (
        F.when(F.col("k") % 11 == 0, "")
        .when(F.col("k") % 13 == 0, "Unlisted")
        .when(F.col("k") % 5 == 0, "Python")
        .when(F.col("k") % 5 == 1, "Java")
        .when(F.col("k") % 5 == 2, "Scala")
        .when(F.col("k") % 5 == 3, "Rust")
        .otherwise("HTML")
    )
    return keyed.select(
        "event_id",
        utc_instant(F.col("ts"), zone).alias("event_ts"),
        mapped.alias("event_type"),
        F.when(F.col("user_id") % 50 == 0, "")
        .otherwise(F.concat(F.lit("user"), F.col("user_id").cast("string")))
        .alias("actor_login"),
        F.concat(
            F.lit("org"),
            (F.col("k") % 10).cast("string"),
            F.lit("/repo"),
            F.col("k").cast("string"),
        ).alias("repo_name"),
        F.when(F.col("event_id") % 17 != 0, F.floor("value").cast("long")).alias("trend_weight"),
        language.alias("language"),
    )
