"""Nested raw events to flat enriched events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgemeter import schemas
from forgemeter.functions.codec import iso_utc
from forgemeter.sources.dimensions import trend_weight


def _text(path: str, default: str = "") -> Column:
    return F.coalesce(F.col(path), F.lit(default))


def _number(path: str, kind: str) -> Column:
    """A number sent bare or quoted, cut to an integer; 0 when absent or no number."""
    raw = F.col(path)
    return F.coalesce(
        raw.try_cast(kind), raw.try_cast("double").try_cast(kind), F.lit(0).cast(kind)
    )


def _only_for(event_type: str, value: Column, default: object) -> Column:
    return F.when(F.col("type") == event_type, value).otherwise(F.lit(default))


def flatten_events(
    raw: DataFrame,
    ingested_at: Column | None = None,
    weights: dict[str, int] | None = None,
) -> DataFrame:
    """The flat event without its language: missing text is empty, a missing number is 0.

    Events without an id are dropped. The seven type-specific columns hold their default
    unless the event is of their type. A column ``arrival`` is kept.
    """
    ingested_at = F.current_timestamp() if ingested_at is None else ingested_at
    event_type = _text("type", schemas.DEFAULT_TYPE)
    return raw.where(_text("id") != "").select(
        *[c for c in ("arrival",) if c in raw.columns],
        F.col("id").alias("event_id"),
        event_type.alias("event_type"),
        _text("actor.login").alias("actor_login"),
        _number("actor.id", "long").alias("actor_id"),
        _number("repo.id", "long").alias("repo_id"),
        _text("repo.name").alias("repo_name"),
        _text("created_at").alias("created_at"),
        iso_utc(ingested_at).alias("ingest_time"),
        trend_weight(event_type, weights).alias("trend_weight"),
        _only_for("PushEvent", _number("payload.size", "int"), 0).alias("push_size"),
        _only_for("PushEvent", _text("payload.ref"), "").alias("push_ref"),
        _only_for("CreateEvent", _text("payload.ref_type"), "").alias("ref_type"),
        _only_for("ForkEvent", _text("payload.forkee.full_name"), "").alias("fork_repo"),
        _only_for("ReleaseEvent", _text("payload.release.tag_name"), "").alias("release_tag"),
        _only_for("PullRequestEvent", _text("payload.action"), "").alias("pr_action"),
        _only_for("IssuesEvent", _text("payload.action"), "").alias("issue_action"),
    )
