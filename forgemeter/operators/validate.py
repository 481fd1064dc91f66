"""Anomaly filter over decoded events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgemeter import schemas


def weight_allowed(bounds: tuple[int, int] = schemas.WEIGHT_RANGE) -> Column:
    weight = F.col("trend_weight")
    return weight.isNull() | weight.between(*bounds)


def keep_valid(
    events: DataFrame,
    known_types: Sequence[str] = schemas.KNOWN_TYPES,
    bounds: tuple[int, int] = schemas.WEIGHT_RANGE,
) -> DataFrame:
    """Events with a repository, a known type and a weight that is in range or missing.

    A blank repository or actor is not null and stays, as its own group.
    """
    return events.where(
        F.col("repo_name").isNotNull()
        & F.col("event_type").isNotNull()
        & F.col("event_type").isin(*known_types)
        & weight_allowed(bounds)
    )


def verdict(
    known_types: Sequence[str] = schemas.KNOWN_TYPES,
    bounds: tuple[int, int] = schemas.WEIGHT_RANGE,
) -> Column:
    """Why an event is dropped, or ``kept``; the first reason that applies."""
    return (
        F.when(F.col("repo_name").isNull(), "missing_repo")
        .when(F.col("event_type").isNull(), "missing_type")
        .when(~F.col("event_type").isin(*known_types), "unknown_type")
        .when(~weight_allowed(bounds), "extreme_weight")
        .otherwise("kept")
    )


def anomaly_counts(events: DataFrame) -> DataFrame:
    return (
        events.select("event_type", verdict().alias("verdict"))
        .groupBy("event_type", "verdict")
        .agg(F.count(F.lit(1)).alias("events"))
    )
