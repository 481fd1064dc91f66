"""Landed files: API pages and stream records, the file twins of the feed and the topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter import schemas


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed page file: its whole text in ``body``, when it landed and its path."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("body"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("_metadata.file_path").alias("page"),
    )


def stream_pages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path, wholetext=True).select(F.col("value").alias("body"))


def explode_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """Each raw event of each page array as one row.

    A body that is not an array gives none. An array of objects is parsed once; only one that does not
    parse so is split into the texts of its elements, where an element that is no object, or cannot be
    read, is left out alone. All of it is one generator, and no filter looks at the body: Catalyst would copy what
    makes the body into it. Where pages know when and as what they landed, ``arrival`` orders the events
    as they came."""
    known = {"landed_at", "page"} <= set(pages.columns)
    at = ["landed_at", "page"] if known else []
    is_array = F.ltrim(F.col(body), F.lit(" \t\r\n\ufeff")).startswith("[")
    objects = F.filter(
        F.from_json(F.col(body), "array<string>"),
        lambda text: F.ltrim(text, F.lit(" \t\r\n")).startswith("{"),
    )
    apart = F.transform(objects, lambda text: F.from_json(text, schemas.RAW_EVENT))
    events = F.when(is_array, F.coalesce(F.from_json(F.col(body), schemas.RAW_PAGE), apart))
    found = pages.select(*at, F.posexplode(events).alias("place", "event")).where(
        F.col("event").isNotNull()
    )
    arrival = [F.struct(*at, "place").alias("arrival")] if known else []
    return found.select(*arrival, "event.*")


def write_records(records: DataFrame, path: str, mode: str = "append") -> None:
    records.select("key", "value", "timestamp").write.mode(mode).parquet(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("key", "value", "timestamp")


def stream_records(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Landed records as a stream, older files first."""
    reader = spark.readStream.schema("key STRING, value STRING, timestamp TIMESTAMP")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
