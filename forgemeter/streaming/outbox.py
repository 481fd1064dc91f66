"""Update messages of all feeds as one table, written by the jobs and read as one stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forgemeter.sources import storage

SCHEMA = "type STRING, body STRING, source STRING, batch_id BIGINT"


def post(messages: DataFrame, root: str, source: str, batch_id: int) -> None:
    """Messages of one batch of one feed; a replay overwrites them with the same."""
    folder = f"{root}/outbox/source={source}/batch_id={batch_id}"
    messages.select("type", "body").write.mode("overwrite").parquet(folder)


def read_outbox(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(f"{root}/outbox")


def stream_outbox(
    spark: SparkSession, root: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """All feeds interleaved as they arrive. After a crash a message can come again; every
    kind replaces what its reader shows, so that does no harm."""
    reader = spark.readStream.schema(SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(storage.ensure_folder(spark, f"{root}/outbox"))
