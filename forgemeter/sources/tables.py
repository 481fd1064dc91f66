"""Columnar tables by folder and name, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(
    spark: SparkSession, folder: str, name: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same table as a stream.

    Without a file cap a run reads everything in one micro-batch, so no row of a history
    whose files are in no time order can come too late. Live reading sets the cap.
    """
    schema = read_table(spark, folder, name).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # The braces make it a glob of one name, which may then be a file or a directory.
    return reader.parquet(f"{folder}/{{{name}.parquet}}")
