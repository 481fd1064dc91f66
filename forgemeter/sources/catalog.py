"""Named views, databases and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def register_view(df: DataFrame, name: str) -> None:
    """Name a DataFrame for SQL in its own session.

    Inside ``foreachBatch`` that is the query's session, not the one that started it.
    """
    df.createOrReplaceTempView(name)


def ensure_database(spark: SparkSession, name: str) -> bool:
    """Create the database if it is absent; true when it is there afterwards."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    return spark.catalog.databaseExists(name)


def ensure_table(spark: SparkSession, name: str, schema: StructType, path: str) -> bool:
    """Create an external Parquet table if it is absent; true when it is there afterwards."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    return spark.catalog.tableExists(name)


def table_or_empty(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """The table, or no rows of the given schema while nobody has created it."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)
