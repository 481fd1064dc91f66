"""What the operators share: reading a table, staging a step, words, and the fixed limits."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgemeter.session import new_run_folder
from forgemeter.sources import storage

# A word is a run of anything but the space and the five ASCII controls from tab to return.
SPACES = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def parts_of(batches: Iterable[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Batches in parts of at most so many rows, which bounds what a worker holds besides the batch."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.iloc[start : start + rows]


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write a step to the shared folder and read it back: the lineage ends there, so a lost
    executor costs a reread and not the step. Its shuffle files, needed no more, are removed."""
    spark = df.sparkSession
    path = new_run_folder(spark, purpose)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def release(step: DataFrame) -> None:
    """Delete a staged step that nothing reads any more: what was made of it is stored."""
    storage.delete_folder(step.sparkSession, step.staged_at)


def numbered(df: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """The rows, stored, with a ``number`` from 0 on in this order: sorted by range, counted within
    partitions, and moved on by the rows of the partitions before, which is one number a partition."""
    placed = stage(
        df.repartitionByRange(shuffle_partitions(df.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumn("number", F.monotonically_increasing_id()),
        purpose,
    )
    part, at = F.shiftright("number", 33), F.col("number").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(bases), "_part")
        .withColumn("number", F.col("_base") + at)
        .drop("_part", "_base")
    )


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_hashes(text: str, lower: bool = False, seed: int = 0) -> np.ndarray:
    """64-bit hashes of a text's words; ``bytes.split`` parts at exactly the six white-space bytes
    and ``bytes.lower`` changes A-Z only."""
    raw = text.encode("utf-8", "surrogatepass")
    found = (raw.lower() if lower else raw).split()
    digest = partial(xxhash.xxh3_64_intdigest, seed=seed) if seed else xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, found), dtype=np.uint64, count=len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values: a bijection with every bit depending on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of ``width`` consecutive elements, in order."""
    n = len(hashes) - width + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    return mix(out)


def words(text: Column) -> Column:
    """The words of a text as an array; none for a null or blank text."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.array_remove(parts, "")
