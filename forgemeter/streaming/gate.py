"""Re-emission of a top list only when its greatest activity has grown."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.operators.ranking import high_water
from forgemeter.sources import storage


def published(spark: SparkSession, folder: str) -> list[int]:
    """Batch ids of the lists sent so far, oldest first."""
    return storage.committed(spark, folder, "batch_id=")


def read_published(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(f"{folder}/batch_id={batch_id}")


def rolling_top(
    changed: DataFrame,
    folder: str,
    batch_id: int,
    key: str,
    rank: Callable[[DataFrame], DataFrame],
    whole_table: Callable[[], DataFrame],
    keep: int = 10,
    committed: Sequence[int] = (),
) -> DataFrame:
    """The top list after a batch, from the list before it and the keys that changed.

    Counts only grow, so a key that is neither on the list nor changed cannot enter it, and
    the table need not be read again. The list of each batch is stored. The first one, which
    has none before it, ranks the whole table; so does one after a gap: of the table's ``committed``
    batches some between the last list and this one were not ranked.
    """
    spark = changed.sparkSession
    stored = published(spark, folder)
    earlier = [n for n in stored if n < batch_id]
    gap = earlier and any(earlier[-1] < n < batch_id for n in committed)
    if earlier and not gap:
        before = read_published(spark, folder, earlier[-1])
        unchanged = before.join(changed.select(key), key, "left_anti")
        top = rank(unchanged.unionByName(changed.select(*before.columns)))
    else:
        top = rank(whole_table())
    top.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
    for n in earlier[:-keep]:
        storage.delete_folder(spark, f"{folder}/batch_id={n}")
    return read_published(spark, folder, batch_id)


def publish_if_grown(
    top: DataFrame, folder: str, batch_id: int, measure: str = "activity_count"
) -> bool:
    """Write the list if its high-water mark exceeds that of the last one sent.

    The state is the output itself. Only lists before ``batch_id`` count, so a replayed
    batch decides as it did the first time. What reaches the driver is one number each.
    """
    spark = top.sparkSession
    earlier = [n for n in published(spark, folder) if n < batch_id]
    previous = 0
    if earlier:
        previous = _mark(read_published(spark, folder, earlier[-1]), measure, 0)
    top = top.persist()
    try:
        grown = _mark(top, measure, previous) > previous
        if grown:
            # At most a hundred rows: one file, in display order.
            (
                top.coalesce(1)
                .sortWithinPartitions(F.desc(measure))
                .write.mode("overwrite")
                .parquet(f"{folder}/batch_id={batch_id}")
            )
        return grown
    finally:
        top.unpersist()


def _mark(rows: DataFrame, measure: str, previous: int) -> int:
    return high_water(rows, measure, previous).first()["high_water"]
