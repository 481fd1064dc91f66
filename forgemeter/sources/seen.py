"""Events of landing runs, each id stored once however many runs bring it.

``<root>/runs/run=N`` holds the events that were new in run N, as files bucketed by id. They are at the
same time the ids seen so far: a later run reads only the id column of them, bucket by bucket, so what is
stored is never shuffled again. One rename commits events and ids together. The shuffled rows of a run are its
own, one per id and task. One run writes to a root at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from forgemeter.operators.dedup import dedup_events
from forgemeter.sources import storage

BUCKETS = 64


def _fixed_buckets(spark: SparkSession, root: str, buckets: int) -> None:
    """The first run fixes the number of buckets; another one later is refused."""
    known = [n.removeprefix("buckets-") for n in storage.names(spark, f"{root}/buckets-*")]
    if not known:
        storage.create(spark, f"{root}/buckets-{buckets}")
    elif known != [str(buckets)]:
        raise ValueError(f"{root} has {known[0]} buckets, not {buckets}")


def runs(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the committed runs."""
    return storage.committed(spark, f"{root}/runs", "run=")


@contextmanager
def _bucketed(
    spark: SparkSession, root: str, schema: StructType, key: str, buckets: int
) -> Iterator[DataFrame]:
    """The stored runs as a bucketed table, known to the catalog while it is in use."""
    name = f"seen_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}, run BIGINT) USING parquet PARTITIONED BY (run) "
        f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{root}/runs'"
    )
    try:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def unseen(events: DataFrame, stored: DataFrame, key: str, buckets: int) -> DataFrame:
    """One row per id of ``events`` that ``stored``, bucketed by it, does not have; of copies the first to
    arrive, where ``arrival`` is known. Rows without an id are dropped.

    Copies shrink to one row per task before the shuffle, so a hot id is no heavy bucket."""
    known = events.where(F.col(key).isNotNull())
    if "arrival" in events.columns:
        once = dedup_events(known, first_by="arrival", key=key).drop("arrival")
    else:
        once = dedup_events(known, key=key)
    return once.repartition(buckets, key).join(stored.select(key).hint("merge"), key, "left_anti")


def store_run(
    events: DataFrame, root: str, run: int, key: str = "event_id", buckets: int = BUCKETS
) -> bool:
    """Store the events whose id no run had. A run that is stored already stays as it is (false)."""
    spark = events.sparkSession
    _fixed_buckets(spark, root, buckets)
    storage.ensure_folder(spark, f"{root}/runs")
    target = f"{root}/runs/run={run}"
    if run in runs(spark, root):
        return False
    pending, name = f"{root}/pending/{uuid.uuid4().hex}", f"run_{uuid.uuid4().hex}"
    schema = StructType([f for f in events.schema if f.name != "arrival"])
    with _bucketed(spark, root, schema, key, buckets) as stored:
        new = unseen(events, stored, key, buckets).select(*schema.names)
        new.write.bucketBy(buckets, key).option("path", pending).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    storage.move_folder(spark, pending, target)
    return True


def read_runs(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """All stored events with the ``run`` that brought them first."""
    stored = spark.read.schema(schema).parquet(storage.ensure_folder(spark, f"{root}/runs"))
    run = F.col("run") if "run" in stored.columns else F.lit(None)
    return stored.select(*schema.names, run.cast("long").alias("run"))
