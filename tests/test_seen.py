"""Ids over several runs, and rows that come too late."""

import pytest
from pyspark.sql import functions as F

from forgemeter.sources import seen
from forgemeter.streaming import jobs, metrics
from tests.conftest import rows

SCHEMA = "event_id string, value long"


def stored(spark, root):
    return rows(seen.read_runs(spark, root, spark.createDataFrame([], SCHEMA).schema))


def test_each_id_is_stored_once(spark, folder):
    def run(number, *pairs):
        return seen.store_run(spark.createDataFrame(list(pairs), SCHEMA), folder, number, buckets=4)

    assert run(0)
    assert stored(spark, folder) == []
    assert run(1, ("a", 1), ("b", 2), ("b", 2), (None, 9))
    assert run(2, ("b", 7), ("c", 3), ("", 4))
    assert not run(2, ("d", 5))  # a replay changes nothing
    assert run(7, ("a", 8), ("c", 8))
    assert stored(spark, folder) == [("", 4, 2), ("a", 1, 1), ("b", 2, 1), ("c", 3, 2)]
    with pytest.raises(ValueError):
        seen.store_run(spark.createDataFrame([], SCHEMA), folder, 8, buckets=5)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(("seen_", "run_"))]


def test_first_copy_stays(spark, folder):
    events = spark.createDataFrame(
        [("a", 2, 5), ("a", 1, 3), ("a", 3, 4)], "event_id string, value long, arrival long"
    )
    seen.store_run(events, folder, 0, buckets=4)
    assert stored(spark, folder) == [("a", 1, 0)]


def test_an_unfinished_run_is_done_again(spark, folder):
    """A run that died before its rename left files that nobody reads."""
    events = spark.createDataFrame([("a", 1)], SCHEMA)
    seen.store_run(events, folder, 0, buckets=4)
    events.write.parquet(f"{folder}/pending/dead")
    assert seen.store_run(spark.createDataFrame([("b", 2)], SCHEMA), folder, 1, buckets=4)
    assert stored(spark, folder) == [("a", 1, 0), ("b", 2, 1)]


def test_stored_ids_are_not_shuffled(spark, folder):
    events = spark.range(1000).select(F.col("id").cast("string").alias("event_id"), "id")
    seen.store_run(events, folder, 0, buckets=4)
    with seen._bucketed(spark, folder, events.schema, "event_id", 4) as table:
        new = seen.unseen(events, table, "event_id", 4)
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert new.count() == 0
    side = plan[plan.rindex("+- Sort") :]  # the join's second child
    assert "Bucketed: true" in side and "Exchange" not in side
    assert "ReadSchema: struct<event_id:string>" in side


def test_late_events_are_counted(spark, folder):
    counted, path = metrics.RunMetrics(), f"{folder}/landed"
    config = jobs.JobConfig(
        tables=folder, checkpoints=f"{folder}/c", trigger=jobs.BACKFILL, watermark="1 hour"
    )
    schema = "event_id long, event_ts timestamp"
    spark.streams.addListener(counted)
    late = []
    try:
        hours = [[(1, 0), (2, 10)], [(3, 9), (4, 8), (5, 0), (1, 0)], [(6, 11)]]
        for part in hours:
            frame = spark.createDataFrame(part, "event_id long, hour int").select(
                "event_id",
                F.timestamp_seconds(F.lit(1_705_276_800) + 3600 * F.col("hour")).alias("event_ts"),
            )
            frame.write.mode("append").parquet(path)
            once = spark.readStream.schema(schema).parquet(path).withWatermark("event_ts", "1 hour")
            query = jobs.land_clean_events(
                once.dropDuplicatesWithinWatermark(["event_id"]), f"{folder}/out", config, "late"
            )
            query.awaitTermination()
            late.append(metrics.late_rows(query))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(counted)
    # At hour 10 the mark is 9, and what is not after it is late.
    assert late == [0, 4, 0]
    assert rows(spark.read.parquet(f"{folder}/out"), "event_id") == [(1,), (2,), (6,)]
    assert sum(counted.late.values()) == 4
