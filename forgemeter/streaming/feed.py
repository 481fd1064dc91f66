"""Incremental window feed: windows not sent before, oldest first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forgemeter import schemas
from forgemeter.operators.messages import item_messages, list_messages
from forgemeter.operators.ranking import high_water
from forgemeter.session import new_run_folder
from forgemeter.sources import changelog, storage
from forgemeter.streaming import outbox
from forgemeter.streaming.jobs import JobConfig, start_query


def rounds_sent(spark: SparkSession, folder: str) -> list[int]:
    return storage.committed(spark, folder, "round=")


def last_seen(spark: SparkSession, folder: str, before: int | None = None) -> int:
    """Start of the newest window sent (in rounds before ``before``), 0 when none was."""
    rounds = [n for n in rounds_sent(spark, folder) if before is None or n < before]
    if not rounds:
        return 0
    newest = spark.read.schema(schemas.WINDOW_COUNT).parquet(f"{folder}/round={rounds[-1]}")
    return high_water(newest, "window_start").first()["high_water"]


def send_new_windows(
    spark: SparkSession,
    root: str,
    table: changelog.KeyedTable,
    folder: str,
    turn: int | None = None,
) -> int | None:
    """Append the windows after the mark to the feed as one round; the mark moves with it.

    Returns the round, or None when there was nothing new. A window is sent once: a count
    that grows later shows in the table, not in the feed. ``turn`` names the round, so that
    a replay overwrites it.
    """
    if turn is None:
        turn = max(rounds_sent(spark, folder), default=-1) + 1
    fresh = changelog.read_since(spark, root, table, last_seen(spark, folder, turn))
    if fresh.isEmpty():
        return None
    (
        fresh.repartitionByRange("window_start")
        .sortWithinPartitions("window_start")
        .write.mode("overwrite")
        .parquet(f"{folder}/round={turn}")
    )
    return turn


def start_feed(
    spark: SparkSession,
    root: str,
    table: changelog.KeyedTable,
    kind: str,
    config: JobConfig,
) -> StreamingQuery:
    """Feed a window table as it grows, and put one message per new window in the outbox.

    The changes only say that there is something to read; what is sent is read from the
    table, so a window that changed twice since the last round is sent once.
    """
    folder = f"{root}/{table.name}_feed"

    def sink(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if batch.isEmpty():
            return
        turn = send_new_windows(session, root, table, folder, batch_id)
        if turn is not None:
            sent = session.read.schema(table.stored).parquet(f"{folder}/round={turn}")
            outbox.post(item_messages(sent, kind), root, f"{table.name}_feed", turn)

    changes = changelog.stream_changes(spark, root, table)
    return start_query(changes, config, f"{table.name}_feed", "append", sink)


LANGUAGE_FEED = "language_feed"


def send_languages(spark: SparkSession, root: str) -> int | None:
    """Post the newest language totals as one list, in parts if it is long, under the number of their batch.
    Totals that are posted already are not posted again. Returns the batch, or None."""
    newest = changelog.last_batch(spark, root, changelog.LANGUAGE)
    sent = storage.committed(spark, f"{root}/outbox/source={LANGUAGE_FEED}", "batch_id=")
    if newest is None or newest in sent:
        return None
    totals = changelog.read_table(spark, root, changelog.LANGUAGE, newest)
    staging = new_run_folder(spark, "messages")
    try:
        parts = list_messages(totals, "LanguageStatsSnapshot", ["language"], staging)
        outbox.post(parts, root, LANGUAGE_FEED, newest)
    finally:
        storage.delete_folder(spark, staging)
    return newest


def start_language_feed(spark: SparkSession, root: str, config: JobConfig) -> StreamingQuery:
    """``send_languages`` at each trigger: the ticks only say that it is time to look."""
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()

    def sink(batch: DataFrame, batch_id: int) -> None:
        send_languages(batch.sparkSession, root)

    return start_query(ticks, config, LANGUAGE_FEED, "append", sink)


def read_feed(spark: SparkSession, folder: str, table: changelog.KeyedTable) -> DataFrame:
    """All windows sent, with the round that sent them."""
    rounds = rounds_sent(spark, folder)
    schema = table.stored.fieldNames()
    if not rounds:
        return spark.createDataFrame([], table.stored).withColumn("round", F.lit(0).cast("long"))
    return (
        spark.read.option("basePath", folder)
        .parquet(*[f"{folder}/round={n}" for n in rounds])
        .select(*schema, F.col("round").cast("long").alias("round"))
    )
