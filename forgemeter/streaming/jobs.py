"""The streaming statistics: three queries, each with its own checkpoint.

Every sink is a ``foreachBatch`` that writes with the executors into a changelog folder of the
batch's own number. A replayed batch has the same number and changes nothing that is stored, and a failed
write fails the query, so the checkpoint never passes rows that were not stored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forgemeter import schemas
from forgemeter.functions.cells import window_key
from forgemeter.operators.aggregates import (
    actor_stats,
    changed_language_stats,
    language_stats,
    repo_stats,
    window_activity,
)
from forgemeter.operators.flatten import flatten_events
from forgemeter.operators.messages import list_message
from forgemeter.operators.panes import pane_states
from forgemeter.operators.ranking import top_actors, top_repos
from forgemeter.plans.statistics import window_table
from forgemeter.session import ROCKSDB
from forgemeter.sources import changelog, seen, storage
from forgemeter.sources.landing import explode_pages
from forgemeter.streaming import outbox
from forgemeter.streaming.gate import publish_if_grown, read_published, rolling_top

LIVE = {"processingTime": "5 seconds"}
BACKFILL = {"availableNow": True}
UPDATE_KINDS = {"repo_stats": "RepoStatsUpdated", "actor_stats": "ActorStatsUpdated"}


@dataclass(frozen=True)
class JobConfig:
    """Where a job writes and how it runs.

    ``output_mode`` of the cumulative queries: ``update`` writes the keys that changed in a
    batch, ``complete`` writes every key every time and suits small key counts only.
    Micro-batches get their numbers in the tables from ``changelog.claim``, none below ``first_batch``: new
    checkpoints on tables that have batches already go on after them. After ``compact_every`` batches of
    a table its log is folded into a base (0: never); before that every ``tier_fan`` folders of a level become
    one, so a read is of one base and a number of folders that grows with the logarithm of the batches.
    """

    tables: str
    checkpoints: str
    trigger: dict = field(default_factory=lambda: dict(LIVE))
    output_mode: str = "update"
    watermark: str = schemas.WATERMARK
    state_store: str = ROCKSDB
    first_batch: int = 0
    compact_every: int = 200
    tier_fan: int = changelog.FAN


@contextmanager
def _state_store(spark: SparkSession, provider: str) -> Iterator[None]:
    """A query takes its settings when it starts; the session gets its own back."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, provider)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def start_query(
    result: DataFrame,
    config: JobConfig,
    name: str,
    mode: str,
    sink: Callable[[DataFrame, int], None],
    tables: Sequence[changelog.KeyedTable] = (),
) -> StreamingQuery:
    """Start a query whose micro-batches have numbers of their own in the ``tables`` that it writes."""
    checkpoint = f"{config.checkpoints}/{name}"

    def numbered(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        generation = json.loads(storage.read_text(session, f"{checkpoint}/metadata"))["id"]
        number = changelog.claim(
            session, config.tables, generation, batch_id, config.first_batch, name, tables
        )
        sink(batch, number)

    writer = (
        result.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**config.trigger)
        .foreachBatch(numbered)
    )
    with _state_store(result.sparkSession, config.state_store):
        return writer.start()


def start_window_job(events: DataFrame, config: JobConfig) -> StreamingQuery:
    """Changed windows of each batch to both window tables."""
    activity = window_activity(events.withWatermark("event_ts", config.watermark))

    def sink(batch: DataFrame, batch_id: int) -> None:
        # Two tables from one batch: without the cache the state would be merged twice.
        batch.persist()
        try:
            if batch.isEmpty():
                return
            for table, measure in (
                (changelog.NEW_REPOS, "repo_count"),
                (changelog.PUSH_SPEED, "push_count"),
            ):
                changelog.write_batch(
                    window_table(batch, measure), config.tables, table, batch_id
                )
                _compact(batch.sparkSession, config, table)
        finally:
            batch.unpersist()

    written = (changelog.NEW_REPOS, changelog.PUSH_SPEED)
    return start_query(activity, config, "windows", "update", sink, written)


def start_pane_job(
    events: DataFrame, config: JobConfig, pane: str = schemas.WINDOW_SLIDE
) -> StreamingQuery:
    """Changed panes of each batch to the table of pane states, which readers merge over any range
    (``panes.range_states``). An event updates one pane, whatever windows are read later."""
    states = pane_states(events.withWatermark("event_ts", config.watermark), pane)

    def sink(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.withColumn("row_key", window_key(F.col("pane_start")))
        changelog.write_batch(keyed, config.tables, changelog.PANES, batch_id)
        _compact(batch.sparkSession, config, changelog.PANES)

    return start_query(states, config, "panes", "update", sink, (changelog.PANES,))


def start_repo_job(
    events: DataFrame,
    rankings: DataFrame,
    config: JobConfig,
    scan_limit: int | None = None,
    publish: bool = False,
    language_every: int = 1,
) -> StreamingQuery:
    """Repository totals, the language totals that follow from them, and the top list.

    Two aggregates cannot follow each other in one streaming query, so the language totals
    are kept per batch: the rows that its repositories had before are taken out of the last totals and
    their new rows added, so a trigger costs what its batch holds and not what the table does. The first
    totals, and those in complete mode, are of all repositories; with ``language_every`` above 1, once for so many batches, and
    ``refresh_languages`` brings in the last ones. With ``language_every=0`` the job leaves them alone and
    ``refresh_languages`` keeps them current on a schedule of its own, as suits large tables.
    """
    stats = repo_stats(events)

    def sink(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if not _store(batch, config.tables, changelog.REPO, batch_id):
            return
        if language_every and _batches_behind(session, config.tables, batch_id) >= language_every:
            totals = _language_totals(session, config, rankings, batch_id)
            changelog.write_batch(totals, config.tables, changelog.LANGUAGE, batch_id)
        if publish:
            _publish(batch, batch_id, config, changelog.REPO, top_repos, scan_limit)
        _compact(session, config, changelog.REPO)
        _compact(session, config, changelog.LANGUAGE)

    written = (changelog.REPO, changelog.LANGUAGE)
    return start_query(stats, config, "repos", config.output_mode, sink, written)


def _language_totals(
    spark: SparkSession, config: JobConfig, rankings: DataFrame, batch_id: int
) -> DataFrame:
    root, repo = config.tables, changelog.REPO
    if config.output_mode == "complete":
        # The batch as stored: it holds every key, so nothing has to be merged.
        return language_stats(changelog.read_batch(spark, root, repo, batch_id, blank_key=True), rankings)
    known = max(
        (n for n in changelog.known_batches(spark, root, changelog.LANGUAGE) if n < batch_id), default=None
    )
    batches = [n for n in changelog.committed_batches(spark, root, repo) if n <= batch_id]
    changed = [n for n in batches if known is not None and n > known]
    # A base later than the last totals hides which keys have changed since, and so does a vacuumed log.
    hidden = known is None or any(
        known < n < batch_id and n not in changed for n in changelog.known_batches(spark, root, repo)
    ) or not changelog.log_is_whole(spark, root, repo, known)
    if hidden or not changelog.readable_as_of(spark, root, repo, known):
        return language_stats(changelog.read_latest(spark, root, repo, batch_id), rankings)
    keys = None
    for n in changed:
        more = changelog.read_batch(spark, root, repo, n, blank_key=True).select(repo.key)
        keys = more if keys is None else keys.unionAll(more)
    keys = keys.distinct()
    if changed == [batch_id]:
        new = changelog.read_batch(spark, root, repo, batch_id, blank_key=True)
    else:
        new = changelog.read_keys(spark, root, repo, keys, batch_id)
    old = changelog.read_keys(spark, root, repo, keys, known)
    totals = changelog.read_latest(spark, root, changelog.LANGUAGE, known)
    return changed_language_stats(totals, old, new, rankings)


def _batches_behind(spark: SparkSession, root: str, batch_id: int) -> int:
    """Repository batches up to this one that the stored language totals do not know yet."""
    newest = changelog.known_batches(spark, root, changelog.LANGUAGE)
    known = max((n for n in newest if n < batch_id), default=-1)
    return sum(known < n <= batch_id for n in changelog.known_batches(spark, root, changelog.REPO))


def refresh_languages(spark: SparkSession, root: str, rankings: DataFrame) -> int | None:
    """Rebuild the language totals from the newest repository table; returns its batch id."""
    newest = changelog.last_batch(spark, root, changelog.REPO)
    if newest is not None:
        repos = changelog.read_latest(spark, root, changelog.REPO, newest)
        changelog.write_batch(language_stats(repos, rankings), root, changelog.LANGUAGE, newest)
    return newest


def _compact(spark: SparkSession, config: JobConfig, table: changelog.KeyedTable) -> None:
    changelog.compact_when_due(spark, config.tables, table, config.compact_every, config.tier_fan)


def _store(batch: DataFrame, root: str, table: changelog.KeyedTable, batch_id: int) -> bool:
    """Write the batch; false when it had no rows. The written files are asked, not the
    batch: every action on the batch merges the state anew."""
    changelog.write_batch(batch, root, table, batch_id)
    stored = changelog.read_batch(batch.sparkSession, root, table, batch_id, blank_key=True)
    return not stored.isEmpty()


def _publish(
    batch: DataFrame,
    batch_id: int,
    config: JobConfig,
    table: changelog.KeyedTable,
    rank: Callable[..., DataFrame],
    scan_limit: int | None,
) -> None:
    """Renew the top list and send it if its greatest activity has grown.

    The batch as stored is read back: the streaming state must not be merged again.
    """
    session, root = batch.sparkSession, config.tables

    def whole_table() -> DataFrame:
        return changelog.read_table(session, root, table, batch_id)

    kind = table.name.removesuffix("_stats")
    if scan_limit is None:
        changed = changelog.read_batch(session, root, table, batch_id)
        top = rolling_top(
            changed, f"{root}/{kind}_top", batch_id, table.key, rank, whole_table,
            committed=changelog.known_batches(session, root, table),
        )
    else:
        top = rank(whole_table(), scan_limit)
    if publish_if_grown(top, f"{root}/{kind}_updates", batch_id):
        sent = read_published(session, f"{root}/{kind}_updates", batch_id)
        message = list_message(
            sent, UPDATE_KINDS[table.name], ["activity_count", table.key], descending=True
        )
        outbox.post(message, root, f"{kind}_updates", batch_id)


def start_actor_job(
    events: DataFrame,
    config: JobConfig,
    scan_limit: int | None = None,
    publish: bool = False,
) -> StreamingQuery:
    """Events per contributor."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        if _store(batch, config.tables, changelog.ACTOR, batch_id) and publish:
            _publish(batch, batch_id, config, changelog.ACTOR, top_actors, scan_limit)
        _compact(batch.sparkSession, config, changelog.ACTOR)

    return start_query(
        actor_stats(events), config, "actors", config.output_mode, sink, (changelog.ACTOR,)
    )


def start_all(
    events: DataFrame, rankings: DataFrame, config: JobConfig, publish: bool = True
) -> list[StreamingQuery]:
    """The three queries over one stream of clean events.

    Each query reads its source on its own. Feed them the landed clean events
    (``land_clean_events``), so that the topic is read and its JSON parsed only once.
    """
    return [
        start_window_job(events, config),
        start_repo_job(events, rankings.cache(), config, publish=publish),
        start_actor_job(events, config, publish=publish),
    ]


def start_page_job(
    pages: DataFrame, root: str, config: JobConfig, buckets: int = seen.BUCKETS
) -> StreamingQuery:
    """Landed pages to flat events below ``root``, each id once over all batches and checkpoints, with no
    state to keep: the ids seen are those stored."""
    flat = flatten_events(explode_pages(pages))

    def sink(batch: DataFrame, batch_id: int) -> None:
        seen.store_run(batch, root, batch_id, buckets=buckets)

    return start_query(flat, config, "pages", "append", sink)


def land_clean_events(
    events: DataFrame, path: str, config: JobConfig, name: str = "landing"
) -> StreamingQuery:
    """Clean events of a stream to Parquet files, exactly once; ``name`` is that of its checkpoint."""
    return (
        events.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{config.checkpoints}/{name}")
        .trigger(**config.trigger)
        .start()
    )
